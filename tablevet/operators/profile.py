"""Column and dataset profiles.

One value-count job serves the distinct, class, constant, identifier, type and task operators, and one
that counts rows by the places of their missing values the others: values are counted per (dataset, column,
value), then folded per (dataset, column), each store in its own type. Both steps aggregate before their shuffle, so a value or dataset that holds a third of all cells
arrives as a few partial counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablevet.functions.values import NUMERIC_DTYPES, STORE_TYPES, value_key
from tablevet.limits import Limits
from tablevet.sources.fleet import KEY, Fleet, dataset_code, numbered

MB = 1024 * 1024


def share(part: Column, whole: Column) -> Column:
    """``part / whole``; NULL when the whole is 0."""
    return F.when(whole != 0, part / whole)


def names_where(condition: Column) -> Column:
    """Names of the columns that meet ``condition``, in table order; one dataset's columns only."""
    picked = F.collect_list(F.when(condition, F.struct("ordinal", "column_name")))
    return F.transform(F.array_sort(picked), lambda c: c["column_name"])


def store_code(store: str | Column) -> Column:
    """A number that stands for one store of a dataset, the same for all its rows; missing for a dataset
    without a name."""
    store = F.lit(store) if isinstance(store, str) else store
    named = F.col(KEY[0]).isNotNull() & F.col(KEY[1]).isNotNull()
    return F.when(named, F.xxhash64(*KEY, store))


def column_code(of_store: Column) -> Column:
    """A number that stands for a column of a fleet, so that its values are not each counted beside the
    names of its dataset."""
    return of_store.bitwiseXOR(F.col("slot").cast("bigint"))


def missing_counts(fleet: Fleet) -> DataFrame:
    """Rows and missing values of every column, by its code. Rows are counted by the places of their missing
    values; the values are not told apart, and where no query asks for them not made."""
    kinds = fleet.rows.select(dataset_code(), F.coalesce("fingerprint.gaps", F.lit("")).alias("_gaps"))
    kinds = kinds.groupBy("_of", "_gaps").agg(F.count(F.lit(1)).alias("_n"))
    code = column_code(store_code(F.col("store"))).alias("_column")
    places = numbered(fleet.columns).select("_of", "_at", code).distinct()
    gap = F.substring(F.col("_gaps"), F.col("_at") + 1, F.lit(1)) == "1"
    return kinds.join(places, "_of").groupBy("_column").agg(
        F.sum("_n").alias("n_rows"), F.sum(F.when(gap, F.col("_n")).otherwise(0)).alias("n_missing")
    )


def value_counts(fleet: Fleet) -> DataFrame:
    """Distinct values, value frequencies and bytes of texts of every column, by its code."""
    parts = []
    for store in STORE_TYPES:
        texts = store == "texts"
        key = value_key(F.col("_value")) if texts else F.col("_value")
        size = F.sum(F.octet_length("_value")) if texts else F.lit(0).cast("bigint")
        counts = (
            fleet.rows.select(store_code(store).alias("_store"), F.posexplode(store).alias("slot", "_value"))
            .groupBy(column_code(F.col("_store")).alias("_column"), key.alias("_key"))
            .agg(F.count("*").alias("_n"), size.alias("_bytes"))
        )
        found = F.when(F.col("_key").isNotNull(), F.col("_n"))
        parts.append(
            counts.groupBy("_column").agg(
                F.count("_key").alias("n_unique"),
                F.min(found).alias("min_count"),
                F.max(found).alias("max_count"),
                F.sum("_bytes").alias("text_bytes"),
            )
        )
    # A store's columns are in one part. Told to be one row each, they need not be joined where not asked for.
    return reduce(DataFrame.unionByName, parts).groupBy("_column").agg(
        *[F.max(c).alias(c) for c in ("n_unique", "min_count", "max_count", "text_bytes")]
    )


def column_profile(fleet: Fleet) -> DataFrame:
    """Rows, missing values, distinct values and value frequencies of every column.

    Spark leaves out the counts of values, or of missing ones, where a query asks for none of them.
    """
    return (
        fleet.columns.withColumn("_column", column_code(store_code(F.col("store"))))
        .join(missing_counts(fleet), "_column", "left")
        .join(value_counts(fleet), "_column", "left")
        .drop("kind", "declared", "store", "slot", "_column")
        .na.fill(0, ["n_rows", "n_missing", "n_unique", "text_bytes"])
    )


def table_shape(profile: DataFrame) -> DataFrame:
    """Rows and features; the target is no feature."""
    return profile.groupBy(*KEY).agg(
        F.max("n_rows").alias("n_instances"),
        F.count_if(~F.col("is_target")).alias("n_features"),
    )


def columns_with_missing(profile: DataFrame) -> DataFrame:
    return profile.groupBy(*KEY).agg(
        F.sum("n_missing").alias("missing_cells"),
        names_where(F.col("n_missing") > 0).alias("columns_with_missing"),
    )


def missing_rate(profile: DataFrame, digits: int | None = None) -> DataFrame:
    """Missing cells over cells, target included; NULL for an empty table."""
    rate = share(F.sum("n_missing"), F.sum("n_rows"))
    rate = rate if digits is None else F.round(rate, digits)
    return profile.groupBy(*KEY).agg(rate.alias("missing_rate"))


def class_counts(df: DataFrame, target: str) -> DataFrame:
    """Rows per target value of one table; missing targets are no class."""
    return (
        df.select(target).na.drop(subset=[target]).groupBy(target).agg(F.count("*").alias("n_rows"))
    )


def class_summary(counts: DataFrame) -> DataFrame:
    return counts.agg(
        F.count("*").alias("n_classes"),
        F.min("n_rows").alias("smallest_class"),
        F.max("n_rows").alias("largest_class"),
    )


def imbalance_ratio(n_classes: Column, smallest: Column, largest: Column) -> Column:
    return F.when(n_classes >= 2, largest / smallest).otherwise(F.lit(1.0))


def p_to_n_ratio(n_features: Column, n_instances: Column) -> Column:
    return F.when(n_instances > 0, n_features / n_instances).otherwise(F.lit(0.0))


def duplicate_rows(fleet: Fleet) -> DataFrame:
    """Rows beyond the first of each kind; only fingerprints are shuffled, never whole rows."""
    kinds = fleet.rows.groupBy(*KEY, "fingerprint.a", "fingerprint.b").agg(F.count("*").alias("_n"))
    return kinds.groupBy(*KEY).agg((F.sum("_n") - F.count("*")).alias("duplicate_rows"))


def is_constant() -> Column:
    return F.col("n_unique") == 1


def is_unique_valued() -> Column:
    return (F.col("n_unique") == F.col("n_rows")) & (F.col("n_rows") > 1)


def constant_list(profile: DataFrame) -> DataFrame:
    return profile.groupBy(*KEY).agg(names_where(is_constant()).alias("constant_columns"))


def unique_list(profile: DataFrame) -> DataFrame:
    """Columns without a repeated value, floats and target included."""
    return profile.groupBy(*KEY).agg(names_where(is_unique_valued()).alias("high_cardinality_columns"))


def type_counts() -> list[Column]:
    dtype = F.col("dtype")
    return [
        F.count_if(dtype.isin(NUMERIC_DTYPES)).alias("numeric"),
        F.count_if(dtype == "string").alias("categorical"),
        F.count_if(F.col("n_unique") == 2).alias("binary"),
        F.count_if(dtype == "datetime").alias("datetime"),
    ]


def feature_types(profile: DataFrame) -> DataFrame:
    """Columns by type, target included; binary means two distinct values of any type."""
    return profile.groupBy(*KEY).agg(*type_counts())


def size_mb() -> Column:
    width = (
        F.when(F.col("dtype") == "string", F.col("text_bytes"))
        .when(F.col("dtype") == "bool", F.col("n_rows"))
        .otherwise(F.col("n_rows") * 8)
    )
    return F.round(F.sum(width) / MB, 3)


def size_estimate(profile: DataFrame) -> DataFrame:
    """8 bytes per number or time, 1 per bool, the UTF-8 length per text."""
    return profile.groupBy(*KEY).agg(size_mb().alias("memory_usage_mb"))


def of_target(value: Column) -> Column:
    """Value of the dataset's one target column, inside an aggregation by dataset."""
    return F.max(F.when(F.col("is_target"), value))


def catalog_task(dtype: Column, n_unique: Column, n_rows: Column, limits: Limits) -> Column:
    """Task by the target's type; whole numbers count as classes while there are few of them."""
    few = (n_unique <= limits.int_class_values) | (n_unique < n_rows * limits.int_class_share)
    return (
        F.when(dtype.isin("string", "bool"), "classification")
        .when(dtype == "float", "regression")
        .when((dtype == "int") & few, "classification")
        .when(dtype == "int", "regression")
        .otherwise("unknown")
    )


def infer_task(profile: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Catalog task of each dataset from its target column."""
    return profile.groupBy(*KEY).agg(
        of_target(F.col("column_name")).alias("target_variable"),
        catalog_task(
            of_target(F.col("dtype")), of_target(F.col("n_unique")), of_target(F.col("n_rows")), limits
        ).alias("task"),
    )


def dataset_metrics(profile: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The record that collection conditions are checked against.

    A target of numbers with many values is regression; every other target is classification.
    No target, or an empty one, is regression of unknown subtype.
    """
    base = profile.groupBy(*KEY).agg(
        F.max("n_rows").alias("n_instances"),
        F.count_if(~F.col("is_target")).alias("n_features"),
        F.coalesce(of_target(F.col("n_unique")), F.lit(0)).alias("n_classes"),
        share(F.sum("n_missing"), F.sum("n_rows")).alias("missing_rate"),
        of_target(F.col("dtype")).alias("_dtype"),
        of_target(F.col("min_count")).alias("_smallest"),
        of_target(F.col("max_count")).alias("_largest"),
    )
    classes = F.col("n_classes")
    classed = (classes > 0) & (
        ~F.col("_dtype").isin(NUMERIC_DTYPES) | (classes <= limits.max_classes)
    )
    subtype = (
        F.when(~classed & (classes > 0), "continuous")
        .when(classed & (classes == 2), "binary")
        .when(classed & (classes > 2), "multiclass")
        .otherwise("unknown")
    )
    ratio = F.when(
        classed, imbalance_ratio(classes, F.col("_smallest"), F.col("_largest"))
    ).otherwise(F.lit(1.0))
    return base.select(
        *KEY,
        "n_instances",
        "n_features",
        "n_classes",
        "missing_rate",
        p_to_n_ratio(F.col("n_features"), F.col("n_instances")).alias("p_to_n_ratio"),
        F.when(classed, "classification").otherwise("regression").alias("task"),
        subtype.alias("task_subtype"),
        ratio.alias("imbalance_ratio"),
        F.lit(False).alias("temporal"),
        F.lit(False).alias("grouped"),
        F.lit(True).alias("academic_usage"),
    )


def dataset_profile(fleet: Fleet, limits: Limits = Limits()) -> DataFrame:
    """One nested record per dataset: task, structure, feature types and data quality."""
    profile = column_profile(fleet)
    n_unique, n_rows = of_target(F.col("n_unique")), of_target(F.col("n_rows"))
    records = profile.groupBy(*KEY).agg(
        F.struct(
            catalog_task(of_target(F.col("dtype")), n_unique, n_rows, limits).alias("type"),
            F.coalesce(of_target(F.col("column_name")), F.lit("unknown")).alias("target_variable"),
        ).alias("task"),
        F.max("n_rows").alias("_rows"),
        F.count("*").alias("_columns"),
        F.round(share(F.sum("n_missing"), F.sum("n_rows")), 4).alias("_rate"),
        size_mb().alias("_mb"),
        F.struct(*type_counts()).alias("feature_types"),
        F.struct(
            names_where(is_constant()).alias("constant_columns"),
            names_where(is_unique_valued()).alias("high_cardinality_columns"),
            names_where(F.col("n_missing") > 0).alias("columns_with_missing"),
        ).alias("data_quality"),
    )
    return records.join(duplicate_rows(fleet), KEY, "left").select(
        *KEY,
        "task",
        F.struct(
            F.col("_rows").alias("n_instances"),
            F.col("_columns").alias("n_features"),
            F.col("_rate").alias("missing_rate"),
            F.coalesce("duplicate_rows", F.lit(0)).alias("duplicate_rows"),
            F.col("_mb").alias("memory_usage_mb"),
        ).alias("structure"),
        "feature_types",
        "data_quality",
    )


def dataset_tags(metrics: DataFrame) -> DataFrame:
    """Descriptive tags of each dataset."""
    # The tag thresholds.
    rules = [
        ("imbalanced", F.col("imbalance_ratio") >= 3),
        ("clean", F.col("missing_rate") <= 0.05),
        ("small", F.col("n_instances") <= 1500),
        ("large", F.col("n_instances") >= 5000),
        ("high_dimensional", F.col("n_features") >= 50),
        ("low_dimensional", F.col("n_features") <= 10),
        ("temporal", F.col("temporal")),
        ("grouped", F.col("grouped")),
    ]
    tags = F.array_compact(F.array(*[F.when(rule, F.lit(tag)) for tag, rule in rules]))
    return metrics.withColumn("tags", tags)
