"""Ranking and shaping of the selected datasets."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablevet.functions.ordered import ranked

# The fields of a selection.
OUTPUT_FIELDS = [
    "dataset_id",
    "name",
    "task",
    "task_subtype",
    "target_variable",
    "source_repository",
    "source_id",
    "n_instances",
    "n_features",
    "n_classes",
    "missing_rate",
    "imbalance_ratio",
    "temporal",
    "grouped",
    "academic_usage",
    "license",
    "status",
]


BARE_VALUE = re.compile(r"(==|!=|=|<>)(\s*)([A-Za-z_]\w*)(?![\w(.])")


def quote_bare(expression: str, columns: list[str]) -> str:
    """Quote words that stand as values without quotes; columns and constants stay as they are."""
    known = {c.lower() for c in columns} | {"true", "false", "null"}

    def quoted(match: re.Match) -> str:
        op, gap, word = match.groups()
        return match[0] if word.lower() in known else f"{op}{gap}'{word}'"

    parts = re.split(r"('[^']*'|\"[^\"]*\")", expression)
    return "".join(p if i % 2 else BARE_VALUE.sub(quoted, p) for i, p in enumerate(parts))


def select_where(catalog: DataFrame, expression: str) -> DataFrame:
    """Rows that meet a text condition, read by Spark's own SQL parser; values may lack quotes."""
    return catalog.where(F.expr(quote_bare(expression, catalog.columns)))


def output_fields(catalog: DataFrame, fields: list[str] = OUTPUT_FIELDS) -> DataFrame:
    """The listed fields in order; absent ones are NULL."""
    present = set(catalog.columns)
    return catalog.select(
        *[F.col(f) if f in present else F.lit(None).cast("string").alias(f) for f in fields]
    )


def top_popular(passing: DataFrame, limit: int = 30) -> DataFrame:
    """The most downloaded ``limit`` datasets of each collection.

    Spark limits each task's groups to ``limit`` rows before the shuffle (WindowGroupLimit).
    """
    order = Window.partitionBy("collection_id").orderBy(F.desc_nulls_last("number_downloads"), "did")
    return passing.withColumn("popularity", F.row_number().over(order)).where(
        F.col("popularity") <= limit
    )


def sort_columns(keys: list[tuple[str, str]], tie: str) -> list[Column]:
    columns = [F.desc_nulls_last(f) if o == "desc" else F.asc_nulls_last(f) for f, o in keys]
    return [*columns, F.asc(tie)]


def preferred_sort(selection: DataFrame, keys: list[tuple[str, str]], tie: str = "dataset_id") -> DataFrame:
    """Rank of each dataset of each collection in the preferred order; ``tie`` must be unique."""
    ranks = ranked(selection, ["collection_id"], sort_columns(keys, tie), "sort_rank")
    return ranks.drop("sort_rank_total")


def preferred_keys(criteria: DataFrame) -> DataFrame:
    """(collection_id, keys): the order of each collection, taken from the fields its conditions use.

    Collections that look at the imbalance put the most imbalanced first; those with a condition on
    rows go from few rows to many, the others from many to few.
    """
    uses = lambda field: F.bool_or(F.col("field") == field)
    key = lambda field, order: F.struct(F.lit(field).alias("field"), order.alias("order"))
    imbalance = F.when(uses("imbalance_ratio"), key("imbalance_ratio", F.lit("desc")))
    rows = key("n_instances", F.when(uses("n_instances"), "asc").otherwise("desc"))
    return criteria.groupBy("collection_id").agg(F.array_compact(F.array(imbalance, rows)).alias("keys"))


def comparable(value: Column, order: Column, numeric: bool) -> Column:
    """A sort key that ascends where the value should, missing values last."""
    missing = value.isNull()
    if numeric:
        number = value.cast("double")
        missing = missing | F.isnan(number)
        number = F.when(order == "desc", -number).otherwise(number)
        text = F.lit("")
    else:
        # Complemented digits descend; the last character puts a longer text before its beginning.
        digits = F.hex(F.encode(value.cast("string"), "utf-8"))
        falling = F.concat(F.translate(digits, "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))
        text = F.when(order == "desc", falling).otherwise(digits)
        number = F.lit(0.0)
    return F.struct(
        missing.cast("int").alias("missing"),
        F.when(~missing, number).alias("number"),
        F.when(~missing, text).alias("text"),
    )


def sorted_by_collection(selection: DataFrame, keys: DataFrame, tie: str = "dataset_id") -> DataFrame:
    """``sort_rank`` of each dataset in its collection's own order.

    ``keys`` (collection_id, keys) lists fields and directions, another list for each collection. A row's
    keys are encoded as one value that compares like the list, so all collections are ranked in one
    range partitioning; a field outside ``selection`` is passed over. ``tie`` must be unique in a collection.
    """
    fields = {f.name: isinstance(f.dataType, (T.NumericType, T.BooleanType)) for f in selection.schema.fields}

    def encoded(k: Column) -> Column:
        key = F.lit(None)
        for name, numeric in fields.items():
            value = F.col(name).cast("int") if isinstance(selection.schema[name].dataType, T.BooleanType) else F.col(name)
            key = F.when(k["field"] == name, comparable(value, k["order"], numeric)).otherwise(key)
        return key

    known = F.filter("_keys", lambda k: k["field"].isin(list(fields)))
    rows = selection.join(keys.select("collection_id", F.col("keys").alias("_keys")), "collection_id", "left")
    rows = rows.withColumn("_key", F.coalesce(F.transform(known, encoded), F.array())).drop("_keys")
    ranks = ranked(rows, ["collection_id"], [F.asc("_key"), F.asc(tie)], "sort_rank")
    return ranks.drop("sort_rank_total", "_key")
