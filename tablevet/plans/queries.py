"""Registered queries: one per operator, each over whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablevet.functions import naming
from tablevet.limits import Limits
from tablevet.operators import catalog as cat
from tablevet.operators import criteria as crit
from tablevet.operators import manifest as man
from tablevet.operators import profile as prof
from tablevet.operators import scores, screening, selection, wide
from tablevet.plans.inputs import (
    METRIC_FIELDS,
    SPECS,
    TABLES,
    derived_fleet,
    lineitem_dirty,
    listing,
    load,
    metrics,
    part_collections,
    table_fleet,
    whole_fleet,
    written_criteria,
)
from tablevet.session import scratch_path, staged
from tablevet.sources import sinks
from tablevet.sources import listing as lst
from tablevet.sources.ledger import Ledger
from tablevet.sources.csv_fleet import discover, infer_dtypes, read_fleet
from tablevet.sources.fleet import KEY, Fleet, cell_digests, row_digests, skipped_columns, to_cells, to_fleet

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# The test tables exceed the default row limit, and several have few features.
LARGE = Limits(max_rows=None)
NARROW = Limits(max_rows=None, min_features=2)


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def listed(column: str) -> Column:
    """A list of names as text, so that results have flat columns."""
    return F.array_join(column, ",").alias(column)


def rounded(*columns: str, digits: int = 6) -> list[Column]:
    return [F.round(c, digits).alias(c) for c in columns]


# ---- scans, sources, sinks -------------------------------------------------------------------


@query
def listing_scan(spark, sf_dir):
    return lst.scan_listing(listing(spark, sf_dir), lst.Bounds(n_classes=2)).select(
        "did", "name", "n_instances", "n_features", "number_downloads"
    )


@query
def listing_scan_by_collection(spark, sf_dir):
    stored = staged(listing(spark, sf_dir), "listing")
    bounds = crit.collection_bounds(written_criteria(spark, sf_dir))
    return lst.scan_by_collection(stored, bounds).select("collection_id", "did", "n_instances", "n_features")


def raw_tree(spark: SparkSession, sf_dir: str, tables: list[str]) -> str:
    root = scratch_path(spark, "raw")
    for table in tables:
        df = load(spark, sf_dir, table)
        sinks.write_raw(df.drop(*skipped_columns(df)), root, "csv", table)
    return root


@query
def discovered(spark, sf_dir):
    found = discover(spark, raw_tree(spark, sf_dir, TABLES))
    return found.select(*KEY, (F.col("n_bytes") > 0).alias("has_data"))


@query
def csv_fleet_cells(spark, sf_dir):
    return row_digests(read_fleet(spark, raw_tree(spark, sf_dir, TABLES)).fleet)


BROKEN = ["no_header", "row_too_wide", "unclosed_quote", "invalid_utf8", "unreadable", "readable"]


def broken_tree(spark: SparkSession, sf_dir: str) -> str:
    """Every table as a CSV dataset with lines that cannot be read, of another kind for each."""
    root = scratch_path(spark, "broken")
    files = spark._jvm.org.apache.hadoop.fs
    for i, table in enumerate(TABLES):
        kind = BROKEN[i % len(BROKEN)]
        rows = load(spark, sf_dir, table)
        key = rows.select(F.col(rows.columns[0]).cast("string").alias("k"))
        line = F.concat(F.lit("v,"), F.col("k"))
        worst = {
            "row_too_wide": F.concat(line, F.lit(",more,")),
            "unclosed_quote": F.concat(F.lit('v,"'), F.col("k")),
            "invalid_utf8": F.concat(line, F.lit(b"\xff").cast("string")),
        }
        first = key.agg(F.min("k")).first()[0]
        lines = key.select(F.when(F.col("k") == first, worst.get(kind, line)).otherwise(line).alias("value"))
        lines = key.agg(F.lit("a,b").alias("value")).unionByName(lines).coalesce(1)
        folder = f"{root}/csv/{table}"
        if kind == "no_header":
            lines = lines.select(F.lit("").alias("value"))
        lines.write.text(folder)
        if kind == "unreadable":  # the name says that the lines are compressed
            path = files.Path(folder)
            system = path.getFileSystem(spark._jsc.hadoopConfiguration())
            for found in system.listStatus(path):
                if found.getPath().getName().startswith("part-"):
                    system.rename(found.getPath(), files.Path(f"{folder}/lines.txt.gz"))
    return root


@query
def csv_failed(spark, sf_dir):
    """Datasets that cannot be read, each with its reason."""
    return read_fleet(spark, broken_tree(spark, sf_dir), "*.txt*").failed


@query
def cells(spark, sf_dir):
    return cell_digests(to_cells(table_fleet(spark, sf_dir)))


@query
def inferred_dtypes(spark, sf_dir):
    return infer_dtypes(to_cells(table_fleet(spark, sf_dir)))


@query
def criteria_table(spark, sf_dir):
    """The sample conditions, with the number of datasets that pass their collection."""
    criteria = crit.criteria_df(spark, SPECS)
    candidates = metrics(spark, sf_dir).select("dataset_id", *METRIC_FIELDS)
    pairs = crit.passing_criteria_table(candidates, criteria, ["dataset_id"])
    passing = pairs.groupBy("collection_id").agg(F.count("*").alias("n_passing"))
    return criteria.drop("any_no", "group_no").join(passing, "collection_id", "left").na.fill(0, ["n_passing"])


@query
def raw_sink(spark, sf_dir):
    customer = load(spark, sf_dir, "customer")
    root = scratch_path(spark, "raw")
    sinks.write_raw(customer, root, "tables", "customer")
    return spark.read.schema(customer.schema).csv(f"{root}/tables/customer", header=True, escape='"')


def cataloged(spark: SparkSession, sf_dir: str, fleet: Fleet) -> DataFrame:
    return cat.catalog_profiles(prof.dataset_profile(fleet), listing(spark, sf_dir))


@query
def catalog_flat(spark, sf_dir):
    ledgers = [
        cat.flatten_profile(cataloged(spark, sf_dir, fleet))
        for fleet in (table_fleet(spark, sf_dir), derived_fleet(spark, sf_dir))
    ]
    return ledgers[0].unionByName(ledgers[1])


@query
def catalog_sink(spark, sf_dir):
    path = scratch_path(spark, "catalog")
    sinks.write_catalog(cat.flatten_profile(cataloged(spark, sf_dir, whole_fleet(spark, sf_dir))), path)
    return spark.read.parquet(path)


@query
def profile_sink(spark, sf_dir):
    path = scratch_path(spark, "profiles")
    profiles = cataloged(spark, sf_dir, whole_fleet(spark, sf_dir))
    sinks.write_profiles(profiles, path)
    return cat.flatten_profile(spark.read.schema(profiles.schema).json(path))


@query
def processed_sink(spark, sf_dir):
    path = scratch_path(spark, "processed")
    cleaned = screening.clean_fleet(whole_fleet(spark, sf_dir), NARROW, by_dataset=True)
    sinks.write_processed(cleaned, path, placed=True)
    return row_digests(sinks.read_processed(spark, path))


def whole_screen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return screening.screen(whole_fleet(spark, sf_dir), NARROW)


@query
def manifest_sink(spark, sf_dir):
    screened = whole_screen(spark, sf_dir)
    header, entries = man.manifest_header(screened, NARROW), man.manifest_entries(screened)
    path = scratch_path(spark, "manifest")
    sinks.write_manifest(header, entries, path)
    found = spark.read.schema(entries.schema).json(f"{path}/entries").select(
        *KEY, F.col("frozen_metadata.structure.n_instances").alias("n_instances")
    )
    totals = spark.read.schema(header.schema).json(f"{path}/header").select(
        F.col("source_collection").alias("collection_id"),
        "total_matched_before_clean",
        "final_dataset_count",
    )
    return totals.join(found, "collection_id", "left")


@query
def export_rows(spark, sf_dir):
    fleet = whole_fleet(spark, sf_dir)
    screened = staged(screening.screen(fleet, NARROW), "screened")
    cleaned = screening.clean_fleet(fleet, NARROW, screened=screened, by_dataset=True)
    path = scratch_path(spark, "export")
    sinks.export(man.manifest_entries(screened), cleaned, path, "derived", placed=True)
    return row_digests(sinks.read_processed(spark, path))


@query
def export_all_rows(spark, sf_dir):
    """The export of all collections."""
    fleet = whole_fleet(spark, sf_dir)
    screened = staged(screening.screen(fleet, NARROW), "screened")
    cleaned = screening.clean_fleet(fleet, NARROW, screened=screened, by_dataset=True)
    path = scratch_path(spark, "export")
    sinks.export(man.manifest_entries(screened), cleaned, path, placed=True)
    return row_digests(sinks.read_processed(spark, path))


@query
def export_readback(spark, sf_dir):
    """The export of all collections as CSV files, read again as a fleet."""
    fleet = whole_fleet(spark, sf_dir)
    screened = staged(screening.screen(fleet, NARROW), "screened")
    cleaned = screening.clean_fleet(fleet, NARROW, screened=screened)
    path = scratch_path(spark, "export")
    sinks.export(man.manifest_entries(screened), cleaned, path, fmt="csv")
    return row_digests(read_fleet(spark, f"{path}/data", "*").fleet)


@query
def export_missing(spark, sf_dir):
    fleet = whole_fleet(spark, sf_dir)
    processed = screening.clean_fleet(fleet, NARROW).columns.where(F.col("collection_id") != "derived")
    return man.export_missing(man.manifest_entries(screening.screen(fleet, NARROW)), processed)


@query
def resolved_collections(spark, sf_dir):
    return man.resolved_collections(man.manifest_header(whole_screen(spark, sf_dir), NARROW))


def part_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics(spark, sf_dir).select(
        F.col("task").alias("collection_id"), "dataset_id", F.lit("cataloged").alias("status")
    )


def part_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics(spark, sf_dir).where(F.col("status") == "active").select(
        F.col("task").alias("collection_id"),
        "dataset_id",
        F.when(F.col("n_features") >= 5, "validated").otherwise("rejected").alias("status"),
    )


@query
def status_update(spark, sf_dir):
    return cat.apply_status(part_catalog(spark, sf_dir), part_outcomes(spark, sf_dir))


@query
def stored_status(spark, sf_dir):
    """The status update, written back as a new version of a stored ledger."""
    ledger = Ledger(spark, scratch_path(spark, "ledger"))
    ledger.commit(part_catalog(spark, sf_dir), 0)
    ledger.update_status(part_outcomes(spark, sf_dir))
    return ledger.read()


@query
def status_filter(spark, sf_dir):
    return cat.with_status(status_update(spark, sf_dir), "validated")


# ---- conditions ------------------------------------------------------------------------------


def ids_where(spark: SparkSession, sf_dir: str, conditions: list[dict], unknown: str = "pass") -> DataFrame:
    found = metrics(spark, sf_dir)
    return found.where(crit.compile_conditions(conditions, found.schema, unknown)).select("dataset_id")


@query
def filter_compare(spark, sf_dir):
    conditions = [
        {"field": "n_instances", "op": ">", "value": 400},
        {"field": "n_instances", "op": "<", "value": 9000},
        {"field": "n_features", "op": ">=", "value": "5"},
        {"field": "missing_rate", "op": "<=", "value": 0.1},
        {"field": "n_classes", "op": "!=", "value": 7},
        {"field": "imbalance_ratio", "op": "==", "value": 3},
    ]
    return ids_where(spark, sf_dir, conditions)


@query
def filter_text_ci(spark, sf_dir):
    conditions = [
        {"field": "task", "op": "==", "value": "CLASSIFICATION"},
        {"field": "task_subtype", "op": "!=", "value": "Binary"},
        {"field": "temporal", "op": "==", "value": False},
    ]
    return ids_where(spark, sf_dir, conditions)


@query
def filter_all_of(spark, sf_dir):
    return ids_where(spark, sf_dir, SPECS[0]["all_of"])


@query
def filter_any_of(spark, sf_dir):
    groups = [
        [{"field": "task", "op": "==", "value": "regression"}],
        [
            {"field": "task_subtype", "op": "==", "value": "multiclass"},
            {"field": "imbalance_ratio", "op": ">=", "value": 5},
        ],
    ]
    conditions = [{"any_of": groups}, {"field": "n_instances", "op": ">=", "value": 1000}]
    return ids_where(spark, sf_dir, conditions)


@query
def filter_between(spark, sf_dir):
    conditions = [
        {"field": "n_instances", "op": "between", "value": [500, 10000]},
        {"field": "missing_rate", "op": "between", "value": [0.02, 0.1]},
    ]
    return ids_where(spark, sf_dir, conditions)


@query
def filter_unknown_field(spark, sf_dir):
    conditions = [
        {"field": "iid_assumed", "op": "==", "value": True},
        {"field": "n_features", "op": "<=", "value": 50},
    ]
    return ids_where(spark, sf_dir, conditions)


# The expression of a sample collection.
# The sample collection as a text.
SELECTION = (
    "task == 'classification' AND task_subtype == 'binary' AND missing_rate <= 0.05"
    " AND n_instances >= 500 AND n_instances <= 10000 AND n_features >= 5 AND n_features <= 100"
)


@query
def filter_expr(spark, sf_dir):
    return selection.select_where(metrics(spark, sf_dir), SELECTION).select("dataset_id")


@query
def filter_expr_bare(spark, sf_dir):
    return selection.select_where(metrics(spark, sf_dir), "task == classification").select("dataset_id")


@query
def filter_reason(spark, sf_dir):
    found = metrics(spark, sf_dir)
    return found.select(
        "dataset_id", crit.explain_criteria(SPECS[1], found.schema).alias("reason")
    )


@query
def match_collections(spark, sf_dir):
    matched = crit.match_collections(metrics(spark, sf_dir), SPECS)
    return matched.select("collection_id", "dataset_id", "passed", "reason")


@query
def match_passing(spark, sf_dir):
    return crit.match_passing(metrics(spark, sf_dir), SPECS).select("collection_id", "dataset_id")


@query
def match_criteria_table(spark, sf_dir):
    candidates = metrics(spark, sf_dir).select("dataset_id", *METRIC_FIELDS)
    return crit.match_criteria_table(candidates, crit.criteria_df(spark, SPECS), ["dataset_id"])


@query
def explain_criteria_table(spark, sf_dir):
    candidates = metrics(spark, sf_dir).select("dataset_id", *METRIC_FIELDS)
    return crit.explain_criteria_table(candidates, crit.criteria_df(spark, SPECS), ["dataset_id"])


@query
def match_part_collections(spark, sf_dir):
    """One collection per part, all of them in one table, against all candidates."""
    candidates = metrics(spark, sf_dir).select("dataset_id", *METRIC_FIELDS)
    return crit.passing_criteria_table(candidates, part_collections(spark, sf_dir), ["dataset_id"])


@query
def coerce_values(spark, sf_dir):
    coerced = crit.coerce_criteria(written_criteria(spark, sf_dir))
    return coerced.select("cond_no", "field", "num_value", "bool_value", "text_value")


@query
def collection_bounds(spark, sf_dir):
    return crit.collection_bounds(written_criteria(spark, sf_dir))


@query
def license_gate(spark, sf_dir):
    return lst.licensed(listing(spark, sf_dir)).select("did", "name")


@query
def non_empty(spark, sf_dir):
    return lst.non_empty(metrics(spark, sf_dir).withColumn("n_instances", F.col("n_features") * 10)).select(
        "dataset_id", "n_instances"
    )


# ---- rows and columns of tables --------------------------------------------------------------


@query
def drop_missing_target(spark, sf_dir):
    return wide.drop_missing_target(lineitem_dirty(spark, sf_dir), "tgt")


@query
def dedup_rows(spark, sf_dir):
    return wide.dedup_rows(lineitem_dirty(spark, sf_dir))


def dirty_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = screening.cleaned_column_stats(whole_fleet(spark, sf_dir))
    return screening.with_drop_flags(stats, Limits())


@query
def drop_sparse_columns(spark, sf_dir):
    return dirty_flags(spark, sf_dir).where("is_sparse").select(*KEY, "column_name")


@query
def drop_constant_columns(spark, sf_dir):
    return dirty_flags(spark, sf_dir).where("is_constant").select(*KEY, "column_name")


@query
def drop_id_columns(spark, sf_dir):
    return dirty_flags(spark, sf_dir).where("is_id").select(*KEY, "column_name")


@query
def clean_classification(spark, sf_dir):
    return wide.clean_table(lineitem_dirty(spark, sf_dir), "tgt", LARGE)


@query
def clean_regression(spark, sf_dir):
    return wide.clean_table(load(spark, sf_dir, "lineitem"), "l_quantity", LARGE)


@query
def gate_table(spark, sf_dir):
    dirty = lineitem_dirty(spark, sf_dir)
    return wide.gate_table(dirty, wide.clean_table(dirty, "tgt", LARGE), "tgt", LARGE)


@query
def output_fields(spark, sf_dir):
    return selection.output_fields(metrics(spark, sf_dir))


# ---- joins -----------------------------------------------------------------------------------


def named_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = listing(spark, sf_dir).select(
        F.col("status").alias("collection_id"), naming.sanitize_name(F.col("name")).alias("dataset_id")
    )
    suppliers = load(spark, sf_dir, "supplier").select(
        F.lit("suppliers").alias("collection_id"),
        naming.sanitize_name(F.col("s_name")).alias("dataset_id"),
    )
    return parts.unionByName(suppliers).distinct()


@query
def academic_join(spark, sf_dir):
    return cat.with_academic(named_catalog(spark, sf_dir), listing(spark, sf_dir))


@query
def target_lookup(spark, sf_dir):
    profiles = prof.dataset_profile(whole_fleet(spark, sf_dir))
    entries = whole_fleet(spark, sf_dir).columns.select(*KEY).distinct()
    regions = load(spark, sf_dir, "region").select(
        F.lit("tables").alias("collection_id"), F.lower("r_name").alias("dataset_id")
    )
    return cat.with_target(entries.unionByName(regions), profiles)


@query
def missing_source(spark, sf_dir):
    present = metrics(spark, sf_dir).where(F.col("status") == "active").select(
        F.col("task").alias("collection_id"), "dataset_id"
    )
    return cat.missing_source(part_catalog(spark, sf_dir), present)


# ---- profiles --------------------------------------------------------------------------------


@query
def column_profile(spark, sf_dir):
    return prof.column_profile(whole_fleet(spark, sf_dir)).drop("text_bytes")


@query
def table_shape(spark, sf_dir):
    return prof.table_shape(prof.column_profile(whole_fleet(spark, sf_dir)))


@query
def column_missing(spark, sf_dir):
    profile = prof.column_profile(whole_fleet(spark, sf_dir))
    return prof.columns_with_missing(profile).select(
        *KEY, "missing_cells", listed("columns_with_missing")
    )


@query
def missing_rate(spark, sf_dir):
    return prof.missing_rate(prof.column_profile(whole_fleet(spark, sf_dir)), 4)


@query
def column_nunique(spark, sf_dir):
    profile = prof.column_profile(whole_fleet(spark, sf_dir))
    return profile.select(*KEY, "ordinal", "column_name", "n_unique")


@query
def class_counts(spark, sf_dir):
    return prof.class_counts(lineitem_dirty(spark, sf_dir), "tgt")


@query
def class_summary(spark, sf_dir):
    return prof.class_summary(prof.class_counts(load(spark, sf_dir, "events"), "event_type"))


@query
def imbalance_ratio(spark, sf_dir):
    summary = prof.class_summary(prof.class_counts(load(spark, sf_dir, "events"), "props"))
    ratio = prof.imbalance_ratio(
        F.col("n_classes"), F.col("smallest_class"), F.col("largest_class")
    )
    return summary.select(F.round(ratio, 6).alias("imbalance_ratio"))


@query
def p_to_n_ratio(spark, sf_dir):
    shape = prof.table_shape(prof.column_profile(whole_fleet(spark, sf_dir)))
    ratio = prof.p_to_n_ratio(F.col("n_features"), F.col("n_instances"))
    return shape.select(*KEY, F.round(ratio, 9).alias("p_to_n_ratio"))


@query
def duplicate_rows(spark, sf_dir):
    return prof.duplicate_rows(whole_fleet(spark, sf_dir))


@query
def constant_columns(spark, sf_dir):
    lists = prof.constant_list(prof.column_profile(whole_fleet(spark, sf_dir)))
    return lists.select(*KEY, listed("constant_columns"))


@query
def high_cardinality_columns(spark, sf_dir):
    lists = prof.unique_list(prof.column_profile(whole_fleet(spark, sf_dir)))
    return lists.select(*KEY, listed("high_cardinality_columns"))


@query
def feature_types(spark, sf_dir):
    return prof.feature_types(prof.column_profile(whole_fleet(spark, sf_dir)))


@query
def size_estimate(spark, sf_dir):
    return prof.size_estimate(prof.column_profile(whole_fleet(spark, sf_dir)))


@query
def infer_task(spark, sf_dir):
    return prof.infer_task(prof.column_profile(whole_fleet(spark, sf_dir)))


@query
def dataset_metrics(spark, sf_dir):
    record = prof.dataset_metrics(prof.column_profile(whole_fleet(spark, sf_dir)))
    numbers = ["missing_rate", "p_to_n_ratio", "imbalance_ratio"]
    return record.select(
        *[c for c in record.columns if c not in numbers], *rounded(*numbers, digits=9)
    )


@query
def dataset_profile(spark, sf_dir):
    lists = ["constant_columns", "high_cardinality_columns", "columns_with_missing"]
    return prof.dataset_profile(whole_fleet(spark, sf_dir)).select(
        *KEY,
        F.col("task.type").alias("task"),
        F.col("task.target_variable").alias("target_variable"),
        "structure.*",
        "feature_types.*",
        *[F.array_join(f"data_quality.{c}", ",").alias(c) for c in lists],
    )


@query
def dataset_tags(spark, sf_dir):
    return prof.dataset_tags(metrics(spark, sf_dir)).select("dataset_id", listed("tags"))


# ---- gates, cleaning, manifest ---------------------------------------------------------------


@query
def gate_outcomes(spark, sf_dir):
    return screening.gate_outcomes(screening.screen(whole_fleet(spark, sf_dir)))


@query
def gate_outcomes_large(spark, sf_dir):
    return screening.gate_outcomes(screening.screen(whole_fleet(spark, sf_dir), LARGE))


@query
def features_only(spark, sf_dir):
    """Line items without their target, as digests of whole rows."""
    table = wide.features_only(load(spark, sf_dir, "lineitem"), "l_returnflag")
    return row_digests(to_fleet(table, "lineitem", "features"))


@query
def gate_outcomes_ledger(spark, sf_dir):
    """Outcomes of a ledger with entries that lost their data or their profile."""
    fleet = whole_fleet(spark, sf_dir)
    entries = fleet.columns.select(*KEY, (F.col("dataset_id") != "part").alias("has_profile")).distinct()
    gone = load(spark, sf_dir, "nation").select(
        F.lit("tables").alias("collection_id"),
        F.lower("n_name").alias("dataset_id"),
        F.lit(True).alias("has_profile"),
    )
    return screening.gate_outcomes(screening.screen(fleet, NARROW), entries.unionByName(gone))


@query
def screening_record(spark, sf_dir):
    lists = ["sparse_columns", "constant_columns", "id_columns"]
    record = screening.screen(whole_fleet(spark, sf_dir), LARGE)
    record = record.drop("kept_longs", "kept_doubles", "kept_texts")
    return record.select(*[listed(c) if c in lists else c for c in record.columns])


@query
def cleaning_report(spark, sf_dir):
    report = screening.cleaning_report(screening.screen(whole_fleet(spark, sf_dir)))
    return report.select(
        *KEY,
        "missing_target_rows",
        "duplicate_rows",
        *[listed(c) for c in ("sparse_columns", "constant_columns", "id_columns")],
    )


@query
def clean_fleet(spark, sf_dir):
    return row_digests(screening.clean_fleet(whole_fleet(spark, sf_dir), NARROW))


@query
def frozen_metadata(spark, sf_dir):
    frozen = man.frozen_metadata(screening.screen(whole_fleet(spark, sf_dir), LARGE))
    return frozen.select(
        *KEY,
        "frozen_metadata.name",
        F.col("frozen_metadata.task.type").alias("task"),
        "frozen_metadata.task.target_variable",
        "frozen_metadata.structure.*",
        "frozen_metadata.feature_types.*",
        "frozen_metadata.status",
    )


@query
def collection_totals(spark, sf_dir):
    return man.collection_totals(screening.screen(whole_fleet(spark, sf_dir)))


@query
def manifest(spark, sf_dir):
    """The whole manifest, one row per selected dataset."""
    screened = staged(screening.screen(whole_fleet(spark, sf_dir), LARGE), "screened")
    return man.manifest_rows(screened, LARGE).select(
        "manifest_id",
        "source_collection",
        "total_matched_before_clean",
        "final_dataset_count",
        F.size("filters_applied").alias("n_filters"),
        "position",
        "dataset_id",
        "frozen_metadata.structure.n_instances",
    )


@query
def manifest_top_k(spark, sf_dir):
    entries = man.manifest_entries(screening.screen(whole_fleet(spark, sf_dir), LARGE), top_k=2)
    return entries.select(*KEY, "position")


# ---- ranking ---------------------------------------------------------------------------------


def passing_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crit.match_passing(metrics(spark, sf_dir), SPECS)


@query
def top_popular(spark, sf_dir):
    ready = lst.licensed(lst.scan_listing(passing_metrics(spark, sf_dir)))
    return selection.top_popular(ready, 30).select(
        "collection_id", "dataset_id", "number_downloads", "popularity"
    )


@query
def listing_latest(spark, sf_dir):
    return lst.listing_latest(listing(spark, sf_dir)).select("dataset_id", "did", "name", "citation")


@query
def sorted_by_collection(spark, sf_dir):
    """Passing candidates in the order of their own collection, which its conditions tell."""
    passing = crit.match_passing(metrics(spark, sf_dir), SPECS)
    keys = selection.preferred_keys(crit.criteria_df(spark, SPECS))
    ranks = selection.sorted_by_collection(passing, keys)
    return ranks.select("collection_id", "dataset_id", "sort_rank")


@query
def preferred_sort(spark, sf_dir):
    matched = passing_metrics(spark, sf_dir).where(F.col("collection_id") == SPECS[1]["collection_id"])
    keys = SPECS[1]["sort"]
    picked = matched.select("collection_id", "dataset_id", *[f for f, _ in keys])
    return selection.preferred_sort(picked, keys)


# ---- scalar functions ------------------------------------------------------------------------


@query
def sanitize_name(spark, sf_dir):
    text = F.concat(F.lit(" "), "p_name", F.lit(" ("), "p_type", F.lit(")--"), "p_brand", F.lit("! "))
    return load(spark, sf_dir, "part").select("p_partkey", naming.sanitize_name(text).alias("folder"))


@query
def slugify(spark, sf_dir):
    text = F.concat(F.lit("--"), "p_name", F.lit(" & "), "p_brand", F.lit("!"))
    text = F.when(F.col("p_size") == 1, F.lit(" ?! ")).otherwise(text)
    return load(spark, sf_dir, "part").select("p_partkey", naming.slugify(text).alias("slug"))


@query
def display_name(spark, sf_dir):
    folder = naming.sanitize_name(F.concat("p_name", F.lit(" "), "p_type"))
    return load(spark, sf_dir, "part").select("p_partkey", naming.display_name(folder).alias("title"))


# ---- scores ----------------------------------------------------------------------------------


@query
def split_80_20(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return scores.split_80_20(orders, "o_orderkey", "o_orderpriority")


@query
def classification_scores(spark, sf_dir):
    guess = F.when(F.col("l_discount") > 0.05, "R").when(F.col("l_tax") > 0.04, "A").otherwise("N")
    scored = load(spark, sf_dir, "lineitem").withColumn("guess", guess)
    result = scores.classification_scores(scored, "l_linestatus", "l_returnflag", "guess")
    return result.select(
        "l_linestatus", *rounded("accuracy", "macro_precision", "macro_recall", "macro_f1", digits=9)
    )


@query
def roc_auc(spark, sf_dir):
    scored = load(spark, sf_dir, "lineitem").withColumn(
        "is_returned", (F.col("l_returnflag") == "R").cast("int")
    )
    result = scores.roc_auc(scored, "l_linestatus", "is_returned", "l_extendedprice")
    return result.select("l_linestatus", *rounded("auc", digits=9))


@query
def regression_scores(spark, sf_dir):
    scored = load(spark, sf_dir, "lineitem").withColumn("guess", F.col("l_quantity") * 1500 + 1000)
    result = scores.regression_scores(scored, "l_returnflag", "l_extendedprice", "guess")
    return result.select("l_returnflag", *rounded("r2", digits=6), *rounded("rmse", "mae", digits=3))


