"""Edges of every gate; all datasets are screened in one job."""

import pytest
from pyspark.sql import functions as F

from tablevet.limits import Limits
from tablevet.operators import profile, screening
from tablevet.sources.fleet import fleet_of, to_cells, to_fleet


def table(spark, rows, features=5, target="id % 4"):
    """Float features that are neither constant nor sparse, and a target."""
    columns = [f"CAST(pmod(id * {i + 3}, 97) AS DOUBLE) + id AS f{i}" for i in range(features)]
    return spark.range(rows).selectExpr(*columns, f"{target} AS y")


def sized(n_big, small, classes):
    """Target of ``classes`` classes, the last of which has ``small`` rows."""
    return f"CASE WHEN id < {small} THEN {classes - 1} ELSE id % {classes - 1} END"


EXPECTED = {
    "rows_499": "row_count",
    "rows_500": None,
    "rows_10000": None,
    "rows_10001": "row_count",
    "features_4": "feature_count",
    "features_5": None,
    "features_100": None,
    "features_101": "feature_count",
    "classes_1": "target_constant",
    "classes_2": None,
    "classes_20": None,
    "classes_21": "too_many_classes",
    "smallest_4": "class_too_small",
    "smallest_5": None,
    "regression_singleton": "singleton_target",
    "regression_pairs": None,
    "int_15": None,
    "int_16": "row_count",
    "datetime_target": "task_unsupported",
    "bool_target": None,
    "float_zero_one": None,
    "all_targets_missing": "target_constant",
    "empty": "target_constant",
    "id_features": "feature_count",
    "unique_floats_stay": None,
}


def datasets(spark):
    yield "rows_499", table(spark, 499)
    yield "rows_500", table(spark, 500)
    yield "rows_10000", table(spark, 10000)
    yield "rows_10001", table(spark, 10001)
    yield "features_4", table(spark, 600, 4)
    yield "features_5", table(spark, 600, 5)
    yield "features_100", table(spark, 600, 100)
    yield "features_101", table(spark, 600, 101)
    yield "classes_1", table(spark, 600, target="1")
    yield "classes_2", table(spark, 600, target="id % 2")
    yield "classes_20", table(spark, 600, target="concat('c', id % 20)")
    yield "classes_21", table(spark, 630, target="concat('c', id % 21)")
    yield "smallest_4", table(spark, 600, target=sized(600, 4, 3))
    yield "smallest_5", table(spark, 600, target=sized(600, 5, 3))
    yield "regression_singleton", table(spark, 601, target="CAST(id DIV 2 AS DOUBLE)")
    yield "regression_pairs", table(spark, 600, target="CAST(id DIV 2 AS DOUBLE)")
    # Whole numbers are classes up to 15 values, or below 5 % of the rows (320 rows: 16 values).
    yield "int_15", table(spark, 600, target="id % 15")
    yield "int_16", table(spark, 320, target="id % 16")
    yield "datetime_target", table(spark, 600, target="timestamp_seconds(id % 3)")
    yield "bool_target", table(spark, 600, target="id % 2 = 0")
    yield "float_zero_one", table(spark, 600, target="CAST(id % 2 AS DOUBLE)")
    yield "all_targets_missing", table(spark, 600, target="CAST(NULL AS STRING)")
    yield "empty", table(spark, 0)
    yield "id_features", table(spark, 600).withColumns({f"f{i}": F.monotonically_increasing_id() + i for i in range(5)})
    yield "unique_floats_stay", table(spark, 600)


@pytest.fixture(scope="module")
def screened(spark):
    fleet = fleet_of([to_fleet(df, name) for name, df in datasets(spark)])
    return {r["dataset_id"]: r for r in screening.screen(fleet).collect()}


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_gate(screened, name):
    assert screened[name]["reason"] == EXPECTED[name]
    assert screened[name]["status"] == ("rejected" if EXPECTED[name] else "validated")


def test_task_edges(screened):
    assert screened["int_15"]["task"] == "classification"
    assert screened["int_16"]["task"] == "regression"
    assert screened["float_zero_one"]["task"] == "regression"
    assert screened["bool_target"]["task"] == "classification"


def test_int_target_by_share(spark):
    def task(rows):
        df = table(spark, rows, 1, "id % 16")
        return profile.infer_task(profile.column_profile(to_fleet(df, "x"))).first()["task"]

    assert task(320) == "regression"
    assert task(321) == "classification"


def test_missing_share_edge_and_drop_order(spark):
    df = spark.range(600).selectExpr(
        "CASE WHEN id < 300 THEN id END AS half_missing",
        "CASE WHEN id < 299 THEN id END AS mostly_missing",
        "CAST(NULL AS INT) AS nothing",
        "CASE WHEN id < 10 THEN 7 END AS sparse_constant",
        "CASE WHEN id < 400 THEN 'x' END AS constant_with_gaps",
        "CAST('NaN' AS DOUBLE) AS nan_only",
        "2.5D AS constant_float",
        "id AS key",
        "id % 2 AS y",
    )
    record = screening.screen(to_fleet(df, "x")).first()
    assert record["sparse_columns"] == ["mostly_missing", "nothing", "sparse_constant", "nan_only"]
    assert record["constant_columns"] == ["constant_with_gaps", "constant_float"]
    assert record["id_columns"] == ["key"]
    assert record["n_features"] == 1
    assert record["missing_rate"] == round(300 / 1200, 4)


def test_row_cleaning_counts(spark):
    rows = [(1, "a", 0.0, "p"), (1, "a", -0.0, "p"), (None, "a", None, "p"), (None, "a", float("nan"), "p")]
    rows += [(2, None, 1.0, "q"), (2, None, 1.0, "q"), (2, "b", 1.0, None), (2, "b", 1.0, None)]
    df = spark.createDataFrame(rows, "i int, s string, d double, y string")
    fleet = to_fleet(df, "x")
    record = screening.screen(fleet).first()
    assert record["raw_rows"] == 8
    assert record["missing_target_rows"] == 2
    assert record["duplicate_rows"] == 3
    assert record["n_instances"] == 3
    assert profile.duplicate_rows(fleet).first()["duplicate_rows"] == 4
    assert to_cells(screening.dedup_rows(fleet)).count() == 4 * 4
    assert to_cells(screening.drop_missing_target(fleet)).count() == 6 * 4


def test_null_positions_are_not_duplicates(spark):
    rows = [("a", None, "t"), (None, "a", "t"), ("a", "a", "t")]
    fleet = to_fleet(spark.createDataFrame(rows, "x string, y string, z string"), "x")
    assert profile.duplicate_rows(fleet).first()["duplicate_rows"] == 0


def test_given_tasks_and_missing_target(spark):
    df = table(spark, 600)
    fleet = fleet_of([to_fleet(df, "no_target", target="absent"), to_fleet(df, "untold")])
    tasks = spark.createDataFrame(
        [("default", "no_target", "regression")], "collection_id string, dataset_id string, task string"
    )
    reasons = {r["dataset_id"]: r["reason"] for r in screening.screen(fleet, tasks=tasks).collect()}
    assert reasons == {"no_target": "target_not_found", "untold": "task_unsupported"}
    inferred = screening.screen(fleet).where("dataset_id = 'no_target'").first()
    assert inferred["reason"] == "task_unsupported"


def test_failed_datasets_do_not_stop_others(spark):
    screened = screening.screen(fleet_of([to_fleet(table(spark, 600), n) for n in ("good", "bad")]))
    failed = spark.createDataFrame(
        [("default", "bad", "row_too_wide")], "collection_id string, dataset_id string, reason string"
    )
    outcomes = {r["dataset_id"]: (r["status"], r["reason"]) for r in screening.gate_outcomes(screened, failed=failed).collect()}
    assert outcomes == {"good": ("validated", None), "bad": ("error", "row_too_wide")}


def test_limits_are_arguments(spark):
    fleet = to_fleet(table(spark, 50, 2), "x")
    assert screening.screen(fleet, Limits(min_rows=50, min_features=2)).first()["status"] == "validated"


def test_nested_columns_are_skipped(spark):
    from tablevet.sources.fleet import skipped_columns

    df = table(spark, 10).withColumn("list", F.array(F.lit(1)))
    assert skipped_columns(df) == ["list"]
    assert to_fleet(df, "x").columns.where("is_target").first()["column_name"] == "y"


def test_identifiers_are_exact_and_no_row_is_stored(spark):
    from tablevet.session import noted_paths

    long = "x" * 80
    df = spark.range(3000).selectExpr(
        "id AS key",
        "IF(id = 2999, 0, id) AS almost_key",
        f"concat('{long}', id) AS long_key",
        f"concat('{long}', IF(id = 1234, 77, id)) AS almost_long_key",
        "IF(id % 900 = 5, NULL, id) AS key_with_gaps",
        "id DIV 2 AS pairs",
        "CAST(id AS DOUBLE) AS number",
        "id % 3 AS y",
    )
    fleet = to_fleet(df.unionByName(df.where("id < 700")), "x")
    with noted_paths() as written:
        record = screening.screen(fleet).first()
    assert record["id_columns"] == ["key", "long_key"]
    assert (record["raw_rows"], record["duplicate_rows"], record["n_instances"]) == (3700, 700, 3000)
    assert (record["n_classes"], record["smallest_class"]) == (3, 1000)
    assert record["missing_rate"] == round(4 / (3000 * 6), 4)
    # A row per column is stored at most, never the rows of a table.
    assert max(spark.read.parquet(path).count() for path in written) <= len(df.columns)


def test_cleaning_meets_copies_only_where_there_are_any(spark):
    plain, copied = table(spark, 600), table(spark, 600).unionByName(table(spark, 50))
    fleet = fleet_of([to_fleet(plain, "plain"), to_fleet(copied, "copied"), to_fleet(table(spark, 10), "short")])
    cleaned = screening.clean_fleet(fleet)
    counts = {r["dataset_id"]: r["count"] for r in cleaned.rows.groupBy("dataset_id").count().collect()}
    assert counts == {"plain": 600, "copied": 600}
    plan = screening.clean_fleet(to_fleet(plain, "plain")).rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan


def test_copies_are_sought_in_buckets_of_short_hashes(spark):
    ids = "id % 50 AS a", "id DIV 7 AS b", "concat('t', id) AS c", "IF(id % 9 = 0, NULL, id) AS d", "id % 3 AS y"
    df = spark.range(4000).selectExpr(*ids)
    pair = df.unionByName(df.where("c = 't18'"))
    hot = df.unionByName(df.where("c = 't5'").crossJoin(spark.range(900)).drop("id"))
    many = df.unionByName(df.where("a < 30"))
    fleet = fleet_of([to_fleet(t, n) for n, t in (("plain", df), ("pair", pair), ("hot", hot), ("many", many))])
    probed = fleet.columns.select("collection_id", "dataset_id").distinct()
    found = screening.maybe_copied(fleet.rows, probed.withColumn("_copied", F.lit(False)))
    buckets = {r["dataset_id"]: r["_buckets"] for r in found.collect()}
    assert {n: b and len(b) for n, b in buckets.items()} == {"pair": 1, "hot": 1, "many": None}
    record = {r["dataset_id"]: r for r in screening.screen(fleet).collect()}
    assert {n: r["duplicate_rows"] for n, r in record.items()} == {"plain": 0, "pair": 1, "hot": 900, "many": 2400}
    for r in record.values():
        assert (r["n_instances"], r["n_classes"], r["smallest_class"], r["id_columns"]) == (4000, 3, 1333, ["c"])
        assert r["missing_rate"] == round(445 / (4000 * 4), 4)


def test_hashes_are_dealt_as_they_are_read_to_tasks_of_a_fixed_size(spark):
    hashed = spark.range(1000).selectExpr("id % 2 AS _of", "xxhash64(id DIV IF(id < 2, 2, 1)) AS _hash")
    assert screening.dealt(hashed, ["_hash"], 5 * screening.TASK_HASHES + 1).rdd.getNumPartitions() == 6
    assert screening.dealt(hashed, ["_hash"], 0).rdd.getNumPartitions() == 1
    fleet = to_fleet(table(spark, 600), "x")
    copied = fleet.columns.select("collection_id", "dataset_id").distinct()
    copied = copied.withColumn("_buckets", F.lit(None).cast("array<int>"))
    for df in (
        screening.repeats(hashed, ["_of"], 1000),
        screening.maybe_copied(fleet.rows, copied.select("collection_id", "dataset_id", F.lit(False).alias("_copied"))),
        screening.row_facts(fleet.rows, copied, 600),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "collect_set" not in plan
        # Nothing is folded or sorted between the rows and the deal.
        lines = plan.split("\n")
        at = max(i for i, line in enumerate(lines) if "REPARTITION_BY_NUM" in line)
        below = [line for line in lines[at + 1 : at + 8] if "Scan" not in line]
        assert not any("Aggregate" in line and "_hash" in line or "Sort" in line for line in below[:3])


def test_repeats_are_exact_for_many_and_few_hashes(spark):
    plain = "SELECT 1L AS _of, xxhash64(id) AS _hash FROM range(5000)"
    again = "SELECT 2L AS _of, xxhash64(id % 4990) AS _hash FROM range(5000)"
    hot = "SELECT 3L AS _of, xxhash64(IF(id % 3 = 0, 0, id)) AS _hash FROM range(5000)"
    found = screening.repeats(spark.sql(f"{plain} UNION ALL {again} UNION ALL {hot}"), ["_of"], 15000)
    assert {r["_of"]: len(r["_buckets"]) for r in found.collect()} == {2: 10, 3: 1}
