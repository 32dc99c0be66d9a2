"""The wide path and the fleet path must agree, and plans must stay in the engine."""

import pytest

from tablevet.limits import Limits
from tablevet.operators import profile, screening, wide
from tablevet.plans import inputs
from tablevet.plans.queries import REGISTRY
from tablevet.sources import sinks
from tablevet.sources.fleet import to_fleet

SF_DIR = "/root/testdata/sf0.001"
LARGE = Limits(max_rows=None, min_rows=1, min_features=1, min_class_size=1, min_target_repeat=1)


@pytest.mark.parametrize("source,target", [("dirty", "tgt"), ("orders", "o_orderpriority"), ("joined", "c_mktsegment")])
def test_wide_and_fleet_agree(spark, source, target):
    df = {
        "dirty": inputs.lineitem_dirty,
        "orders": lambda s, d: inputs.load(s, d, "orders"),
        "joined": inputs.orders_customer,
    }[source](spark, SF_DIR)
    cleaned = wide.clean_table(df, target, LARGE)
    fleet = screening.clean_fleet(to_fleet(df, "x", target=target), LARGE)
    restored = sinks.dataset_frame(fleet, "default", "x")
    assert restored.columns == cleaned.columns
    as_rows = lambda d: sorted(map(repr, map(tuple, d.collect())))
    assert as_rows(restored) == as_rows(cleaned)


def test_declared_types_come_back(spark):
    df = spark.range(1).selectExpr(
        "CAST('12345678901234567890.123456789012345678' AS DECIMAL(38,18)) AS d", "DATE '2020-02-29' AS day",
        "TIMESTAMP_NTZ '2020-01-01 01:02:03.000004' AS at", "CAST(7 AS TINYINT) AS small", "CAST(0.5 AS FLOAT) AS f", "true AS y",
    )
    back = sinks.dataset_frame(to_fleet(df, "x"), "default", "x")
    assert back.dtypes == df.dtypes and back.collect() == df.collect()


def test_table_stats(spark):
    df = spark.range(2000).selectExpr(
        "id AS key", "concat('n', id) AS name", "CASE WHEN id > 0 THEN id END AS gap", "id % 1999 AS nearly",
        "CAST(id AS DOUBLE) AS unique_float", "3 AS same", "CAST(NULL AS STRING) AS empty", "id % 2 AS y",
    )
    stats = wide.table_stats(df, "y")
    assert wide.id_columns(stats, "y") == ["key", "name"]
    assert wide.constant_columns(stats, "y") == ["same"]
    assert wide.sparse_columns(stats, "y") == ["empty"]
    assert wide.clean_table(df, "y").columns == ["gap", "nearly", "unique_float", "y"]
    assert wide.features_only(df, "y").columns == df.columns[:-1]


def test_profile_of_floats_with_nan(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (None,), (1.5,)], "x double")
    row = profile.column_profile(to_fleet(df, "d")).first()
    assert (row["n_rows"], row["n_missing"], row["n_unique"], row["max_count"]) == (5, 2, 2, 2)


def test_empty_table_profile(spark):
    record = profile.dataset_profile(to_fleet(spark.createDataFrame([], "a int, b string"), "e")).first()
    assert record["structure"]["n_instances"] == 0
    assert record["structure"]["missing_rate"] is None
    assert record["structure"]["duplicate_rows"] == 0


PLANNED = [
    "column_profile", "dataset_profile", "gate_outcomes", "clean_fleet", "cells", "match_collections",
    "match_criteria_table", "collection_bounds", "academic_join", "top_popular", "preferred_sort",
    "split_80_20", "roc_auc", "export_missing", "status_update", "csv_fleet_cells",
]


@pytest.mark.parametrize("name", PLANNED)
def test_plan_has_no_cross_join_or_python(spark, name):
    plan = REGISTRY[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "PythonUDF"):
        assert node not in plan


def test_single_dataset_fleet_has_no_cross_join(spark):
    df = inputs.load(spark, SF_DIR, "orders")
    plan = screening.clean_fleet(to_fleet(df, "x"), LARGE).rows._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_popularity_is_limited_before_the_shuffle(spark):
    plan = REGISTRY["top_popular"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_listing_bounds_reach_the_scan(spark, tmp_path):
    from tablevet.sources.listing import scan_listing

    inputs.listing(spark, SF_DIR).write.parquet(str(tmp_path / "l"))
    plan = scan_listing(spark.read.parquet(str(tmp_path / "l")))._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    for part in ("GreaterThanOrEqual(n_instances,500)", "LessThanOrEqual(n_features,100)", "EqualTo(status,active)"):
        assert part in pushed


def test_missing_values_are_counted_without_telling_values_apart(spark):
    from tablevet.operators import profile
    from tablevet.sources.fleet import fleet_of, to_fleet

    df = spark.range(700).selectExpr(
        "IF(id % 7 = 0, NULL, id) AS a",
        "CASE WHEN id % 5 = 0 THEN double('nan') WHEN id % 5 = 1 THEN NULL ELSE id END AS b",
        "CAST(id AS STRING) AS c",
        "IF(id < 3, NULL, timestamp_ntz'2020-01-01 00:00:00') AS t",
        "CAST(NULL AS INT) AS y",
    )
    fleet = fleet_of([to_fleet(df, "gaps"), to_fleet(df.where("id < 0"), "empty"), to_fleet(df.select("c"), "full")])
    got = profile.column_profile(fleet)
    counts = {(r["dataset_id"], r["column_name"]): (r["n_rows"], r["n_missing"]) for r in got.collect()}
    assert counts == {
        ("gaps", "a"): (700, 100), ("gaps", "b"): (700, 280), ("gaps", "c"): (700, 0),
        ("gaps", "t"): (700, 3), ("gaps", "y"): (700, 700), ("full", "c"): (700, 0),
        **{("empty", c): (0, 0) for c in "abcty"},
    }
    plan = profile.columns_with_missing(got)._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" not in plan
    assert "posexplode" in profile.feature_types(got)._jdf.queryExecution().optimizedPlan().toString()
