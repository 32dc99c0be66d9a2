import pytest
from pyspark.sql import functions as F

from tablevet.operators import criteria, selection
from tablevet.sources import listing as lst

METRICS = [
    ("d1", 1000, 10, 0.0, 4.0, "classification", "binary", True),
    ("d2", 400, 60, 0.3, float("nan"), "regression", "continuous", False),
    ("d3", 9000, None, None, 1.0, "Classification", "multiclass", False),
    ("d4", 5000, 30, 0.05, None, None, None, None),
]
SCHEMA = (
    "dataset_id string, n_instances bigint, n_features bigint, missing_rate double,"
    " imbalance_ratio double, task string, task_subtype string, temporal boolean"
)


def cond(field, op, value):
    return {"field": field, "op": op, "value": value}


@pytest.fixture(scope="module")
def metrics(spark):
    return spark.createDataFrame(METRICS, SCHEMA)


CASES = [
    ([], ["d1", "d2", "d3", "d4"]),
    ([cond("missing_rate", "==", 0)], ["d1"]),
    ([cond("missing_rate", "<=", "0.05")], ["d1", "d4"]),
    ([cond("imbalance_ratio", ">", 0)], ["d1", "d3"]),
    ([cond("imbalance_ratio", "!=", 1)], ["d1"]),
    ([cond("n_features", ">=", "many")], []),
    ([cond("task", "==", "CLASSIFICATION")], ["d1", "d3"]),
    ([cond("task", "!=", "regression")], ["d1", "d3"]),
    ([cond("temporal", "==", True)], ["d1"]),
    ([cond("n_instances", "between", [400, 1000])], ["d1", "d2"]),
    ([cond("iid_assumed", "==", True)], ["d1", "d2", "d3", "d4"]),
    ([{"any_of": [[cond("task", "==", "regression")], [cond("n_instances", ">", 4000), cond("missing_rate", "<", 1)]]}], ["d2", "d4"]),
    ([cond("n_instances", "<", 6000), {"any_of": [[cond("n_features", "==", 10)], [cond("n_features", "==", 30)]]}], ["d1", "d4"]),
    ([{"any_of": [[cond("n_features", "==", 10)], [cond("n_features", "==", 30)]]}, {"any_of": [[cond("n_instances", ">", 4000)], [cond("task", "==", "regression")]]}], ["d4"]),
    ([{"any_of": [[cond("n_instances", "<", 500)], [cond("missing_rate", "<=", 0.05), {"any_of": [[cond("temporal", "==", True)], [cond("n_features", ">", 50)]]}]]}], ["d1", "d2"]),
    ([{"any_of": []}], []),
    ([{"any_of": [[]]}], ["d1", "d2", "d3", "d4"]),
]


@pytest.mark.parametrize("conditions,expected", CASES)
def test_filter(metrics, conditions, expected):
    found = metrics.where(criteria.compile_conditions(conditions, metrics.schema))
    assert sorted(r[0] for r in found.select("dataset_id").collect()) == expected


def test_column_and_table_forms_agree(spark, metrics):
    specs = [{"collection_id": f"c{i}", "all_of": c} for i, (c, _) in enumerate(CASES) if c]
    compiled = criteria.match_collections(metrics, specs).select("collection_id", "dataset_id", "passed")
    joined = criteria.explain_criteria_table(metrics, criteria.criteria_df(spark, specs), ["dataset_id"], salts=3)
    as_set = lambda df: {tuple(r) for r in df.collect()}
    assert as_set(compiled) == as_set(joined.select("collection_id", "dataset_id", "passed"))
    assert len(as_set(compiled)) == len(specs) * len(METRICS)
    passing = criteria.match_passing(metrics, specs).select("collection_id", "dataset_id")
    assert as_set(passing) == {(c, d) for c, d, passed in as_set(compiled) if passed}
    boxed = criteria.passing_criteria_table(metrics, criteria.criteria_df(spark, specs), ["dataset_id"])
    assert sorted(map(tuple, boxed.collect())) == sorted(as_set(passing))


def test_unknown_field_and_operator(metrics):
    with pytest.raises(ValueError, match="unknown field"):
        criteria.compile_conditions([cond("nope", "==", 1)], metrics.schema, unknown="error")
    with pytest.raises(ValueError, match="unknown operator"):
        criteria.compile_conditions([cond("n_features", "~", 1)], metrics.schema)


def test_first_failing_condition(metrics):
    spec = {"collection_id": "c", "all_of": [cond("n_instances", ">=", 500), cond("missing_rate", "<=", 0.05)]}
    found = metrics.select("dataset_id", criteria.explain_criteria(spec, metrics.schema).alias("r")).collect()
    assert {r[0]: r[1] for r in found} == {
        "d1": None,
        "d2": "n_instances >= 500",
        "d3": "missing_rate <= 0.05",
        "d4": None,
    }


def test_coercion(spark):
    rows = [
        ("n_instances", " 12 ", 12.0, None, None), ("missing_rate", "1e-2", 0.01, None, None),
        ("missing_rate", "5d", None, None, None), ("missing_rate", "nan", None, None, None),
        ("temporal", "Y", None, True, None), ("grouped", "0", None, False, None),
        ("iid_assumed", "perhaps", None, None, None), ("task", "'a b'", None, None, "a b"),
        ("task", "\"q'", None, None, "\"q'"), ("task", "'", None, None, "'"), ("task", "''", None, None, ""),
    ]
    df = spark.createDataFrame([r[:2] for r in rows], "field string, value string")
    got = criteria.coerce_criteria(df).collect()
    assert [(r["field"], r["value"], r["num_value"], r["bool_value"], r["text_value"]) for r in got] == rows


def bounds(spark, conditions):
    spec = {"collection_id": "c", "all_of": conditions or [cond("task", "==", "x")]}
    row = criteria.collection_bounds(criteria.criteria_df(spark, [spec])).first()
    return tuple(row)[1:]


def test_bounds(spark):
    assert bounds(spark, []) == (500, 10000, 5, 100, None)
    assert bounds(spark, [cond("n_instances", ">", 999), cond("n_instances", "<", 2000)]) == (1000, 1999, 5, 100, None)
    assert bounds(spark, [cond("n_instances", ">=", 1), cond("n_features", "<=", 1000)]) == (500, 10000, 5, 100, None)
    assert bounds(spark, [cond("n_features", "==", 3), cond("task_subtype", "==", "Binary")]) == (500, 10000, 3, 3, 2)
    low, high, *_ = bounds(spark, [cond("n_instances", "==", 700), cond("n_instances", "==", 900)])
    assert low > high
    assert bounds(spark, [cond("n_instances", ">=", "junk")]) == (500, 10000, 5, 100, None)


def test_comparisons_reach_the_scan(spark, metrics, tmp_path):
    metrics.write.parquet(str(tmp_path / "m"))
    stored = spark.read.parquet(str(tmp_path / "m"))
    spec = [cond("n_instances", ">=", 500), cond("missing_rate", "<=", 0.05), cond("n_features", ">", 7)]
    plan = stored.where(criteria.compile_conditions(spec, stored.schema))._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    for part in ("GreaterThanOrEqual(n_instances,500)", "LessThanOrEqual(missing_rate,0.05)", "GreaterThan(n_features,7)"):
        assert part in pushed


def test_listing_gates(spark):
    rows = [(1, "A b", None, "MIT", "", "http://p", 2), (2, "a-b", "X", None, "c", None, 9), (3, "c", "", "", "c", "p", 5)]
    listing = spark.createDataFrame(rows, "did bigint, name string, licence string, license string, citation string, paper_url string, number_downloads bigint")
    assert [r["did"] for r in lst.licensed(listing).orderBy("did").collect()] == [1, 2]
    latest = {r["dataset_id"]: r["did"] for r in lst.listing_latest(listing).collect()}
    assert latest == {"a_b": 2, "c": 3}
    top = selection.top_popular(listing.withColumn("collection_id", F.lit("x")), 2)
    assert [r["did"] for r in top.orderBy("popularity").collect()] == [2, 3]
