"""Edges that the SQL comparison cannot see."""

import pytest

from tablevet.operators import criteria, manifest, scores, selection
from tablevet.session import scratch_path


def test_missing_shared_folder_is_an_error_off_one_machine():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        scratch_path(Session(), "x")


def test_both_forms_agree_on_unknown_groups_and_number_texts(spark):
    metrics = spark.createDataFrame([("a", "5d"), ("b", "5"), ("c", None)], "dataset_id string, n_features string")
    specs = [
        {"collection_id": "u", "all_of": [{"any_of": [[{"field": "nope", "op": "==", "value": 1}]]}]},
        {"collection_id": "n", "all_of": [{"field": "n_features", "op": "<", "value": 10}]},
    ]
    table = criteria.match_criteria_table(metrics, criteria.criteria_df(spark, specs), ["dataset_id"])
    got = {(r.collection_id, r.dataset_id): r.passed for r in table.collect()}
    assert got == {
        ("u", "a"): True, ("u", "b"): True, ("u", "c"): True,
        ("n", "a"): False, ("n", "b"): True, ("n", "c"): False,
    }
    compiled = metrics.where(criteria.compile_criteria(specs[1], metrics.schema))
    assert [r.dataset_id for r in compiled.collect()] == ["b"]


def test_bare_words_are_values_and_columns_stay():
    text = "task == classification AND name != 'a == b' AND x == task AND ok == true AND n == f(1)"
    assert (
        selection.quote_bare(text, ["task", "name", "x"])
        == "task == 'classification' AND name != 'a == b' AND x == task AND ok == true AND n == f(1)"
    )


def test_scores_leave_out_missing_values_and_multiply_large_counts(spark):
    rows = [("g", 1, 0.9), ("g", 0, 0.1), ("g", 1, None), ("g", None, 0.5)]
    df = spark.createDataFrame(rows, "g string, y int, s double")
    assert scores.roc_auc(df, "g", "y", "s").first().auc == 1.0
    pairs = spark.sql("select cast(4e9 as bigint) as p").selectExpr("cast(p as double) * p as all").first()
    assert pairs["all"] == 1.6e19
    some = spark.createDataFrame([("g", 1.0, 1.0), ("g", 3.0, 3.0), ("g", 90.0, None)], "g string, y double, p double")
    assert scores.regression_scores(some, "g", "y", "p").first().r2 == 1.0


def test_manifest_has_no_limit_by_default():
    import inspect

    assert "top_k" not in inspect.signature(manifest.manifest_rows).parameters


def test_match_criteria_table_returns_failing_pairs_with_their_reason(spark):
    metrics = spark.createDataFrame([("a", 5), ("b", 50)], "dataset_id string, n_features bigint")
    specs = [{"collection_id": "n", "all_of": [{"field": "n_features", "op": "<", "value": 10}]}]
    table = criteria.match_criteria_table(metrics, criteria.criteria_df(spark, specs), ["dataset_id"])
    got = {r.dataset_id: (r.passed, r.reason) for r in table.collect()}
    assert got == {"a": (True, None), "b": (False, "n_features < 10")}
