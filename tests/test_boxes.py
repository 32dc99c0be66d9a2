"""Points in boxes against the product, and bounds that reach the scan."""

import random

import pytest
from pyspark.sql import functions as F

from tablevet.operators import boxes, criteria
from tablevet.sources import listing as lst

SCHEMA = "id bigint, a double, b bigint"
BOX_SCHEMA = "box bigint, min_a double, max_a double, min_b bigint, max_b bigint"


def number(rng):
    return rng.choice([None, float("nan"), -5.0, 0.0, 0.5, rng.uniform(0, 50), rng.uniform(0, 1e6), 1e300, 2.0**41])


def some(rng, n_points, n_boxes):
    points = [(i, number(rng), rng.choice([None, rng.randint(-3, 40), rng.randint(0, 10**6)])) for i in range(n_points)]
    found = []
    for i in range(n_boxes):
        a, b = sorted((rng.uniform(-10, 60), rng.choice([rng.uniform(0, 60), 1e6])))
        c, d = sorted((rng.randint(-5, 40), rng.choice([rng.randint(0, 40), 10**6])))
        if rng.random() < 0.1:
            a, b = b, a
        found.append((i, *[None if rng.random() < 0.15 else x for x in (a, b, c, d)]))
    return points, found


def holds(point, box):
    for value, low, high in ((point[1], box[1], box[2]), (point[2], box[3], box[4])):
        if low is None and high is None:
            continue
        if value is None:
            return False
        value = float("inf") if value != value else value  # a missing number is the largest one to Spark
        if (low is not None and value < low) or (high is not None and value > high):
            return False
    return True


def test_box_join_equals_the_product(spark):
    rng = random.Random(1)
    points, found = some(rng, 250, 120)
    out = boxes.box_join(spark.createDataFrame(points, SCHEMA), spark.createDataFrame(found, BOX_SCHEMA), ["a", "b"])
    got = sorted((r["id"], r["box"]) for r in out.select("id", "box").collect())
    assert got == sorted((p[0], b[0]) for p in points for b in found if holds(p, b))


def test_no_boxes_or_no_points(spark):
    points, found = some(random.Random(2), 5, 5)
    p, b = spark.createDataFrame(points, SCHEMA), spark.createDataFrame(found, BOX_SCHEMA)
    assert boxes.box_join(p, b.limit(0), ["a", "b"]).count() == 0
    assert boxes.box_join(p.limit(0), b, ["a", "b"]).count() == 0


def test_joined_rows_follow_the_pairs(spark):
    """Ten times the points and boxes give ten times the candidates, not a hundred times."""
    counts = []
    for n in (300, 3000):
        points = spark.range(n).selectExpr("id", "CAST(id * 10 AS double) AS a", "id % 100 AS b")
        ranges = spark.range(n).selectExpr(
            "id AS box", "CAST(id * 10 AS double) AS min_a", "CAST(id * 10 + 25 AS double) AS max_a", "0L AS min_b", "100L AS max_b"
        )
        counts.append(boxes.candidates(points, ranges, ["a", "b"]).count())
        assert boxes.box_join(points, ranges, ["a", "b"]).count() == 3 * n - 3
        assert counts[-1] < 10 * n
    assert counts[1] < 11 * counts[0]


def test_criteria_join_follows_the_passing_pairs(spark):
    def sizes(n):
        metrics = spark.range(n).selectExpr("id AS dataset_id", "id * 20 AS n_instances", "10L AS n_features", "concat('t', id % 5) AS task")
        specs = [
            {
                "collection_id": f"c{i}",
                "all_of": [
                    {"field": "n_instances", "op": "between", "value": [i * 20, i * 20 + 30]},
                    {"field": "task", "op": "==", "value": f"T{i % 5}"},
                ],
            }
            for i in range(n)
        ]
        table = criteria.criteria_df(spark, specs)
        passing = criteria.passing_criteria_table(metrics, table, ["dataset_id"])
        assert {(r["collection_id"], r["dataset_id"]) for r in passing.collect()} == {(f"c{i}", i) for i in range(n)}
        return criteria.criteria_candidates(metrics, table, ["dataset_id"]).count()

    assert sizes(400) < 6 * 400


def test_criteria_join_is_no_broadcast_and_keeps_open_ends(spark):
    metrics = spark.range(30).selectExpr("id AS dataset_id", "id AS n_instances", "id % 7 AS n_features", "if(id % 2 = 0, 'A=b', 'c') AS task")
    conditions = [("n_instances", ">", "4"), ("n_instances", "<", "20"), ("n_instances", ">=", "3"), ("n_features", "<", "5"), ("task", "==", "a=B")]
    rows = [("x", i, None, None, *c) for i, c in enumerate(conditions)]
    table = spark.createDataFrame(rows, "collection_id string, cond_no int, any_no int, group_no int, field string, op string, value string")
    passing = criteria.passing_criteria_table(metrics, table, ["dataset_id"])
    assert "Broadcast" not in passing._jdf.queryExecution().executedPlan().toString()
    found = sorted(r["dataset_id"] for r in passing.collect())
    assert found == [i for i in range(5, 20) if i % 7 < 5 and i % 2 == 0]


def test_merged_ranges_hold_all_and_are_disjoint(spark):
    rng = random.Random(3)
    for n, most in ((0, 4), (1, 4), (40, 64), (400, 5)):
        rows = []
        for i in range(n):
            a = rng.randint(0, 10 ** rng.randint(1, 9))
            rows.append((i, float(a), float(a + rng.randint(0, 50)), 0, 1))
        ranges = boxes.merged_ranges(spark.createDataFrame(rows, BOX_SCHEMA), "a", most)
        assert len(ranges) <= most and all(x[1] < y[0] for x, y in zip(ranges, ranges[1:]))
        for row in rows:
            assert any(low <= row[1] and row[2] <= high for low, high in ranges)


def test_buckets_ascend(spark):
    places = sorted({0, 1, *[2**k + d for k in range(1, 41) for d in (-1, 0, 1)], *range(0, 5000, 7)})
    df = spark.createDataFrame([(p,) for p in places], "p bigint").select("p", boxes.bucket(F.col("p")).alias("b"))
    got = [(r["p"], r["b"]) for r in df.orderBy("p").collect()]
    assert [b for _, b in got] == sorted(b for _, b in got)
    assert all(boxes.bucket_ends(b)[0] <= p <= boxes.bucket_ends(b)[1] for p, b in got)


@pytest.fixture(scope="module")
def stored_listing(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("listing") / "l")
    spark.range(20_000).selectExpr(
        "id AS did", "concat('n', id) AS name", "id AS n_instances", "id % 150 AS n_features", "id % 4 AS n_classes",
        "CASE WHEN id % 9 = 0 THEN 'gone' ELSE 'active' END AS status",
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_listing_scan_by_collection(spark, stored_listing):
    bounds = spark.createDataFrame(
        [("x", 500, 900, 5, 20, None), ("y", 700, 1500, 10, 10, 2), ("z", 9000, 9100, 0, 200, None), ("none", 50, 10, 5, 9, None)],
        "collection_id string, min_rows bigint, max_rows bigint, min_features bigint, max_features bigint, n_classes bigint",
    )
    found = lst.scan_by_collection(stored_listing, bounds)
    rows = [r.asDict() for r in stored_listing.where("status = 'active'").collect()]
    expected = [
        (b["collection_id"], r["did"])
        for b in bounds.collect()
        for r in rows
        if b["min_rows"] <= r["n_instances"] <= b["max_rows"]
        and b["min_features"] <= r["n_features"] <= b["max_features"]
        and b["n_classes"] in (None, r["n_classes"])
    ]
    assert sorted((r["collection_id"], r["did"]) for r in found.collect()) == sorted(expected)
    plan = found._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(n_instances,500)" in pushed and "Or(" in pushed and "EqualTo(status,active)" in pushed
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_nothing_to_scan_without_collections(spark, stored_listing):
    bounds = spark.createDataFrame([], "collection_id string, min_rows bigint, max_rows bigint, min_features bigint, max_features bigint, n_classes bigint")
    assert lst.scan_by_collection(stored_listing, bounds).count() == 0
