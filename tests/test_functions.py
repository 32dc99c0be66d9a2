import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tablevet.functions import naming
from tablevet.functions.ordered import ranked, running_sums
from tablevet.operators import scores


def texts(spark, values, function):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(function(F.col("v"))).collect()]


def test_names(spark):
    raw = ["  Wine (red)--2 ", "Café_Ünï", "__a__b__", "x!@#y", "(( ))"]
    assert texts(spark, raw, naming.sanitize_name) == ["wine_red_2", "café_ünï", "a_b", "xy", ""]
    assert texts(spark, ["Binary & Clean!", "--", "a__b", "É1"], naming.slugify) == ["binary_clean", "collection", "a_b", "é1"]
    assert texts(spark, ["wine_quality_white"], naming.display_name) == ["Wine Quality White"]


def test_stamp_is_utc(spark):
    stamp = spark.range(1).select(naming.utc_stamp()).first()[0]
    assert len(stamp) == 20 and stamp.endswith("Z") and stamp[10] == "T"


def hot_frame(spark):
    """One group holds most of the rows; one group key is NULL."""
    rows = [(None if i % 50 == 0 else "hot" if i % 10 else f"g{i % 3}", (i * 37) % 101, i) for i in range(3000)]
    return spark.createDataFrame(rows, "g string, v int, k int")


def test_ranks_equal_window(spark):
    df = hot_frame(spark)
    order = Window.partitionBy("g").orderBy(F.desc("v"), "k")
    want = {tuple(r) for r in df.withColumn("n", F.row_number().over(order)).select("k", "n").collect()}
    got = ranked(df, ["g"], [F.desc("v"), F.asc("k")], "n")
    assert {tuple(r) for r in got.select("k", "n").collect()} == want
    sizes = {r["g"]: r["n_total"] for r in got.select("g", "n_total").distinct().collect()}
    assert sizes == {r["g"]: r["count"] for r in df.groupBy("g").count().collect()}


def test_running_sums_spread_the_hot_group(spark):
    df = hot_frame(spark)
    order = Window.partitionBy("g").orderBy("v", "k")
    want = {tuple(r) for r in df.withColumn("s", F.sum("v").over(order.rowsBetween(Window.unboundedPreceding, 0))).select("k", "s").collect()}
    got = running_sums(df, ["g"], [F.asc("v"), F.asc("k")], {"s": "v"})
    assert {tuple(r) for r in got.select("k", "s").collect()} == want


def test_auc_against_pairs(spark):
    rng = random.Random(3)
    rows = [(g, rng.randint(0, 1), rng.randint(0, 20) / 4) for g in ("a", "b") for _ in range(150)]
    rows += [("one_class", 1, 0.5)]
    df = spark.createDataFrame(rows, "g string, y int, s double")
    got = {r["g"]: r["auc"] for r in scores.roc_auc(df, "g", "y", "s").collect()}
    for group in ("a", "b"):
        pos = [s for g, y, s in rows if g == group and y == 1]
        neg = [s for g, y, s in rows if g == group and y == 0]
        won = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
        assert abs(got[group] - won / (len(pos) * len(neg))) < 1e-12
    assert got["one_class"] is None


def test_classification_scores(spark):
    rows = [("g", t, p) for t, p in [("a", "a"), ("a", "b"), ("b", "b"), ("b", "b"), ("c", "a"), ("a", "d")]]
    row = scores.classification_scores(spark.createDataFrame(rows, "g string, t string, p string"), "g", "t", "p").first()
    assert abs(row["accuracy"] - 3 / 6) < 1e-12
    assert abs(row["macro_precision"] - (1 / 2 + 2 / 3 + 0 + 0) / 4) < 1e-12
    assert abs(row["macro_recall"] - (1 / 3 + 1 + 0 + 0) / 4) < 1e-12
    assert abs(row["macro_f1"] - (2 / 5 + 4 / 5 + 0 + 0) / 4) < 1e-12


def test_split_is_stratified_and_repeatable(spark):
    df = spark.range(1003).selectExpr("id AS k", "CASE WHEN id < 900 THEN 'big' WHEN id < 1000 THEN 'mid' END AS y")
    once = {tuple(r) for r in scores.split_80_20(df, "k", "y").collect()}
    again = {tuple(r) for r in scores.split_80_20(df.repartition(5), "k", "y").collect()}
    assert once == again and len(once) == 1003
    train = [y for _, y, part in once if part == "train"]
    assert (train.count("big"), train.count("mid"), train.count(None)) == (720, 80, 3)
