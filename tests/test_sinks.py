"""CSV trees that any reader opens, stored ledger versions, and orders of their own."""

import random

import pytest
from pyspark.sql import functions as F

from tablevet.operators import criteria, manifest, screening, selection
from tablevet.sources import sinks
from tablevet.sources.csv_fleet import read_fleet
from tablevet.sources.fleet import Fleet, to_fleet
from tablevet.sources.ledger import Ledger, VersionTaken

TEXTS = ["plain", "", None, "a,b", 'say "hi"', " padded ", "two\nlines", "é", "NA"]


def mixed_fleet(spark):
    rows = [(i, TEXTS[i % len(TEXTS)], i / 4 if i % 3 else None, i % 2 == 0) for i in range(300)]
    first = spark.createDataFrame(rows, "`k` bigint, `te,xt` string, d double, y boolean")
    second = spark.range(7).selectExpr("id AS only")
    third = spark.createDataFrame([(None,), ("x",), ("",)], "t string")
    return to_fleet(first, "mixed one", "c 1").union(to_fleet(second, "narrow", "c 1"), to_fleet(third, "gaps", "c=2"))


@pytest.mark.parametrize("rows_per_file", [20, 1_000_000])
def test_csv_tree_opens_with_a_plain_reader(spark, tmp_path, rows_per_file):
    fleet = mixed_fleet(spark)
    path = str(tmp_path / "tree")
    sinks.write_csv_tree(fleet, path, rows_per_file)
    folder = tmp_path / "tree" / "collection_id=c 1"
    files = [f for f in (folder / "dataset_id=mixed one").iterdir() if f.suffix == ".txt"]
    assert len(files) == (8 if rows_per_file == 20 else 1)
    assert all(f.read_text().startswith('k,"te,xt",d,y\n') and f.read_text().count('"te,xt"') == 1 for f in files)
    plain = spark.read.csv(str(folder / "dataset_id=narrow"), header=True)
    assert plain.columns == ["only"] and sorted(r[0] for r in plain.collect()) == [str(i) for i in range(7)]
    whole = spark.read.csv(str(folder / "dataset_id=mixed one"), header=True, multiLine=True, escape='"')
    assert whole.columns == ["k", "te,xt", "d", "y"] and whole.count() == 300

    back = read_fleet(spark, path, "*.txt")
    assert back.failed.count() == 0
    rows = sinks.dataset_frame(back.fleet, "c 1", "mixed one")
    expected = [(i, t if (t := TEXTS[i % len(TEXTS)]) not in ("", "NA") else None, i / 4 if i % 3 else None, i % 2 == 0) for i in range(300)]
    assert sorted(map(tuple, rows.collect())) == expected
    assert sinks.dataset_frame(back.fleet, "c=2", "gaps").count() == 3


def test_datasets_without_rows_keep_their_header(spark, tmp_path):
    fleet = to_fleet(spark.range(3).selectExpr("id AS a", "id AS b"), "empty", "c")
    sinks.write_csv_tree(Fleet(fleet.rows.where("false"), fleet.columns), str(tmp_path / "t"))
    got = spark.read.csv(str(tmp_path / "t" / "collection_id=c" / "dataset_id=empty"), header=True)
    assert got.columns == ["a", "b"] and got.count() == 0


def test_export_tells_what_is_missing(spark, tmp_path):
    def table(n):
        return spark.range(n).selectExpr("id % 9 AS a", "id / 3 AS b", "id % 4 AS d", "id % 2 = 0 AS y")

    fleet = to_fleet(table(600), "one", "c").union(to_fleet(table(700), "two", "c"))
    limits = screening.Limits(min_rows=10, min_features=2)
    entries = manifest.manifest_entries(screening.screen(fleet, limits))
    assert entries.count() == 2
    some = Fleet(fleet.rows.where("dataset_id = 'one'"), fleet.columns.where("dataset_id = 'one'"))
    sinks.export(entries, some, str(tmp_path / "e"), fmt="csv")
    missing = spark.read.schema("collection_id string, dataset_id string").json(str(tmp_path / "e" / "missing"))
    assert [tuple(r) for r in missing.collect()] == [("c", "two")]
    assert spark.read.json(str(tmp_path / "e" / "manifest")).count() == 2
    assert spark.read.csv(str(tmp_path / "e" / "data" / "collection_id=c" / "dataset_id=one"), header=True).count() == 600
    with pytest.raises(ValueError, match="unknown format"):
        sinks.export(entries, some, str(tmp_path / "f"), fmt="zip")


def test_placed_rows_are_written_where_they_are(spark, tmp_path):
    df = spark.range(900).selectExpr("id % 9 AS a", "id AS b", "id / 3 AS d", "id % 2 AS y")
    copied = df.unionByName(df.where("b < 40")).drop("b").withColumn("b", F.col("d") * 2)
    fleet = to_fleet(df, "one", "c").union(to_fleet(copied, "two", "c", "y"))
    limits = screening.Limits(min_rows=10, min_features=2)
    screened = screening.screen(fleet, limits).localCheckpoint()
    cleaned = screening.clean_fleet(fleet, limits, screened=screened, by_dataset=True)
    sinks.export(manifest.manifest_entries(screened), cleaned, str(tmp_path / "e"), placed=True)
    back = sinks.read_processed(spark, str(tmp_path / "e"))
    assert {r["dataset_id"]: r["count"] for r in back.rows.groupBy("dataset_id").count().collect()} == {"one": 900, "two": 900}
    plain = sinks.read_processed(spark, str(tmp_path / "e")).rows.where("dataset_id = 'one'")
    assert plain.selectExpr("sum(longs[0])").first()[0] == sum(i % 9 for i in range(900))


LEDGER = "collection_id string, dataset_id string, status string"


def test_ledger_versions(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    with pytest.raises(LookupError):
        ledger.read()
    rows = spark.createDataFrame([("c", "a", "cataloged"), ("c", "b", "cataloged")], LEDGER)
    assert ledger.commit(rows, 0) == 1
    before = ledger.read()
    assert ledger.update_status(spark.createDataFrame([("c", "a", "validated")], LEDGER)) == 2
    as_set = lambda df: {(r["dataset_id"], r["status"]) for r in df.collect()}
    assert as_set(ledger.read()) == {("a", "validated"), ("b", "cataloged")}
    assert as_set(before) == as_set(ledger.read(1)) == {("a", "cataloged"), ("b", "cataloged")}


def test_second_writer_is_rejected(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    rows = spark.createDataFrame([("c", "a", "cataloged")], LEDGER)
    ledger.commit(rows, 0)
    ledger.commit(rows.withColumn("status", F.lit("first")), 1)
    with pytest.raises(VersionTaken):
        ledger.commit(rows.withColumn("status", F.lit("second")), 1)
    assert ledger.versions() == [1, 2]
    assert ledger.read().first()["status"] == "first"


def test_reader_during_an_update_sees_a_whole_version(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    rows = spark.createDataFrame([("c", str(i), "old") for i in range(50)], LEDGER)
    ledger.commit(rows, 0)
    # The data of the next version is there, its name is not.
    rows.withColumn("status", F.lit("new")).limit(20).write.parquet(str(tmp_path / "ledger" / "data" / "2-unfinished"))
    assert {(r["status"], r["n"]) for r in ledger.read().groupBy("status").agg(F.count("*").alias("n")).collect()} == {("old", 50)}


def test_orders_of_their_own(spark):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        number = rng.choice([None, float("nan"), float(rng.randint(-3, 3)), 1e300, -0.5])
        rows.append((rng.choice("xyz"), f"d{i}", number, rng.choice([None, "", "a", "ab", "b", "é", "Z"]), rng.choice([True, False, None])))
    df = spark.createDataFrame(rows, "collection_id string, dataset_id string, n double, t string, f boolean")
    orders = {"x": [("n", "desc"), ("t", "asc")], "y": [("t", "desc"), ("n", "asc"), ("gone", "asc")], "z": [("f", "desc")]}
    keys = spark.createDataFrame([(c, [tuple(k) for k in o]) for c, o in orders.items()], "collection_id string, keys array<struct<field string, order string>>")
    got = {(r["collection_id"], r["dataset_id"]): r["sort_rank"] for r in selection.sorted_by_collection(df, keys).collect()}
    columns = ["collection_id", "dataset_id", "n", "t", "f"]
    for c, order in orders.items():
        own = [r for r in rows if r[0] == c]
        own.sort(key=lambda r: r[1])
        for field, direction in reversed([k for k in order if k[0] in columns]):
            at = columns.index(field)
            value = lambda r: r[at].encode() if isinstance(r[at], str) else r[at]  # noqa: B023, E731
            gone = lambda r: r[at] is None or r[at] != r[at]  # noqa: B023, E731
            present = sorted((r for r in own if not gone(r)), key=value, reverse=direction == "desc")
            if direction == "desc":  # equal ones keep their order
                present = sorted((r for r in own if not gone(r)), key=lambda r: value(r), reverse=False)
                groups = {}
                for r in present:
                    groups.setdefault(value(r), []).append(r)
                present = [r for v in sorted(groups, reverse=True) for r in groups[v]]
            own = present + [r for r in own if gone(r)]
        assert [got[c, r[1]] for r in own] == list(range(1, len(own) + 1))


def test_order_follows_the_conditions(spark):
    specs = [
        {"collection_id": "a", "all_of": [{"field": "imbalance_ratio", "op": ">", "value": 2}]},
        {"collection_id": "b", "all_of": [{"field": "n_instances", "op": ">", "value": 2}]},
        {"collection_id": "c", "all_of": [{"field": "task", "op": "==", "value": "x"}]},
    ]
    keys = selection.preferred_keys(criteria.criteria_df(spark, specs)).collect()
    assert {r["collection_id"]: [tuple(k) for k in r["keys"]] for r in keys} == {
        "a": [("imbalance_ratio", "desc"), ("n_instances", "desc")],
        "b": [("n_instances", "asc")],
        "c": [("n_instances", "desc")],
    }
