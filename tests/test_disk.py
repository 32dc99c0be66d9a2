"""What queries leave on disk while they run, beside their results."""

import time

from pyspark.sql import functions as F

from tablevet.operators import screening
from tablevet.session import fixed_scan, noted_paths, staged
from tablevet.sources import sinks
from tablevet.sources.csv_fleet import read_fleet
from tablevet.sources.fleet import to_fleet


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum("shuffle_" in files.apply(i).getName() for i in range(files.size()))


def test_staged_tables_leave_no_shuffle_files(spark):
    before = shuffle_files(spark)
    held = [staged(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "folded") for _ in range(5)]
    end = time.time() + 20
    while shuffle_files(spark) > before and time.time() < end:
        time.sleep(0.2)
    assert shuffle_files(spark) <= before and held[0].count() == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_lines_of_a_csv_tree_are_not_written_again(spark, tmp_path):
    table = spark.range(500).selectExpr("id AS a", "concat('x, ', id, '\\n\"q\"') AS t", "id % 3 AS y")
    for part in range(3):
        sinks.write_raw(table.where(f"y = {part}"), str(tmp_path / "raw"), f"c{part}", "d", rows_per_file=40)
    with noted_paths() as made:
        fleet = read_fleet(spark, str(tmp_path / "raw")).fleet
        rows = {(r.collection_id, r.longs[0], r.texts[0]) for r in fleet.rows.collect()}
    assert rows == {(f"c{i % 3}", i, f'x, {i}\n"q"') for i in range(500)}
    names = {path.rsplit("/", 1)[-1].rsplit("-", 1)[0] for path in made}
    assert "records" in names and "lines" not in names


def test_a_fixed_scan_numbers_rows_the_same_under_another_split(spark, tmp_path):
    spark.range(20_000).selectExpr("CAST(id AS STRING) AS value").coalesce(1).write.text(str(tmp_path / "t"))
    scan = spark.read.text(str(tmp_path / "t")).withColumn("at", F.monotonically_increasing_id())
    fixed = fixed_scan(scan)
    first = {tuple(r) for r in fixed.collect()}
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert {tuple(r) for r in fixed.select("value", "at").collect()} == first
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def copied_fleet(spark, n):
    table = spark.range(60).selectExpr("id % 30 AS k", "id % 30 DIV 2 AS a", "id % 30 / 4 AS b", "id % 30 % 5 AS d", "id % 2 = 0 AS y")
    tables = [to_fleet(table.selectExpr("*"), f"d{i}", "c") for i in range(n)]
    return tables[0].union(*tables[1:])


def test_folded_rows_of_few_datasets_are_not_shuffled_again(spark, tmp_path):
    limits = screening.Limits(min_rows=10, min_features=1)
    fleet = copied_fleet(spark, 2)
    cleaned = screening.clean_fleet(fleet, limits, by_dataset=True)
    plan = cleaned.rows._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE" not in plan and cleaned.rows.count() == 60
    sinks.write_processed(cleaned, str(tmp_path / "p"), placed=True)
    assert sinks.read_processed(spark, str(tmp_path / "p")).rows.groupBy("dataset_id").count().collect() != []


def test_folded_rows_of_many_datasets_are_laid_out_by_dataset(spark, monkeypatch):
    monkeypatch.setattr(screening, "FEW_DATASETS", 1)
    limits = screening.Limits(min_rows=10, min_features=1)
    cleaned = screening.clean_fleet(copied_fleet(spark, 2), limits, by_dataset=True)
    assert "REBALANCE" in cleaned.rows._jdf.queryExecution().executedPlan().toString() and cleaned.rows.count() == 60


def test_file_counts_of_a_csv_tree_are_stored(spark, tmp_path):
    fleet = to_fleet(spark.range(30).selectExpr("id AS a", "id % 2 AS y"), "d", "c")
    with noted_paths() as made:
        sinks.write_csv_tree(fleet, str(tmp_path / "t"))
    assert any("/files-" in path for path in made)
