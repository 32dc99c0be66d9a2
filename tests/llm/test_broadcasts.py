"""Joins whose sides an explode or a list makes larger than Spark estimates are never broadcast by size."""

import re

from pyspark.sql import functions as F

from tablevet.llm import secret_ledger, simhash
from tablevet.session import staged


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_grid_cells_are_never_broadcast(spark):
    nodes = spark.range(200).select(F.col("id").alias("node"), F.xxhash64("id").alias("fp"), F.lit(1).alias("n"))
    plan = plan_of(simhash.node_links(staged(nodes, "nodes")))
    assert "BroadcastHashJoin" not in plan and len(re.findall("SortMergeJoin", plan)) == 1


def test_pieces_of_masked_texts_are_never_broadcast(spark):
    docs = spark.createDataFrame([(i, i, f"a text of secret{i}") for i in range(20)], "f bigint, p bigint, text string")
    span = F.array(F.struct(F.lit(10).alias("start"), F.lit(16).alias("end")))
    docs = staged(docs, "docs")
    found = staged(docs.select("f", "p", F.length("text").alias("length"), span.alias("spans")), "found")
    masked = secret_ledger.mask(docs, ["f", "p"], found)
    joins = re.findall(r"(\w+Join) \[.*\], (\w+)", plan_of(masked))
    assert ("SortMergeJoin", "Inner") in joins and ("BroadcastHashJoin", "Inner") not in joins
    assert sorted(r.text for r in masked.collect()) == sorted(f"a text of ******{i}" for i in range(20))
