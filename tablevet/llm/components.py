"""Connected components of an edge table, by joins and aggregations only."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablevet.llm.common import join_by_size, ship
from tablevet.session import staged


# A node with up to so many links is no burden for a task of a shuffled join.
FEW_LINKS = 10_000
# Links of a task that are connected at once.
CHUNK_LINKS = 1_000_000


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of the nodes that some links tie to a smaller one."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while len(a):
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
        a, b = root[a], root[b]
        a, b = a[a != b], b[a != b]
    tied = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[tied], nodes[root[tied]]


def contracted(links: DataFrame) -> DataFrame:
    """Links (a, b), b < a, that connect the same nodes: stars of what each task connects by itself."""

    def star_rows(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        a, b = (c.to_numpy() for c in table.columns)
        columns = [pa.array(x, t) for x, t in zip(stars(a, b), table.schema.types)]
        return pa.RecordBatch.from_arrays(columns, ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held += [batch] if batch.num_rows else []
            if sum(x.num_rows for x in held) >= CHUNK_LINKS:
                yield star_rows(held)
                held = []
        if held:
            yield star_rows(held)

    links = ship(links.select("a", "b"))
    return links.mapInArrow(run, links.schema)


def with_least(links: DataFrame, least: DataFrame, total: int, most: int) -> DataFrame:
    """Links (a, b) with ``m`` of their node a. ``least`` has one row per node and its number of links,
    ``total`` in all and at most ``most`` a node."""
    if most <= max(FEW_LINKS, total // 1000):
        return links.join(least, "a")
    return join_by_size(links, least, "a", "n", total)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the smallest node reachable.

    Alternates two rewritings: every neighbour that is larger than a node is linked to the smallest
    neighbour of that node, then every neighbour that is smaller. Both keep the components and turn
    them into stars around their smallest node in about log(n) rounds; they are stars when no node with a
    smaller neighbour has another one. Before that, a task connects what its own links connect. Each round is a written table, so plans stay short and a lost
    executor costs one re-read. A node with many neighbours meets its smallest one in a broadcast of such
    nodes, so its rows never gather.
    """
    links = staged(contracted(edges.where("a <> b")).distinct(), "links")
    total, most = F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count(F.lit(1)).alias("n"))
        least = staged(least, "least")
        *sizes, loose = least.agg(total, most, F.count_if((F.col("m") < F.col("a")) & (F.col("n") > 1))).first()
        if not loose:
            return least.select(F.col("a").alias("node"), F.col("m").alias("root"))
        large = with_least(both, least, *sizes).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = staged(large.where("a <> b").distinct(), "large")
        least = staged(large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")), "least")
        small = with_least(large, least, *least.agg(total, most).first())
        small = small.select("a", F.col("m").alias("b")).unionByName(
            small.select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        links = staged(contracted(small.where("a <> b")).distinct(), "links")
