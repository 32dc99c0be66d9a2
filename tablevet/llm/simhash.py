"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint of 64 bits is mapped to the bit counts of its 2-bit segments, once cut at even and once
at odd positions. The Manhattan distance of two such vectors never exceeds the Hamming distance of
the fingerprints. The vectors are joined on a grid: the 32 even segments form 7 blocks, and if four
bits differ at most, three blocks agree in all counts, so the counts of each choice of three blocks
name a grid cell of unit width (35 cells a fingerprint) and every link shares a cell. Pairs of a cell
pass the Manhattan bound, then the Hamming distance itself.

Counts are stored in unary (0: 00, 1: 01, 2: 11), so a vector is one long and the Manhattan distance
of two vectors is the bit count of their exclusive or.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablevet.llm.common import Words, addressed, by_address, give_back, join_by_size, ship, text_slices
from tablevet.llm.components import connected_components
from tablevet.llm.jaccard_regions import LINK, cut_regions, member_texts, region_rows, set_names, shingle_sets
from tablevet.session import staged

N_BLOCKS = 7
MAX_DISTANCE = 4
CELL_ROWS = 4096
EVEN = 0x5555555555555555


def text_fingerprints(texts: list[bytes], width: int) -> np.ndarray:
    """SimHash of the word shingles of each text; no word gives 0."""
    words = Words(texts, lower=True)
    out = np.zeros(len(texts), np.uint64)
    if not len(words.starts):
        return out
    # Words joined by one space each: a shingle is one byte range of that text.
    flat = b" ".join(words.data.tobytes().split())
    ends = np.cumsum(words.ends - words.starts + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    n = np.maximum(words.counts - width + 1, np.minimum(words.counts, 1))
    doc = np.repeat(np.arange(len(texts)), n)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n) + words.first[doc]
    last = np.minimum(place + width, words.first[doc] + words.counts[doc]) - 1
    h = np.fromiter(
        (xxhash.xxh64_intdigest(flat[a:b], 42) for a, b in zip(starts[place].tolist(), ends[last].tolist())),
        np.uint64,
        len(doc),
    )
    has = np.flatnonzero(n)
    first = (np.cumsum(n) - n)[has]
    for byte in range(8):
        part = (h >> np.uint64(8 * byte)).astype(np.uint8)
        bits = np.unpackbits(part[:, None], axis=1, bitorder="little")
        votes = np.add.reduceat(bits, first, axis=0, dtype=np.int64)
        bit = (2 * votes > n[has, None]).astype(np.uint64)
        shifts = np.arange(8 * byte, 8 * byte + 8, dtype=np.uint64)
        out[has] |= (bit << shifts).sum(axis=1, dtype=np.uint64)
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """(locator, fp): SimHash of word shingles of each text; no word gives 0, null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches):
            fp = text_fingerprints(texts, width).view(np.int64)
            yield pa.RecordBatch.from_arrays([rows.column(0).cast(pa.int64()), pa.array(fp)], ["locator", "fp"])

    return ship(docs).select(F.col(id_col).cast("bigint").alias("locator"), F.col(text_col).alias("text")).mapInArrow(
        run, "locator bigint, fp bigint"
    )


def unary(x):
    """Bit counts of the 2-bit segments of a long, in unary."""
    low = F.lit(EVEN).cast("bigint")
    high = F.shiftrightunsigned(x, 1)
    return x.bitwiseOR(high).bitwiseAND(low).bitwiseOR(F.shiftleft(x.bitwiseAND(high).bitwiseAND(low), 1))


def rotated(x):
    return F.shiftrightunsigned(x, 1).bitwiseOR(F.shiftleft(x, 63))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def cell_masks(n_blocks: int = N_BLOCKS, distance: int = MAX_DISTANCE) -> list[tuple[int, int]]:
    """For every choice of blocks that must agree: masks of the even and of the odd segments."""
    cuts = [round(32 * i / n_blocks) for i in range(n_blocks + 1)]
    masks = []
    for chosen in combinations(range(n_blocks), n_blocks - distance):
        even = odd = 0
        for block in chosen:
            for segment in range(cuts[block], cuts[block + 1]):
                even |= 3 << (2 * segment)
                if segment + 1 < cuts[block + 1]:  # odd segments inside the block
                    odd |= 3 << (2 * segment)
        masks.append((_signed(even), _signed(odd)))
    return masks


def in_cells(nodes: DataFrame, n_blocks: int, distance: int) -> DataFrame:
    """(cell, node, fp, n): each node in the grid cells of all block choices of its fingerprint."""
    even, odd = unary(F.col("fp")), unary(rotated(F.col("fp")))
    cells = [
        F.xxhash64(F.lit(k), F.col("_even").bitwiseAND(F.lit(a)), F.col("_odd").bitwiseAND(F.lit(b)))
        for k, (a, b) in enumerate(cell_masks(n_blocks, distance))
    ]
    with_counts = nodes.select("node", "fp", "n", even.alias("_even"), odd.alias("_odd"))
    return with_counts.select("node", "fp", "n", F.explode(F.array(*cells)).alias("cell"))


def _unary(x: np.ndarray) -> np.ndarray:
    low, high = np.uint64(EVEN), x >> np.uint64(1)
    return ((x | high) & low) | ((x & high & low) << np.uint64(1))


class Cell:
    """Members of some grid cells: their fingerprints, and the sizes that may not differ too much."""

    def __init__(self, fp: np.ndarray, n: np.ndarray, distance: int, similar: int):
        self.fp, self.n, self.distance, self.similar = fp, n, distance, similar
        self.counts = _unary(fp)

    def verified(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Pairs within the distance whose smaller size is at least ``similar`` percent of the larger one."""
        near = np.bitwise_count(self.fp[a] ^ self.fp[b]) <= self.distance
        if self.similar:
            low, high = np.minimum(self.n[a], self.n[b]), np.maximum(self.n[a], self.n[b])
            near &= 100 * low >= self.similar * high
        return near

    def forest(self, start: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Links that connect what is connected in one cell: all pairs by the Manhattan bound of their
        counts, a block at a time, then by the distance itself where they are not connected yet."""
        counts, part = self.counts[start : start + n], np.arange(n)
        out: list[tuple[int, int]] = []
        step = max(1, (1 << 18) // n)
        for begin in range(0, n, step):
            block = counts[begin : begin + step]
            near = np.bitwise_count(block[:, None] ^ counts[None, begin:]) <= self.distance
            a, b = np.nonzero(near)
            a, b = a + begin, b + begin
            open_ = (a < b) & (part[a] != part[b])
            a, b = a[open_], b[open_]
            linked = self.verified(start + a, start + b)
            for one, other in zip(a[linked].tolist(), b[linked].tolist()):
                if part[one] != part[other]:
                    out.append((start + one, start + other))
                    part[part == part[other]] = part[one]
        pairs = np.array(out, np.int64).reshape(-1, 2)
        return pairs[:, 0], pairs[:, 1]

    def small(self, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Linked pairs within runs of equal cells, all runs at once; index of both members."""
        place = np.concatenate([np.arange(s, s + m) for s, m in zip(starts, sizes)])
        n_after = np.repeat(starts + sizes, sizes) - place - 1
        a = np.repeat(place, n_after)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n_after) - n_after, n_after)
        out = [np.zeros((2, 0), np.int64)]
        for i in range(0, len(a), 1 << 18):
            x, y = a[i : i + (1 << 18)], b[i : i + (1 << 18)]
            near = np.bitwise_count(self.counts[x] ^ self.counts[y]) <= self.distance
            x, y = x[near], y[near]
            near = self.verified(x, y)
            out.append(np.stack([x[near], y[near]]))
        a, b = np.concatenate(out, axis=1)
        return a, b


def _edges(distance: int, similar: int):
    """Links among the members of each (cell, lo, hi); rows come sorted by these."""
    names = ("cell", "lo", "hi", "node", "fp", "n")

    def links(rows: np.ndarray) -> pa.RecordBatch:
        keys, node = rows[:, :3], rows[:, 3]
        cell = Cell(rows[:, 4].astype(np.uint64), rows[:, 5], distance, similar)
        cut = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
        sizes = np.diff(np.append(cut, len(rows)))
        small = (sizes > 1) & (sizes <= 16)
        pairs = [np.zeros((2, 0), np.int64)]
        if small.any():
            pairs.append(node[np.stack(cell.small(cut[small], sizes[small]))])
        for start, n in zip(cut[sizes > 16].tolist(), sizes[sizes > 16].tolist()):
            pairs.append(node[np.stack(cell.forest(start, n))])
        found = np.unique(np.concatenate(pairs, axis=1), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.zeros((0, len(names)), np.int64)
        for batch in batches:
            rows = np.concatenate([kept, np.stack([batch.column(c).to_numpy() for c in names], axis=1)])
            if not len(rows):
                continue
            other = (rows[:, :3] != rows[-1, :3]).any(axis=1)
            whole = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
            kept = rows[whole:]
            if whole:
                yield links(rows[:whole])
        if len(kept):
            yield links(kept)
        give_back()

    return run


def blocks_for(n_nodes: int, distance: int) -> int:
    """Number of blocks: more must agree in a larger table, so that cells stay small."""
    agree = 2 if distance > 6 else 3
    while n_nodes > 4_000_000 * 30 ** (agree - (2 if distance > 6 else 3)):
        agree += 1
    return distance + agree


def node_links(nodes: DataFrame, distance: int = MAX_DISTANCE, similar: int = 0, n_blocks: int | None = None) -> DataFrame:
    """Links (a, b) between nodes (node, fp, n), enough to connect all that are linked.

    A cell of many members is cut into chunks of about CELL_ROWS, and every two chunks meet in a
    group of their own, so no task holds a whole cell and no pair is left out. A group gives a
    forest, not all pairs. With ``similar``, the smaller n of a link is at least that percentage of the larger.
    """
    cells = in_cells(nodes, n_blocks or blocks_for(nodes.count(), distance), distance)
    sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("in_cell")).where("in_cell > 1")
    chunks = F.ceil(F.col("in_cell") / CELL_ROWS).cast("int")
    # Estimates miss that a node is in many cells, so a broadcast would pass them all through the driver.
    members = cells.hint("merge").join(sizes, "cell").withColumn("k", chunks)
    members = members.withColumn("own", F.pmod(F.xxhash64("node"), "k").cast("int"))
    others = F.filter(F.sequence(F.lit(0), F.col("k") - 1), lambda j: (j != F.col("own")) | (F.col("k") == 1))
    groups = members.select("cell", "node", "fp", "n", "own", F.explode(others).alias("other")).select(
        "cell",
        F.least("own", "other").cast("bigint").alias("lo"),
        F.greatest("own", "other").cast("bigint").alias("hi"),
        "node",
        "fp",
        F.col("n").cast("bigint").alias("n"),
    )
    groups = groups.repartition("cell", "lo", "hi").sortWithinPartitions("cell", "lo", "hi")
    return groups.mapInArrow(_edges(distance, similar), "a bigint, b bigint").distinct()


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """Links (a, b) between different fingerprints, enough to connect all that are linked."""
    return node_links(fps.select(F.col("fp").alias("node"), "fp", F.lit(0).alias("n")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(locator, fp, component): component is the smallest id reachable over links, the own included.

    Null texts are empty; all texts without words have fingerprint 0 and are linked. A null id never
    names a component but for components without any other id. Repeated rows give repeated rows, an
    empty table none. Copies fold into one fingerprint before any join.
    """
    rows = staged(fingerprints(docs, id_col, text_col), "fingerprints")
    fps = staged(
        rows.groupBy("fp").agg(F.min("locator").alias("least"), F.count(F.lit(1)).alias("n")), "distinct"
    )
    parts = connected_components(fingerprint_links(fps))
    in_parts = fps.join(parts, F.col("fp") == F.col("node"))
    least = in_parts.groupBy("root").agg(F.min("least").alias("component"))
    named = in_parts.select("fp", "n", "root").join(least, "root").select("fp", "n", "component")
    copies = fps.where("n > 1").join(named.select("fp"), "fp", "left_anti")
    named = staged(named.unionByName(copies.select("fp", "n", F.col("least").alias("component"))), "named")
    out = join_by_size(rows, named, "fp", "n", rows.count())
    return out.select("locator", "fp", F.coalesce("component", "locator").alias("component"))


def near_duplicate_report(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select(
        F.col("locator").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


# The stage: texts are near copies if their sets of five-word shingles are similar by 80 percent. Candidates
# are texts whose fingerprints of two-word shingles differ in at most nine bits, which finds more of them than
# fingerprints of longer shingles.
STAGE_WIDTH = 5
STAGE_SIMILAR = 80
STAGE_FEATURES = 2
STAGE_DISTANCE = 9


def _judged_rows(docs: DataFrame, keys: list[str], features: int, width: int) -> DataFrame:
    """(both keys, doc_id, fp, node, name, n) of every row: the fingerprint, and name and size of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches):
            sizes, hashes = shingle_sets(texts, width)
            names = set_names(sizes, hashes)
            fp = text_fingerprints(texts, features)
            columns = [rows.column(k) for k in range(3)]
            columns += [pa.array(fp.view(np.int64)), pa.array(names[:, 0].view(np.int64))]
            columns += [pa.array([x.tobytes() for x in names], pa.binary()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*keys, "doc_id", "fp", "node", "name", "n"])

    schema = f"`{keys[0]}` bigint, `{keys[1]}` bigint, doc_id bigint, fp bigint, node bigint, name binary, n bigint"
    picked = docs.select(*keys, F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text"))
    return picked.mapInArrow(run, schema)


def keep_representatives(
    docs: DataFrame,
    width: int = STAGE_WIDTH,
    similar: int = STAGE_SIMILAR,
    features: int = STAGE_FEATURES,
    distance: int = STAGE_DISTANCE,
) -> DataFrame:
    """The rows of ``docs`` that stay, with all columns: one per component of near copies, of the smallest id
    and then the first of its rows by address.

    Fingerprints of ``features`` words within ``distance`` bits propose pairs; texts of such a family are then
    compared exactly, and linked if the sets of their shingles of ``width`` words have a Jaccard similarity
    of ``similar`` percent. Texts without words, null ones among them, are copies of each other. Rows are
    named by address, so rows that share an id but not a text are judged each by its own component. Rows
    without an id all stay, but they link what they resemble. An empty table gives no rows; columns of
    any name are kept as they are. Of all texts only those move that have a candidate.
    """
    docs, keys = addressed(ship(docs))
    rows = staged(_judged_rows(docs, keys, features, width), "judged")
    nodes = rows.where("n > 0").groupBy("node").agg(F.min("fp").alias("fp"), F.max("n").alias("n"))
    parts = staged(connected_components(node_links(staged(nodes, "nodes"), distance, similar)), "families")
    members = staged(member_texts(docs, parts, "text", width), "members")
    regions, links = cut_regions(members, width, similar)
    regions = regions.repartition("region").sortWithinPartitions("region")
    links = staged(links.unionByName(regions.mapInArrow(region_rows(width, similar), LINK)), "region-links")
    linked = connected_components(links)
    named = rows.where("doc_id IS NOT NULL").groupBy("name").agg(F.min(F.struct("doc_id", *keys)).alias("least"))
    named = named.join(linked.withColumnRenamed("node", "name"), "name", "left")
    stays = named.groupBy(F.coalesce("root", "name")).agg(F.min("least").alias("least"))
    stays = stays.select(*[F.col("least")[k].alias(k) for k in keys])
    lost = staged(rows.where("doc_id IS NOT NULL").join(stays, keys, "left_anti").select(*keys), "lost")
    return by_address(docs, keys, lost, "left_anti").drop(*keys)
