"""Removal of repeated byte strings by a hash-compared suffix sort.

Every string of ``least`` bytes contains an anchor: the smallest hash of ``GRAM`` bytes in it, chosen by
its own content alone. Equal strings therefore have equal anchors at equal offsets, and only suffixes
behind equal anchors have to be sorted against each other:

1. One pass finds the anchors of every text, with the range of string starts that chose each and a
   128-bit digest of the bytes around it, its context.
2. Contexts that occur twice or more repeat all their strings. Anchors with one context are done.
3. For anchors with several contexts, one copy of each context is fetched. Suffixes are sorted within
   (anchor, offset) by a mergesort that compares two suffixes by the length of their common extension,
   found by binary search over prefix polynomial hashes. The byte behind it decides, and it must differ,
   which exposes collisions. Neighbours that share ``least`` bytes, verified byte by byte, are repeated.
4. Repeated starts become intervals of their texts, and these leave the text.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablevet.llm.common import mixed, powers, prefix_hashes, ship, text_slices
from tablevet.session import staged

LEAST = 400
GRAM = 64
BUCKET_ROWS = 4_000
HOT_KINDS = 20_000
INDEX_BITS = 26


def anchors(text: bytes, least: int = LEAST, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(hash, position, first start, last start) of the anchors of a text, by position.

    A start chooses the smallest gram hash among the ``least - gram + 1`` grams of its string, the
    leftmost of equals. Texts of more than 2**26 bytes are cut into overlapping parts.
    """
    part = 1 << INDEX_BITS
    if len(text) > part:
        step = part - least + 1
        cuts = [anchors(text[a : a + part], least, gram) for a in range(0, len(text) - least + 1, step)]
        return tuple(
            np.concatenate([c[k] + (np.int64(i * step) if k else np.uint64(0)) for i, c in enumerate(cuts)]) for k in range(4)
        )
    n = len(text) - least + 1
    if n <= 0:
        return np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3
    data = np.frombuffer(text, np.uint8)
    prefix = prefix_hashes(data)
    grams = len(text) - gram + 1
    h = mixed((prefix[gram:] - prefix[:grams]) * powers(grams)[1])
    key = (h & ~np.uint64((1 << INDEX_BITS) - 1)) | np.arange(grams, dtype=np.uint64)
    window = least - gram + 1
    # Sliding minimum: the end of one block and the beginning of the next.
    blocks = -(-grams // window) * window
    padded = np.full(blocks, np.uint64(2**64 - 1))
    padded[:grams] = key
    square = padded.reshape(-1, window)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    back = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    least_key = np.minimum(back[:n], ahead[window - 1 : window - 1 + n])
    at = (least_key & np.uint64((1 << INDEX_BITS) - 1)).astype(np.int64)
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    last = np.append(first[1:], n) - 1
    return h[at[first]], at[first], first, last


def find_anchors(plain: DataFrame, least: int, gram: int) -> DataFrame:
    """One row per text: its row number, id, byte count, digest, and arrays over its anchors: hash,
    first and last start, and both halves of the digest of the context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches):
            out: list[list] = [[] for _ in range(7)]
            for text in texts:
                h, at, first, last = anchors(text, least, gram)
                # A context covers the strings of all starts that chose the anchor.
                digests = b"".join(
                    xxhash.xxh3_128_digest(text[f : g + least] + (p - f).to_bytes(4, "little"))
                    for f, p, g in zip(first.tolist(), at.tolist(), last.tolist())
                )
                halves = np.frombuffer(digests, np.int64).reshape(-1, 2)
                found = (len(text), hashlib.sha256(text).hexdigest(), h.view(np.int64), first, last, halves[:, 0], halves[:, 1])
                for column, x in zip(out, found):
                    column.append(x)
            lists = [pa.array(x, pa.list_(pa.int64())) for x in out[2:]]
            yield pa.RecordBatch.from_arrays(
                [rows.column("row"), rows.column("id"), pa.array(out[0], pa.int64()), pa.array(out[1]), *lists],
                ["row", "id", "n_bytes", "sha", "h", "first", "last", "c1", "c2"],
            )

    lists = ", ".join(f"{c} array<bigint>" for c in ("h", "first", "last", "c1", "c2"))
    return plain.mapInArrow(run, f"row bigint, id bigint, n_bytes bigint, sha string, {lists}")


class Suffixes:
    """Suffixes of some byte strings, compared up to ``least`` bytes by prefix hashes."""

    def __init__(self, contexts: list[bytes], least: int):
        self.data = np.frombuffer(b"".join(contexts) + bytes(least + 1), np.uint8)
        self.prefix = prefix_hashes(self.data)
        self.inverse = powers(len(self.prefix))[1]
        self.least = least

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of each pair of starts, at most ``least``: binary search for
        the longest prefix with equal hashes."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.least)
        left = np.flatnonzero(a != b)
        low[a == b] = self.least
        back_a, back_b = self.inverse[a], self.inverse[b]
        while len(left):
            middle = (low[left] + high[left] + 1) // 2
            x, y = a[left], b[left]
            same = (self.prefix[x + middle] - self.prefix[x]) * back_a[left] == (self.prefix[y + middle] - self.prefix[y]) * back_b[left]
            low[left] = np.where(same, middle, low[left])
            high[left] = np.where(same, high[left], middle - 1)
            left = left[low[left] < high[left]]
        # A true extension ends at bytes that differ; otherwise two hashes collided.
        odd = (low < self.least) & (self.data[a + low] == self.data[b + low])
        for i in np.flatnonzero(odd):
            low[i] = self.direct(int(a[i]), int(b[i]))
        return low

    def direct(self, a: int, b: int) -> int:
        differ = self.data[a : a + self.least] != self.data[b : b + self.least]
        return int(np.argmax(differ)) if differ.any() else self.least

    def before(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        common = self.common(a, b)
        return np.where(common < self.least, self.data[a + common] < self.data[b + common], or_equal)

    def sort(self, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """``starts`` sorted within consecutive groups of ``sizes``: a bottom-up mergesort of all groups
        at once, in which every suffix finds its place in the other run by binary search."""
        group = np.repeat(np.cumsum(sizes) - sizes, sizes)
        end = group + np.repeat(sizes, sizes)
        run, most = 1, int(sizes.max(initial=0))
        while run < most:
            at = np.flatnonzero(end - group > run)
            base, inside = group[at], at - group[at]
            other = base + ((inside // run) ^ 1) * run
            low, high = np.minimum(other, end[at]), np.minimum(other + run, end[at])
            begin, own = low.copy(), starts[at]
            is_left = (inside // run) % 2 == 0
            open_ = np.flatnonzero(low < high)
            while len(open_):
                middle = (low[open_] + high[open_]) // 2
                # Equal suffixes keep the left run first.
                goes = self.before(starts[middle], own[open_], ~is_left[open_])
                low[open_] = np.where(goes, middle + 1, low[open_])
                high[open_] = np.where(goes, high[open_], middle)
                open_ = open_[low[open_] < high[open_]]
            pair = base + (inside // (2 * run)) * 2 * run
            place = pair + inside % run + (low - begin)
            moved = starts.copy()
            moved[place] = own
            starts, run = moved, 2 * run
        return starts

    def repeated(self, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Sorted starts whose first ``least`` bytes equal those of a neighbour in their group."""
        ordered = self.sort(starts, sizes)
        group = np.repeat(np.arange(len(sizes)), sizes)
        pair = np.flatnonzero(group[1:] == group[:-1])
        same = pair[self.common(ordered[pair], ordered[pair + 1]) >= self.least]
        hit = np.zeros(len(ordered), bool)
        for i in range(0, len(same), 4096):  # verified byte by byte
            part = same[i : i + 4096]
            offsets = np.arange(self.least)
            equal = (self.data[ordered[part][:, None] + offsets] == self.data[ordered[part + 1][:, None] + offsets]).all(axis=1)
            hit[part[equal]] = hit[part[equal] + 1] = True
        return ordered[hit]


def repeated_starts(contexts: list[bytes], anchor: np.ndarray, at: np.ndarray, least: int, most: int = 1 << 19) -> list[np.ndarray]:
    """For each context the starts, relative to it, whose string repeats in another context with the
    same ``anchor``. ``at`` is the anchor's place in the context."""
    lengths = np.array([len(c) - least + 1 for c in contexts], np.int64)
    order = np.argsort(anchor, kind="stable")
    hits: list[np.ndarray] = [np.zeros(0, np.int64)] * len(contexts)
    cut = np.flatnonzero(np.append(True, anchor[order][1:] != anchor[order][:-1]))
    weights = np.add.reduceat(lengths[order], cut)
    part = (np.cumsum(weights) - 1) // most  # whole anchors, about ``most`` suffixes at a time
    for p in np.unique(part):
        groups = np.flatnonzero(part == p)
        stop = cut[groups[-1] + 1] if groups[-1] + 1 < len(cut) else len(order)
        own = order[cut[groups[0]] : stop]
        texts = [contexts[i] for i in own]
        suffixes = Suffixes(texts, least)
        n = lengths[own]
        sizes = np.array([len(t) for t in texts])
        begin = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(own)), n)
        offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start = begin[owner] + offset
        # Strings with one anchor have it at one offset.
        behind = at[own][owner] - offset
        by = np.lexsort((behind, anchor[own][owner]))
        first = np.append(True, (np.diff(anchor[own][owner][by]) != 0) | (np.diff(behind[by]) != 0))
        edges = np.flatnonzero(first)
        counts = np.diff(np.append(edges, len(by)))
        several = np.repeat(counts > 1, counts)
        found = suffixes.repeated(start[by][several], counts[counts > 1])
        where = np.searchsorted(begin, found, side="right") - 1
        for k in np.unique(where):
            hits[own[k]] = np.sort(found[where == k] - begin[k])
    return hits


def intervals(starts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes covered by strings from sorted ``starts``."""
    if not len(starts):
        return starts, starts
    gap = np.flatnonzero(np.diff(starts) > least)
    return starts[np.append(0, gap + 1)], starts[np.append(gap, len(starts) - 1)] + least


def spans_within(pdf: pd.DataFrame, least: int) -> pd.DataFrame:
    """Repeated spans of the contexts of one bucket that occur once: (row, start, end) in their texts."""
    hits = repeated_starts(
        list(pdf["bytes"]), pdf["h"].to_numpy(np.int64), pdf["behind"].to_numpy(np.int64), least
    )
    out = []
    for row, first, n, found in zip(pdf["row"], pdf["first"], pdf["n"], hits):
        if n == 1 and len(found):
            starts, ends = intervals(found, least)
            out += [(row, first + a, first + b) for a, b in zip(starts.tolist(), ends.tolist())]
    return pd.DataFrame(out, columns=["row", "start", "end"])


def fetch_contexts(plain: DataFrame, wanted: DataFrame, least: int, gram: int) -> DataFrame:
    """The bytes of contexts, from their (row, i): the i-th anchor of the row. A row has all its wanted
    contexts in one list, which its own text bounds."""
    lists = wanted.groupBy("row").agg(F.collect_list(F.struct("i", "h", "n", "many")).alias("wanted"))
    texts = plain.select("row", "text").join(lists, "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                text = batch.column("text")[k].as_py().encode()
                row = batch.column("row")[k].as_py()
                h, at, first, last = anchors(text, least, gram)
                out = []
                for w in batch.column("wanted")[k].as_py():
                    i = w["i"]
                    if i >= len(h) or int(h.view(np.int64)[i]) != w["h"]:
                        raise RuntimeError("rows of the input changed between two reads")
                    out.append((w["h"], row, int(first[i]), int(at[i] - first[i]), w["n"], w["many"], text[first[i] : last[i] + least]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in zip(*out)], ["h", "row", "first", "behind", "n", "many", "bytes"]
                )

    return texts.mapInArrow(run, "h bigint, row bigint, first bigint, behind bigint, n bigint, many boolean, bytes binary")


def spans_by_digest(contexts: DataFrame, least: int) -> DataFrame:
    """Repeated spans behind anchors with very many contexts: strings are counted by digest, spread
    over all tasks, since no task should sort such an anchor alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                row = {c: batch.column(c)[k].as_py() for c in ("h", "row", "first", "behind", "n", "bytes")}
                own = row["bytes"]
                n = len(own) - least + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["h"]] * n), pa.array([row["row"]] * n),
                        pa.array(np.arange(row["first"], row["first"] + n)), pa.array([row["n"]] * n),
                        pa.array([xxhash.xxh3_128_digest(own[a : a + least] + (row["behind"] - a).to_bytes(4, "little")) for a in range(n)]),
                    ],
                    ["h", "row", "start", "n", "digest"],
                )

    each = contexts.mapInArrow(run, "h bigint, row bigint, start bigint, n bigint, digest binary")
    twice = each.groupBy("h", "digest").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("h", "digest")
    found = each.where("n = 1").join(twice, ["h", "digest"], "left_semi")
    return found.select("row", "start", (F.col("start") + least).alias("end"))


def suffix_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, gram: int = GRAM
) -> DataFrame:
    """(id, n_bytes, n_removed, spans, kept, kept_sha256) of every row: spans are the maximal removed
    runs of bytes and ``kept`` the remaining bytes; both are null where nothing is removed.

    Null texts are empty; texts shorter than ``least`` bytes lose nothing; a repeated row repeats all
    its strings. Null and repeated ids are rows like others, an empty table gives no rows. ``docs`` is
    read three times and must give the same rows in the same order each time, as stored tables do;
    a read that differs raises an error.
    """
    plain = ship(docs).select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("bigint").alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    found = staged(find_anchors(plain, least, gram), "anchors")
    arrays = F.arrays_zip("h", "first", "last", "c1", "c2")
    each = found.select("row", F.posexplode(arrays).alias("i", "a")).select("row", "i", "a.*")
    kinds = each.groupBy("h", "c1", "c2").agg(
        F.count(F.lit(1)).alias("n"), F.first("row").alias("row"), F.first("i").alias("i")
    )
    kinds = staged(kinds, "kinds")
    release(docs)
    several = kinds.groupBy("h").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    wanted = kinds.join(several, "h").select("h", "n", "row", "i", (F.col("kinds") > HOT_KINDS).alias("many"))
    contexts = staged(fetch_contexts(plain, wanted, least, gram), "contexts")
    release(docs)

    few = contexts.where("not many")
    n_buckets = max(1, -(-few.count() // BUCKET_ROWS))
    within = (
        few.withColumn("bucket", F.pmod(F.xxhash64("h"), F.lit(n_buckets)))
        .groupBy("bucket")
        .applyInPandas(lambda pdf: spans_within(pdf, least), "row bigint, start bigint, end bigint")
    )
    whole = each.join(kinds.where("n > 1").select("h", "c1", "c2"), ["h", "c1", "c2"], "left_semi")
    whole = whole.select("row", F.col("first").alias("start"), (F.col("last") + least).alias("end"))
    spans = whole.unionByName(within)
    if not contexts.where("many").isEmpty():
        spans = spans.unionByName(spans_by_digest(contexts.where("many"), least))
    spans = spans.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    spans = staged(spans.join(found.select("row", "sha"), "row"), "spans")
    release(docs)

    cut = plain.join(spans, "row").mapInArrow(remove, REMOVED)
    same = found.join(spans.select("row"), "row", "left_anti").select(
        "id", "n_bytes", F.lit(0).cast("bigint").alias("n_removed"),
        F.lit(None).cast("array<struct<start:bigint,end:bigint>>").alias("spans"),
        F.lit(None).cast("binary").alias("kept"), F.col("sha").alias("kept_sha256"),
    )
    return cut.unionByName(same)


REMOVED = "id bigint, n_bytes bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept binary, kept_sha256 string"


def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Take the union of the spans out of each text."""
    for batch in batches:
        for k in range(len(batch)):
            text = batch.column("text")[k].as_py().encode()
            if hashlib.sha256(text).hexdigest() != batch.column("sha")[k].as_py():
                raise RuntimeError("rows of the input changed between two reads")
            runs: list[list[int]] = []
            for s in sorted((s["start"], s["end"]) for s in batch.column("spans")[k].as_py()):
                if runs and s[0] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], s[1])
                else:
                    runs.append(list(s))
            edges = [0, *[x for r in runs for x in r], len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
            spans = [{"start": a, "end": b} for a, b in runs]
            columns = [[batch.column("id")[k].as_py()], [len(text)], [len(text) - len(kept)], [spans], [kept], [hashlib.sha256(kept).hexdigest()]]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], ["id", "n_bytes", "n_removed", "spans", "kept", "kept_sha256"]
            )


def release(df: DataFrame) -> None:
    """Let Spark drop shuffle files of finished steps, which it does when the driver collects garbage."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def suffix_report(docs: DataFrame) -> DataFrame:
    return suffix_dedup(docs).select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        "n_removed",
        F.coalesce(F.size("spans"), F.lit(0)).cast("bigint").alias("n_spans"),
        "kept_sha256",
    )
