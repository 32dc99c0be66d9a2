"""Periodic runs of words, found by recursive frequency splitting and a lag scan.

A run of period q and at least four periods holds each of its words at least four times. Words that
occur more rarely within their segment cannot join a run there and split it; the parts are counted
anew until nothing splits. What survives is scanned over all lags: for lags from B to 2B - 1 a run
covers a multiple of B with three whole periods behind it, so two hashed ranges are compared at every
such place and lag, n comparisons for each doubling of B. Matches are extended by binary search over
common prefixes and then compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablevet.llm.common import mixed, powers, run_hashes, ship, text_slices

LEAST_WORDS = 6
LEAST_PERIODS = 4
GRID = 1 << 20
RUN = "struct<start:bigint,length:bigint,period:bigint>"
SCHEMA = f"locator bigint, n_words bigint, runs array<{RUN}>, strongest {RUN}, collapsed string"
Run = tuple[int, int, int]


def split_segments(ids: np.ndarray, segment: np.ndarray, least: int, times: int) -> tuple[np.ndarray, np.ndarray]:
    """Places that survive the splitting and the start of each surviving segment among them.

    ``segment`` numbers the segment of each word in ascending order. A word that occurs in its segment
    fewer than ``times`` times ends it there, and segments shorter than ``least`` words are dropped.
    """
    place = np.arange(len(ids))
    while len(place):
        key = segment * (int(ids.max()) + 1) + ids[place]
        _, which, counts = np.unique(key, return_inverse=True, return_counts=True)
        kept = counts[which] >= times
        number = np.cumsum(np.append(0, (np.diff(place) > 1) | (np.diff(segment) > 0) | ~kept[1:] | ~kept[:-1]))
        kept &= np.bincount(number)[number] >= least
        if kept.all():
            break
        place, number = place[kept], number[kept]
        segment = np.unique(number, return_inverse=True)[1] if len(number) else number
    return place, np.flatnonzero(np.append(len(place) > 0, np.diff(segment) > 0))


def _extended(prefix: np.ndarray, at: np.ndarray, lag: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal stretches around three periods from ``at`` in which words ``lag`` apart are equal."""

    def furthest(most: np.ndarray, same) -> np.ndarray:
        low, high = np.zeros(len(most), np.int64), most
        while (low < high).any():
            middle = (low + high + 1) // 2
            holds = same(middle)
            low, high = np.where(holds, middle, low), np.where(holds, high, middle - 1)
        return low

    def equal(a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        return run_hashes(prefix, a, a + size) == run_hashes(prefix, b, b + size)

    left = furthest(at, lambda size: equal(at - size, at - size + lag, size))
    end = at + 3 * lag
    right = furthest(n - end, lambda size: equal(end, end - lag, size))
    return at - left, end + right


def _stretches(ids: np.ndarray, lag: int, least: int, times: int) -> list[Run]:
    """Runs of one lag by plain comparison; their period may be a part of the lag."""
    same = np.zeros(len(ids) - lag + 2, np.int8)
    same[1:-1] = ids[:-lag] == ids[lag:]
    step = np.diff(same)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1) + lag
    return [(int(a), int(b - a), lag) for a, b in zip(starts, ends) if b - a >= max(least, times * lag)]


def lag_scan(ids: np.ndarray, least: int = LEAST_WORDS, times: int = LEAST_PERIODS) -> list[Run]:
    """All runs (start, length, smallest period) of a word sequence, ascending."""
    n = len(ids)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(mixed(ids.astype(np.uint64) + np.uint64(1)) * powers(n)[0], out=prefix[1:])
    covered = np.zeros(n, np.int64)  # furthest end of a run that starts here or before
    runs: set[Run] = set()
    base = 1
    while times * base <= n:
        lags = np.arange(base, min(2 * base, n // times + 1))
        found: set[Run] = set()
        places = np.arange(0, n - 3 * base + 1, base)
        step = max(1, GRID // len(lags))
        for i in range(0, len(places), step):
            at = np.repeat(places[i : i + step], len(lags))
            lag = np.tile(lags, len(at) // len(lags))
            # Three periods inside a run of a smaller period have that period too.
            open_ = (at + 3 * lag <= n) & (covered[at] < at + 3 * lag)
            at, lag = at[open_], lag[open_]
            same = run_hashes(prefix, at, at + 2 * lag) == run_hashes(prefix, at + lag, at + 3 * lag)
            at, lag = at[same], lag[same]
            start, end = _extended(prefix, at, lag, n)
            long = end - start >= np.maximum(least, times * lag)
            spans = np.stack([start, end - start, lag])[:, long]
            found.update(map(tuple, np.unique(spans, axis=1).T.tolist()))
        for start, length, lag in list(found):
            end = start + length
            whole = (ids[start : end - lag] == ids[start + lag : end]).all()
            left = start == 0 or ids[start - 1] != ids[start - 1 + lag]
            right = end == n or ids[end] != ids[end - lag]
            if not (whole and left and right):  # a hash collision: compare this lag everywhere
                found = {r for r in found if r[2] != lag}
                found.update(r for r in _stretches(ids, lag, least, times) if covered[r[0]] < r[0] + r[1])
        for start, length, _ in found:
            covered[start] = max(covered[start], start + length)
        covered = np.maximum.accumulate(covered)
        runs |= found
        base *= 2
    return sorted(runs, key=lambda r: (r[0], r[2]))


def runs_of_texts(texts: list[list[bytes]], least: int = LEAST_WORDS, times: int = LEAST_PERIODS) -> list[list[Run]]:
    """The runs of each text, given as words."""
    numbers: dict[bytes, int] = {}
    counts = np.fromiter(map(len, texts), np.int64, len(texts))
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for t in texts for w in t), np.int64, counts.sum())
    owner, first = np.repeat(np.arange(len(texts)), counts), np.cumsum(counts) - counts
    place, cuts = split_segments(ids, owner, least, times)
    out: list[list[Run]] = [[] for _ in texts]
    for a, b in zip(cuts, np.append(cuts[1:], len(place))):
        text = owner[place[a]]
        shift = int(place[a] - first[text])
        out[text] += [(start + shift, n, q) for start, n, q in lag_scan(ids[place[a:b]], least, times)]
    return out


def strongest(runs: list[Run]) -> Run | None:
    """The run with the most periods, by exact fractions; the first of equals."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapse_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = LEAST_WORDS,
    times: int = LEAST_PERIODS,
) -> DataFrame:
    """(locator, n_words, runs, strongest, collapsed) of every row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+``. A run is a maximal stretch of words with smallest period q and at
    least ``max(least, times * q)`` words; ``runs`` has them by start and period. ``collapsed`` is the
    text without the words that some run holds behind its first period, joined by spaces. Runs may
    overlap, and a word stays only if no run drops it. Null and empty texts have no words, no runs, a
    null ``strongest`` and an empty ``collapsed``. Ids may be null or repeat, an empty table gives no
    rows, and other columns are not read. A map over the rows: nothing is shuffled, and memory follows
    the longest text.
    """
    if times < 4:
        raise ValueError("a lag scan needs runs of four periods at least")

    def record(run: Run) -> dict:
        return dict(zip(("start", "length", "period"), run))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entry = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
        for rows, texts in text_slices(batches):
            words = [t.split() for t in texts]
            runs = runs_of_texts(words, least, times)
            collapsed = []
            for own, found in zip(words, runs):
                kept = np.ones(len(own), bool)
                for start, length, period in found:
                    kept[start + period : start + length] = False
                collapsed.append(b" ".join(own if kept.all() else [own[i] for i in np.flatnonzero(kept)]).decode())
            best = [strongest(r) for r in runs]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    pa.array([len(w) for w in words], pa.int64()),
                    pa.array([[record(r) for r in found] for found in runs], pa.list_(entry)),
                    pa.array([record(r) if r else None for r in best], entry),
                    pa.array(collapsed, pa.string()),
                ],
                ["locator", "n_words", "runs", "strongest", "collapsed"],
            )

    columns = [F.col(id_col).cast("bigint").alias("locator"), F.col(text_col).alias("text")]
    return ship(docs).select(*columns).mapInArrow(run, SCHEMA)


def looped_text(doc_id: Column, text: Column) -> Column:
    """The text that the query judges: every tenth document, by crc32 of its id, repeats a part."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    a = F.pmod(g, F.greatest(n, F.lit(1)).cast("bigint")).cast("int")
    p = (F.floor((n - a) / (g % 8 + 3)) + 1).cast("int")
    loop = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    looped = F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), a), loop), F.lit(1), n), " ")
    return F.when((h % 10 == 0) & (n > 0), looped).otherwise(text)


def run_report(docs: DataFrame) -> DataFrame:
    """Counts and digests of ``collapse_runs`` for every document, parts repeated as the query says."""
    looped = docs.select("doc_id", looped_text(F.col("doc_id"), F.col("text")).alias("text"))
    best = F.col("strongest")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return collapse_runs(looped).select(
        F.col("locator").alias("doc_id"),
        F.size("runs").cast("bigint").alias("n_runs"),
        *[best[c].alias(c) for c in ("start", "length", "period")],
        F.expr("strongest.length * 1000 div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
