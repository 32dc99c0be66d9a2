"""Packing of tokenized documents into sequences by bin completion.

Only lengths matter to a packing, and lengths are at most the capacity, so the search runs on a
histogram: a few thousand counts, whatever the corpus. Around the largest length that is left it
enumerates undominated fillings, takes them least waste first, as often as the counts allow or less
often, and backtracks while the waste so far could still lead to fewer sequences than the best packing
known. The first incumbent is the best-fit-decreasing packing of the histogram. The rows get their
places by their rank within their length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablevet.functions.ordered import ranked
from tablevet.llm.bpe import codec, id_lists
from tablevet.llm.common import ship, text_slices
from tablevet.session import staged

CAPACITY = 2048
END_ID = 0
SEARCH_NODES = 20_000
SEARCH_STEPS = 6_000_000
SORT_STEPS = 300

Filling = tuple[tuple[int, int], ...]


def pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): tokens of every text and an end id, cut into
    pieces of ``capacity``; the first piece takes the remainder. A null or empty text is the end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches):
            ids, counts = codec(path).encode(texts)
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, END_ID).astype("<u4")
            totals = counts + 1
            n = -(-totals // capacity)
            row = np.repeat(np.arange(len(texts)), n)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            head = totals - (n - 1) * capacity
            start = np.where(piece == 0, 0, head[row] + (piece - 1) * capacity)
            length = np.where(piece == 0, head[row], capacity)
            at = 4 * ((np.cumsum(totals) - totals)[row] + start)
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[a : a + m]) for a, m in zip(at.tolist(), (4 * length).tolist())]
            out = [rows.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                out.append(id_lists(ids, length))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names)

    plain = ship(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return plain.mapInArrow(run, schema)


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs: large items each need one, small ones what room is left."""
    sizes = np.arange(len(counts))
    n, total = np.cumsum(counts), np.cumsum(counts * sizes)
    half = capacity // 2
    best = -(-int(total[-1]) // capacity)
    for k in range(1, half + 1):
        alone = int(n[-1] - n[capacity - k])
        large = int(n[capacity - k] - n[half])
        room = large * capacity - int(total[capacity - k] - total[half])
        small = int(total[half] - total[k - 1])
        best = max(best, alone + large + max(0, -(-(small - room) // capacity)))
    return best


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """The best-fit-decreasing packing as (filling, times), from the histogram alone.

    Bins of equal room and filling are one group. The tightest bin takes a length as often as it can
    before another bin is tighter, so a length splits one group at most.
    """
    rooms: dict[int, list[tuple[Filling, int]]] = {}
    for size in sorted(histogram, reverse=True):
        n = histogram[size]
        fit = [(room, g) for room in sorted(r for r in rooms if r >= size) for g in rooms.pop(room)]
        fit.append((capacity, ((), n)))
        for room, (filling, bins) in fit:
            most = room // size
            full = min(bins, n // most)
            over = n - full * most if bins > full else 0
            n -= full * most + over
            for times, each in ((full, most), (min(over, 1), over), (bins - full - min(over, 1), 0)):
                if times and (filling or each):
                    grown = (*filling, (size, each)) if each else filling
                    rooms.setdefault(room - each * size, []).append((grown, times))
    return [group for room in sorted(rooms) for group in rooms[room]]


def fillings(counts: np.ndarray, room: int, budget: list[int], sort_steps: int = SORT_STEPS) -> Iterator[Filling]:
    """All undominated fillings of ``room`` by the lengths in ``counts``, made as they are asked for.

    A filling is dominated if another length in hand fits besides, or can take the place of a smaller
    member; one length that fills the room dominates all others. Perfect fillings come at once, others
    by waste among those of the same ``sort_steps`` steps. Steps are taken off ``budget``; it ends early
    only where that is used up.
    """
    if room <= 0 or counts[room]:
        yield ((room, 1),) if room > 0 else ()
        return
    sizes = [int(s) for s in np.flatnonzero(counts[: room + 1])[::-1]]
    have = [int(counts[s]) for s in sizes]
    used = [0] * len(sizes)

    def dominated(left: int) -> bool:
        for k in range(len(sizes) - 1, -1, -1):
            if sizes[k] > left:
                break
            if have[k] > used[k]:
                return True
        for k in chosen:
            j = k - 1
            while j >= 0 and sizes[j] - sizes[k] <= left:
                if have[j] > used[j]:
                    return True
                j -= 1
        return False

    chosen: list[int] = []
    found: list[tuple[int, Filling]] = []
    k, left, steps = 0, room, 0
    while True:
        steps += 1
        if k < len(sizes) and sizes[k] > left:
            k = bisect_left(sizes, -left, k, key=lambda s: -s)
        if k < len(sizes):  # the next length as often as it can
            used[k] = min(have[k], left // sizes[k])
            left -= used[k] * sizes[k]
            chosen.append(k)
            k += 1
            continue
        if not dominated(left):
            filling = tuple((sizes[c], used[c]) for c in chosen)
            if left:
                found.append((left, filling))
            else:
                yield filling
        if steps >= sort_steps and found:
            budget[0] -= steps
            steps = 0
            yield from (f for _, f in sorted(found, key=lambda f: (f[0], len(f[1]))))
            found = []
        elif steps >= sort_steps:
            budget[0] -= steps
            steps = 0
        if budget[0] <= 0 or not chosen:
            break
        k = chosen[-1] + 1  # the last length once less
        used[k - 1] -= 1
        left += sizes[k - 1]
        if not used[k - 1]:
            chosen.pop()
    budget[0] -= steps
    yield from (f for _, f in sorted(found, key=lambda f: (f[0], len(f[1]))))


def complete_bins(
    histogram: dict[int, int], capacity: int = CAPACITY, nodes: int = SEARCH_NODES, steps: int = SEARCH_STEPS
) -> list[tuple[Filling, int]]:
    """A packing as (filling, times). Branch and bound over fillings around the largest length.

    A filling is tried as often as the counts allow, then half as often and so on down to once, which
    reaches every packing of undominated fillings. The result is the best of all packings if the search
    ends or meets the lower bound; after ``nodes`` choices or ``steps`` steps of the enumeration it is
    the best one seen, never worse than best-fit-decreasing.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for size, n in histogram.items():
        counts[size] = n
    total = int((counts * np.arange(capacity + 1)).sum())
    goal = lower_bound(counts, capacity)
    best = best_fit({size: n for size, n in histogram.items() if n}, capacity)
    best_bins = sum(times for _, times in best)
    bins = waste = visited = 0
    budget = [steps]
    path: list[tuple[Filling, int]] = []
    stack: list[Iterator[tuple[Filling, int]]] = []
    least: dict[bytes, int] = {}  # fewest sequences before a state of few lengths

    def choices() -> Iterator[tuple[Filling, int]]:
        large = int(np.flatnonzero(counts)[-1])
        rest = counts.copy()
        rest[large] -= 1
        later = []
        for f in fillings(rest, capacity - large, budget):
            filling = tuple(sorted(_merged(((large, 1), *f)), reverse=True))
            times = min(int(counts[s]) // c for s, c in filling)
            if times > 1:
                later.append((filling, times // 2))
            yield filling, times
        while later:
            yield from later
            later = [(filling, times // 2) for filling, times in later if times > 1]

    def undo() -> None:
        nonlocal bins, waste
        filling, times = path.pop()
        bins -= times
        waste -= times * (capacity - sum(s * c for s, c in filling))
        for s, c in filling:
            counts[s] += c * times

    def seen() -> bool:
        left = np.flatnonzero(counts)
        if len(left) > 64:
            return False
        state = np.concatenate([left, counts[left]]).tobytes()
        if least.get(state, bins + 1) <= bins:
            return True
        least[state] = bins
        return False

    if best_bins > goal:
        stack.append(choices())
    while stack and visited < nodes and budget[0] > 0:
        choice = next(stack[-1], None)
        if choice is None:
            stack.pop()
            if path:
                undo()
            continue
        filling, times = choice
        visited += 1
        for s, c in filling:
            counts[s] -= c * times
        path.append((filling, times))
        bins += times
        waste += times * (capacity - sum(s * c for s, c in filling))
        if -(-(total + waste) // capacity) >= best_bins:
            undo()
        elif not counts.any():
            best, best_bins = list(path), bins
            if bins <= goal:
                break
            undo()
        elif seen():
            undo()
        else:
            stack.append(choices())
    return best


def _merged(filling: tuple[tuple[int, int], ...]) -> list[tuple[int, int]]:
    out: dict[int, int] = {}
    for size, n in filling:
        out[size] = out.get(size, 0) + n
    return list(out.items())


def places(plan: list[tuple[Filling, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first, last, per, sequence, offset): rows of this length with these ranks lie ``per`` in
    each of the sequences from ``sequence`` on, from ``offset`` on."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for filling, times in plan:
        offset = 0
        for size, n in filling:
            first = used.get(size, 0)
            out.append((size, first, first + n * times - 1, n, sequence, offset))
            used[size] = first + n * times
            offset += size * n
        sequence += times
    return out


def pack(
    docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``pieces`` with sequence_id and offset: sequences hold at most ``capacity`` ids, without gaps.

    Repeated rows and null ids are packed like others, an empty table gives no rows. The driver sees
    one count per length; the table of places is broadcast and has at most a few entries for each
    filling, of which there are about as many as lengths. Only (length, rank) is shuffled.
    """
    cut = pieces(docs, path, capacity, with_ids, id_col, text_col)
    cut = staged(cut.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = cut.sparkSession.createDataFrame(
        places(complete_bins(histogram, capacity)),
        "length bigint, _first bigint, _last bigint, _per bigint, _sequence bigint, _offset bigint",
    )
    slim = ranked(cut.drop("ids"), ["length"], ["_row"], "_rank").drop("_rank_total")
    at = F.col("_rank") - 1
    placed = slim.join(F.broadcast(table), "length").where(at.between(F.col("_first"), F.col("_last")))
    placed = placed.withColumn("_at", at - F.col("_first"))
    placed = placed.select(
        *[c for c in cut.columns if c != "ids"],
        (F.col("_sequence") + F.floor(F.col("_at") / F.col("_per"))).alias("sequence_id"),
        (F.col("_offset") + F.pmod("_at", "_per") * F.col("length")).alias("offset"),
    )
    if with_ids:
        placed = placed.join(cut.select("_row", "ids"), "_row")
    return placed.drop("_row")
