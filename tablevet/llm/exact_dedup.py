"""Exact deduplication against a history kept in a minimal perfect hash table.

The history is a table of distinct digests. It is cut into buckets by digest prefix; each bucket is
one row that holds a minimal perfect hash function and its slots, and slot i holds a full digest and
the locator of the winning row. A lookup goes from digest to bucket to slot and compares all bytes
of the digest. What is not a member is grouped by itself.

The function of a bucket is a cascade of bit arrays: a digest sets a bit of level 0 by its hash;
digests that collide go on to level 1, and so on. The rank of a digest's bit over all levels is its
slot, so n digests have exactly the slots 0 to n - 1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablevet.llm.common import addressed, ascii_lower, by_address, join_by_size, mixed, ship
from tablevet.session import staged

TABLE_SCHEMA = "bucket bigint, levels array<binary>, digests binary, winners array<bigint>, sizes array<bigint>"


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(locator, digest) of every row; equal texts up to the case of A-Z have equal digests."""
    normalised = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    return ship(docs).select(
        F.col(id_col).cast("bigint").alias("locator"), F.unhex(F.sha2(normalised, 256)).alias("digest")
    )


def distinct_digests(rows: DataFrame) -> DataFrame:
    """One row per digest: the largest locator wins. Copies fold before the shuffle."""
    return rows.groupBy("digest").agg(
        F.max("locator").alias("winner"), F.count(F.lit(1)).alias("n")
    )


def bucket_of(n_buckets: int):
    """Buckets by the first seven bytes of the digest."""
    head = F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("bigint")
    return (head % n_buckets).alias("bucket")


def _keys(raw: bytes) -> np.ndarray:
    """Two 64-bit words of each 32-byte digest, to hash from."""
    return np.frombuffer(raw, np.uint64).reshape(-1, 4)[:, 2:]


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    h = mixed(keys[:, 0] + np.uint64(level * 2 + 1) * keys[:, 1])
    return (h % np.uint64(size)).astype(np.int64)


def build_function(raw: bytes) -> tuple[list[bytes], np.ndarray]:
    """The levels of a minimal perfect hash of distinct digests, and the slot of each digest."""
    keys = _keys(raw)
    slots = np.zeros(len(keys), np.int64)
    left, levels, placed = np.arange(len(keys)), [], 0
    while len(left):
        size = max(8, 2 * len(left))
        places = _places(keys[left], len(levels), size)
        once = np.bincount(places, minlength=size) == 1
        rank = np.cumsum(once) - 1
        alone = once[places]
        slots[left[alone]] = placed + rank[places[alone]]
        placed += int(alone.sum())
        left = left[~alone]
        levels.append(len(once).to_bytes(8, "little") + np.packbits(once).tobytes())
    return levels, slots


def find_slots(levels: list[bytes], raw: bytes) -> np.ndarray:
    """The slot of each digest, or -1 where no level has a bit for it."""
    keys = _keys(raw)
    slots = np.full(len(keys), -1, np.int64)
    left, placed = np.arange(len(keys)), 0
    for number, level in enumerate(levels):
        size = int.from_bytes(level[:8], "little")
        once = np.unpackbits(np.frombuffer(level, np.uint8, offset=8), count=size).astype(bool)
        rank = np.cumsum(once) - 1
        places = _places(keys[left], number, size)
        found = once[places]
        slots[left[found]] = placed + rank[places[found]]
        placed += int(once.sum())
        left = left[~found]
    return slots


def build_table(distinct: DataFrame, n_buckets: int) -> DataFrame:
    """The history as one row per bucket. ``distinct`` comes from ``distinct_digests``."""

    def build(rows: pa.Table) -> pa.Table:
        raw = b"".join(rows["digest"].to_pylist())
        levels, slots = build_function(raw)
        order = pa.array(np.argsort(slots))
        digests = np.frombuffer(raw, np.uint8).reshape(-1, 32)[order.to_numpy()]
        return pa.table(
            {
                "bucket": pa.array([rows["bucket"][0].as_py()], pa.int64()),
                "levels": pa.array([levels], pa.list_(pa.binary())),
                "digests": pa.array([digests.tobytes()], pa.binary()),
                "winners": pa.array([rows["winner"].take(order).to_pylist()], pa.list_(pa.int64())),
                "sizes": pa.array([rows["n"].take(order).to_pylist()], pa.list_(pa.int64())),
            }
        )

    keyed = distinct.select(bucket_of(n_buckets), "digest", "winner", "n")
    return keyed.groupBy("bucket").applyInArrow(build, TABLE_SCHEMA)


def look_up(distinct: DataFrame, table: DataFrame, n_buckets: int) -> DataFrame:
    """Members and nonmembers of the history: (digest, winner, n, old_winner, old_n).

    ``old_winner`` and ``old_n`` are null for nonmembers. Every claimed slot is compared with the
    whole digest, so a function that maps a stranger to some slot never makes it a member.
    """

    def probe(new: pa.Table, old: pa.Table) -> pa.Table:
        found = np.full(new.num_rows, -1, np.int64)
        winners, sizes = pa.array([], pa.int64()), pa.array([], pa.int64())
        if old.num_rows and new.num_rows:
            raw = b"".join(new["digest"].to_pylist())
            slots = find_slots(old["levels"][0].as_py(), raw)
            stored = np.frombuffer(old["digests"][0].as_py(), np.uint8).reshape(-1, 32)
            hit = np.flatnonzero(slots >= 0)
            same = (stored[slots[hit]] == np.frombuffer(raw, np.uint8).reshape(-1, 32)[hit]).all(axis=1)
            found[hit[same]] = slots[hit[same]]
            winners, sizes = old["winners"][0].values, old["sizes"][0].values
        # Whole numbers stay so beside nulls: a missing slot takes a null.
        at = pa.array(found, mask=found < 0)
        return new.select(["digest", "winner", "n"]).append_column("old_winner", winners.take(at)).append_column("old_n", sizes.take(at))

    keyed = distinct.select(bucket_of(n_buckets), "digest", "winner", "n")
    return keyed.groupBy("bucket").cogroup(table.groupBy("bucket")).applyInArrow(
        probe, "digest binary, winner bigint, n bigint, old_winner bigint, old_n bigint"
    )


def exact_dedup(
    docs: DataFrame,
    is_history,
    id_col: str = "doc_id",
    text_col: str = "text",
    per_bucket: int = 4096,
) -> DataFrame:
    """Class of every row of ``docs``: (locator, digest, keep, group_size).

    ``is_history`` is a condition on the locator column that marks the rows of earlier loads. Their
    distinct digests form the perfect hash table; digests of the other rows are looked up there.
    Members join the group in their slot, nonmembers form groups of their own, and the largest
    locator of a group stays. Null texts are empty texts, null locators lose to any other, repeated
    rows are rows; an empty table gives no rows. Only the two columns are read.

    Copies fold into one digest row before any lookup, so the largest group costs a bucket one row.
    """
    rows = staged(digests(docs, id_col, text_col), "digests")
    groups = equal_groups(rows, is_history, per_bucket)
    return join_by_size(rows, groups, "digest", "group_size", rows.count())


def equal_groups(rows: DataFrame, is_history: Column, per_bucket: int = 4096) -> DataFrame:
    """(digest, keep, group_size) of a stored table of locators and digests, by lookups in the history."""
    history = rows.where(F.coalesce(is_history, F.lit(False)))
    news = rows.where(~F.coalesce(is_history, F.lit(False)))
    old, new = staged(distinct_digests(history), "history"), staged(distinct_digests(news), "news")
    # A bucket bounds both sides of its lookup, however uneven history and news are.
    n_buckets = max(1, -(-max(old.count(), new.count()) // per_bucket))
    found = look_up(new, build_table(old, n_buckets), n_buckets)
    members = found.select(
        "digest",
        F.greatest("winner", "old_winner").alias("keep"),
        (F.col("n") + F.coalesce("old_n", F.lit(0))).alias("group_size"),
    )
    members = staged(members, "members")
    untouched = old.join(members.select("digest"), "digest", "left_anti").select(
        "digest", F.col("winner").alias("keep"), F.col("n").alias("group_size")
    )
    return staged(members.unionByName(untouched), "groups")


def lower_half(rows: DataFrame, id_col: str) -> Column:
    """Whether a row's locator is in the lower half of the id range."""
    ends = rows.agg(F.min(id_col).alias("a"), F.max(id_col).alias("b")).first()
    middle = 0 if ends["a"] is None else (ends["a"] + ends["b"]) // 2
    return F.col("locator") <= F.lit(middle)


def dedup_report(docs: DataFrame) -> DataFrame:
    """Digest columns of ``exact_dedup`` with the lower half of the id range as history.

    Rows whose id equals the winner's are kept, so rows that repeat id and text are kept together.
    """
    out = exact_dedup(docs, lower_half(docs, "doc_id"))
    return out.select(
        F.col("locator").alias("doc_id"),
        F.col("keep").alias("keep_id"),
        "group_size",
        F.col("locator").eqNullSafe(F.col("keep")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_winners(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all columns: exactly one per group of equal texts.

    Of equal texts the largest id stays, null ids losing, and of rows that repeat id and text the first
    by address. Null texts are empty texts; an empty table gives no rows; columns of any name are kept
    as they are. Decisions are made on addresses and digests alone, folded before each shuffle, so neither a
    hot text nor a hot id gathers in one task; texts are read once more to drop the losers.
    """
    docs, keys = addressed(docs)
    file, place = keys
    normalised = ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    rows = ship(docs).select(
        *keys, F.col("doc_id").cast("bigint").alias("locator"), F.unhex(F.sha2(normalised, 256)).alias("digest")
    )
    rows = staged(rows, "digests")
    groups = equal_groups(rows.select("locator", "digest"), lower_half(rows, "locator"))
    first = rows.groupBy("digest", "locator").agg(F.min(F.struct(*keys)).alias("at"))
    stays = first.join(groups, "digest").where(F.col("locator").eqNullSafe(F.col("keep")))
    stays = stays.select(F.col("at")[file].alias(file), F.col("at")[place].alias(place))
    lost = staged(rows.join(stays, keys, "left_anti").select(*keys), "lost")
    return by_address(docs, keys, lost, "left_anti").drop(*keys)
