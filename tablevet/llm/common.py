"""Helpers shared by the operators: batches of bytes, words, hashes and joins on skewed keys."""

from __future__ import annotations

import ctypes
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablevet.session import staged

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = bytes([0x20, *range(0x09, 0x0E)])
IS_SPACE = np.isin(np.arange(256), list(SPACES))
# An odd multiplier and its inverse modulo 2**64, for polynomial hashes of byte runs.
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 2**64)


def ship(df: DataFrame) -> DataFrame:
    """Give the executors of ``df``'s session this package, once per session; returns ``df``."""
    sc = df.sparkSession.sparkContext
    if not getattr(sc, "_tablevet_shipped", False):
        root = Path(__file__).resolve().parents[2]
        target = Path(tempfile.mkdtemp(prefix="tablevet-code-")) / "tablevet"
        if (root / "tablevet").is_dir():
            sc.addPyFile(shutil.make_archive(str(target), "zip", root, "tablevet"))
        sc._tablevet_shipped = True
    return df


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in lower case; other letters stay as they are."""
    return F.translate(text, UPPER, UPPER.lower())


def in_test_fold(doc_id: Column) -> Column:
    """Rows that no model learns from: crc32 of the id as text leaves 0 modulo 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def give_back() -> None:
    """Return freed memory of this worker to the system, where the C library can; workers live on."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, size: int = 4 << 20) -> Iterator[None]:
    """Inside the block Spark sends rows to Python in batches of about ``size`` bytes. Its own bound is 64 MB,
    held by the executor and by the worker of each task. For queries that end inside the block."""
    before = spark.conf.get(BATCH_BYTES, None)
    spark.conf.set(BATCH_BYTES, str(size))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_BYTES)
        else:
            spark.conf.set(BATCH_BYTES, before)


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 1 << 18
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Row slices of about ``most`` bytes of text, with the texts as UTF-8; null is empty.

    A text longer than ``most`` is a slice by itself, so memory follows the longest text.
    """
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        total = np.append(0, np.cumsum(sizes, dtype=np.int64))
        start = 0
        while start < len(sizes):
            stop = max(start + 1, int(np.searchsorted(total, total[start] + most, side="right")) - 1)
            rows = batch.slice(start, stop - start)
            yield rows, [t or b"" for t in rows.column(column).cast(pa.binary()).to_pylist()]
            start = stop
    give_back()


_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of BASE and of its inverse, modulo 2**64."""
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 19)
        for k, factor in enumerate((BASE, BASE_INVERSE)):
            steps = np.full(size, np.uint64(factor))
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes of a byte array; entry i covers the first i bytes."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data))[0], out=out[1:])
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def run_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte runs ``[start, end)``, equal for equal runs at any place."""
    return mixed((prefix[ends] - prefix[starts]) * powers(len(prefix))[1][starts])


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of some texts as byte ranges of one array.

    ``doc`` has the text of each word, ``counts`` the words of each text and ``first`` the number of
    words before it. Texts are joined by line feeds, so no word spans two of them.
    """

    def __init__(self, texts: list[bytes], lower: bool = False):
        joined = b"\n".join(texts)
        if lower:
            joined = joined.lower()
        self.data = np.frombuffer(joined, np.uint8)
        inside = np.zeros(len(self.data) + 2, np.int8)
        inside[1:-1] = ~IS_SPACE[self.data]
        step = np.diff(inside)
        self.starts, self.ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.begin = np.cumsum(lengths + 1) - lengths - 1
        self.lengths = lengths
        self.first = np.searchsorted(self.starts, self.begin)
        self.counts = np.diff(np.append(self.first, len(self.starts)))
        self.doc = np.repeat(np.arange(len(texts)), self.counts)

    def hashes(self) -> np.ndarray:
        return run_hashes(prefix_hashes(self.data), self.starts, self.ends)

    def per_text(self, marked: np.ndarray) -> np.ndarray:
        """Sums over each text of a number per byte."""
        total = np.append(0, np.cumsum(marked, dtype=np.int64))
        return total[self.begin + self.lengths] - total[self.begin]


# Row addresses are broadcast up to this number; 16 bytes each, so some 100 MB as a hash table.
BROADCAST_ROWS = 1_000_000


def spare_names(df: DataFrame, *names: str) -> list[str]:
    """Names longer than that of any column, so that no column of a user is in the way."""
    tail = "_" * max(map(len, df.columns), default=0)
    return [f"_{name}{tail}" for name in names]


def addressed(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with two columns that name a row the same at every reading, and their names.

    A scan of Parquet files knows the file and the place of each row in it. Other frames are written
    first, because their rows may come in another order when they are computed again.
    """
    for source in (docs, None):
        if source is None:
            source = staged(docs, "rows")
        names = spare_names(source, "file", "place")
        try:
            where = source.metadataColumn("_metadata")
            out = source.select("*", F.xxhash64(where["file_path"]).alias(names[0]), where["row_index"].alias(names[1]))
            out.schema  # fails here where there is no such thing
        except AnalysisException:
            continue
        return out, names
    raise RuntimeError("written rows have no address")


def by_address(rows: DataFrame, keys: list[str], chosen: DataFrame, how: str) -> DataFrame:
    """``rows`` joined ``left_semi`` or ``left_anti`` to the addresses of ``chosen``.

    Few addresses are broadcast, after they were counted, and no text moves; beyond BROADCAST_ROWS Spark
    chooses the join.
    """
    chosen = chosen.select(*keys)
    side = F.broadcast(chosen) if chosen.count() <= BROADCAST_ROWS else chosen
    return rows.join(side, keys, how)


def join_by_size(left: DataFrame, right: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Left join on ``key`` where ``right`` has one row per key and ``size`` left rows belong to it.

    Keys with more than a thousandth of all ``total`` rows are fewer than a thousand, so those are
    broadcast and their rows never move; the others cannot overload a task of the shuffled join.
    ``left`` is read twice and should be a stored table.
    """
    bound = max(total // 1000, 1)
    hot = F.broadcast(right.where(F.col(size) > bound))
    rest = right.where(F.col(size) <= bound)
    cold = left.join(hot.select(key), key, "left_anti")
    return left.join(hot, key).unionByName(cold.join(rest, key, "left"))
