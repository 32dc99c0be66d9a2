"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

The score is the logistic of a bias, linear terms and all pairwise products of features, where the
weight of a pair is the inner product of two rows of a low-rank matrix. The sum over all pairs equals
half of (square of the sum - sum of the squares), so scoring is linear in the features of a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablevet.llm.common import Words, in_test_fold, ship, text_slices
from tablevet.llm.decision_list import COUNTS, statistics

WORD_BUCKETS = 1 << 16
RANK = 8
SAMPLE_ROWS = 6_000
BATCH_ROWS, STEPS = 64, 600
DENSE = 11


def dense_features(counts: np.ndarray, n_chars: np.ndarray) -> np.ndarray:
    """Structure statistics as shares, and the metadata column n_chars (NaN where null)."""
    c = dict(zip(COUNTS, counts.T.astype(float)))
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)
    out = np.stack(
        [
            np.log1p(c["n_words"]) / 5,
            c["word_chars"] / words / 10,
            c["n_symbols"] / words,
            c["n_dup_lines"] / np.maximum(c["n_lines"], 1),
            c["n_repeat_words"] / words,
            c["n_upper"] / chars,
            c["n_punctuation"] / words,
            c["n_digits"] / chars,
            c["n_distinct"] / words,
            np.log1p(np.maximum(np.nan_to_num(n_chars), 0)) / 8,
            np.isnan(n_chars).astype(float),
        ],
        axis=1,
    )
    return np.clip(out, 0, 4)


def featurize(texts: list[bytes], n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index, value, features per text). Words count by the root of their number, scaled to length 1
    over a text; dense features come last and are always there."""
    words = Words(texts, lower=True)
    bucket = (words.hashes() % np.uint64(WORD_BUCKETS)).astype(np.int64)
    key, n = np.unique(words.doc * WORD_BUCKETS + bucket, return_counts=True)
    doc, index = key // WORD_BUCKETS, key % WORD_BUCKETS
    value = np.sqrt(n.astype(float))
    value /= np.sqrt(np.bincount(doc, weights=n, minlength=len(texts)))[doc]
    dense = dense_features(statistics(texts), n_chars)
    all_docs = np.concatenate([doc, np.repeat(np.arange(len(texts)), DENSE)])
    order = np.argsort(all_docs, kind="stable")
    index = np.concatenate([index, np.tile(np.arange(DENSE) + WORD_BUCKETS, len(texts))])[order]
    value = np.concatenate([value, dense.ravel()])[order].astype(np.float32)
    return index, value, np.bincount(all_docs, minlength=len(texts))


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def margins(self, index: np.ndarray, value: np.ndarray, per_row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The margin of each row, and the sums of factors that its gradient needs."""
        first = np.cumsum(per_row) - per_row
        scaled = self.factors[index] * value[:, None]
        sums = np.add.reduceat(scaled, first, axis=0)
        squares = np.add.reduceat((scaled * scaled).sum(axis=1), first)
        linear = np.add.reduceat(self.linear[index] * value, first)
        return self.bias + linear + 0.5 * ((sums * sums).sum(axis=1) - squares), sums


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(index, value, per_row, target, rank: int = RANK, steps: int = STEPS, rate: float = 0.1, decay: float = 1e-4) -> Machine:
    """Minibatch AdaGrad on the log loss. Same rows in the same order give the same machine."""
    rng = np.random.default_rng(7)
    size = WORD_BUCKETS + DENSE
    share = np.clip(target.mean() if len(target) else 0.5, 1e-3, 1 - 1e-3)
    m = Machine(float(np.log(share / (1 - share))), np.zeros(size, np.float32), rng.normal(0, 0.02, (size, rank)).astype(np.float32))
    seen_linear, seen_factors, seen_bias = np.full(size, 1e-3), np.full((size, rank), 1e-3), 1e-3
    first = np.cumsum(per_row) - per_row
    for _ in range(-(-steps * BATCH_ROWS // len(target)) if len(target) else 0):
        shuffled = rng.permutation(len(target))
        for rows in np.array_split(shuffled, max(1, len(shuffled) // BATCH_ROWS)):
            n = per_row[rows]
            take = np.repeat(first[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            i, x, row = index[take], value[take], np.repeat(np.arange(len(rows)), n)
            margin, sums = m.margins(i, x, n)
            error = (logistic(margin) - target[rows]) / len(rows)
            used, at = np.unique(i, return_inverse=True)
            g = np.bincount(at, weights=error[row] * x) + decay * m.linear[used]
            parts = (error[row] * x)[:, None] * (sums[row] - m.factors[i] * x[:, None])
            v = np.stack([np.bincount(at, weights=parts[:, k]) for k in range(rank)], axis=1) + decay * m.factors[used]
            seen_linear[used] += g * g
            seen_factors[used] += v * v
            m.linear[used] -= (rate * g / np.sqrt(seen_linear[used])).astype(np.float32)
            m.factors[used] -= (rate * v / np.sqrt(seen_factors[used])).astype(np.float32)
            b = float(error.sum())
            seen_bias += b * b
            m.bias -= rate * b / np.sqrt(seen_bias)
    return m


def _inputs(docs: DataFrame, *more: str) -> DataFrame:
    n_chars = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    return docs.select("doc_id", "text", n_chars.alias("n_chars"), *more)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Machine:
    """A machine from labelled rows outside the test fold: at most ``sample_rows`` ids, by hash of the
    id. The driver holds the features of these rows only."""
    known = labels.where("doc_id is not null and quality is not null").where(~in_test_fold(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("quality").cast("double").alias("target"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)  # bounded, so broadcast
    chosen = _inputs(ship(docs)).join(F.broadcast(sample), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches):
            index, value, n = featurize(texts, rows.column("n_chars").to_numpy(zero_copy_only=False).astype(float))
            lists = [pa.array([p.tobytes() for p in np.split(x, np.cumsum(n)[:-1])]) for x in (index.astype(np.int32), value)]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("target"), *lists], ["doc_id", "target", "i", "x"])

    kind = chosen.schema["doc_id"].dataType.simpleString()
    found = chosen.select("doc_id", "target", "text", "n_chars").mapInArrow(run, f"doc_id {kind}, target double, i binary, x binary")
    rows = found.dropDuplicates(["doc_id"]).toPandas().sort_values("doc_id")
    if not len(rows):
        return fit(np.zeros(0, np.int64), np.zeros(0, np.float32), np.zeros(0, np.int64), np.zeros(0))
    per_row = rows["i"].map(len).to_numpy() // 4
    index, value = np.frombuffer(b"".join(rows["i"]), np.int32), np.frombuffer(b"".join(rows["x"]), np.float32)
    return fit(index.astype(np.int64), value, per_row, rows["target"].to_numpy())


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """(doc_id, score) of every row and whole text, empty and null texts by their structure alone."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # its size is a parameter

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches):
            index, value, n = featurize(texts, rows.column("n_chars").to_numpy(zero_copy_only=False).astype(float))
            margin, _ = shared.value.margins(index, value, n)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(logistic(margin.astype(float)))], ["doc_id", "score"])

    plain = _inputs(ship(docs))
    return plain.mapInArrow(run, f"doc_id {plain.schema['doc_id'].dataType.simpleString()}, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Scores of all rows. Ids, languages, sources and labels are no inputs of a score; null ids are
    scored and not held out; without labels every text gets the same even bias plus no terms."""
    scored = score(docs, train(docs, labels))
    return scored.select(
        "doc_id",
        in_test_fold(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
