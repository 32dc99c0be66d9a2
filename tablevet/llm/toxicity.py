"""Toxicity by a classifier chain.

Categories are predicted one after the other by linear models over hashed words and word beginnings.
Each later model also sees the probabilities of the earlier categories. In training these come from
models that did not see the row (out-of-fold), as at scoring time.

The labels name one category, toxic. Two earlier ones are derived from labelled rows: ``lexical``,
whether a text has a word that training texts have almost only if toxic, and ``dense``, whether the
share of such words is at least the median of the toxic texts that have one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablevet.llm.common import Words, in_test_fold, prefix_hashes, run_hashes, ship, text_slices
from tablevet.llm.factorization import logistic

BUCKETS = 1 << 17
BEGINNINGS = (4, 5)
SAMPLE_ROWS_PER_CLASS = 3_000
CATEGORIES = ("lexical", "dense", "toxic")
FOLDS = 3
PRIOR_ROWS = 4
BATCH_ROWS, STEPS = 64, 600
EDGES = np.isin(np.arange(256), list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"))


def featurize(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index, value, features per text): word and word-beginning buckets without outer punctuation;
    a bucket counts by one plus the log of its number, and half of the buckets' room is for words."""
    words = Words(texts, lower=True)
    starts, ends = words.starts.copy(), words.ends.copy()
    for _ in range(3):
        starts += (ends - starts > 1) & EDGES[words.data[starts]] if len(starts) else 0
        ends -= (ends - starts > 1) & EDGES[words.data[ends - 1]] if len(starts) else 0
    prefix, half = prefix_hashes(words.data), np.uint64(BUCKETS // 2)
    found = [words.doc * BUCKETS + (run_hashes(prefix, starts, ends) % half).astype(np.int64)]
    for k in BEGINNINGS:
        long = ends - starts > k
        h = run_hashes(prefix, starts[long], starts[long] + k)
        found.append(words.doc[long] * BUCKETS + (h % half + half).astype(np.int64))
    key, n = np.unique(np.concatenate(found), return_counts=True)
    doc = key // BUCKETS
    return key % BUCKETS, (1 + np.log(n)).astype(np.float32), np.bincount(doc, minlength=len(texts))


def sums_by_row(values: np.ndarray, per_row: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(values, dtype=np.float64))
    ends = np.cumsum(per_row)
    return total[ends] - total[ends - per_row]


@dataclass
class Linear:
    """Logistic model of hashed features and of the earlier probabilities of the chain. A feature is
    scaled by its log odds in training if these speak for the category; the others have no part, so
    that a few telling words are not outweighed by the length of the text around them."""

    scale: np.ndarray
    bias: float
    weights: np.ndarray
    chained: np.ndarray

    def predict(self, index, value, per_row, earlier: np.ndarray) -> np.ndarray:
        margin = self.bias + sums_by_row(self.weights[index] * self.scale[index] * value, per_row)
        return logistic(margin + earlier[:, : len(self.chained)] @ self.chained)


def fit(index, value, per_row, earlier: np.ndarray, target: np.ndarray, steps: int = STEPS, rate: float = 0.2) -> Linear:
    """Minibatch AdaGrad on the log loss with a small pull to zero."""
    rng = np.random.default_rng(11)
    share = np.clip(target.mean() if len(target) else 0.01, 1e-3, 1 - 1e-3)
    row = np.repeat(np.arange(len(per_row)), per_row)
    bad = np.bincount(index, weights=target[row], minlength=BUCKETS)
    good = np.bincount(index, weights=1 - target[row], minlength=BUCKETS)
    prior = PRIOR_ROWS * np.array([share, 1 - share])
    scale = np.log((bad + prior[0]) / (good + prior[1])) - np.log(share / (1 - share))
    m = Linear(np.where(scale > 0.5, scale, 0), float(np.log(share / (1 - share))), np.zeros(BUCKETS), np.zeros(earlier.shape[1]))
    seen, seen_chained, seen_bias = np.full(BUCKETS, 1e-3), np.full(earlier.shape[1], 1e-3), 1e-3
    first = np.cumsum(per_row) - per_row
    for _ in range(-(-steps * BATCH_ROWS // len(target)) if len(target) else 0):
        for rows in np.array_split(rng.permutation(len(target)), max(1, len(target) // BATCH_ROWS)):
            n = per_row[rows]
            take = np.repeat(first[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            i, x, row = index[take], value[take], np.repeat(np.arange(len(rows)), n)
            scaled = x * m.scale[i]
            error = (m.predict(i, x, n, earlier[rows]) - target[rows]) / len(rows)
            used, at = np.unique(i, return_inverse=True)
            g = np.bincount(at, weights=error[row] * scaled, minlength=len(used)) + 1e-5 * m.weights[used]
            seen[used] += g * g
            m.weights[used] -= rate * g / np.sqrt(seen[used])
            c, b = earlier[rows].T @ error, error.sum()
            seen_chained += c * c
            seen_bias += b * b
            m.chained -= rate * c / np.sqrt(seen_chained)
            m.bias -= rate * b / np.sqrt(seen_bias)
    return m


def categories(index: np.ndarray, per_row: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """The derived targets of training rows, one column per category."""
    row = np.repeat(np.arange(len(per_row)), per_row)
    bad = np.bincount(index, weights=toxic[row], minlength=BUCKETS)
    good = np.bincount(index, weights=1 - toxic[row], minlength=BUCKETS)
    telling = (bad >= 3) & (bad >= 20 * good)
    hits = np.bincount(row, weights=telling[index], minlength=len(per_row))
    lexical = (hits > 0) & (toxic > 0)
    share = hits / np.maximum(per_row, 1)
    middle = np.median(share[lexical]) if lexical.any() else np.inf
    return np.stack([lexical, lexical & (share >= middle), toxic > 0], axis=1).astype(float)


def fit_chain(index, value, per_row, targets: np.ndarray) -> list[Linear]:
    """One model per category. The probabilities that later models learn from are out-of-fold."""
    n = len(per_row)
    fold = np.arange(n) % FOLDS
    first = np.cumsum(per_row) - per_row

    def rows_of(rows: np.ndarray):
        k = per_row[rows]
        take = np.repeat(first[rows] - (np.cumsum(k) - k), k) + np.arange(k.sum())
        return index[take], value[take], k

    earlier, models = np.zeros((n, 0)), []
    for target in targets.T:
        models.append(fit(index, value, per_row, earlier, target))
        unseen = np.zeros(n)
        if len(models) < targets.shape[1]:
            for f in range(FOLDS):
                own, rest = np.flatnonzero(fold == f), np.flatnonzero(fold != f)
                m = fit(*rows_of(rest), earlier[rest], target[rest])
                unseen[own] = m.predict(*rows_of(own), earlier[own])
        earlier = np.concatenate([earlier, unseen[:, None]], axis=1)
    return models


def predict_chain(models: list[Linear], index, value, per_row) -> np.ndarray:
    out = np.zeros((len(per_row), len(models)))
    for k, model in enumerate(models):
        out[:, k] = model.predict(index, value, per_row, out)
    return out


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS_PER_CLASS) -> list[Linear]:
    """A chain from labelled rows outside the test fold: at most ``sample_rows`` ids of each class, by
    hash of the id. Without labels all models answer with their bias, far below one half."""
    known = labels.where("doc_id is not null and toxic is not null").where(~in_test_fold(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("double").alias("target"))
    parts = [
        known.where(F.col("target") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows) for k in (0, 1)
    ]
    sample = parts[0].unionByName(parts[1])  # bounded, so broadcast
    chosen = ship(docs).select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches):
            index, value, n = featurize(texts)
            lists = [pa.array([p.tobytes() for p in np.split(x, np.cumsum(n)[:-1])]) for x in (index.astype(np.int32), value)]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("target"), *lists], ["doc_id", "target", "i", "x"])

    kind = chosen.schema["doc_id"].dataType.simpleString()
    found = chosen.select("doc_id", "target", "text").mapInArrow(run, f"doc_id {kind}, target double, i binary, x binary")
    rows = found.dropDuplicates(["doc_id"]).toPandas()
    rows = rows.sort_values("doc_id").sample(frac=1, random_state=5)
    per_row = rows["i"].map(len).to_numpy().astype(np.int64) // 4
    index = np.frombuffer(b"".join(rows["i"]), np.int32).astype(np.int64)
    value = np.frombuffer(b"".join(rows["x"]), np.float32)
    return fit_chain(index, value, per_row, categories(index, per_row, rows["target"].to_numpy()))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Probability of each category for every row and whole text, and the verdict on the last.

    Empty and null texts have no features and get the biases; null ids are scored like others."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels))  # its size is a parameter
    names = [f"p_{c}" for c in CATEGORIES[:-1]] + ["score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches):
            found = predict_chain(shared.value, *featurize(texts))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *map(pa.array, found.T.copy())], ["doc_id", *names])

    plain = ship(docs).select("doc_id", "text")
    schema = f"doc_id {plain.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{n} double" for n in names)
    return plain.mapInArrow(run, schema).select(
        "doc_id",
        in_test_fold(F.col("doc_id")).alias("held_out"),
        *names,
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        (F.col("score") >= threshold).alias("toxic"),
    )
