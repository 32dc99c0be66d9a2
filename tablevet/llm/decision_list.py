"""Quality rules as a learned decision list.

Statistics of each text feed an ordered list of threshold conjunctions. The list is learned by
sequential covering: a rule is grown one threshold at a time by information gain on one part of the
labelled rows, pruned from its end on the other part, accepted while it is precise there, and its rows
are removed before the next. The list becomes one ordered CASE expression of Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablevet.llm.common import Words, in_test_fold, mixed, ship, text_slices
from tablevet.session import staged

SYMBOLS = b"#*$%&|<>"
PUNCTUATION = b"!\"'(),-./:;?@[\\]^_`{}~+="
WINDOW = 5
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_punctuation", "n_digits", "n_distinct",
)
SAMPLE_ROWS = 20_000


def _marks(data: np.ndarray, chars: bytes) -> np.ndarray:
    return np.isin(np.arange(256), list(chars))[data]


def repeated_windows(words: Words, h: np.ndarray) -> np.ndarray:
    """True for words in a window of WINDOW words that occurs twice or more in the same text."""
    n = len(h) - WINDOW + 1
    covered = np.zeros(len(h) + 1, np.int64)
    if n > 0:
        key = words.doc[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for k in range(WINDOW):
            key = mixed(key + h[k : k + n])
        inside = np.flatnonzero(words.doc[:n] == words.doc[WINDOW - 1 :])
        order = inside[np.argsort(key[inside])]
        same = key[order[1:]] == key[order[:-1]]
        twice = order[np.append(False, same) | np.append(same, False)] if len(order) else order
        np.add.at(covered, twice, 1)
        np.add.at(covered, twice + WINDOW, -1)
    return np.cumsum(covered)[:-1] > 0


def statistics(texts: list[bytes]) -> np.ndarray:
    """COUNTS of each text, one row per text."""
    words = Words(texts)
    out = np.zeros((len(COUNTS), len(texts)), np.int64)
    h = words.hashes()
    by_text = lambda marked: np.bincount(words.doc[marked], minlength=len(texts))
    data = words.data
    spaces = _marks(data, b" \t\n\v\f\r")
    out[0] = words.counts
    out[1] = words.per_text(((data & 0xC0) != 0x80) & ~spaces)
    out[2] = words.per_text(_marks(data, SYMBOLS))
    for i, text in enumerate(texts):
        lines = [line for line in text.split(b"\n") if line.strip()]
        out[3, i] = len(lines) - len(set(lines))
        out[5, i] = len(lines)
    out[4] = by_text(repeated_windows(words, h))
    out[6] = words.per_text((data >= 65) & (data <= 90))
    out[7] = words.per_text(_marks(data, PUNCTUATION))
    out[8] = words.per_text((data >= 48) & (data <= 57))
    order = np.lexsort((h, words.doc))
    new = np.ones(len(h), bool)
    new[1:] = (h[order[1:]] != h[order[:-1]]) | (words.doc[order[1:]] != words.doc[order[:-1]])
    out[9] = by_text(order[new])
    return out.T


def with_statistics(docs: DataFrame, text_col: str = "text", name: str = "_statistics") -> DataFrame:
    """``docs`` and a struct of COUNTS of each whole text. Null texts are empty."""
    columns = [f"c{i}" for i in range(len(docs.columns))]
    plain = ship(docs).toDF(*columns)
    text = columns[docs.columns.index(text_col)]
    fields = ", ".join(f"{c}: bigint" for c in COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches, text):
            counts = statistics(texts)
            found = pa.StructArray.from_arrays([pa.array(counts[:, k]) for k in range(len(COUNTS))], list(COUNTS))
            yield pa.RecordBatch.from_arrays([*rows.columns, found], [*columns, "s"])

    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in plain.schema] + [f"s struct<{fields}>"])
    return plain.mapInArrow(run, schema).toDF(*docs.columns, name)


def features(s: Column) -> dict[str, Column]:
    """What rules test: shares and means, from the struct of counts."""
    words = F.greatest(s["n_words"], F.lit(1)).cast("double")
    chars = F.greatest(s["word_chars"], F.lit(1)).cast("double")
    return {
        "words": s["n_words"].cast("double"),
        "word_length": s["word_chars"] / words,
        "symbols_per_word": s["n_symbols"] / words,
        "dup_line_share": s["n_dup_lines"] / F.greatest(s["n_lines"], F.lit(1)),
        "repeat_share": s["n_repeat_words"] / words,
        "upper_share": s["n_upper"] / chars,
        "punctuation_per_word": s["n_punctuation"] / words,
        "digit_share": s["n_digits"] / chars,
        "distinct_share": s["n_distinct"] / words,
    }


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 10) | (100 * s["n_repeat_words"] > 20 * s["n_words"])


@dataclass(frozen=True)
class Rule:
    """Rows that pass all (feature, "<=" or ">=", threshold) tests are rejected."""

    tests: tuple[tuple[str, str, float], ...]
    precision: float
    covered: int

    def condition(self, columns: dict[str, Column]) -> Column:
        out = F.lit(True)
        for name, op, value in self.tests:
            out &= columns[name] <= value if op == "<=" else columns[name] >= value
        return out


def _passes(x: np.ndarray, names: list[str], tests) -> np.ndarray:
    out = np.ones(len(x), bool)
    for name, op, value in tests:
        column = x[:, names.index(name)]
        out &= column <= value if op == "<=" else column >= value
    return out


def _grow(x: np.ndarray, bad: np.ndarray, names: list[str], most: int) -> list:
    tests: list = []
    inside = np.ones(len(x), bool)
    while len(tests) < most and (inside & ~bad).any() and (inside & bad).any():
        p, n = (inside & bad).sum(), (inside & ~bad).sum()
        best, choice = 1e-9, None
        for k, name in enumerate(names):
            values = x[inside, k]
            order = np.argsort(values)
            values, is_bad = values[order], bad[inside][order]
            cuts = np.flatnonzero(values[1:] > values[:-1])
            up = np.cumsum(is_bad)[cuts]
            for op, pos, size, at in (
                ("<=", up, cuts + 1, values[cuts]),
                (">=", p - up, len(values) - cuts - 1, values[cuts + 1]),
            ):
                if len(cuts):
                    gain = pos * (np.log2(np.maximum(pos, 1e-12) / size) - np.log2(p / (p + n)))
                    i = int(np.argmax(gain))
                    if gain[i] > best:
                        best, choice = gain[i], (name, op, float(at[i]))
        if choice is None:
            break
        tests.append(choice)
        inside &= _passes(x, names, [choice])
    return tests


def learn(
    x: np.ndarray, bad: np.ndarray, names: list[str], least_precision: float = 0.97, most_rules: int = 16,
    most_tests: int = 4,
) -> list[Rule]:
    """Sequential covering of the bad rows. Every third row is held back to prune and accept rules."""
    rules: list[Rule] = []
    pruning = np.arange(len(x)) % 3 == 0
    open_ = np.ones(len(x), bool)
    while len(rules) < most_rules and (open_ & bad).any():
        grow, prune = open_ & ~pruning, open_ & pruning
        tests = _grow(x[grow], bad[grow], names, most_tests)
        scored = []
        for k in range(len(tests), 0, -1):
            hit = prune & _passes(x, names, tests[:k])
            p, n = (hit & bad).sum(), (hit & ~bad).sum()
            scored.append(((p - n) / max(p + n, 1), k, p / max(p + n, 1), p))
        if not scored:
            break
        _, k, precision, support = max(scored)
        if precision < least_precision or support < 5:
            break
        hit = open_ & _passes(x, names, tests[:k])
        rules.append(Rule(tuple(tests[:k]), float(precision), int(hit.sum())))
        open_ &= ~hit
    return rules


def decision(rules: list[Rule], s: Column) -> Column:
    """The list as an ordered CASE: the number of the first rule that rejects, else null."""
    columns = features(s)
    out = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules))):
        out = F.when(rule.condition(columns), F.lit(number)).otherwise(out)
    return out


def learn_from(counted: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules from labelled rows outside the test fold: at most ``sample_rows``, taken by hash of the id.

    ``counted`` has doc_id and ``_statistics``. Without labels there are no rules, and all rows pass.
    """
    known = labels.where("doc_id is not null and quality is not null").where(~in_test_fold(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    columns = features(F.col("_statistics"))
    rows = (
        counted.join(known, "doc_id")
        .select(F.xxhash64("doc_id").alias("h"), "quality", *[c.alias(n) for n, c in columns.items()])
        .orderBy("h", *columns)
        .limit(sample_rows)
        .toPandas()
    )
    if not len(rows):
        return []
    return learn(rows[list(columns)].to_numpy(float), rows["quality"].to_numpy() == 0, list(columns))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts and verdicts of every row of ``docs``: null and empty texts have no words and fail the
    base rules; null ids are judged like others but never learned from."""
    counted = staged(with_statistics(docs.select("doc_id", "text")).drop("text"), "statistics")
    s = F.col("_statistics")
    rules = learn_from(counted, labels)
    return counted.select(
        "doc_id",
        *[s[c].alias(c) for c in COUNTS[:5]],
        base_failed(s).alias("base_failed"),
        (~base_failed(s) & decision(rules, s).isNull()).alias("kept"),
        decision(rules, s).alias("rule_no"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass the base rules and the learned list, with all columns.

    The texts are read twice and never shuffled: once for the statistics to learn from, once to filter.
    """
    counted = staged(with_statistics(docs.select("doc_id", "text")).drop("text"), "statistics")
    rules = learn_from(counted, labels)
    name = "_statistics" + "_" * max(map(len, docs.columns))
    s = F.col(name)
    return with_statistics(docs, name=name).where(~base_failed(s) & decision(rules, s).isNull()).drop(name)
