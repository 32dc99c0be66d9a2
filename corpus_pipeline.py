"""A corpus pipeline: documents in, packed training sequences out.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read again as
the next stage's documents. A stage begins by deleting what the one before it staged for itself, unless
its documents still read from there.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tablevet.llm import decision_list, exact_dedup, packing, secret_ledger, simhash
from tablevet.llm.queries import load, vocabulary
from tablevet.session import noted_paths, release, staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Learned rules, fingerprints and token ids are not expressible in SQL; the tests hold every stage
# against a brute-force version.
ORACLE_SQL = None


_left: dict[str, list[str]] = {}


def tidy(stage: Stage) -> Stage:
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        session = spark.sparkContext.applicationId
        kept = release(spark, _left.pop(session, []), docs)
        with noted_paths() as made:
            out = stage(spark, docs, sf_dir)
        _left[session] = kept + made
        return out

    return run_stage


@tidy
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the base rules or the learned decision list rejects."""
    return decision_list.keep_good(docs, load(spark, sf_dir, "labels"))


@tidy
def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row per text, compared without the case of A-Z."""
    return exact_dedup.keep_winners(docs)


@tidy
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row per group of near copies: five-word shingles, similarity 0.8 or more."""
    return simhash.keep_representatives(docs)


@tidy
def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks every secret; all rows stay."""
    return secret_ledger.keep_clean(docs)


@tidy
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_duplicates),
    ("simhash_near_dedup", near_duplicates),
    ("secret_scan", secret_scan),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    before: list[str] = []
    for name, stage in STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        with noted_paths() as written:
            docs = staged(out, name)
        # The stage's documents have been read for the last time.
        release(spark, before, docs)
        before = written
    return STAGES[-1][1](spark, docs, sf_dir)
