"""Registered queries of the numbered operators, each over whole tables, and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablevet.llm import (
    bpe,
    decision_list,
    exact_dedup,
    factorization,
    jaccard_regions,
    link_trust,
    packing,
    periodic_runs,
    phrase_index,
    secret_ledger,
    simhash,
    suffix_dedup,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def vocabulary() -> str:
    """The tokenizer file: ``TOKENIZER_FILE`` or the installed public one."""
    if path := os.environ.get("TOKENIZER_FILE"):
        return path
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_quality_classifier(spark, sf_dir):
    return factorization.quality_scores(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query
def op2_exact_dedup(spark, sf_dir):
    return exact_dedup.dedup_report(load(spark, sf_dir, "documents"))


@query
def op3_quality_rules(spark, sf_dir):
    return decision_list.quality_report(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query
def op4_best_fit_packing(spark, sf_dir):
    return packing.pack(load(spark, sf_dir, "documents"), vocabulary())


@query
def op5_suffix_dedup(spark, sf_dir):
    return suffix_dedup.suffix_report(load(spark, sf_dir, "documents"))


@query
def op6_bpe_round_trip(spark, sf_dir):
    return bpe.round_trip_report(load(spark, sf_dir, "documents"), vocabulary())


@query
def op7_secret_scan(spark, sf_dir):
    return secret_ledger.secret_report(load(spark, sf_dir, "documents"))


@query
def op8_toxicity(spark, sf_dir):
    return toxicity.toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query
def op9_simhash(spark, sf_dir):
    return simhash.near_duplicate_report(load(spark, sf_dir, "documents"))


@query
def op10_url_filter(spark, sf_dir):
    return link_trust.filter_urls(load(spark, sf_dir, "pages"))


@query
def op11_phrase_mining(spark, sf_dir):
    return phrase_index.collocations(load(spark, sf_dir, "documents"))


@query
def op12_jaccard_join(spark, sf_dir):
    return jaccard_regions.jaccard_report(load(spark, sf_dir, "documents"))


@query
def op13_periodic_runs(spark, sf_dir):
    return periodic_runs.run_report(load(spark, sf_dir, "documents"))


ORACLE = {
    "op2_exact_dedup": """
        WITH d AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                            'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
            FROM documents)
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept,
               text_sha256
        FROM d
    """,
    "op11_phrase_mining": """
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(regexp_split_to_array(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[.,;:!?\\x0A-\\x0D]')) AS piece
            FROM documents),
        words AS (
            SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
        placed AS (
            SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (VALUES (1), (2), (3), (4)) AS t(k)),
        f AS (
            SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
            FROM placed GROUP BY ALL HAVING count(*) >= 30),
        cuts AS (
            SELECT f.lang, phrase, f AS a, c.k,
                   array_to_string(string_split(phrase, ' ')[1:c.k], ' ') AS head,
                   array_to_string(string_split(phrase, ' ')[c.k + 1:], ' ') AS tail
            FROM f JOIN (VALUES (1), (2), (3)) AS c(k) ON c.k < f.k),
        weakest AS (
            SELECT cuts.lang, cuts.phrase, a, h.f AS l, t.f AS r,
                   CAST(2000000::HUGEINT * a // (h.f + t.f) AS BIGINT) AS score
            FROM cuts
            JOIN f h ON h.lang = cuts.lang AND h.phrase = cuts.head
            JOIN f t ON t.lang = cuts.lang AND t.phrase = cuts.tail
            QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY score, cuts.k) = 1),
        longer AS (
            SELECT lang, array_to_string(string_split(phrase, ' ')[begin_:begin_ + size - 1], ' ') AS phrase, max(f) AS f
            FROM f, (VALUES (2), (3)) AS s(size), (VALUES (1), (2), (3)) AS p(begin_)
            WHERE size < k AND begin_ + size - 1 <= k GROUP BY ALL),
        totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang)
        SELECT weakest.lang,
               row_number() OVER (PARTITION BY weakest.lang ORDER BY score DESC, a DESC, weakest.phrase) AS rank,
               weakest.phrase, a, l, r, n, score
        FROM weakest JOIN totals USING (lang)
        LEFT JOIN longer ON longer.lang = weakest.lang AND longer.phrase = weakest.phrase
        WHERE longer.f IS NULL OR 100 * longer.f < 80 * a
        QUALIFY rank <= 2000
    """,
    "op12_jaccard_join": """
        WITH RECURSIVE words AS (
            SELECT doc_id,
                   list_filter(regexp_split_to_array(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
            FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1)) + 1)) AS i FROM words)),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
            FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
        links AS (
            SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
            WHERE 100 * common.n >= 85 * (p.n + q.n - common.n)),
        paired AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
        reach AS (
            SELECT doc_id AS x, doc_id AS y FROM words
            UNION
            SELECT reach.x, paired.y FROM reach JOIN paired ON paired.x = reach.y)
        SELECT words.doc_id, coalesce(max(sizes.n), 0) AS n_shingles, min(reach.y) AS component_id
        FROM words JOIN reach ON reach.x = words.doc_id LEFT JOIN sizes ON sizes.doc_id = words.doc_id
        GROUP BY words.doc_id
    """,
}
