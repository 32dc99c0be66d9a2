"""Phrase mining, the Jaccard join and periodic runs against brute-force versions."""

import hashlib
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from tablevet.llm import jaccard_regions, periodic_runs, phrase_index
from tablevet.llm.queries import ORACLE

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def words_of(text):
    return (text or "").encode().translate(LOWER).split()


# ---- periodic runs


def plain_runs(ids, least=6, times=4):
    found = {}
    for q in range(1, len(ids) // times + 1):
        i = 0
        while i + q < len(ids):
            j = i
            while j + q < len(ids) and ids[j] == ids[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((a, n, q) for (a, n), q in found.items()), key=lambda r: (r[0], r[2]))


def looping_words(rng, n=6):
    words = []
    for _ in range(rng.randint(0, n)):
        if rng.random() < 0.6:
            period = [rng.choice("abcd") for _ in range(rng.randint(1, 7))]
            words += (period * rng.randint(1, 9))[: rng.randint(1, 60)]
        else:
            words += [rng.choice("abcdefgxyz") for _ in range(rng.randint(1, 12))]
    return words


def test_runs_equal_plain_comparison():
    rng = random.Random(5)
    for _ in range(1500):
        texts = [[w.encode() for w in looping_words(rng)] for _ in range(rng.randint(1, 4))]
        assert periodic_runs.runs_of_texts(texts) == [plain_runs(t) for t in texts]


@pytest.mark.parametrize("least,times", [(6, 4), (10, 4), (5, 5), (12, 6)])
def test_runs_with_other_limits(least, times):
    rng = random.Random(6)
    for _ in range(300):
        text = [w.encode() for w in looping_words(rng)]
        assert periodic_runs.runs_of_texts([text], least, times) == [plain_runs(text, least, times)]


def test_lag_scan_survives_hash_collisions(monkeypatch):
    monkeypatch.setattr(periodic_runs, "mixed", lambda h: h * np.uint64(0))  # every range is equal
    rng = random.Random(7)
    for _ in range(200):
        ids = np.array([rng.randint(0, 2) for _ in range(rng.randint(4, 40))])
        expected = [r for r in plain_runs(ids)]
        assert set(expected) <= set(periodic_runs.lag_scan(ids))


def test_long_texts_of_one_word_and_of_a_long_period():
    assert periodic_runs.lag_scan(np.zeros(300_000, np.int64)) == [(0, 300_000, 1)]
    period = np.random.default_rng(1).integers(0, 50_000, 20_000)
    assert (0, 200_000, 20_000) in periodic_runs.lag_scan(np.tile(period, 10))


def looped(doc_id, text):
    words = (text or "").encode().split()
    if doc_id is None:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    a = h // 10 % n
    p = 1 + (n - a) // (3 + h // 10 % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def plain_report(doc_id, text):
    words = looped(doc_id, text)
    runs = plain_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    left = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return (
        doc_id,
        len(runs),
        *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(left).hexdigest(),
    )


def test_run_report(spark, stored):
    rng = random.Random(8)
    rows = [(i, " ".join(looping_words(rng, 9))) for i in range(300)]
    rows += [(i, " ".join(rng.choices("abc", k=200))) for i in range(300, 400)]
    rows += [(None, "x " * 20), (None, None), (7, ""), (7, "é é\té\né \x0b é é"), (2**60 + 1, "z " * 9), (8, " \n ")]
    rows += rows[:20]
    report = periodic_runs.run_report(stored(rows))
    assert report.columns[:6] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli"]
    assert sorted(map(tuple, report.collect()), key=str) == sorted((plain_report(*r) for r in rows), key=str)
    assert periodic_runs.run_report(stored([])).count() == 0
    texts = {r["collapsed"] for r in periodic_runs.collapse_runs(stored([(1, "a b " * 5 + "c")])).collect()}
    assert texts == {"a b c"}


# ---- Jaccard join


def plain_components(rows, width=4, similar=85):
    sets = []
    for _, text in rows:
        w = words_of(text)
        sets.append(frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= similar * len(a | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        out.append((doc_id, len(sets[i]), least.get(find(i)) if sets[i] else doc_id))
    return sorted(out, key=str)


def family(rng, n, words=60, most=8):
    base = [f"w{rng.randint(0, 500)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, most)):
            at = rng.randrange(len(copy))
            kind = rng.random()
            if kind < 0.4:
                copy[at] = f"x{rng.randint(0, 10**6)}"
            elif kind < 0.7:
                del copy[at]
            else:
                copy.insert(at, f"x{rng.randint(0, 10**6)}")
        out.append(" ".join(copy))
    return out


@pytest.fixture(scope="module")
def families():
    rng = random.Random(3)
    texts = []
    for words, most in ((60, 3), (60, 8), (150, 12), (400, 30), (12, 2), (5, 1), (3, 1)):
        texts += family(rng, 25, words, most)
    texts += [" ".join(f"w{rng.randint(0, 30)}" for _ in range(rng.randint(0, 40))) for _ in range(60)]
    texts += texts[:30] + [t.upper() for t in texts[30:40]] + ["", None, " \n ", "one", "One", "one two three", "one two"]
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("pairs", [1, 400, 1 << 24])
def test_links_of_a_region_equal_all_pairs(monkeypatch, pairs):
    monkeypatch.setattr(jaccard_regions, "LEAF_PAIRS", pairs)
    rng = random.Random(4)
    for most in (2, 6, 12):
        texts = [t.encode() for t in set(family(rng, 150, 80, most))]
        sizes, hashes = jaccard_regions.shingle_sets(texts)
        sets = jaccard_regions.Sets(np.split(hashes, np.cumsum(sizes)[:-1]))
        everyone = np.arange(len(texts))
        for own in (len(texts), len(texts) // 3):
            found = jaccard_regions.region_links(sets, everyone[:own], everyone[own:])
            assert all(a < own or b < own for a, b in found)
            both = {frozenset(p) for p in found}
            parent = list(everyone)

            def find(x):
                while parent[x] != x:
                    x = parent[x]
                return x

            for a, b in both:
                parent[find(a)] = find(b)
            for a in range(own):
                shared, union = sets.similarity(a, everyone)
                for b in everyone[100 * shared >= 85 * union]:
                    assert find(a) == find(b)
            for a, b in found:
                shared, union = sets.similarity(a, np.array([b]))
                assert 100 * shared[0] >= 85 * union[0]


def test_linked_sets_share_a_bucket():
    rng = random.Random(9)
    texts = [t.encode() for words in (4, 8, 20, 60, 300) for t in family(rng, 40, words, max(1, words // 12))]
    sizes, hashes = jaccard_regions.shingle_sets(texts)
    owner, key = jaccard_regions.bucket_keys(sizes, hashes)
    keys = [set(key[owner == i].tolist()) for i in range(len(texts))]
    sets = [set(s.tolist()) for s in np.split(hashes, np.cumsum(sizes)[:-1])]
    linked = 0
    for i, a in enumerate(sets):
        for j in range(i):
            if a != sets[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                linked += 1
                assert keys[i] & keys[j]
    assert linked > 50


@pytest.mark.parametrize("limits", [{}, {"task_tokens": 2_000}, {"task_pairs": 50}, {"task_pairs": 200, "task_tokens": 3_000}])
def test_jaccard_components(spark, stored, families, limits):
    out = jaccard_regions.similar_sets(stored(families), **limits)
    assert sorted(map(tuple, out.collect()), key=str) == plain_components(families)


def test_regions_that_pivots_do_not_cut_meet_in_chunks(spark, stored, families):
    docs = stored(families)
    parts = jaccard_regions.families(docs, "text", 4, 85)
    members = jaccard_regions.member_texts(docs, parts, "text", 4)
    regions, links = jaccard_regions.cut_regions(members, 4, 85, 1_000, rounds=0)
    found = regions.repartition("region").sortWithinPartitions("region")
    found = found.mapInArrow(jaccard_regions.region_rows(4, 85), jaccard_regions.LINK).unionByName(links).distinct()
    whole, none = jaccard_regions.cut_regions(members, 4, 85)
    whole = whole.repartition("region").sortWithinPartitions("region")
    whole = whole.mapInArrow(jaccard_regions.region_rows(4, 85), jaccard_regions.LINK)
    roots = [
        {(r["node"], r["root"]) for r in jaccard_regions.connected_components(x).collect()} for x in (found, whole)
    ]
    assert roots[0] == roots[1] and roots[0]


def test_jaccard_edges(spark, stored):
    text = " ".join(f"a{i}" for i in range(50))
    rows = [(None, text), (2**60 + 3, text), (2**60 + 1, text.upper()), (5, text + " b"), (5, ""), (None, None), (None, "q")]
    rows += [(6, "q"), (6, "q"), (9, None), (10, "")]
    out = jaccard_regions.jaccard_report(stored(rows))
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, out.collect()), key=str) == plain_components(rows)
    assert jaccard_regions.jaccard_report(stored([])).count() == 0


# ---- phrases


def plain_collocations(rows, least, top):
    import re

    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        lower = (text or "").encode().translate(LOWER).decode()
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    f = {p: c for p, c in f.items() if c >= least}
    covered = set()
    for (lang, phrase), c in f.items():
        for size in range(2, len(phrase)):
            for at in range(len(phrase) - size + 1):
                inner = phrase[at : at + size]
                if 100 * c >= 80 * f[lang, inner]:
                    covered.add((lang, inner))
    out = []
    for lang in n:
        scored = []
        for (own, phrase), a in f.items():
            if own != lang or len(phrase) < 2 or (lang, phrase) in covered:
                continue
            cuts = []
            for k in range(1, len(phrase)):
                l_, r_ = f[lang, phrase[:k]], f[lang, phrase[k:]]
                cuts.append((2_000_000 * a // (l_ + r_), k, l_, r_))
            score, _, l_, r_ = min(cuts)
            scored.append((-score, -a, " ".join(phrase).encode(), l_, r_))
        for rank, (s, a, phrase, l_, r_) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l_, r_, n[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("size,bits,top", [(8 << 20, 1 << 24, 2000), (300, 64, 7), (1500, 1 << 12, 2000)])
def test_collocations(spark, stored, size, bits, top):
    rng = random.Random(11)
    vocabulary = ["the", "of", "New", "york", "é", "a-b", "x1", " w", "to"]
    rows = []
    for i in range(400):
        words = [rng.choice(vocabulary[: rng.randint(2, 9)]) for _ in range(rng.randint(0, 25))]
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n"]) for w in words)
        rows.append((i, text, rng.choice(["en", "en", "fr", None])))
    rows += [(None, None, "de"), (1, "", "en"), (1, "the of the of the of", "en"), (2, "...", "nl")] + rows[:50]
    docs = stored(rows, "doc_id bigint, text string, lang string")
    out = phrase_index.collocations(docs, least=8, size=size, bits=bits, top=top)
    assert sorted(map(tuple, out.collect())) == plain_collocations([r[1:] for r in rows], 8, top)


def test_collocations_of_nothing(spark, stored):
    assert phrase_index.collocations(stored([], "doc_id bigint, text string, lang string")).count() == 0
    rare = stored([(1, "a b c", "en")], "doc_id bigint, text string, lang string")
    assert phrase_index.collocations(rare).count() == 0


def test_scores_stay_exact_beyond_64_bits(spark):
    big = 9 * 10**15
    counts = spark.createDataFrame(
        [("en", "a", big, 1), ("en", "b", big + 1, 1), ("en", "a b", big - 1, 2)], "lang string, phrase string, f bigint, length int"
    )
    (row,) = phrase_index.weakest_cut(counts).collect()
    assert row["score"] == 2_000_000 * (big - 1) // (2 * big + 1)


def test_index_extends_both_ways():
    words, stream = phrase_index.word_stream(b"a b a b c. b a b")
    table = type("All", (), {"may_hold": staticmethod(lambda hashes, lang: np.ones(len(hashes), bool))})
    for length in (1, 2, 3, 4):
        hashes = phrase_index.word_hashes(words)
        ids, counts = phrase_index.shard_phrases(hashes, stream, length, "en", [table] * max(1, length - 1))
        got = {" ".join(words[i - 1].decode() for i in row): int(c) for row, c in zip(ids, counts)}
        pieces = [["a", "b", "a", "b", "c"], ["b", "a", "b"]]
        assert got == Counter(" ".join(p[i : i + length]) for p in pieces for i in range(len(p) - length + 1))


def test_new_queries_against_sql(spark):
    import duckdb

    import __spark_entry__ as contract

    for name in ("op11_phrase_mining", "op12_jaccard_join"):
        con = duckdb.connect()
        con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
        cursor = con.execute(ORACLE[name])
        names = [c[0] for c in cursor.description]
        df = contract.queries()[name](spark, "/root/testdata/sf0.001")
        assert set(df.columns) == set(names)
        assert sorted(map(tuple, df.select(names).collect())) == sorted(cursor.fetchall())
