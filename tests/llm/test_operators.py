"""Every operator against a brute-force version, with nulls, ties, repeats and empty tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tablevet.llm import (
    bpe,
    decision_list,
    exact_dedup,
    factorization,
    link_trust,
    packing,
    queries,
    secret_ledger,
    simhash,
    suffix_dedup,
    toxicity,
)
from tablevet.llm.components import connected_components

WORDS = [f"w{i}" for i in range(60)]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edge_rows():
    rng = random.Random(1)
    rows = [(i, prose(rng, rng.randint(1, 120))) for i in range(60)]
    long = prose(rng, 20_000)
    rows += [(100, rows[3][1].upper()), (101, rows[3][1]), (102, long), (103, long + " tail"), (104, ""), (105, None)]
    rows += [(106, " \n\t "), (3, rows[3][1]), (None, rows[5][1]), (None, None), (107, "É é ß 日本 😀 \x85\r\n<|endoftext|> it's")]
    return rows


def labels_of(spark, rows, column="quality"):
    return spark.createDataFrame(rows, f"doc_id bigint, {column} int")


def test_exact_dedup(stored):
    rows = edge_rows()
    got = {}
    for r in exact_dedup.dedup_report(stored(rows)).collect():
        got.setdefault(r.text_sha256, []).append(r)
    fold = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(hashlib.sha256(fold(t).encode()).hexdigest(), []).append(i)
    assert {k: len(v) for k, v in got.items()} == {k: len(v) for k, v in groups.items()}
    for k, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        assert {(r.keep_id, r.group_size) for r in got[k]} == {(keep, len(ids))}
        assert all(r.kept == (r.doc_id == keep) for r in got[k])
    kept = exact_dedup.keep_winners(stored(rows))
    assert kept.count() == len(groups) and "fp" in kept.columns


def test_exact_dedup_bounds_buckets_of_a_small_history(stored, monkeypatch):
    seen = []
    real = exact_dedup.look_up
    monkeypatch.setattr(exact_dedup, "look_up", lambda a, b, n: seen.append(n) or real(a, b, n))
    rows = [(-(10**6), "first")] + [(i, f"text {i}") for i in range(100)] + [(200, "FIRST")]
    out = exact_dedup.exact_dedup(stored(rows), F.col("locator") < 0, per_bucket=10)
    got = {r.locator: (r.keep, r.group_size) for r in out.collect()}
    assert seen == [11]
    assert got == {i: (i, 1) for i in range(100)} | {-(10**6): (200, 2), 200: (200, 2)}


def test_near_duplicates_keep_rows_without_id_and_one_of_each_group(stored):
    text = "a b c d e f g h"
    kept = simhash.keep_representatives(stored([(4, text), (4, text), (7, text), (None, text), (None, text), (9, "other")]))
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, -1, 4, 9]


def test_perfect_hash_is_minimal_and_knows_strangers():
    raw = b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(5000))
    levels, slots = exact_dedup.build_function(raw)
    assert sorted(slots) == list(range(5000))
    assert (exact_dedup.find_slots(levels, raw) == slots).all()


def test_decision_list_counts(stored, spark):
    rows = edge_rows() + [(200, "a b c d e\na b c d e\n \nx #$|"), (201, "a " * 30)]
    out = decision_list.quality_report(stored(rows), labels_of(spark, [(1, 1), (2, 0)]))
    got = sorted((r.doc_id or -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out.collect())
    want = []
    for i, t in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        at = {}
        for k in range(len(w) - 4):
            at.setdefault(tuple(w[k : k + 5]), []).append(k)
        covered = {p for v in at.values() if len(v) > 1 for k in v for p in range(k, k + 5)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        n = len(covered)
        want.append((i or -1, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), n, len(w) < 10 or 100 * n > 20 * len(w)))
    assert got == sorted(want)


def test_decision_list_learns_a_conjunction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    bad = (x[:, 0] > 0.7) & (x[:, 1] < 0.4)
    rules = decision_list.learn(x, bad, ["a", "b", "c"])
    hit = np.zeros(len(x), bool)
    for rule in rules:
        hit |= decision_list._passes(x, ["a", "b", "c"], rule.tests)
    assert (hit & ~bad).sum() <= 5 and (hit & bad).sum() > 0.95 * bad.sum()


def test_packing(stored):
    path = queries.vocabulary()
    rows = edge_rows()
    out = packing.pack(stored(rows), path, with_ids=True).collect()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    want = []
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        head = len(ids) % 2048 or 2048
        cuts = [0, *range(head, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.append((i or -1, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in out) == sorted(want)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in out)
    bins = {}
    for r in out:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) == -(-sum(r.length for r in out) // 2048)


@pytest.mark.parametrize("seed", range(6))
def test_bin_completion_meets_exhaustive_search(seed):
    rng = random.Random(seed)
    sizes = [rng.randint(1, 20) for _ in range(9)]
    histogram = {s: sizes.count(s) for s in sizes}
    plan = packing.complete_bins(histogram, 20)

    def exhaustive(left, bins):
        if not left:
            return len(bins)
        first, rest = left[0], left[1:]
        tries = {b for b in bins if b + first <= 20}
        best = exhaustive(rest, [*bins, first])
        for b in tries:
            other = list(bins)
            other.remove(b)
            best = min(best, exhaustive(rest, [*other, b + first]))
        return best

    used = {}
    for filling, times in plan:
        for s, c in filling:
            used[s] = used.get(s, 0) + c * times
    assert used == histogram
    assert sum(t for _, t in plan) == exhaustive(sorted(sizes, reverse=True), [])


def brute_repeats(texts, least):
    seen = {}
    for t in texts:
        for a in range(len(t) - least + 1):
            seen[t[a : a + least]] = seen.get(t[a : a + least], 0) + 1
    for t in texts:
        covered = np.zeros(len(t), bool)
        for a in range(len(t) - least + 1):
            if seen[t[a : a + least]] > 1:
                covered[a : a + least] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~covered]) if t else b""
        runs = int((np.diff(np.append(0, covered.astype(int))) == 1).sum())
        yield len(t), int(covered.sum()), runs, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("hot", [20_000, 3])
def test_suffix_dedup(stored, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_KINDS", hot)
    rng = random.Random(2)
    base = ["".join(rng.choice("abcde \n") for _ in range(1500)) for _ in range(4)]
    rows = []
    for i in range(50):
        t = "".join(rng.choice("fgh é") for _ in range(rng.randint(0, 300)))
        for _ in range(rng.randint(0, 2)):
            a = rng.randint(0, 1400)
            t += rng.choice(base)[a : a + rng.randint(100, 900)] + "x" * rng.randint(0, 5)
        rows.append((i, t))
    rows += [(60, "a" * 900), (61, "ab" * 600), (62, ""), (63, None), (64, "z" * 400), (65, "y" * 399), (None, rows[0][1]), (0, rows[0][1])]
    got = sorted(tuple(r)[1:] for r in suffix_dedup.suffix_report(stored(rows)).collect())
    assert got == sorted(brute_repeats([(t or "").encode() for _, t in rows], 400))


def test_bpe(stored):
    path = queries.vocabulary()
    rng = random.Random(3)
    letters = ["a", "b", " ", "  ", "\n", "\t", "é", "'s", "1", ".", "!!", "<|endoftext|>", "日", "😀", "\r\n", "\x85", "\x00"]
    rows = edge_rows() + [(300 + i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 80)))) for i in range(200)]
    rows += [(600, "ab" * 5000), (601, "é" * 3001), (602, "日本" * 2000), (603, " " * 4000), (604, "=" * 7777)]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    want = []
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        text = tokenizer.decode(ids, skip_special_tokens=False)
        want.append((i or -1, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    got = bpe.round_trip_report(stored(rows), path).collect()
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want)


def test_secret_ledger_finds_masks_and_remembers(stored, spark, tmp_path):
    rows = edge_rows() + [
        (400, "é password = 'abc123x' AKIA" + "A1" * 9 + " " + "0123456789abcdef" * 2),
        (401, 'secret=token" : abcdef123 Token:"a.b-c_d=" api_key=12345'),
        (402, "x ghp_" + "a" * 36),
    ]
    path = str(tmp_path / "ledger")
    got = sorted((r.doc_id or -1, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in secret_ledger.secret_report(stored(rows), path).collect())
    want = []
    for i, t in rows:
        t = t or ""
        a = [(m.start(), 0, "assign", m.end()) for m in re.finditer(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[2]) >= 6]
        b = [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        c = [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
        text = ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(a + b + c))
        want.append((i or -1, len(a), len(b), len(c), hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want)
    ledger = secret_ledger.ledger_table(spark, path)
    n = ledger.count()
    secret_ledger.secret_report(stored(rows), path).count()
    assert secret_ledger.ledger_table(spark, path).count() == n  # nothing unseen
    newer = (*secret_ledger.RULES[:2], secret_ledger.Rule("hex", "[0-9a-f]{24,}", least=24, version=2))
    secret_ledger.scan(stored(rows), path, newer).count()
    added = secret_ledger.ledger_table(spark, path).where("array_contains(rules, 'hex@2')")
    assert added.count() == n and added.selectExpr("max(size(rules)) as m").first().m == 1
    stricter = (*secret_ledger.RULES[:2], secret_ledger.Rule("hex", "[0-9a-f]{40,}", least=40, version=3))
    found = {r.doc_id: [s.kind for s in r.spans] for r in secret_ledger.scan(stored(rows), path, stricter).collect()}
    assert found[400] == ["assign", "access"]  # what an older version found is not reported
    found = {r.doc_id: [s.kind for s in r.spans] for r in secret_ledger.scan(stored(rows), path).collect()}
    assert found[400] == ["assign", "access", "hex"]
    masked = {r.doc_id: r.text for r in secret_ledger.keep_clean(stored(rows)).collect()}
    assert "0123456789abcdef" not in masked[400] and masked[400].startswith("é ") and masked[102] == dict(rows)[102]


def test_simhash(stored):
    rng = random.Random(4)
    rows = edge_rows()
    long = [rng.choice(WORDS) for _ in range(400)]
    for k in range(60):
        copy = list(long)
        copy[rng.randrange(400)] = f"edit{k}"
        rows.append((500 + k, " ".join(copy)))

    def fingerprint(t):
        w = (t or "").encode().lower().split()
        shingles = [b" ".join(w[k : k + 4]) for k in range(max(1, len(w) - 3))] if w else []
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fps = [fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    want = sorted((i or -1, f"{fps[k]:016x}", least.get(find(k))) for k, (i, _) in enumerate(rows))
    got = simhash.near_duplicate_report(stored(rows)).collect()
    assert sorted((r.doc_id or -1, r.fingerprint, r.component_id) for r in got) == want


def test_large_cells_are_cut_without_losing_links(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CELL_ROWS", 8)
    fps = [(1 << a) | (1 << b) for a in range(20) for b in range(a)]
    df = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    parts = connected_components(simhash.fingerprint_links(df))
    assert parts.select("root").distinct().count() == 1 and parts.count() == len(fps)


def test_classifiers_rank_held_out_rows(stored, spark):
    rng = random.Random(5)
    rows, quality, toxic = [], [], []
    for i in range(600):
        bad, rude = i % 5 == 0, i % 4 == 0
        words = prose(rng, 60).split()
        if rude:
            words[7] = words[30] = rng.choice(["vile", "vilest", "nasty"])
        rows.append((i, " ".join(f"{w}###" if bad else w for w in words)))
        quality.append((i, 0 if bad else 1))
        toxic.append((i, int(rude)))
    rows += [(None, "vile"), (900, ""), (901, None), (0, rows[0][1])]
    docs = stored(rows)
    good = factorization.quality_scores(docs, labels_of(spark, quality)).collect()
    assert len(good) == len(rows) and all(0 <= r.score <= 1 for r in good)
    held = [r for r in good if r.held_out and r.doc_id < 600]
    assert held and sum(r.predicted == (r.doc_id % 5 != 0) for r in held) >= 0.97 * len(held)
    rude = toxicity.toxicity(docs, labels_of(spark, toxic, "toxic")).collect()
    held = [r for r in rude if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) >= 0.97 * len(held)
    assert len(toxicity.toxicity(docs, labels_of(spark, [], "toxic")).where("predicted = 1").collect()) == 0


def test_sum_of_squares_identity():
    rng = np.random.default_rng(1)
    m = factorization.Machine(0.5, rng.normal(size=20), rng.normal(size=(20, 3)))
    index, value = np.array([1, 4, 9, 2]), np.array([0.5, 1.0, 2.0, 3.0])
    margin, _ = m.margins(index, value, np.array([3, 1]))
    pairs = sum(m.factors[a] @ m.factors[b] * x * y for (a, x), (b, y) in [((1, 0.5), (4, 1.0)), ((1, 0.5), (9, 2.0)), ((4, 1.0), (9, 2.0))])
    assert np.isclose(margin[0], 0.5 + m.linear[index[:3]] @ value[:3] + pairs)
    assert np.isclose(margin[1], 0.5 + 3 * m.linear[2])


def test_url_filter(stored, spark):
    pages = [
        (1, "https://A.example.org/es/x?q", None),
        (2, "http://b.example.org/en/12", ""),
        (3, "http://example.org", '<a href="//bad.com/de/">'),
        (4, "http://notexample.org/es/", "x"),
        (5, "http://bad.com/de/1", "x"),
        (6, "http://bad.com/other", "x"),
        (7, "http://links.net/p", "<A HREF='http://bad.com/de/2'>"),
        (8, None, None),
        (9, "no scheme", "x"),
        (None, "http://good.com/fr/#f", "x"),
        (10, "http://far.net/#a/b", "<a href=http://LINKS.net/>"),
    ]
    df = stored(pages, "page_id bigint, url string, html string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in link_trust.filter_urls(df).collect()}
    assert got[1] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert got[2][2:] == ("example.org/en/1", "block")
    assert got[3] == ("example.org", "", None, "block")  # it links to a blocked host
    assert got[4][2:] == ("org/", "allow")
    assert got[5][2:] == ("com/de/", "block") and got[6][2:] == (None, "block")
    assert got[7][2:] == (None, "block") and got[10] == ("far.net", "/", None, "block")
    assert got[8] == ("", "", None, "allow") == got[9] and got[None][2:] == ("com/fr/", "allow")


def test_empty_tables(spark, stored):
    docs, none = stored([]), labels_of(spark, [])
    path = queries.vocabulary()
    for out in (
        exact_dedup.dedup_report(docs), decision_list.quality_report(docs, none), packing.pack(docs, path),
        suffix_dedup.suffix_report(docs), bpe.round_trip_report(docs, path), secret_ledger.secret_report(docs),
        simhash.near_duplicate_report(docs), factorization.quality_scores(docs, none),
        toxicity.toxicity(docs, labels_of(spark, [], "toxic")),
        link_trust.filter_urls(stored([], "page_id bigint, url string, html string")),
    ):
        assert out.collect() == []


def test_pipeline_stages(spark, stored, tmp_path_factory):
    import corpus_pipeline

    folder = str(tmp_path_factory.mktemp("sf"))
    rng = random.Random(6)
    rows = [(i, prose(rng, 80)) for i in range(40)] + [(50, "short"), (51, None), (52, "junk " * 50)]
    rows += [(60, rows[2][1].upper()), (61, rows[3][1] + " more words here"), (62, prose(rng, 30) + " password=hunter2222")]
    stored(rows).write.parquet(f"{folder}/documents.parquet")
    labels_of(spark, [(1, 1), (2, 1)]).write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == names
        path = f"{folder}/{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    kept = {r.doc_id: r.text for r in docs.collect()}
    assert not {50, 51, 52, 2} & set(kept) and {60, 62, 0, 1} <= set(kept)
    assert "hunter2222" not in kept[62]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == set(kept)
