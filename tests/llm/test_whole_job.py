"""Cases in which an operator once did less than the whole job."""

import random
from functools import lru_cache

import numpy as np
import pytest

from tablevet.llm import exact_dedup, link_trust, packing, simhash


def fewest(sizes, capacity):
    @lru_cache(None)
    def search(left, bins):
        if not left:
            return len(bins)
        best = search(left[1:], tuple(sorted((*bins, left[0]))))
        for b in {b for b in bins if b + left[0] <= capacity}:
            other = list(bins)
            other.remove(b)
            best = min(best, search(left[1:], tuple(sorted((*other, b + left[0])))))
        return best

    return search(tuple(sorted(sizes, reverse=True)), ())


def used_by(plan, capacity):
    used = {}
    for filling, times in plan:
        assert times > 0 and sum(s * c for s, c in filling) <= capacity
        for s, c in filling:
            used[s] = used.get(s, 0) + c * times
    return used


def test_bin_completion_tries_smaller_multiplicities():
    histogram = {11: 2, 4: 2, 3: 2, 2: 2}
    plan = packing.complete_bins(histogram, 20)
    assert used_by(plan, 20) == histogram and sum(t for _, t in plan) == 2


def test_fillings_are_all_undominated_ones():
    counts = np.zeros(21, np.int64)
    counts[[2, 3, 4, 11]] = [2, 2, 2, 1]
    assert list(packing.fillings(counts, 9, [10**6])) == [((4, 1), (3, 1), (2, 1)), ((4, 2),)]


@pytest.mark.parametrize("seed", range(60))
def test_bin_completion_of_repeated_lengths_meets_exhaustive_search(seed):
    rng = random.Random(seed)
    kinds = [rng.randint(1, 20) for _ in range(rng.randint(2, 5))]
    sizes = [rng.choice(kinds) for _ in range(11)]
    histogram = {s: sizes.count(s) for s in sizes}
    plan = packing.complete_bins(histogram, 20)
    assert used_by(plan, 20) == histogram
    assert sum(t for _, t in plan) == fewest(sizes, 20)
    cut_short = packing.complete_bins(histogram, 20, nodes=0)
    bins = []
    for s in sorted(sizes, reverse=True):
        room = min((b for b in bins if b >= s), default=20)
        if room in bins:
            bins.remove(room)
        bins.append(room - s)
    assert used_by(cut_short, 20) == histogram
    # Without any search it is the best-fit-decreasing packing.
    assert sum(t for _, t in cut_short) == len(bins)


def test_near_duplicates_of_repeated_ids_are_judged_by_their_own_text(stored):
    rng = random.Random(7)
    a, b, c, d = (" ".join(rng.choice("abcdefghij") * 3 + str(rng.randrange(99)) for _ in range(300)) for _ in range(4))
    near = a + " tail"
    rows = [
        (1, a), (5, near),  # near each other: 1 stays
        (5, b),  # shares the loser's id, near nothing
        (7, c), (7, d),  # one id, unrelated texts
        (7, c),  # a copy of id and text
        (None, d), (None, a),  # rows without an id stay
        (9, ""), (9, None), (8, " "),  # no words: one component
    ]
    got = [(r.doc_id, r.text) for r in simhash.keep_representatives(stored(rows)).collect()]
    want = [(1, a), (5, b), (7, c), (7, d), (None, d), (None, a), (8, " ")]
    fps = {r.locator: r.fp % 2**64 for r in simhash.fingerprints(stored([(i, t) for i, t in enumerate([a, near, b, c, d])])).collect()}
    assert (fps[0] ^ fps[1]).bit_count() <= 4 < min((fps[i] ^ fps[j]).bit_count() for i in range(2, 5) for j in range(i))
    # Row 7 of text d and the row without id of that text share a component, in which 7 has the smallest id.
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_url_filter_follows_long_chains_and_converges(stored, spark):
    pages = [(k, f"http://h{k}.net/", f"<a href=http://h{k + 1}.net/>") for k in range(13)]
    pages[12] = (12, "http://h12.net/", "<a href=http://bad.com/de/>")
    pages += [(13, "http://bad.com/de/", None), (14, "http://alone.net/", "")]
    df = stored(pages, "page_id bigint, url string, html string")
    got = {r.page_id: r.verdict for r in link_trust.filter_urls(df).collect()}
    assert got == {k: "block" for k in range(14)} | {14: "allow"}

    edges = spark.createDataFrame([("a", "b", 1.0), ("b", "a", 3.0), ("b", "c", 1.0)], "src string, dst string, links double")
    seeds = spark.createDataFrame([("a", 1.0, 0.0)], "host string, trust double, distrust double")
    ranks = {r.host: r.trust for r in link_trust.propagate(edges, seeds, damping=0.5, tolerance=1e-6).collect()}
    a = 0.5 / (1 - 0.5 * 0.5 * 0.75)
    assert ranks == pytest.approx({"a": a, "b": a / 2, "c": a / 16}, abs=1e-5)


def test_exact_dedup_folds_copies_of_id_and_text_before_the_shuffle(stored):
    rows = [(1, "Same")] * 50 + [(None, "none")] * 50 + [(2, "same"), (2, "other"), (3, None), (3, "")]
    kept = exact_dedup.keep_winners(stored(rows))
    assert "Window" not in kept._jdf.queryExecution().toString()
    got = [(r.doc_id, r.text or "") for r in kept.collect()]
    assert sorted(got, key=repr) == sorted([(None, "none"), (2, "same"), (2, "other"), (3, "")], key=repr)
