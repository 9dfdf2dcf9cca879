import random
import re

import numpy as np
import pytest

from scorecast.llm import jaccard_join

from .corpus import documents, empty, frame

FOLD = {c: c + 32 for c in range(65, 91)}


def brute(rows, k, num, den):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(FOLD))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(rows[a][0]), root(rows[b][0])
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for (i, _), s in zip(rows, sets)}


@pytest.mark.parametrize("k,num,den", [(3, 90, 100), (5, 80, 100)])
def test_against_brute_force(spark, k, num, den):
    rows = documents(seed=k, n=250)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in jaccard_join.jaccard_classes(frame(spark, rows), k, num, den).collect()}
    assert got == brute(rows, k, num, den)


@pytest.mark.parametrize("joined_first", [True, False])
def test_large_clusters_are_cut_into_tiles(spark, monkeypatch, joined_first):
    rows = documents(seed=9, n=120)
    base = rows[20][1].split(" ") * 3
    for i in range(150):                                        # a hot group of near copies
        rows.append((5000 + i, " ".join(f"w{i}" if j % (40 + i % 9) == i % 7 else w for j, w in enumerate(base))))
    for i in range(60):                                         # copies of one text, each changed at some other tenths
        rows.append((7000 + i, " ".join(f"v{i}" if j // 12 % 10 == i % 10 else w for j, w in enumerate(base))))
    plain, first = jaccard_join._tiles, jaccard_join._first_links
    monkeypatch.setattr(jaccard_join, "_tiles", lambda *a: plain(*a, limit=400))
    # without the first round, all links come from the tiles
    monkeypatch.setattr(jaccard_join, "_first_links", lambda *a: first(*a, limit=300) if joined_first else first(*a).limit(0))
    for k, num, den in [(3, 90, 100), (5, 80, 100)]:
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_classes(frame(spark, rows), k, num, den).collect()}
        assert got == brute(rows, k, num, den)


def test_long_near_copies_at_the_threshold(spark):
    """Texts of 200 to 20,000 words, pairs just above and just below 0.8."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    passage, rows = [word() for _ in range(80)], []
    for n in [200, 333, 500, 700, 1000, 1500, 2200, 3000, 5000, 9000, 20000]:
        base = [word() for _ in range(n)] + passage             # a passage common to all
        for cut in range(0, 8):
            # a changed word changes five shingles; so many bring the similarity to about 0.8
            copy, spots = list(base), rng.sample(range(0, n // 10), max(0, n // 45 + cut - 4))
            for x in spots:
                copy[x * 10 + 2] = word()
            rows.append((len(rows), " ".join(copy)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_classes(frame(spark, rows), 5, 80, 100).collect()}
    want = brute(rows, 5, 80, 100)
    assert got == want and 11 < len({c for _, c in want.values()}) < len(rows)


def test_edge_cases(spark):
    rows = [(4, "a b c d"), (4, "e f g h"), (2, "E f g h"), (None, "a b c d"), (None, "q"), (9, None), (9, " ")]
    out = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_classes(frame(spark, rows)).collect()), key=str)
    assert out == sorted([(4, 2, 2), (4, 2, 2), (2, 2, 2), (None, 2, 2), (None, 1, None), (9, 0, 9), (9, 0, 9)], key=str)
    assert jaccard_join.jaccard_classes(empty(spark)).count() == 0


@pytest.mark.parametrize("num,den", [(9, 10), (4, 5), (7, 10)])
def test_similar_sets_share_a_key(num, den):
    """The pigeonhole: whatever the sizes, two sets at the threshold agree on a key."""
    rng, bands = np.random.default_rng(1), jaccard_join.Bands(num, den)
    for n in [*range(1, 60), 150, 200, 1000, 3000]:
        base = rng.integers(0, 2**64, n, np.uint64)
        step = max(1, n // 20)
        for common in (0, n // 3, n):                          # shingles that count for nothing at first
            known = np.sort(base[n - common:])
            for lost in range(0, n, step):
                # as many new ones as the similarity allows
                new = den * (n - lost) // num - n
                if new < 0:
                    break
                other = np.unique(np.concatenate((base[lost:], rng.integers(0, 2**64, new, np.uint64))))
                keys = [set(bands.keys(v, known).tolist()) for v in (np.unique(base), other)]
                assert keys[0] & keys[1], (n, lost, new)


def test_texts_that_share_a_common_passage_do_not_meet():
    """A passage common in the sample brings no two texts together."""
    rng, bands = np.random.default_rng(2), jaccard_join.Bands(4, 5)
    passage = np.sort(rng.integers(0, 2**64, 60, np.uint64))
    seen, sizes = set(), []
    for _ in range(300):
        keys = set(bands.keys(np.unique(np.concatenate((passage, rng.integers(0, 2**64, 400, np.uint64)))), passage).tolist())
        assert not keys & seen
        seen |= keys
        sizes.append(len(keys))
    assert np.mean(sizes) < 0.8 * 460
