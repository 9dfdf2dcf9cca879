import hashlib
import random
import re

import numpy as np
import pyarrow as pa

from scorecast.llm import substring_dedup
from scorecast.llm import words as W

from .corpus import documents, empty, frame


def brute(rows, size):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        keep = [True] * len(w)
        for p in range(len(w) - size + 1):
            g = tuple(w[p:p + size])
            if g in seen:
                keep[p:p + size] = [False] * size
            seen.add(g)
        kept = " ".join(x for x, k in zip(w, keep) if k)
        out[i] = (len(w), len(w) - sum(keep), hashlib.sha256(kept.encode()).hexdigest(), kept)
    return out


def test_against_brute_force(spark):
    rows = documents(n=150)
    rows.append((2000, "again " * 100))
    rows.append((2001, rows[7][1] + " tail"))
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"], r["kept"])
           for r in substring_dedup.remove_repeats(frame(spark, rows)).collect()}
    assert got == brute(rows, 20)


def test_large_groups_are_split_by_longer_prefixes(spark, monkeypatch):
    rows = documents(seed=8, n=120)
    passage = " ".join(f"p{i % 60}" for i in range(70))
    rows += [(3000 + i, f"a{i} b{i} " + " ".join(passage.split()[i % 5:60 + i % 9]) + f" {rows[20][1]}"[:i * 7]) for i in range(120)]
    rows += [(4000 + i, "hum " * (25 + i)) for i in range(10)]
    want = {i: x[:3] for i, x in brute(rows, 20).items()}
    for group in (40, 12, 2):
        monkeypatch.setattr(substring_dedup, "GROUP", group)
        got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup.remove_repeats(frame(spark, rows)).collect()}
        assert got == want, group


def test_words_are_compared_as_words(monkeypatch):
    """Hashes that all collide change nothing in a subtree."""
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["aa", "ab", "abcdefghijk", "abcdefghijl", "é", "b" * 9]) for _ in range(34)) for _ in range(40)]
    texts += texts[:10] + [texts[0][:60]]
    size, n_left = 20, np.array([min(14, len(t.split()) - 6) for t in texts])
    every = lambda v: np.full(len(texts), v)
    args = (every(0), every(0), every(14), np.arange(len(texts)), n_left, pa.array(texts), size)
    want = np.zeros((len(texts), 15), bool)
    for o in range(15):
        seen = set()
        for i, t in enumerate(texts):
            w = t.split()[n_left[i] - o: n_left[i] - o + size] if n_left[i] >= o else []
            want[i, o] = len(w) == size and tuple(w) in seen and len(t.split()) >= n_left[i] - o + size
            seen.add(tuple(w))
    assert (substring_dedup.subtree_repeats(*args) == want).all() and want.sum() > 100
    monkeypatch.setattr(W, "_hash", lambda data, start, end: np.full(len(start), 7, np.uint64))
    assert (substring_dedup.subtree_repeats(*args) == want).all()


def test_edge_cases(spark):
    long = " ".join(f"w{i}" for i in range(40))
    rows = [(1, long), (1, long), (1, "x " + long), (None, long), (None, None), (0, "short")]
    out = sorted(((r["doc_id"], r["n_words"], r["n_removed"]) for r in substring_dedup.remove_repeats(frame(spark, rows)).collect()), key=str)
    assert len(out) == 6
    # one of the two texts of id 1 comes first and loses nothing
    assert [x for x in out if x[0] == 1] in ([(1, 40, 0), (1, 40, 0), (1, 41, 40)], [(1, 40, 40), (1, 40, 40), (1, 41, 0)])
    assert (None, 40, 40) in out and (None, 0, 0) in out and (0, 1, 0) in out
    assert substring_dedup.remove_repeats(empty(spark)).count() == 0
