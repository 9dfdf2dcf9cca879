import random
import re

import numpy as np
import pyarrow as pa

from scorecast.llm import decontaminate as d
from scorecast.llm import words as W

from .corpus import documents, empty, frame


def bag(words, k=5):
    k = min(k, len(words))
    out = {}
    for i in range(len(words) - k + 1 if words else 0):
        s = tuple(words[i:i + k])
        out[s] = out.get(s, 0) + sum(len(w.encode()) for w in s)
    return out


def brute(rows, items, least=0.8):
    found = set()
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        for item, x in items:
            v = re.findall(r"[^\x20\x09-\x0D]+", (x or "").lower())
            if not v or not w:
                continue
            a, n = bag(v), min(len(v), len(w)) if len(v) >= 5 else len(v)
            for p in range(len(w) - n + 1):
                b = bag(w[p:p + n])
                top = sum(max(a.get(s, 0), b.get(s, 0)) for s in {*a, *b})
                if top and sum(min(a.get(s, 0), b.get(s, 0)) for s in a) >= least * top:
                    found.add((i, item))
                    break
    return found


def items_of(spark, items):
    return spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")


def test_against_brute_force(spark):
    rng = random.Random(6)
    rows = documents(n=80)
    items = [(i, " ".join(rng.choice(["ab", "cde", "f", "ghij", "kl", "mno", "pq", "rst"]) + str(rng.randint(0, 30)) for _ in range(rng.randint(5, 60)))) for i in range(30)]
    items += [(100, "one two"), (101, None), (102, " "), (103, items[0][1])]
    for i in range(40):
        words = items[i % 30][1].split()
        for _ in range(i % 3):
            words[rng.randrange(len(words))] = "zz"
        rows.append((3000 + i, (rows[10 + i][1] or "") + " " + " ".join(words).upper() + "\nend of it"))
    for block in (d.BLOCK_BYTES, 400):                     # one block of items, and many
        out = d.leaks(frame(spark, rows), items_of(spark, items), block_bytes=block).collect()
        assert {(r["doc_id"], r["item_id"]) for r in out} == brute(rows, items)
        assert len(out) == len({(r["doc_id"], r["item_id"]) for r in out})
    exact = [r for r in out if r["similarity"] == 1.0]
    assert exact and all(r["hamming"] == 0 for r in exact if r["n_words"] > 4)


def test_index_finds_every_fingerprint_within_the_radius():
    rng = np.random.default_rng(3)
    items = d.Items([(i, " ".join(f"w{x}" for x in rng.integers(0, 500, 24))) for i in range(40)], 5)
    key = next(iter(items.by_size))
    members, own, _, _ = items.table(key)
    flips = [own[i % len(own)] ^ np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, n, replace=False).astype(np.uint64)) for i in range(400) for n in (1, 10, 19, 30)]
    prints = np.array(flips, np.uint64)
    got = {(int(a), int(b)) for a, b, _ in zip(*items.near(key, prints))}
    want = {(w, int(members[i])) for w in range(len(prints)) for i in range(len(own)) if np.bitwise_count(prints[w] ^ own[i]) <= d.RADIUS}
    assert got == want


def test_simhash_of_windows_is_that_of_their_shingles():
    w = W.split(pa.array(["a b c d e f g h i j k l m n o p a b c d e f"]), True)
    h, weight = d.shingles(w.hash, w.end - w.start, 5)
    many = d.simhash(h, weight, np.arange(len(h) - 5), 6)
    assert many.tolist() == [d.simhash(h[i:i + 6], weight[i:i + 6], np.array([0]), 6)[0] for i in range(len(h) - 5)]


def test_empty_tables(spark):
    items = items_of(spark, [(1, "a b c d e f")])
    assert d.leaks(empty(spark), items).count() == 0
    assert d.leaks(frame(spark, [(None, "x a b c d e f"), (1, None)]), items).count() == 1
    assert d.leaks(frame(spark, [(1, "a b")]), items_of(spark, [])).count() == 0
