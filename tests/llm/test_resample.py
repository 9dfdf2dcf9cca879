import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from scorecast.llm import resample

from .corpus import SCHEMA, documents, empty, frame

FOLD = {c: c + 32 for c in range(65, 91)}


def grams(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))
    return len(w), [" ".join(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute(rows, target, num=5, den=100):
    bucket = lambda g: zlib.crc32(g.encode()) % 10000
    s, t = np.zeros(10000), np.zeros(10000)
    for _, x in rows:
        for g in grams(x)[1]:
            s[bucket(g)] += 1
    for x in target:
        for g in grams(x)[1]:
            t[bucket(g)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.sum() + 10000) / ((s[b] + 1) * (t.sum() + 10000)))) for b in range(10000)]
    out = []
    for i, x in rows:
        n, g = grams(x)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[bucket(y)] for y in g)
        out.append([i, n, len(g), w, w + math.floor(-1000 * math.log(-math.log((h + .5) / 2**32))), None])
    fit = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0]))
    for k, r in enumerate(fit[:len(fit) * num // den]):
        r[5] = k + 1
    return sorted((tuple(r) for r in out), key=str)


def run(spark, rows, target, **options):
    bench = spark.createDataFrame([(i, x) for i, x in enumerate(target)], "item_id long, text string")
    return sorted((tuple(r) for r in resample.resample(frame(spark, rows), bench, **options).collect()), key=str)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aZ09 é\t.世_~", max_size=400), st.text(max_size=30),
                          st.builds(lambda c, k: c * k + " b", st.sampled_from("xé"), st.integers(60, 9000))), max_size=6))
def test_crc_of_every_ngram(texts):
    first, found = resample.ngram_crcs(pa.array(texts, pa.string()), 3)
    for d, x in enumerate(texts):
        n, want = grams(x)
        got = [int(c) for k, crc in enumerate(found) for c in crc[first[d]: max(first[d], first[d + 1] - k)]]
        assert n == first[d + 1] - first[d] and got == [zlib.crc32(g.encode()) for g in want]


def test_against_brute_force(spark):
    rows = documents(seed=5, n=400)
    rows += [(rows[30][0], rows[30][1]), (None, rows[40][1]), (9999, "Ärger über A_b-c 3.5 " * 40)]
    target = [rows[20][1], None, "", "One two three", rows[9][1]]
    assert run(spark, rows, target) == brute(rows, target)


def test_share_ties_and_edges(spark):
    text = " ".join("abcdefghijklmnopqrstuvwxyz")
    rows = [(i, text) for i in range(30)] + [(7, text), (7, text), (None, None)]
    assert run(spark, rows, [text], num=50) == brute(rows, [text], num=50)
    assert run(spark, rows, [], num=0) == brute(rows, [], num=0)
    none = resample.resample(empty(spark), spark.createDataFrame([], "item_id long, text string"))
    assert none.count() == 0 and none.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    docs = frame(spark, rows)
    got = resample.drawn(docs, spark.createDataFrame([(1, text)], "item_id long, text string"), num=10)
    assert got.columns == docs.columns and 3 <= got.count() <= 5


def test_drawn_texts_lean_to_the_target(spark):
    """Documents of the target's vocabulary are drawn first."""
    rng = np.random.default_rng(1)
    text = lambda words: " ".join(rng.choice(words, 60))
    a, b = [f"alpha{i}" for i in range(50)], [f"beta{i}" for i in range(50)]
    rows = [(i, text(a if i % 10 == 0 else b)) for i in range(400)]
    got = resample.drawn(frame(spark, rows), spark.createDataFrame([(0, text(a) + " " + text(a))], "item_id long, text string"))
    assert [r["doc_id"] % 10 for r in got.collect()] == [0] * 20
    assert SCHEMA.startswith("doc_id")
