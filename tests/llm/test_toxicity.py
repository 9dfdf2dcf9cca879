import zlib

import numpy as np
import pyarrow as pa
import pytest

from scorecast.llm import toxicity

from .corpus import documents, empty, frame


def corpus(n=700):
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("aeinorst"), rng.integers(2, 8))) for _ in range(400)]
    bad = ["zork", "blarg", "quuxen", "quuxal"]
    rows, labels = [], []
    for i in range(n):
        text = [str(w) for w in rng.choice(words, rng.integers(5, 120))]
        toxic = int(rng.random() < 0.3)
        if toxic:
            for _ in range(3):
                text.insert(int(rng.integers(0, len(text))), str(rng.choice(bad)) + str(rng.choice(["", ",", "."])))
        rows.append((i, " ".join(text)))
        labels.append((i, 1, toxic))
    return rows, labels


def test_gradient_matches_finite_differences():
    model = toxicity.Model(np.random.default_rng(0))
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    inp = toxicity.inputs(pa.array(["a bb ccc dd e f", "the quick brown " * 20, "x"]))
    which = np.arange(len(inp.start))
    y = (which % 2).astype(np.float32)

    def loss():
        z = toxicity.window_logits(model, inp).astype(np.float64)
        return np.mean(np.log1p(np.exp(z)) - y * z)
    g = model.gradient(inp, which, y, np.ones(len(y), np.float32))
    for k in model.p:
        for at in map(tuple, np.argwhere(np.abs(g[k]) > 1e-4)[:3]):
            old = model.p[k][at]
            model.p[k][at] = old + 0.01
            up = loss()
            model.p[k][at] = old - 0.01
            down = loss()
            model.p[k][at] = old
            assert g[k][at] == pytest.approx((up - down) / 0.02, rel=0.05, abs=2e-5)


def test_windows_cover_every_word_and_overlap():
    inp = toxicity.inputs(pa.array(["w " * 100, None, "", "w " * 32, "w " * 33]))
    assert inp.doc.tolist() == [0, 0, 0, 0, 3, 4, 4]
    assert inp.start[:4].tolist() == [0, 24, 48, 68] and inp.size[:4].tolist() == [32] * 4


def test_held_out_accuracy_and_edges(spark):
    rows, labels = corpus()
    docs = frame(spark, rows + [(9001, None), (9002, ""), (None, "zork zork"), (9003, "zork " * 5000)])
    known = spark.createDataFrame(labels + [(9001, 0, 1), (None, 1, 1), (3, 0, 1 - labels[3][2])], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, known)
    out = {r["doc_id"]: r for r in toxicity.score(docs, model).withColumn("held_out", toxicity.held_out()).collect()}
    assert all(out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _ in rows)
    held = [(out[i]["predicted"], y) for i, _, y in labels if out[i]["held_out"]]
    assert sum(p == y for p, y in held) >= 0.97 * len(held)
    assert out[9001]["score"] == 0 and out[9002]["score"] == 0 and out[9003]["predicted"] == 1
    assert 0 <= min(r["score"] for r in out.values()) and max(r["score"] for r in out.values()) <= 1
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in out.items() if not r["predicted"]}
    assert toxicity.score(empty(spark), model).count() == 0


def test_no_labels(spark):
    docs = frame(spark, documents(n=5))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.fit(docs, none) is None
    assert toxicity.score(docs, None).agg({"score": "max"}).first()[0] == 0
