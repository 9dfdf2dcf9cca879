import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorecast.llm import hard_negatives as H
from scorecast.llm import queries

SCHEMA = "vec_id long, embedding array<float>, label int, a long, rank int, tops array<int>"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, l, 1, 2, [3]) for i, v, l in rows], SCHEMA).repartition(3)


def brute(rows, every=100):
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v], (l + 1) % 10 if i % 7 == 0 else l) for i, v, l in rows
            if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(np.float32(x)) for x in v)]
    out = []
    for i, v, l in good:
        if i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, m) for j, w, m in good)
        for ps, p, _ in [x for x in scored if x[2] == l and x[1] != i][:5]:
            near = [x for x in scored if x[2] != l and -80 * ps <= -100 * x[0] <= -100 * ps][:5]
            out += [(i, p, k + 1, j, -ps, -ns) for k, (ns, j, _) in enumerate(near)]
    return sorted(out)


def run(spark, rows, every=100):
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    out = H.mine(frame(spark, rows), F.col("vec_id") % every == 0, shifted)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


def vectors(n, dim, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    return [(i, (rng.standard_normal(dim) * spread).astype(np.float32).tolist(), int(rng.integers(0, 10))) for i in range(n)]


@pytest.mark.parametrize("dim,most", [(1, 0), (3, 7), (64, 256), (700, 400), (64, 60_000), (8, 1 << 24)])
def test_residues_give_exact_scores(dim, most):
    rng = np.random.default_rng(dim)
    a, b = (rng.integers(-most, most + 1, (n, dim)) for n in (9, 13))
    a[0], b[0], b[1] = most, most, -most
    rns = H.Residues(dim, most)
    got = rns.scores(rns.split(a.astype(float)), rns.split(b.astype(float)))
    assert (got == a @ b.T).all()


def test_scores_that_do_not_fit():
    with pytest.raises(ValueError):
        H.Residues(64, 1 << 30)


def test_against_brute_force(spark, monkeypatch):
    for name, value in (("BLOCK", 70), ("ANCHORS", 3), ("_ROWS", 16), ("_SOME", 2)):
        monkeypatch.setattr(H, name, value)
    rows = vectors(260, 8, 1)
    assert run(spark, rows, 10) == brute(rows, 10) and len(brute(rows, 10)) > 300


def test_ties_repeats_and_nulls(spark):
    rows = [(i, [1.0, float(i % 3), 0.5], i % 4) for i in range(120)]
    rows += [(200 + i, [2.0, 2.0, 2.0], i % 2) for i in range(40)]                # many equal scores
    rows += [(5, [1.0, 1.0, 1.0], 3), (5, [1.0, 1.0, 1.0], 3), (None, [1.0, 1.0, 1.0], 1), (300, None, 1), (301, [1.0, 1.0, 1.0], None),
             (400, [1.0, None, 2.0], 1), (401, [float("nan"), 1.0, 1.0], 1), (402, [float("inf"), 1.0, 1.0], 1),
             (403, [], 1), (404, [3.0], 2), (500, [], 2), (600, [-1.0, -2.0, -3.0], 2)]
    assert run(spark, rows, 20) == brute(rows, 20)
    assert run(spark, [(0, [1.0], 1)]) == [] and run(spark, []) == [] and run(spark, [(3, [1.0], 1)]) == []


def test_large_components(spark):
    rows = vectors(150, 4, 3, spread=5000.0)
    assert run(spark, rows, 10) == brute(rows, 10)


def test_query_equals_its_sql(spark):
    import duckdb
    duck = duckdb.connect()
    duck.execute("create view embeddings as select * from '/root/testdata/sf0.001/embeddings.parquet'")
    got = queries.queries()["op12_hard_negatives"](spark, "/root/testdata/sf0.001")
    want = duck.execute(queries.oracle_sql()["op12_hard_negatives"])
    names = [c[0] for c in want.description]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())
