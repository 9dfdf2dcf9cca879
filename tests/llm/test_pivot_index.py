import numpy as np
import pytest

from scorecast.llm import pivot_index as P
from scorecast.llm import queries

SCHEMA = "vec_id long, embedding array<float>, label int, n long, rep long, list long, u long"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, 4, 5) for i, v in rows], SCHEMA).repartition(3)


def brute(rows, cos=0.9):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
            if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    parent, n = {i: i for i, _ in rows if i is not None}, [0] * len(good)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, (i, x) in enumerate(good):
        for b in range(a):
            j, y = good[b]
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= cos:
                n[a] += 1
                n[b] += 1
                lo, hi = sorted((root(i), root(j)))
                parent[hi] = lo
    out = [(i, n[a], root(i), root(i) == i) for a, (i, _) in enumerate(good)]
    seen = [(i, np.array(v, np.float32).astype(float).tolist()) for i, v in good]
    rest = list(rows)
    for i, v in seen:
        rest.remove(next(r for r in rest if r[0] == i and r[1] is not None and np.array_equal(np.array(r[1], np.float32).astype(float), v)))
    return sorted(out + [(i, 0, None if i is None else root(i), i is None or root(i) == i) for i, _ in rest], key=str)


def run(spark, rows, **options):
    out = P.near_duplicates(frame(spark, rows), **options)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def clusters(seed, groups, dim=64, alone=200):
    """Groups (size, noise) around random centres, and single vectors."""
    rng, out = np.random.default_rng(seed), []
    for size, noise in [*groups, *[(1, 0)] * alone]:
        centre = rng.standard_normal(dim)
        centre /= np.linalg.norm(centre)
        out += [(centre + noise * rng.standard_normal(dim) / np.sqrt(dim)).astype(np.float32).tolist() for _ in range(size)]
    order = rng.permutation(len(out))
    return [(int(i), out[k]) for i, k in enumerate(order)]


def test_hot_groups_and_near_copies(spark):
    rows = clusters(1, [(200, 0.1), (80, 0.2), (30, 0.3), *[(3, 0.15)] * 30])
    rows += [(1000 + i, rows[7][1]) for i in range(50)]
    assert run(spark, rows) == brute(rows)


def test_blocks_and_no_leaders(spark, monkeypatch):
    """Lists cut into pairs of blocks give what whole lists give."""
    rows = clusters(2, [(150, 0.3), (60, 0.12), (40, 0.25)], alone=150)
    want = brute(rows)
    monkeypatch.setattr(P, "LIST", 256 * 12)
    assert run(spark, rows) == want
    plain = P.Index.__init__

    def without_leaders(self, *a):
        plain(self, *a)
        self.leaders = {d: x[:0] for d, x in self.leaders.items()}
    monkeypatch.setattr(P.Index, "__init__", without_leaders)
    assert run(spark, rows) == want


def test_recall_at_the_threshold():
    """Pairs at a cosine of 0.9 exactly share enough pivots; recall of the index."""
    rng = np.random.default_rng(4)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    a, b = unit(rng.standard_normal((2000, 64))), rng.standard_normal((2000, 64))
    b = 0.9 * a + np.sqrt(1 - 0.81) * unit(b - (b * a).sum(1, keepdims=True) * a)
    index = P.Index({64: unit(rng.standard_normal((3000, 64)))}, 512, 0.9, 10, 3)
    x, y = index.place(a)[0], index.place(b)[0]
    assert ((x[:, :, None] == y[:, None, :]).sum((1, 2)) >= 3).mean() >= 0.97


@pytest.mark.parametrize("noise", [0.05, 0.2, 0.6])
def test_list_finds_each_shared_pair_once(noise):
    """Sparse and dense ways, against the definition."""
    rng = np.random.default_rng(5)
    u = np.repeat(rng.standard_normal((30, 16)), 4, axis=0) + noise * rng.standard_normal((120, 16))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    perm = np.sort(np.argsort(-(u @ rng.standard_normal((16, 40))), axis=1)[:, :6], axis=1)
    m, total = rng.integers(1, 4, 120), np.zeros(120, int)
    want = np.zeros(120, int)
    for p in range(40):
        rows = np.flatnonzero((perm == p).any(1))
        if len(rows) > 1:
            total[rows] += P.compare_list(u[rows], m[rows], perm[rows], np.zeros(len(rows), int), p, 0.9, 3).n
    for i in range(120):
        for j in range(120):
            if i != j and len(set(perm[i]) & set(perm[j])) >= 3 and u[i] @ u[j] >= 0.9:
                want[i] += m[j]
    assert (total == want).all() and want.sum() > 0


def test_edge_cases(spark):
    v, w = [1.0, 2.0, 3.0], [3.0, -2.0, 1.0]
    rows = [(1, v), (2, [2.0, 4.0, 6.0]), (3, w), (3, v), (4, None), (5, []), (6, [0.0, 0.0, 0.0]), (7, [1.0, None, 3.0]),
            (8, [float("nan"), 2.0, 3.0]), (9, [float("inf"), 2.0, 3.0]), (10, [1.0, 2.0]), (11, [1e30, 2e30, 3e30]), (12, [-0.0, 1.0, 0.0]), (13, [0.0, 1.0, 0.0])]
    got = run(spark, rows + [(None, v)])
    want = brute(rows)
    want = [(i, n, 1, i == 1) if i in (1, 2, 3, 11) else (i, n, c, k) for i, n, c, k in want]      # both rows of 3 are one node
    assert got == sorted(want + [(None, 0, None, True)], key=str)
    assert run(spark, []) == []
    with pytest.raises(ValueError):
        P.near_duplicates(frame(spark, rows), cos=0.5)


def test_query_equals_its_sql(spark):
    import duckdb
    duck = duckdb.connect()
    duck.execute("create view embeddings as select * from '/root/testdata/sf0.001/embeddings.parquet'")
    got = queries.queries()["op13_near_vectors"](spark, "/root/testdata/sf0.001")
    want = duck.execute(queries.oracle_sql()["op13_near_vectors"])
    names = [c[0] for c in want.description]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())
