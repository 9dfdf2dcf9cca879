import zlib
from collections import Counter

from scorecast.llm import sharding

from .corpus import documents, empty, frame, rng_source


def test_shards_match_the_mixture(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", 50)       # many buckets and ranges
    rows = [(i, t) for i, (_, t) in enumerate(documents(n=900))]
    out = sharding.shard(frame(spark, rows), n_shards=8).collect()
    texts = dict(rows)
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in out} == {
        i: (len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts.items()}
    count = Counter(r["shard"] for r in out)
    assert set(count) == set(range(8)) and max(count.values()) - min(count.values()) <= 1
    for s in range(8):
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(count[s]))
    total = Counter(rng_source(i) for i in texts)
    part = Counter((rng_source(r["doc_id"]), r["shard"]) for r in out)
    assert all(abs(part[src, s] - n / 8) <= 2 for src, n in total.items() for s in range(8))
    again = sharding.shard(frame(spark, rows[::-1]), n_shards=8).collect()
    assert sorted(again) == sorted(out)                         # the seed alone decides


def test_edge_cases(spark):
    rows = [(None, None), (1, ""), (1, ""), (1, "x")]
    out = sharding.shard(frame(spark, rows), n_shards=3).collect()
    assert sorted(Counter(r["shard"] for r in out).values()) == [1, 1, 2]
    assert sharding.shard(empty(spark)).count() == 0
    plan = sharding.shard(frame(spark, rows))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
