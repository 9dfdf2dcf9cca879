import hashlib
import re
from collections import defaultdict

from scorecast.llm import exact_dedup

from .corpus import documents, empty, frame


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        norm = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        groups[hashlib.sha256(norm.encode()).hexdigest()].append((-len(t or ""), i))
    out = {}
    for sha, found in groups.items():
        keep = min(found)[1]
        for _, i in found:
            out[i] = (keep, len(found), i == keep, sha)
    return out


def test_against_brute_force(spark):
    rows = documents()
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"])
           for r in exact_dedup.exact_dedup(frame(spark, rows)).collect()}
    assert got == brute(rows)


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(1, "a b"), (1, "a b"), (None, "ab"), (2, "c"), (None, "a  b")]
    out = exact_dedup.exact_dedup(frame(spark, rows)).collect()
    assert len(out) == 5
    same = [r for r in out if r["group_size"] == 4]
    assert len(same) == 4 and sum(r["kept"] for r in same) == 1
    assert {r["keep_id"] for r in same} == {None}          # the longest text has a null id
    kept = exact_dedup.drop_copies(frame(spark, rows))
    assert sorted((r["doc_id"] is None, r["text"]) for r in kept.collect()) == [(False, "c"), (True, "a  b")]
    assert kept.columns == frame(spark, rows).columns
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0
    assert exact_dedup.drop_copies(empty(spark)).count() == 0


def test_hot_group(spark):
    rows = [(i, "same text" if i % 3 else f"text {i}") for i in range(4000)]
    out = exact_dedup.exact_dedup(frame(spark, rows))
    assert out.filter("kept").count() == 1334 + 1
    assert exact_dedup.drop_copies(frame(spark, rows)).count() == 1335


def test_no_python_in_the_plan(spark):
    plan = exact_dedup.exact_dedup(frame(spark, documents()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
