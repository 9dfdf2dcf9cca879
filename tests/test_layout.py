"""Bucketed fact layout: same results, fewer shuffles."""

import contextlib
import io

from scorecast.plans import extracts
from scorecast.registry import CFG, _cat
from scorecast.sources.layout import TableCatalog, write_bucketed

from conftest import SF_SMALL


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_bucketed_facts_join_without_shuffle(spark):
    base = _cat(spark, SF_SMALL)
    write_bucketed(base, "scorecast_layout_test", 4)
    cat = TableCatalog(spark, "scorecast_layout_test", fallback=base)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = extracts.standards_summary(base, None, CFG)
        b = extracts.standards_summary(cat, None, CFG)
        pa, pb = _plan(a), _plan(b)   # before execution: the initial plans only
        # the bucketed tables meet in a join without a shuffle of the answers
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert pb.count("Exchange hashpartitioning") < pa.count("Exchange hashpartitioning")
    for line, below in zip(pb.split("\n"), pb.split("\n")[1:]):
        assert not ("Exchange" in line and "scorecast_layout_test.answer" in below.lower())
