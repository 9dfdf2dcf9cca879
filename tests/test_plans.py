"""Plan-shape checks: the physical operators the design relies on."""

import contextlib
import io
import re

import pytest

from conftest import SF_SMALL
from scorecast import registry


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def q():
    return registry.queries()


def test_period_assignment_is_broadcast_range_join_with_pushdown(spark, q):
    p = plan(q["usage_results_by_client"](spark, SF_SMALL))
    assert "BroadcastNestedLoopJoin" in p
    # the three report weeks reach the Parquet scan as an OR of ranges
    assert "PushedFilters: [Or(Or(And(GreaterThan(o_orderdate" in p
    # share of total: a window over the aggregated frame, the fact read once
    assert p.count("orders.parquet") == 1


def test_sessions_push_login_bounds(spark, q):
    p = plan(q["sessions_by_hour"](spark, SF_SMALL))
    assert "GreaterThan(ts," in p and "BroadcastNestedLoopJoin" in p


def test_column_pruning_reaches_scan(spark, q):
    p = plan(q["usage_results_by_date"](spark, SF_SMALL))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz>" in p


def test_cluster_chain_runs_once(spark, q):
    p = plan(q["cluster_ratio"](spark, SF_SMALL))
    assert p.count("lineitem.parquet") == 1 and "rand(" not in p


def test_results_are_cut_by_test_before_they_meet_scores(spark):
    """The first large join has the test filter below it."""
    from scorecast.plans import extracts
    from scorecast.registry import CFG, _cat
    cat = _cat(spark, SF_SMALL)
    for df in (extracts.detail_rows(cat, None, CFG), extracts.state_scores(cat, None, CFG), extracts.cluster_ratio(cat, None, CFG)):
        # joins nest to the left: what is printed between a join and its
        # right side lies below it; the scores come after the test filter
        text = df._jdf.queryExecution().optimizedPlan().toString()
        tests = text.index("p_type")
        facts = [i for i in range(len(text)) if text.startswith("Relation [o_orderkey", i)]
        assert len(facts) == 2 and facts[0] < tests < facts[1]


def test_roster_uses_semi_join_for_existence(spark, q):
    p = plan(q["status_roster"](spark, SF_SMALL))
    assert "LeftSemi" in p


def test_no_python_udfs_anywhere(spark, q):
    for k, fn in q.items():
        p = plan(fn(spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, k


def test_single_district_filter_reaches_scan(spark):
    from scorecast.plans.extracts import student_gender
    from scorecast.registry import _cat
    p = plan(student_gender(_cat(spark, SF_SMALL), 5))
    assert "EqualTo(c_nationkey,5)" in p


def test_windows_run_over_aggregated_frames_only(spark, q):
    for k, fn in q.items():
        lines = plan(fn(spark, SF_SMALL)).split("\n")
        tree = [x for x in lines[: next((i for i, x in enumerate(lines) if x == ""), len(lines))]]
        at = [i for i, x in enumerate(tree) if "Window" in x]
        for i in at:
            below = [x for x in tree[i + 1:] if not re.search("Sort|Exchange|Project|Window", x)]
            assert re.search("HashAggregate|Union", below[0]), k


def test_no_single_partition_exchange(spark, q):
    """No plan funnels its data through one task."""
    for k, fn in q.items():
        assert "SinglePartition" not in plan(fn(spark, SF_SMALL)), k
