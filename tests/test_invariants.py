"""Cross-query invariants on the sf0.01 binding."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from scorecast.functions.dates import report_periods, ts_literal
from scorecast.plans import extracts, usage
from scorecast.registry import CFG, _cat
from scorecast.sources.binding import EVENTS_AS_OF, ORDERS_AS_OF

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def cat(spark):
    return _cat(spark, SF)


def test_usage_totals_agree(cat):
    by_date, by_client = defaultdict(int), defaultdict(int)
    for r in usage.results_by_date(cat, ORDERS_AS_OF, CFG).collect():
        by_date[r.period] += r.Total
    for r in usage.results_by_client(cat, ORDERS_AS_OF, CFG).collect():
        by_client[r.period] += r.TotalResults
    totals = {r.period: r.Total for r in usage.results_by_date_total(cat, ORDERS_AS_OF, CFG).collect()
              if r.section == "all"}
    assert set(totals) == set(CFG.period_labels)
    for p in CFG.period_labels:
        assert by_date[p] == by_client[p] == totals[p]
    assert sum(totals.values()) > 0


def test_shares_sum_to_one(cat):
    s = defaultdict(float)
    for r in usage.results_by_client(cat, ORDERS_AS_OF, CFG).collect():
        s[r.period] += r.share
    assert s and all(abs(v - 1.0) < 1e-9 for v in s.values())


def test_one_pass_periods_equal_separate_filters(cat):
    """The range join gives each period exactly what a plain filter on
    that period's interval gives."""
    base = (cat["TestResult"].join(cat["Student"].select("StudentID", "DistrictID"), "StudentID")
            .join(cat["District"].select("DistrictID", F.col("Name").alias("District")), "DistrictID")
            .where(~F.col("District").ilike(CFG.demo_district_pattern))
            .where(F.col("BubbleSheetID").isNotNull() | F.col("QTIOnlineTestSessionID").isNotNull()))
    totals = {r.period: r.Total for r in usage.results_by_date_total(cat, ORDERS_AS_OF, CFG).collect()
              if r.section == "all"}
    for label, _, s, e in report_periods(ORDERS_AS_OF, CFG):
        n = base.where((F.col("UpdatedDate") > ts_literal(s)) & (F.col("UpdatedDate") < ts_literal(e))).count()
        assert n == totals[label], label


def test_session_status_columns_within_total(cat):
    rows = usage.sessions_by_date(cat, EVENTS_AS_OF, "StartDate", CFG).collect()
    assert rows
    for r in rows:
        assert r.Created + r.Started + r.Paused + r.PendingReview + r.Completed <= r.TotalOnlineTests
    hours = usage.sessions_by_hour(cat, EVENTS_AS_OF, CFG).collect()
    assert sum(r.NumberOfSessions for r in hours if r.period == "This Week") == \
        sum(r.TotalOnlineTests for r in usage.sessions_by_date(cat, EVENTS_AS_OF, "LastLoginDate", CFG).collect()
            if r.period == "This Week")


def test_cluster_values_constant_within_group(cat):
    df = extracts.cluster_ratio(cat, None, CFG)
    bad = (df.groupBy("DistrictID", "TestName", "School", "ClusterName")
           .agg(F.countDistinct("NUM").alias("n"), F.countDistinct("DIV").alias("d"))
           .where("n > 1 OR d > 1").count())
    assert bad == 0


def test_demographic_union_equals_single_blocks(cat):
    long = {tuple(r) for r in extracts.standards_by_demographic(cat, None, CFG).collect()}
    parts = set()
    for d in ("Gender", "Race", "Program"):
        parts |= {tuple(r) for r in extracts.standards_by_demographic(cat, None, CFG, (d,)).collect()}
    assert long == parts and long


@pytest.mark.parametrize("fn", [extracts.local_benchmark_detail, extracts.state_scores, extracts.cluster_ratio,
                                extracts.standards_summary, extracts.standards_by_demographic,
                                extracts.state_test_extract])
def test_single_district_equals_filtered_all(cat, fn):
    for d in (1, 8):
        one = sorted(map(repr, fn(cat, d, CFG).collect()))
        alld = sorted(map(repr, fn(cat, None, CFG).where(F.col("DistrictID") == d).collect()))
        assert one == alld


def test_most_answers_reach_the_demographic_sums(cat):
    """The binding ties answers to the questions of their own test, so the
    (question, test) join keeps them."""
    answers = cat["Answer"].join(cat["TestResult"].select("TestResultID", "VirtualTestID"), "TestResultID")
    kept = answers.join(cat["VirtualQuestion"], ["VirtualQuestionID", "VirtualTestID"])
    assert kept.count() >= 0.99 * answers.count()
