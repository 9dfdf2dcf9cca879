"""Report-level edge cases on hand-written rows (FIXTURES section 3)."""

import datetime as dt

from scorecast.config import DEFAULT
from scorecast.plans import extracts, status, usage

from tiny import T, catalog, result

AS_OF = dt.date(2018, 3, 7)   # this week = (Mar 2, Mar 9), last week = (Feb 23, Mar 2)

BASE = dict(
    State=[(1, "NJ")],
    District=[(2479, "A Beka", 1, 112), (7, "Frog Street Press", 1, None), (8, "Plain", 1, 113)],
    VirtualTest=[(10, 1, "LinkIt Math Form A", 0, 3, 1), (11, 1, "LinkIt ELA Form B", 0, 1, 2)],
    Student=[(100, "S100", 2479, "Ann", None, "Lee", 1, 1, 1), (101, "S101", 7, "Bo", "Q", "Park", 1, 1, 1),
             (102, "S102", 8, "Cy", None, "Ray", 1, 1, 1)],
)


def test_overlapping_client_groups_give_negative_others(spark):
    # District 2479 is A Beka and in group 112 (BEC): one session counts twice.
    sessions = [(1, 100, T(2018, 3, 5, 10), T(2018, 3, 5, 10), 2)]
    cat = catalog(spark, QTIOnlineTestSession=sessions, **BASE)
    r = usage.sessions_by_hour(cat, AS_OF, DEFAULT).where("period = 'This Week'").first()
    assert (r.NumberOfSessions, r.ABeka, r.BEC, r.Frogstreet, r.Others) == (1, 1, 1, 0, -1)
    assert r.Hour == "2018-03-05 06"


def test_total_row_over_empty_period_is_zero(spark):
    res = [result(1, 102, 10, T(2018, 3, 5, 9))]
    cat = catalog(spark, TestResult=res, **BASE)
    rows = usage.benchmarks_by_client(cat, AS_OF, DEFAULT).collect()
    totals = {r.period: r.TotalResults for r in rows if r.row_kind == "total"}
    assert totals == {"This Week": 1, "Last Week": 0, "Last Year": 0}
    # the total row comes first within its period
    assert rows[0].row_kind == "total" and rows[0].State == "Total" and rows[0].District == ""


def test_change_with_zero_base_is_null(spark):
    res = [result(i, 102, 10, T(2018, 3, 5, 9)) for i in range(5)]
    cat = catalog(spark, TestResult=res, **BASE)
    r = {(x.section, x.measure): x for x in usage.period_change_report(cat, AS_OF, DEFAULT).collect()}
    t = r[("all", "Total")]
    assert (t.this_week, t.last_week, t.weekly_change) == (5, 0, None)


def test_exclusions_drop_null_group_and_named_clients(spark):
    res = [result(1, 100, 10, T(2018, 3, 5, 9)), result(2, 101, 10, T(2018, 3, 5, 9)),
           result(3, 102, 10, T(2018, 3, 5, 9))]
    cat = catalog(spark, TestResult=res, **BASE)
    rows = usage.results_by_date(cat, AS_OF, DEFAULT, exclude_clients=True).collect()
    assert [(r.period, r.Total) for r in rows] == [("This Week", 1)]   # only district 8 remains


def test_dense_days_fill_zero(spark):
    res = [result(1, 102, 10, T(2018, 3, 5, 9)), result(2, 102, 10, T(2018, 3, 6, 9))]
    cat = catalog(spark, TestResult=res, **BASE)
    rows = [r for r in usage.dense_daily_counts(cat, AS_OF, DEFAULT).collect() if r.period == "This Week"]
    assert len(rows) == 8 and sum(r.Total == 0 for r in rows) == 6
    assert rows[0].day == "2018-03-02" and rows[-1].day == "2018-03-09"


def test_share_and_invariants(spark):
    res = [result(i, 100 + i % 3, 10, T(2018, 3, 5, 9)) for i in range(9)]
    cat = catalog(spark, TestResult=res, **BASE)
    rows = usage.results_by_client(cat, AS_OF, DEFAULT).collect()
    assert abs(sum(r.share for r in rows) - 1.0) < 1e-12
    by_date = usage.results_by_date(cat, AS_OF, DEFAULT).collect()
    assert sum(r.TotalResults for r in rows) == sum(r.Total for r in by_date) == 9


def _cluster_catalog(spark):
    tests = [(20, 1, "2016-2017 PARCC ELA Grade 5", 217, 1, 1)]
    res = [result(i, 102, 20, T(2017, 4, 1), school=1 if i < 6 else 2) for i in range(1, 8)]
    scores = [(i, i, 0.0, 0.0, 700.0, 3) for i in range(1, 8)]
    subs = [(1, "Reading Scale Score", 10.0, 1), (2, "Reading Scale Score", 20.0, 1),
            (3, "Reading Scale Score", None, 1),
            (4, "Reading", 1.0, 1), (5, "Reading", 2.0, 1), (1, "Reading", 1.0, 1),
            (7, "Reading", 1.0, 1)]
    return catalog(
        spark, TestResult=res, TestResultScore=scores, TestResultSubScore=subs, VirtualTest=tests,
        DistrictTerm=[(1, 8, "2016-17", 1)], District=BASE["District"], Student=BASE["Student"],
        School=[(1, "North", 8), (2, None, 8)], Class=[(1, "Period 1", 1, 1)], User=[(1, 8, "T1", "A", "B")])


def test_cluster_ratio(spark):
    rows = extracts.cluster_ratio(_cluster_catalog(spark), None, DEFAULT).collect()
    got = {(r.School, r.ClusterName, r.NUM, r.DIV) for r in rows}
    assert ("North", "Reading Scale Score", 30.0, 2) in got
    assert ("North", "Reading", 2.0, 3) in got
    assert (None, "Reading", None, None) in got         # NULL school: no group values
    assert len(rows) == 7                                 # repeated on every member row


def _standards_catalog(spark, **extra):
    tables = dict(
        TestResult=[result(1, 102, 10, T(2017, 9, 1)), result(2, 102, 99, T(2017, 9, 1), school=5)],
        VirtualTest=BASE["VirtualTest"], Bank=[(1, 1)], Subject=[(1, "Math", 1)], Grade=[(1, "5")],
        School=[(1, "North", 8)], Class=[(1, "Period 1", 1, 1)], DistrictTerm=[(1, 8, "Fall", 1)],
        User=[(1, 8, "T1", "Tina", "Ames")],
        Answer=[(1, 500, 3.0, 4.0), (2, 500, 3.0, 4.0)], VirtualQuestion=[(500, 10, 900)], QTIItem=[(900,)],
        VirtualQuestionStateStandard=[(500, 1), (500, 2)], MasterStandard=[(1, "RL.1"), (2, "RL.2")],
        VirtualQuestionLessonOne=[(500, 1)], LessonOne=[(1, "Main\r\nidea")],
    )
    tables.update(extra)
    return catalog(spark, **tables)


def test_standards_fan_out_and_left_enrichment(spark):
    rows = extracts.standards_summary(_standards_catalog(spark), None, DEFAULT).collect()
    # one 3-point answer under two standards counts under both; the result
    # whose test does not exist is dropped by the test-name filter
    assert sorted((r.StandardNbr, r.TotalPointsEarned, r.TotalPointsPossible) for r in rows) == [
        ("RL.1", 3, 4), ("RL.2", 3, 4)]
    assert {r.Form for r in rows} == {"A"} and {r.TermName for r in rows} == {"2017-18"}


def test_missing_school_is_kept_with_null(spark):
    cat = _standards_catalog(spark, School=[])
    rows = extracts.standards_summary(cat, None, DEFAULT).collect()
    assert len(rows) == 2 and all(r.SchoolName is None for r in rows)


def test_skills_strip_line_breaks(spark):
    rows = extracts.skills_summary(_standards_catalog(spark), None, DEFAULT).collect()
    assert [r.Skills for r in rows] == ["Mainidea"]


def test_points_truncate_to_int(spark):
    cat = _standards_catalog(spark, Answer=[(1, 500, 2.9, 4.5)])
    rows = extracts.standards_summary(cat, None, DEFAULT).collect()
    assert {(r.TotalPointsEarned, r.TotalPointsPossible) for r in rows} == {(2, 4)}


def _status_catalog(spark):
    return catalog(
        spark,
        DistrictTerm=[(1, 8, "2017-18", 1)], Class=[(1, "P1", 1, 1), (2, "P2", 1, 1)],
        ClassUser=[(1, 1, 1), (2, 1, 1)], ClassUserLOE=[(1,)], User=[(1, 8, "T1", "A", "B")],
        School=[(1, "North", 8)], ClassStudent=[(1, 102), (2, 102), (1, 103), (1, 104)],
        Student=[(102, "S102", 8, "Cy", None, "Ray", 1, 1, 1), (103, "S103", 8, "Di", None, "Fox", 9, 1, 1),
                 (104, None, 8, "Ed", None, "Gil", 1, 1, 1)],
        Grade=[(1, "5")], Subject=[(1, "Language Arts", 1), (2, "Math", 1)], Bank=[(1, 1), (2, 2)],
        VirtualTest=[(10, 1, "LinkIt ELA Form A", 0, 1, 1), (11, 2, "LinkIt Math Form B", 0, 1, 1)],
        TestResult=[result(1, 102, 10, T(2017, 9, 1)), result(2, 103, 11, T(2017, 9, 1))],
        TestResultScore=[(1, 1, 5.0, 10.0, 0.0, 1), (2, 2, 5.0, 10.0, 0.0, 1)],
    )


def test_roster_distinct_and_left_grade(spark):
    rows = status.status_roster(_status_catalog(spark), 8, DEFAULT).collect()
    codes = [r.Code for r in rows]
    assert sorted(codes, key=str) == sorted(["S102", "S103", None], key=str)   # S102 once despite two classes
    assert {r.Code: r.Grade for r in rows}["S103"] is None                     # grade missing -> NULL


def test_completion_matrix(spark):
    rows = {r.Code: (r.ELA, r.Math) for r in status.status_matrix(_status_catalog(spark), 8, "A", DEFAULT).collect()}
    assert rows["S102"] == ("Yes", "No")
    assert rows["S103"] == ("No", "No")     # only a form B score
    assert rows[None] == ("No", "No")       # no code, no match


def test_district_mode_equals_filtered_all_districts(spark):
    cat = _status_catalog(spark)
    one = {tuple(r) for r in status.status_roster(cat, 8, DEFAULT).collect()}
    alld = {tuple(r) for r in status.status_roster(cat, None, DEFAULT).where("DistrictID = 8").collect()}
    assert one == alld


def test_null_district_name_dropped_by_not_like(spark):
    tables = dict(BASE)
    tables["District"] = BASE["District"] + [(9, None, 1, 113)]
    tables["Student"] = BASE["Student"] + [(103, "S103", 9, "Di", None, "Fox", 1, 1, 1)]
    res = [result(1, 103, 10, T(2018, 3, 5, 9)), result(2, 102, 10, T(2018, 3, 5, 9))]
    cat = catalog(spark, TestResult=res, **tables)
    rows = usage.results_by_client(cat, AS_OF, DEFAULT).collect()
    assert [(r.District, r.TotalResults) for r in rows] == [("Plain", 1)]
