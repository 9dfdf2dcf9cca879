"""DuckDB oracle SQL for every registered query.

Each statement runs against the raw driver tables: it starts with the
binding CTEs of the logical tables it reads (``sources.binding``), then
states the report in plain SQL.  Report parameters (period dates, ids,
patterns) are rendered as literals from the same config the Spark side gets;
the period dates are computed here in plain Python, independently of the
Spark column expressions.
"""

from __future__ import annotations

import datetime as dt

from .config import ReportConfig
from .sources import binding

TD = dt.timedelta


def py_periods(as_of: dt.date, labels, strict: bool = False):
    def prev_friday(d):
        wd = d.weekday()
        return d - TD(days=7 if wd == 4 else wd + 3)

    def next_friday(d):
        return d + TD(days=(4 - d.weekday()) % 7)

    def a_year_before(d):
        try:
            return d.replace(year=d.year - 1)
        except ValueError:  # Feb 29
            return d.replace(year=d.year - 1, day=28)

    cw_end = next_friday(as_of)
    cw_start = cw_end - TD(days=7) if strict else prev_friday(as_of)
    lw_start = cw_start - TD(days=7) if strict else prev_friday(cw_start)
    ly = (next_friday(a_year_before(cw_start)), next_friday(a_year_before(cw_end)))
    return list(zip(labels, (1, 2, 3), ((cw_start, cw_end), (lw_start, cw_start), ly)))


def periods_cte(as_of, cfg: ReportConfig) -> str:
    rows = ", ".join(
        f"('{lab}', {o}, DATE '{s}', DATE '{e}')" for lab, o, (s, e) in py_periods(as_of, cfg.period_labels, cfg.strict_week))
    return f"periods(period, period_ord, week_start, week_end) AS (VALUES {rows})"


def with_tables(names, extra_ctes=()) -> str:
    body = binding.sql_ctes(names)
    for cte in extra_ctes:
        body = body.rstrip("\n") + ",\n" + cte + "\n"
    return body


def sql_list(values) -> str:
    return "(" + ", ".join(str(v) for v in values) + ")"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# ---------------------------------------------------------------- usage ----
#
# One CTE ``wk`` holds every result of the three weeks (a row per matching
# period) with the attributes the sections filter and group on; each
# section is then a query over ``wk``.

_USAGE_TABLES = ["TestResult", "VirtualTest", "Student", "District", "State"]


def _wk(cfg) -> str:
    return f"""wk AS (
  SELECT p.period, p.period_ord, r.TestResultID AS rid, CAST(r.UpdatedDate AS DATE) AS day,
         (r.QTIOnlineTestSessionID IS NOT NULL) AS online, (r.BubbleSheetID IS NOT NULL) AS bubble,
         t.Name AS test_name, t.VirtualTestSourceID AS test_source, t.VirtualTestType AS test_type,
         dist.DistrictID AS did, dist.Name AS dname, dist.DistrictGroupID AS dgroup, sta.Name AS sname
  FROM periods p
  JOIN TestResult r ON r.UpdatedDate > CAST(p.week_start AS TIMESTAMP) AND r.UpdatedDate < CAST(p.week_end AS TIMESTAMP)
  JOIN Student stu ON stu.StudentID = r.StudentID
  JOIN District dist ON dist.DistrictID = stu.DistrictID
  JOIN State sta ON sta.StateID = dist.StateID
  JOIN VirtualTest t ON t.VirtualTestID = r.VirtualTestID
  WHERE dist.Name NOT ILIKE {q(cfg.demo_district_pattern)})"""


def _kept(cfg) -> str:
    """Named-client exclusions (NULL group -> not kept, like NOT IN)."""
    return (f"(did NOT IN {sql_list(cfg.usage_excluded_district_ids)} AND dgroup NOT IN "
            f"{sql_list(cfg.usage_excluded_group_ids)} AND dname NOT ILIKE {q(cfg.frog_street_pattern)})")


def _daily(excl: bool, cfg) -> str:
    cond = "(online OR bubble)" + (f" AND {_kept(cfg)}" if excl else "")
    return f"""SELECT period, period_ord, day, CAST(count(rid) AS BIGINT) AS Total,
  CAST(count(*) FILTER (WHERE online) AS BIGINT) AS OnlineTests,
  CAST(count(*) FILTER (WHERE bubble) AS BIGINT) AS BubbleSheets
FROM wk WHERE {cond} GROUP BY period, period_ord, day"""


def usage_sql(cfg: ReportConfig, as_of) -> dict[str, str]:
    head = with_tables(_USAGE_TABLES, [periods_cte(as_of, cfg), _wk(cfg)])
    lab = cfg.period_labels
    measures = ["Total", "OnlineTests", "BubbleSheets"]
    out = {}
    for key, excl in (("usage_results_by_date", False), ("usage_results_by_date_excl", True)):
        out[key] = head + f"""SELECT period, strftime(day, '%m/%d/%Y') AS Date, Total, OnlineTests, BubbleSheets
FROM ({_daily(excl, cfg)}) daily"""

    def section_totals(section, excl):
        return f"""SELECT '{section}' AS section, per.period, per.period_ord,
  CAST(coalesce(sum(daily.Total), 0) AS BIGINT) AS Total,
  CAST(coalesce(sum(daily.OnlineTests), 0) AS BIGINT) AS OnlineTests,
  CAST(coalesce(sum(daily.BubbleSheets), 0) AS BIGINT) AS BubbleSheets
FROM periods per LEFT JOIN ({_daily(excl, cfg)}) daily ON daily.period = per.period
GROUP BY per.period, per.period_ord"""
    totals = section_totals("all", False) + "\nUNION ALL\n" + section_totals("excluding_clients", True)
    out["usage_results_by_date_total"] = head + f"SELECT section, period, Total, OnlineTests, BubbleSheets FROM ({totals}) tot"
    pivots = ",\n  ".join(
        f"max(value) FILTER (WHERE period = {q(label)}) AS {col}"
        for label, col in zip(lab, ("this_week", "last_week", "last_year")))
    unpivot = " UNION ALL ".join(
        f"SELECT section, period, '{m}' AS measure, {m} AS value FROM tot" for m in measures)
    out["usage_period_change"] = head + f""", tot AS ({totals}), longform AS ({unpivot}),
piv AS (SELECT section, measure,
  {pivots}
  FROM longform GROUP BY section, measure)
SELECT section, measure, this_week, last_week, last_year,
  (this_week - last_week) / nullif(CAST(last_week AS DOUBLE), 0) AS weekly_change,
  (this_week - last_year) / nullif(CAST(last_year AS DOUBLE), 0) AS yearly_change
FROM piv"""
    codes = [x.lower().replace(" ", "_") for x in lab]
    cols = []
    for label, code in zip(lab, codes):
        cols.append(f"max(Date) FILTER (WHERE period = {q(label)}) AS {code}_Date")
        cols += [f"max({m}) FILTER (WHERE period = {q(label)}) AS {code}_{m}" for m in measures]
    out["usage_results_by_date_wide"] = head + f""", calendar AS (
  SELECT period, week_start, CAST(unnest(generate_series(week_start, week_end, INTERVAL 1 DAY)) AS DATE) AS day
  FROM periods),
cells AS (
  SELECT calendar.period, CAST(calendar.day - calendar.week_start AS INTEGER) AS "row",
    strftime(calendar.day, '%m/%d/%Y') AS Date,
    CAST(coalesce(daily.Total, 0) AS BIGINT) AS Total,
    CAST(coalesce(daily.OnlineTests, 0) AS BIGINT) AS OnlineTests,
    CAST(coalesce(daily.BubbleSheets, 0) AS BIGINT) AS BubbleSheets
  FROM calendar LEFT JOIN ({_daily(False, cfg)}) daily ON daily.period = calendar.period AND daily.day = calendar.day)
SELECT "row", {', '.join(cols)} FROM cells GROUP BY "row" """
    out["dense_daily_counts"] = head + f""", calendar AS (
  SELECT period, CAST(unnest(generate_series(week_start, week_end, INTERVAL 1 DAY)) AS DATE) AS day FROM periods)
SELECT calendar.period, strftime(calendar.day, '%Y-%m-%d') AS day,
  CAST(coalesce(daily.Total, 0) AS BIGINT) AS Total,
  CAST(coalesce(daily.OnlineTests, 0) AS BIGINT) AS OnlineTests,
  CAST(coalesce(daily.BubbleSheets, 0) AS BIGINT) AS BubbleSheets
FROM calendar LEFT JOIN ({_daily(False, cfg)}) daily ON daily.period = calendar.period AND daily.day = calendar.day"""

    def clients(extra):
        return f"""SELECT period, sname AS State, dname AS District, CAST(count(*) AS BIGINT) AS TotalResults,
  CAST(count(*) FILTER (WHERE online) AS BIGINT) AS OnlineTests,
  CAST(count(*) FILTER (WHERE bubble) AS BIGINT) AS BubbleSheets
FROM wk WHERE (online OR bubble){extra} GROUP BY period, sname, dname"""
    out["usage_results_by_client"] = head + f"""SELECT period, State, District, TotalResults, OnlineTests, BubbleSheets,
  TotalResults / CAST(sum(TotalResults) OVER (PARTITION BY period) AS DOUBLE) AS share
FROM ({clients('')}) c"""
    bench = clients(f" AND test_name ILIKE {q(cfg.usage_benchmark_include[0])}")
    out["benchmarks_by_client_total"] = head + f""", bc AS ({bench})
SELECT period, 'detail' AS row_kind, State, District, TotalResults, OnlineTests, BubbleSheets FROM bc
UNION ALL
SELECT per.period, 'total', 'Total', '', CAST(coalesce(sum(bc.TotalResults), 0) AS BIGINT),
  CAST(coalesce(sum(bc.OnlineTests), 0) AS BIGINT), CAST(coalesce(sum(bc.BubbleSheets), 0) AS BIGINT)
FROM periods per LEFT JOIN bc ON bc.period = per.period GROUP BY per.period"""
    entry = (f"test_source = {cfg.data_entry_source_id} AND test_type IN {sql_list(cfg.data_entry_test_types)}")
    out["entry_by_date"] = head + f""", ent AS (
  SELECT period, day, CAST(count(rid) AS BIGINT) AS Total FROM wk WHERE {entry} GROUP BY period, day)
SELECT period, 'detail' AS row_kind, strftime(day, '%m/%d/%Y') AS Date, Total FROM ent
UNION ALL
SELECT per.period, 'total', 'Total', CAST(coalesce(sum(ent.Total), 0) AS BIGINT)
FROM periods per LEFT JOIN ent ON ent.period = per.period GROUP BY per.period"""
    out["entry_by_client"] = head + f"""SELECT period, sname AS State, dname AS District, CAST(count(rid) AS BIGINT) AS Total
FROM wk WHERE {entry} GROUP BY period, sname, dname"""
    return out


def window_totals_sql(cfg: ReportConfig) -> str:
    """Totals of the weeks of every report date, counted row by row."""
    windows = period_windows_sql(cfg)
    return f"""WITH windows AS ({windows}), facts AS ({with_tables(_USAGE_TABLES)}
SELECT r.UpdatedDate AS ts, (r.QTIOnlineTestSessionID IS NOT NULL) AS online, (r.BubbleSheetID IS NOT NULL) AS bubble
FROM TestResult r JOIN Student stu ON stu.StudentID = r.StudentID JOIN District dist ON dist.DistrictID = stu.DistrictID
JOIN State sta ON sta.StateID = dist.StateID JOIN VirtualTest t ON t.VirtualTestID = r.VirtualTestID
WHERE dist.Name NOT ILIKE {q(cfg.demo_district_pattern)} AND (r.QTIOnlineTestSessionID IS NOT NULL OR r.BubbleSheetID IS NOT NULL))
SELECT w.as_of, w.period, CAST(count(f.ts) AS BIGINT) AS TotalResults, CAST(count(*) FILTER (WHERE f.online) AS BIGINT) AS OnlineTests,
  CAST(count(*) FILTER (WHERE f.bubble) AS BIGINT) AS BubbleSheets
FROM windows w LEFT JOIN facts f ON f.ts > CAST(w.week_start AS TIMESTAMP) AND f.ts < CAST(w.week_end AS TIMESTAMP)
GROUP BY w.as_of, w.period"""


def side_by_side_sql(section: str, order: str, columns: list[str], cfg: ReportConfig) -> str:
    """A section's periods next to each other, row by row in ``order``."""
    cells = ", ".join(f'max({c}) FILTER (WHERE period = {q(lab)}) AS {lab.lower().replace(" ", "_")}_{c}'
                      for lab in cfg.period_labels for c in columns)
    return (f'SELECT "row", {cells} FROM (SELECT *, row_number() OVER (PARTITION BY period ORDER BY {order}) - 1 AS "row" '
            f'FROM ({section}) section) ranked GROUP BY "row"')


def wide_sql(usage: dict, sessions: dict, cfg: ReportConfig) -> dict[str, str]:
    measures = ["TotalResults", "OnlineTests", "BubbleSheets"]
    statuses = [name for name, _ in cfg.session_statuses]
    by_count = "TotalResults DESC, State, District"
    return {
        "usage_results_by_client_wide": side_by_side_sql(usage["usage_results_by_client"], by_count, ["State", "District", *measures, "share"], cfg),
        "benchmarks_by_client_wide": side_by_side_sql(usage["benchmarks_by_client_total"], f"row_kind DESC, {by_count}", ["State", "District", *measures], cfg),
        "entry_by_client_wide": side_by_side_sql(usage["entry_by_client"], "Total DESC, State, District", ["State", "District", "Total"], cfg),
        "sessions_by_start_date_wide": side_by_side_sql(sessions["sessions_by_start_date"], "strptime(DateStarted, '%m/%d/%Y')",
                                                        ["DateStarted", "TotalOnlineTests", *statuses], cfg),
        "sessions_by_hour_wide": side_by_side_sql(
            sessions["sessions_by_hour"], "NumberOfSessions DESC, Hour",
            ["Hour", "NumberOfSessions", "ABeka", "BEC", "Frogstreet", "Others", "pct_ABeka", "pct_BEC", "pct_FrogStreet", "pct_Others"], cfg),
    }


def sessions_sql(cfg: ReportConfig, as_of) -> dict[str, str]:
    def online(ts):
        return f"""online_{ts} AS (
  SELECT p.period, sess.{ts} AS ts, sess.StatusID AS status, dist.DistrictID AS did,
         dist.DistrictGroupID AS dgroup, dist.Name AS dname
  FROM periods p
  JOIN QTIOnlineTestSession sess ON sess.{ts} > CAST(p.week_start AS TIMESTAMP) AND sess.{ts} < CAST(p.week_end AS TIMESTAMP)
  JOIN Student stu ON stu.StudentID = sess.StudentID
  JOIN District dist ON dist.DistrictID = stu.DistrictID
  WHERE dist.Name NOT ILIKE {q(cfg.demo_district_pattern)})"""

    statuses = ", ".join(f"CAST(count(*) FILTER (WHERE status = {code}) AS BIGINT) AS {name}"
                         for name, code in cfg.session_statuses)
    out = {}
    for key, ts, label in (("sessions_by_start_date", "StartDate", "DateStarted"),
                           ("sessions_by_login_date", "LastLoginDate", "DateLastLogIn")):
        head = with_tables(["QTIOnlineTestSession", "Student", "District"], [periods_cte(as_of, cfg), online(ts)])
        out[key] = head + f"""SELECT period, strftime(CAST(ts AS DATE), '%m/%d/%Y') AS {label},
  CAST(count(*) AS BIGINT) AS TotalOnlineTests, {statuses}
FROM online_{ts} GROUP BY period, CAST(ts AS DATE)"""
    head = with_tables(["QTIOnlineTestSession", "Student", "District"], [periods_cte(as_of, cfg), online("LastLoginDate")])
    out["sessions_by_hour"] = head + f""", hourly AS (
SELECT period, strftime(ts + to_hours({cfg.hour_shift_hours}), '%Y-%m-%d %H') AS Hour,
  CAST(count(*) AS BIGINT) AS NumberOfSessions,
  CAST(count(*) FILTER (WHERE did = {cfg.a_beka_district_id}) AS BIGINT) AS ABeka,
  CAST(count(*) FILTER (WHERE dgroup = {cfg.bec_group_id}) AS BIGINT) AS BEC,
  CAST(count(*) FILTER (WHERE dname ILIKE {q(cfg.frog_street_pattern)}) AS BIGINT) AS Frogstreet
FROM online_LastLoginDate GROUP BY 1, 2)
SELECT period, Hour, NumberOfSessions, ABeka, BEC, Frogstreet,
  NumberOfSessions - ABeka - BEC - Frogstreet AS Others,
  ABeka / CAST(NumberOfSessions AS DOUBLE) AS pct_ABeka,
  BEC / CAST(NumberOfSessions AS DOUBLE) AS pct_BEC,
  Frogstreet / CAST(NumberOfSessions AS DOUBLE) AS pct_FrogStreet,
  (NumberOfSessions - ABeka - BEC - Frogstreet) / CAST(NumberOfSessions AS DOUBLE) AS pct_Others
FROM hourly"""
    return out


def period_windows_sql(cfg: ReportConfig) -> str:
    """Periods for every distinct result date, in SQL date arithmetic
    (isodow: Monday = 1)."""
    lab = cfg.period_labels

    def lastfri(d):
        return (f"(CASE WHEN isodow({d}) = 5 THEN {d} - INTERVAL 7 DAY "
                f"ELSE {d} - (isodow({d}) + 2) * INTERVAL 1 DAY END)")

    def thisfri(d):
        return f"({d} + ((12 - isodow({d})) % 7) * INTERVAL 1 DAY)"

    def lastyear(d):
        return thisfri(f"CAST({d} - INTERVAL 1 YEAR AS DATE)")

    return with_tables(["TestResult"]) + f""", days AS (SELECT DISTINCT CAST(UpdatedDate AS DATE) AS as_of FROM TestResult),
w AS (SELECT as_of, CAST({lastfri('as_of')} AS DATE) AS cs, CAST({thisfri('as_of')} AS DATE) AS ce FROM days)
SELECT strftime(as_of, '%Y-%m-%d') AS as_of, period, period_ord,
  strftime(week_start, '%Y-%m-%d') AS week_start, strftime(week_end, '%Y-%m-%d') AS week_end,
  strftime(make_date(CAST(year(as_of) - 1 AS INTEGER), 8, 1), '%Y-%m-%d') AS since FROM (
SELECT as_of, {q(lab[0])} AS period, 1 AS period_ord, cs AS week_start, ce AS week_end FROM w
UNION ALL SELECT as_of, {q(lab[1])}, 2, CAST({lastfri('cs')} AS DATE), cs FROM w
UNION ALL SELECT as_of, {q(lab[2])}, 3, CAST({lastyear('cs')} AS DATE), CAST({lastyear('ce')} AS DATE) FROM w) u"""


# ------------------------------------------------------------- extracts ----

def _ts(v) -> str:
    return f"TIMESTAMP '{v.strftime('%Y-%m-%d %H:%M:%S')}'"


def _like_all(col, pats):
    return " AND ".join(f"{col} ILIKE {q(p)}" for p in pats)


def _incl_excl(col, inc, exc):
    s = _like_all(col, inc)
    if exc:
        s += " AND NOT (" + " OR ".join(f"{col} ILIKE {q(p)}" for p in exc) + ")"
    return s


def _school_year(term, date, cfg) -> str:
    whens = [f"WHEN strpos({term}, {q(n)}) > 0 THEN {q(lab)}" for n, lab in cfg.term_contains_rules]
    whens += [f"WHEN {date} > {_ts(b)} THEN {q(lab)}" for b, lab in cfg.term_date_rules]
    return "CASE " + " ".join(whens) + f" ELSE {term} END"


def _form(name, cfg, guarded=True) -> str:
    pos = f"strpos({name}, {q(cfg.form_marker)})"
    letter = f"substr({name}, {pos} + {cfg.form_offset}, 1)"
    return f"CASE WHEN {pos} > 0 THEN {letter} ELSE ' ' END" if guarded else letter


def _variant_cols(cfg) -> str:
    (pt, pl), (ot, ol) = cfg.parcc_variant, cfg.other_variant
    return (f"CASE WHEN StateID = {cfg.parcc_state_id} THEN {q(pt)} ELSE {q(ot)} END AS StateTest, "
            f"CASE WHEN StateID = {cfg.parcc_state_id} THEN {pl} ELSE {ol} END AS lvl")


# Test -> subject -> grade, and class -> term, as lookup CTEs.
_TESTS = """tests AS (
  SELECT t.VirtualTestID, t.BankID, t.Name AS test_name, t.AchievementLevelSettingID AS lvl,
         sj.Name AS subject, g.Name AS grade
  FROM VirtualTest t, Bank bk, Subject sj, Grade g
  WHERE bk.BankID = t.BankID AND sj.SubjectID = bk.SubjectID AND g.GradeID = sj.GradeID)"""
_CLASSES = """classes AS (
  SELECT cl.ClassID, cl.Name AS class_name, cl.SchoolID AS class_school, term.DistrictID AS term_district,
         term.Name AS term_name, term.Active AS active
  FROM Class cl JOIN DistrictTerm term ON term.DistrictTermID = cl.DistrictTermID)"""
_SCORED = """scored AS (
  SELECT r.TestResultID, r.UpdatedDate, r.ResultDate, sc.ScoreRaw, sc.PointsPossible AS score_possible,
         x.test_name, x.subject, x.grade, k.class_name, k.ClassID, k.term_district, k.term_name, k.active,
         sch.Name AS school_name, tch.UserID, tch.Code AS teacher_code, tch.NameFirst AS teacher_first,
         tch.NameLast AS teacher_last, stu.StudentID, stu.Code AS student_code, stu.FirstName AS student_first,
         stu.LastName AS student_last
  FROM TestResult r
  JOIN TestResultScore sc ON sc.TestResultID = r.TestResultID
  JOIN tests x ON x.VirtualTestID = r.VirtualTestID
  JOIN classes k ON k.ClassID = r.ClassID
  JOIN School sch ON sch.SchoolID = r.SchoolID
  JOIN "User" tch ON tch.UserID = r.UserID
  JOIN Student stu ON stu.StudentID = r.StudentID)"""
_SCORED_TABLES = ["TestResult", "TestResultScore", "VirtualTest", "Bank", "Subject", "Grade", "Class",
                  "DistrictTerm", "School", "User", "Student"]

_STATE_ROWS = """state_rows AS (
  SELECT sch.DistrictID AS school_district, x.test_name, x.subject, x.grade, x.lvl, sch.SchoolID,
         sch.Name AS school_name, stu.StudentID, stu.Code AS student_code, stu.FirstName AS student_first,
         stu.LastName AS student_last, sc.ScoreScaled, sc.AchievementLevel
  FROM TestResult r
  JOIN TestResultScore sc ON sc.TestResultID = r.TestResultID
  JOIN tests x ON x.VirtualTestID = r.VirtualTestID
  JOIN School sch ON sch.SchoolID = r.SchoolID
  JOIN Student stu ON stu.StudentID = r.StudentID)"""


def extracts_sql(cfg: ReportConfig) -> dict[str, str]:
    out = {}
    out["detail_star_join"] = with_tables(_SCORED_TABLES, [_TESTS, _CLASSES, _SCORED]) + f"""SELECT term_district AS DistrictID,
  strftime(UpdatedDate, '%-m/%-d/%Y') AS ResultDate,
  {_school_year('term_name', 'UpdatedDate', cfg)} AS DistrictTerm,
  test_name AS TestName, subject AS Subject, grade AS Grade, {_form('test_name', cfg)} AS Form,
  school_name AS School, UserID, teacher_code AS TeacherCode, teacher_first AS TeacherFirstName,
  teacher_last AS TeacherLastName, ClassID, class_name AS ClassName, StudentID, student_code AS StudentCode,
  student_first AS StudentFirstName, student_last AS StudentLastName,
  ScoreRaw AS TotalPointsEarned, score_possible AS TotalPointsPossible
FROM scored
WHERE ResultDate > {_ts(cfg.detail_since)} AND {_incl_excl('test_name', cfg.detail_include, cfg.detail_exclude)}"""

    state_tables = ["TestResult", "TestResultScore", "VirtualTest", "Bank", "Subject", "Grade", "School",
                    "Student", "District"]
    pattern = cfg.state_test_name_pattern
    pre, post = pattern.split("{test}")
    variants = f"variants AS (SELECT DistrictID, {_variant_cols(cfg)} FROM District)"
    out["state_test_extract"] = with_tables(state_tables, [_TESTS, _STATE_ROWS, variants]) + f"""SELECT
  school_district AS DistrictID, v.StateTest, substr(test_name, 6, 4) AS Year, test_name AS TestName,
  subject AS Subject, grade AS Grade, SchoolID, school_name AS SchoolName, StudentID,
  student_code AS StudentCode, student_first AS StudentFirstName, student_last AS StudentLastName,
  ScoreScaled AS ScaledScore, AchievementLevel
FROM state_rows JOIN variants v ON v.DistrictID = school_district
WHERE test_name ILIKE ({q(pre)} || v.StateTest || {q(post)}) AND state_rows.lvl = v.lvl"""

    ptest, plevel = cfg.parcc_variant
    nav = ("CASE " + " ".join(f"WHEN strpos(test_name, {q(n)}) > 0 THEN {q(g)}" for n, g in cfg.nav_grade_rules)
           + " ELSE grade END")
    subj = "CASE " + " ".join(f"WHEN subject = {q(a)} THEN {q(b)}" for a, b in cfg.subject_recodes) + " ELSE subject END"
    out["state_scores"] = with_tables(state_tables[:-1], [_TESTS, _STATE_ROWS]) + f"""SELECT
  school_district AS DistrictID, substr(test_name, 6, 4) AS Year, test_name AS TestName, {subj} AS Subject,
  grade AS Grade, {nav} AS NAVGrade, school_name AS SchoolID, StudentID, student_code AS StudentCode,
  student_first AS StudentFirstName, student_last AS StudentLastName, ScoreScaled AS ScaledScore,
  AchievementLevel AS ProfLevel
FROM state_rows
WHERE {_incl_excl('test_name', (pattern.format(test=ptest),), cfg.state_score_exclude)} AND lvl = {plevel}"""

    cl_tables = ["TestResult", "TestResultScore", "VirtualTest", "DistrictTerm", "District", "Student",
                 "School", "Class", "User", "TestResultSubScore"]
    keys = "DistrictID, TestName, School, ClusterName"
    null_key = " OR ".join(f"{k} IS NULL" for k in keys.split(", "))
    num = "CASE WHEN strpos(ClusterName, 'Scale Score') > 0 THEN Score WHEN Score = 1 THEN 1.0 ELSE 0.0 END"
    clusters = f"""clusters AS (
  SELECT term.DistrictID, t.Name AS TestName, sch.Name AS School, cl.ClassID, cl.Name AS ClassName,
         part.Name AS ClusterName, part.ScoreScaled AS Score
  FROM TestResultSubScore part
  JOIN TestResultScore sc ON sc.TestResultScoreID = part.TestResultScoreID
  JOIN TestResult r ON r.TestResultID = sc.TestResultID
  JOIN VirtualTest t ON t.VirtualTestID = r.VirtualTestID
  JOIN DistrictTerm term ON term.DistrictTermID = r.DistrictTermID
  JOIN District dd ON dd.DistrictID = term.DistrictID
  JOIN School sch ON sch.SchoolID = r.SchoolID
  JOIN Class cl ON cl.ClassID = r.ClassID
  WHERE t.Name ILIKE {q(pattern.format(test=ptest))} AND t.AchievementLevelSettingID = {plevel}
    AND EXISTS (SELECT 1 FROM Student stu WHERE stu.StudentID = r.StudentID)
    AND EXISTS (SELECT 1 FROM "User" tch WHERE tch.UserID = r.UserID))"""
    out["cluster_ratio"] = with_tables(cl_tables, [clusters]) + f"""SELECT DistrictID, TestName, School, ClassID,
  ClassName, ClusterName,
  CASE WHEN {null_key} THEN NULL ELSE coalesce(sum({num}) OVER (PARTITION BY {keys}), 0.0) END AS NUM,
  CASE WHEN {null_key} THEN NULL ELSE count(Score) OVER (PARTITION BY {keys}) END AS DIV
FROM clusters"""
    out["cluster_ratio_groups"] = with_tables(cl_tables, [clusters]) + f"""SELECT {keys},
  coalesce(sum({num}), 0.0) AS NUM, count(Score) AS DIV
FROM clusters WHERE NOT ({null_key}) GROUP BY {keys}"""

    out["student_gender"] = with_tables(["Student", "Gender"]) + """SELECT stu.DistrictID, stu.StudentID, gd.Name AS Gender
FROM Student stu JOIN Gender gd ON gd.GenderID = stu.GenderID"""
    out["student_race"] = with_tables(["Student", "Race"]) + """SELECT stu.DistrictID, stu.StudentID, rc.Name AS Race
FROM Student stu JOIN Race rc ON rc.RaceID = stu.RaceID"""
    out["student_program"] = with_tables(["StudentProgram", "Program"]) + """SELECT pr.DistrictID, link.StudentID, pr.Name AS Program
FROM StudentProgram link JOIN Program pr ON pr.ProgramID = link.ProgramID"""
    out["student_dimension"] = with_tables(["Student", "Gender", "Race", "StudentProgram", "Program"]) + """
SELECT stu.DistrictID, stu.StudentID, 'Gender' AS Dimension, gd.Name AS Value FROM Student stu JOIN Gender gd ON gd.GenderID = stu.GenderID
UNION ALL SELECT stu.DistrictID, stu.StudentID, 'Race', rc.Name FROM Student stu JOIN Race rc ON rc.RaceID = stu.RaceID
UNION ALL SELECT pr.DistrictID, link.StudentID, 'Program', pr.Name FROM StudentProgram link JOIN Program pr ON pr.ProgramID = link.ProgramID"""

    out.update(_standards_sql(cfg))
    out.update(_demographic_sql(cfg))

    out["report_variant"] = with_tables(["District", "Student"]) + f"""SELECT dd.DistrictID, dd.Name AS DistrictName, dd.StateID,
  CASE WHEN dd.StateID = {cfg.parcc_state_id} THEN {q(cfg.parcc_variant[0])} ELSE {q(cfg.other_variant[0])} END AS StateTest,
  CASE WHEN dd.StateID = {cfg.parcc_state_id} THEN {cfg.parcc_variant[1]} ELSE {cfg.other_variant[1]} END AS AchievementLevelSettingID,
  CAST((SELECT count(*) FROM Student stu WHERE stu.DistrictID = dd.DistrictID) AS BIGINT) AS Students
FROM District dd"""
    return out


def _standards_sql(cfg) -> dict[str, str]:
    """Points per class, teacher, test and tag.  School and class/term
    names are scalar lookups (NULL when absent); the test-name filter needs
    the test, so that join is inner."""
    tables = ["TestResult", "User", "School", "VirtualTest", "Bank", "Subject", "Grade", "Class", "DistrictTerm",
              "Answer", "VirtualQuestion", "QTIItem"]
    scoped = f"""scoped AS (
  SELECT r.TestResultID, r.UpdatedDate, tch.DistrictID, tch.UserID, tch.Code AS TeacherCode,
         tch.NameFirst AS TeacherFirstName, tch.NameLast AS TeacherLastName, r.ClassID,
         (SELECT sch.Name FROM School sch WHERE sch.SchoolID = r.SchoolID) AS SchoolName,
         (SELECT k.class_name FROM classes k WHERE k.ClassID = r.ClassID) AS ClassName,
         (SELECT k.term_name FROM classes k WHERE k.ClassID = r.ClassID) AS TermName,
         x.test_name AS TestName, x.subject AS Subject, x.grade AS Grade
  FROM TestResult r
  JOIN "User" tch ON tch.UserID = r.UserID
  JOIN tests x ON x.VirtualTestID = r.VirtualTestID
  WHERE r.ResultDate > {_ts(cfg.standards_since)}
    AND {_incl_excl('x.test_name', cfg.standards_include, cfg.standards_exclude)})"""
    keys = ("DistrictID, TermName, TestName, Subject, Grade, SchoolName, UserID, TeacherCode, "
            "TeacherFirstName, TeacherLastName, ClassID, ClassName, tag")

    def block(bridge, bridge_key, tag_table, tag_key, tag_col, final_tag):
        points = f"""points AS (
  SELECT a.TestResultID, lbl.{tag_col} AS tag,
         CAST(trunc(a.PointsEarned) AS INTEGER) AS earned, CAST(trunc(a.PointsPossible) AS INTEGER) AS possible
  FROM Answer a
  JOIN VirtualQuestion vq ON vq.VirtualQuestionID = a.VirtualQuestionID
  JOIN {bridge} link ON link.VirtualQuestionID = vq.VirtualQuestionID
  JOIN {tag_table} lbl ON lbl.{tag_key} = link.{bridge_key}
  WHERE EXISTS (SELECT 1 FROM QTIItem item WHERE item.QTIItemID = vq.QTIItemID))"""
        return with_tables(tables + [bridge, tag_table], [_TESTS, _CLASSES, scoped, points]) + f""", grouped AS (
  SELECT {keys}, min(UpdatedDate) AS earliest, max(UpdatedDate) AS latest,
         CAST(sum(earned) AS BIGINT) AS TotalPointsEarned, CAST(sum(possible) AS BIGINT) AS TotalPointsPossible
  FROM scoped JOIN points USING (TestResultID)
  GROUP BY {keys})
SELECT DistrictID, {_school_year('TermName', 'latest', cfg)} AS TermName, TestName, Subject, Grade,
  {_form('TestName', cfg, guarded=False)} AS Form, SchoolName, UserID, TeacherCode, TeacherFirstName,
  TeacherLastName, ClassID, ClassName, {final_tag}, TotalPointsEarned, TotalPointsPossible
FROM grouped"""

    spans = block("VirtualQuestionStateStandard", "StateStandardID", "MasterStandard", "MasterStandardID", "Number",
                  "tag AS StandardNbr, strftime(earliest, '%Y-%m-%d') AS FirstDate, strftime(latest, '%Y-%m-%d') AS LastDate")
    return {
        "standards_dates": f"SELECT DistrictID, TestName, ClassID, UserID, StandardNbr, FirstDate, LastDate FROM ({spans}) spans",
        "standards_summary": block("VirtualQuestionStateStandard", "StateStandardID", "MasterStandard",
                                   "MasterStandardID", "Number", "tag AS StandardNbr"),
        "skills_summary": block("VirtualQuestionLessonOne", "LessonOneID", "LessonOne", "LessonOneID", "Name",
                                "replace(replace(tag, chr(10), ''), chr(13), '') AS Skills"),
    }


def _demographic_sql(cfg) -> dict[str, str]:
    tables = ["VirtualTest", "TestResult", "School", "Student", "VirtualQuestion",
              "VirtualQuestionStateStandard", "MasterStandard", "Answer", "District", "Gender", "Race",
              "TestResultProgram", "Program"]
    banks = ", ".join(f"({q(t)}, {b})" for t, ids in cfg.bank_ids.items() for b in ids)
    ctes = [
        f"variants AS (SELECT DistrictID, {_variant_cols(cfg)} FROM District)",
        f"banks(StateTest, BankID) AS (VALUES {banks})",
        """picked AS (
  SELECT r.TestResultID, r.VirtualTestID, t.Name AS TestName, sch.Name AS School, stu.DistrictID,
         stu.GenderID, stu.RaceID
  FROM TestResult r
  JOIN VirtualTest t ON t.VirtualTestID = r.VirtualTestID
  JOIN School sch ON sch.SchoolID = r.SchoolID
  JOIN Student stu ON stu.StudentID = r.StudentID
  JOIN variants v ON v.DistrictID = stu.DistrictID
  JOIN banks bk ON bk.StateTest = v.StateTest AND bk.BankID = t.BankID)""",
        """pts AS (
  SELECT pk.*, ms.Number, a.PointsEarned, a.PointsPossible
  FROM picked pk
  JOIN Answer a ON a.TestResultID = pk.TestResultID
  JOIN VirtualQuestion vq ON vq.VirtualQuestionID = a.VirtualQuestionID AND vq.VirtualTestID = pk.VirtualTestID
  JOIN VirtualQuestionStateStandard link ON link.VirtualQuestionID = vq.VirtualQuestionID
  JOIN MasterStandard ms ON ms.MasterStandardID = link.StateStandardID)""",
    ]
    head = with_tables(tables, ctes)
    parts = {
        "Gender": "SELECT pts.*, 'Gender' AS Demographic, gd.Name AS Value FROM pts JOIN Gender gd ON gd.GenderID = pts.GenderID",
        "Race": "SELECT pts.*, 'Race' AS Demographic, rc.Name AS Value FROM pts JOIN Race rc ON rc.RaceID = pts.RaceID",
        "Program": ("SELECT pts.*, 'Program' AS Demographic, pr.Name AS Value FROM pts "
                    "JOIN TestResultProgram rp ON rp.TestResultID = pts.TestResultID "
                    "JOIN Program pr ON pr.ProgramID = rp.ProgramID"),
    }

    def agg(names):
        body = "\nUNION ALL\n".join(parts[n] for n in names)
        return head + f"""SELECT DistrictID, School, TestName, Demographic, Value, Number,
  sum(PointsEarned) AS PointsEarned, sum(PointsPossible) AS PointsPossible
FROM ({body}) labelled GROUP BY DistrictID, School, TestName, Demographic, Value, Number"""

    return {
        "standards_by_demographic": agg(["Gender", "Race", "Program"]),
        "standards_by_gender": agg(["Gender"]),
        "standards_by_race": agg(["Race"]),
        "standards_by_program": agg(["Program"]),
    }


# --------------------------------------------------------------- status ----

def status_sql(cfg: ReportConfig, form: str) -> dict[str, str]:
    tables = sorted(set(_SCORED_TABLES + ["ClassUser", "ClassUserLOE", "ClassStudent"]))
    roster = """roster AS (
  SELECT DISTINCT stu.DistrictID, sch.Name AS School, stu.LastName, stu.FirstName, stu.MiddleName, stu.Code,
         gr.Name AS Grade
  FROM ClassStudent enr
  JOIN Student stu ON stu.StudentID = enr.StudentID
  JOIN classes k ON k.ClassID = enr.ClassID AND k.active = 1
  JOIN School sch ON sch.SchoolID = k.class_school
  LEFT JOIN Grade gr ON gr.GradeID = stu.CurrentGradeID
  WHERE EXISTS (SELECT 1 FROM ClassUser cu
                WHERE cu.ClassID = enr.ClassID
                  AND EXISTS (SELECT 1 FROM "User" tch WHERE tch.UserID = cu.UserID)
                  AND EXISTS (SELECT 1 FROM ClassUserLOE loe WHERE loe.ClassUserLOEID = cu.ClassUserLOEID)))"""
    done = f"""done AS (
  SELECT term_district AS DistrictID, student_code, subject, {_form('test_name', cfg)} AS form_letter
  FROM scored
  WHERE active = 1 AND {_incl_excl('test_name', cfg.status_include, cfg.status_exclude)})"""
    flags = ",\n  ".join(
        f"""CASE WHEN EXISTS (SELECT 1 FROM done WHERE done.DistrictID = roster.DistrictID
    AND done.student_code = roster.Code AND done.subject = {q(subject)} AND done.form_letter = {q(form)})
    THEN 'Yes' ELSE 'No' END AS {col}"""
        for col, subject in cfg.status_subjects)
    return {
        "status_roster": with_tables(tables, [_CLASSES, roster]) + "SELECT * FROM roster",
        "status_matrix": with_tables(tables, [_TESTS, _CLASSES, _SCORED, roster, done]) + f"""SELECT roster.*,
  {flags}
FROM roster""",
    }


# --------------------------------------------------------------- labels ----

def labels_sql(cfg: ReportConfig, district_id: int) -> dict[str, str]:
    parcc = cfg.state_test_name_pattern.format(test=cfg.parcc_variant[0])
    other = cfg.state_test_name_pattern.format(test=cfg.other_variant[0])
    return {
        "form_label": with_tables(["VirtualTest"]) + f"""SELECT VirtualTestID, Name AS TestName,
  {_form('Name', cfg)} AS FormGuarded, {_form('Name', cfg, guarded=False)} AS FormUnguarded FROM VirtualTest""",
        "term_label": with_tables(["TestResult", "Class", "DistrictTerm"]) + f"""SELECT tr.TestResultID, dt.Name AS TermName,
  strftime(tr.UpdatedDate, '%Y-%m-%d %H:%M:%S') AS UpdatedDate,
  {_school_year('dt.Name', 'tr.UpdatedDate', cfg)} AS SchoolYear
FROM TestResult tr JOIN Class c ON c.ClassID = tr.ClassID JOIN DistrictTerm dt ON dt.DistrictTermID = c.DistrictTermID""",
        "pattern_filter": with_tables(["VirtualTest"]) + f"""SELECT VirtualTestID, Name AS TestName,
  ({_incl_excl('Name', cfg.detail_include, cfg.detail_exclude)}) AS detail_ok,
  ({_incl_excl('Name', cfg.standards_include, cfg.standards_exclude)}) AS standards_ok,
  ({_incl_excl('Name', cfg.status_include, cfg.status_exclude)}) AS status_ok,
  ({_like_all('Name', cfg.usage_benchmark_include)}) AS usage_benchmark_ok,
  ({_incl_excl('Name', (parcc,), cfg.state_score_exclude)}) AS parcc_score_ok,
  (Name ILIKE {q(other)}) AS other_state_test
FROM VirtualTest""",
        "param_filter": with_tables(["TestResult", "Student"]) + f"""SELECT s.StudentID, s.Code AS StudentCode, count(*) AS Results
FROM TestResult tr JOIN Student s ON s.StudentID = tr.StudentID
WHERE s.DistrictID = {district_id} AND tr.ResultDate > {_ts(cfg.detail_since)}
GROUP BY s.StudentID, s.Code""",
    }
