"""Binding of the assessment schema onto the driver's TPC-H-style tables.

The reports read ~30 logical tables (TestResult, Student, District, ...).
Production reads them from Parquet or JDBC (``sources.catalog``).  The
test data instead has ``region nation customer supplier part orders
lineitem events``; each logical table is defined here as one or more
projections of those tables.

Every definition is a list of ``Select(source, exprs, where)``, where the
expressions are plain SQL understood by both Spark and DuckDB.  Spark turns
each one into ``spark.read.parquet(...).where(...).selectExpr(...)`` (no
shuffle: bindings are narrow projections, so Catalyst still prunes columns
and pushes filters into the Parquet scan), and the DuckDB oracle turns the
same text into CTEs.  Several Selects are unioned (bridge tables with
fan-out).

No row of any driver table is dropped: the main projection of every table
has no filter, modulo expressions only derive foreign keys (e.g. the test of
a result), and the few ``where`` clauses only *add* second rows to bridge
tables (a student in two classes, a question under two standards, a result
in two programs).

Mapping (fact tables stay facts, small tables become dimensions):

* TestResult, TestResultScore <- orders (one result per order)
* Answer, TestResultSubScore <- lineitem (one answer / sub-score per line)
* QTIOnlineTestSession <- events
* Student, StudentProgram, ClassStudent <- customer
* District, Subject, Race, DistrictTerm <- nation;  State, Grade, Gender,
  ClassUserLOE <- region
* School, Program <- supplier
* VirtualTest, Bank, VirtualQuestion, QTIItem, VirtualQuestionStateStandard,
  MasterStandard, VirtualQuestionLessonOne, LessonOne, Class, User,
  ClassUser <- part
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from dataclasses import dataclass

from ..config import DEFAULT, ReportConfig


@dataclass(frozen=True)
class Select:
    source: str
    exprs: tuple
    where: str | None = None


def _s(source, *exprs, where=None):
    return Select(source, tuple(exprs), where)


# Test names: three in four tests are local benchmarks ("<vendor> <type>
# Form|form <A|B|C>", some CR / Retake / Luppino variants), one in four is a
# state test ("<yyyy>-<yyyy> PARCC|PSSA <subject>").
_VT_NAME = """CASE WHEN p_partkey % 4 = 3 THEN
    CAST(2015 + p_size % 3 AS STRING) || '-' || CAST(2016 + p_size % 3 AS STRING)
    || CASE WHEN p_partkey % 8 = 3 THEN ' PARCC ' ELSE ' PSSA ' END
    || CASE p_size % 6 WHEN 0 THEN 'ELA Grade ' || CAST(3 + p_size % 5 AS STRING)
                       WHEN 1 THEN 'Math Alg I' WHEN 2 THEN 'Math Alg II'
                       WHEN 3 THEN 'Math Geo' WHEN 4 THEN 'Math Grade 5'
                       ELSE 'ELA N/A' END
  ELSE
    CASE WHEN p_partkey % 9 = 1 THEN 'linkit ' ELSE 'LinkIt ' END || p_type
    || CASE WHEN p_partkey % 2 = 0 THEN ' Form ' ELSE ' form ' END
    || CASE p_partkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END
    || CASE WHEN p_partkey % 7 = 0 THEN ' CR' WHEN p_partkey % 11 = 0 THEN ' Retake'
            WHEN p_partkey % 13 = 0 THEN ' Luppino' ELSE '' END
  END"""

_VT_LEVEL = """CASE WHEN p_partkey % 8 = 3 THEN 217 WHEN p_partkey % 8 = 7 THEN 109
  ELSE CAST(p_size % 3 AS INT) END"""

# Class of a student = c_custkey % 100; term of a class k =
# 2 * (k % 25) + (1 when k % 50 < 25: the active term).
_TERM_OF = "CAST(2 * ({k} % 25) + CASE WHEN {k} % 50 < 25 THEN 1 ELSE 0 END AS BIGINT)"

BINDINGS: dict[str, list[Select]] = {
    "State": [_s("region", "CAST(r_regionkey AS BIGINT) AS StateID", "r_name AS Name")],
    "District": [_s(
        "nation",
        "CAST(n_nationkey AS BIGINT) AS DistrictID",
        "CASE WHEN n_nationkey % 6 = 1 THEN n_name || ' Demo' "
        "WHEN n_nationkey % 6 = 2 THEN 'Frog Street ' || n_name ELSE n_name END AS Name",
        "CAST(n_regionkey AS BIGINT) AS StateID",
        "CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE CAST(110 + n_nationkey % 5 AS BIGINT) END AS DistrictGroupID",
    )],
    "Student": [_s(
        "customer",
        "c_custkey AS StudentID",
        "c_name AS Code",
        "CAST(c_nationkey AS BIGINT) AS DistrictID",
        "c_mktsegment AS FirstName",
        "CASE WHEN c_acctbal < 0 THEN NULL ELSE substr(c_mktsegment, 1, 1) END AS MiddleName",
        "'Student' || CAST(c_custkey AS STRING) AS LastName",
        "CAST(c_custkey % 7 AS BIGINT) AS CurrentGradeID",
        "CAST(c_custkey % 7 AS BIGINT) AS GenderID",
        "CAST(c_custkey % 29 AS BIGINT) AS RaceID",
    )],
    "Gender": [_s("region", "CAST(r_regionkey AS BIGINT) AS GenderID",
                  "CASE r_regionkey WHEN 0 THEN 'F' WHEN 1 THEN 'M' ELSE 'X' END AS Name")],
    "Race": [_s("nation", "CAST(n_nationkey AS BIGINT) AS RaceID",
                "CASE n_nationkey % 5 WHEN 0 THEN 'Asian' WHEN 1 THEN 'Black' WHEN 2 THEN 'Hispanic' "
                "WHEN 3 THEN 'White' ELSE 'Multiracial' END AS Name")],
    "Grade": [_s("region", "CAST(r_regionkey AS BIGINT) AS GradeID",
                 "CAST(r_regionkey + 3 AS STRING) AS Name")],
    "Subject": [_s("nation", "CAST(n_nationkey AS BIGINT) AS SubjectID",
                   "CASE n_nationkey % 4 WHEN 0 THEN 'Language Arts' WHEN 1 THEN 'Math' "
                   "WHEN 2 THEN 'Science' ELSE 'Social Studies' END AS Name",
                   "CAST(n_nationkey % 5 AS BIGINT) AS GradeID")],
    "Bank": [_s("part", "p_partkey AS BankID", "CAST(p_partkey % 25 AS BIGINT) AS SubjectID")],
    "VirtualTest": [_s(
        "part",
        "p_partkey AS VirtualTestID",
        "CAST(p_size AS BIGINT) AS BankID",
        _VT_NAME + " AS Name",
        _VT_LEVEL + " AS AchievementLevelSettingID",
        "CASE WHEN p_size % 3 = 0 THEN 3 ELSE 1 END AS VirtualTestSourceID",
        "CAST(1 + p_partkey % 5 AS INT) AS VirtualTestType",
    )],
    "TestResult": [_s(
        "orders",
        "o_orderkey AS TestResultID",
        "o_custkey AS StudentID",
        "o_orderkey % 200 AS VirtualTestID",
        "o_custkey % 10 AS SchoolID",
        "o_custkey % 100 AS ClassID",
        "o_custkey % 100 AS UserID",
        _TERM_OF.format(k="o_custkey") + " AS DistrictTermID",
        "o_orderdate AS UpdatedDate",
        "o_orderdate AS ResultDate",
        "CASE WHEN o_orderstatus = 'F' THEN o_orderkey END AS QTIOnlineTestSessionID",
        "CASE WHEN o_orderstatus = 'P' THEN o_orderkey END AS BubbleSheetID",
    )],
    "TestResultScore": [_s(
        "orders",
        "o_orderkey AS TestResultScoreID",
        "o_orderkey AS TestResultID",
        "CAST(CAST(floor(o_totalprice) AS BIGINT) % 51 AS DOUBLE) AS ScoreRaw",
        "CAST(50 AS DOUBLE) AS PointsPossible",
        "CAST(650 + CAST(floor(o_totalprice) AS BIGINT) % 201 AS DOUBLE) AS ScoreScaled",
        "CAST(1 + CAST(floor(o_totalprice) AS BIGINT) % 5 AS INT) AS AchievementLevel",
    )],
    "TestResultSubScore": [_s(
        "lineitem",
        "l_orderkey AS TestResultScoreID",
        "CASE l_linenumber WHEN 1 THEN 'Reading Scale Score' WHEN 2 THEN 'Writing Scale Score' "
        "WHEN 3 THEN 'Reading Literature' WHEN 4 THEN 'Reading Informational Text' "
        "WHEN 5 THEN 'Vocabulary' WHEN 6 THEN 'Written Expression' "
        "ELSE 'Knowledge of Conventions' END AS Name",
        "CASE WHEN l_linenumber <= 2 THEN 10 + l_quantity WHEN l_discount = 0 THEN NULL "
        "ELSE CAST(CAST(l_quantity AS BIGINT) % 3 AS DOUBLE) END AS ScoreScaled",
        "CAST(1 + l_linenumber % 5 AS INT) AS AchievementLevel",
    )],
    # an answer is to a question of its result's own test (same remainder)
    "Answer": [_s("lineitem", "l_orderkey AS TestResultID",
                  "l_partkey - l_partkey % 200 + l_orderkey % 200 AS VirtualQuestionID",
                  "l_quantity AS PointsEarned", "CAST(50 AS DOUBLE) AS PointsPossible")],
    "VirtualQuestion": [_s("part", "p_partkey AS VirtualQuestionID",
                           "p_partkey % 200 AS VirtualTestID", "p_partkey AS QTIItemID")],
    "QTIItem": [_s("part", "p_partkey AS QTIItemID")],
    # Every question carries one standard; large questions carry a second
    # one (many-to-many fan-out).
    "VirtualQuestionStateStandard": [
        _s("part", "p_partkey AS VirtualQuestionID", "p_partkey % 40 AS StateStandardID"),
        _s("part", "p_partkey AS VirtualQuestionID", "40 + CAST(p_size % 10 AS BIGINT) AS StateStandardID",
           where="p_size > 30"),
    ],
    "MasterStandard": [_s("part", "p_partkey AS MasterStandardID",
                          "upper(substr(p_type, 1, 2)) || '.' || CAST(p_partkey AS STRING) AS Number")],
    "VirtualQuestionLessonOne": [_s("part", "p_partkey AS VirtualQuestionID",
                                    "p_partkey % 30 AS LessonOneID")],
    "LessonOne": [_s("part", "p_partkey AS LessonOneID",
                     "p_name || CASE p_size % 4 WHEN 0 THEN chr(13) || chr(10) WHEN 1 THEN chr(10) "
                     "ELSE ' ' END || p_brand AS Name")],
    "School": [_s("supplier", "s_suppkey AS SchoolID", "s_name AS Name",
                  "CAST(s_nationkey AS BIGINT) AS DistrictID")],
    "Class": [_s("part", "p_partkey AS ClassID", "'Period ' || CAST(p_size AS STRING) || ' ' || p_name AS Name",
                 "p_partkey % 10 AS SchoolID", _TERM_OF.format(k="p_partkey") + " AS DistrictTermID")],
    "DistrictTerm": [
        _s("nation", "CAST(2 * n_nationkey + 1 AS BIGINT) AS DistrictTermID",
           "CAST(n_nationkey AS BIGINT) AS DistrictID",
           "CASE n_nationkey % 3 WHEN 0 THEN '2017-18' WHEN 1 THEN 'FY18 ' || n_name "
           "ELSE 'Current Term' END AS Name",
           "1 AS Active"),
        _s("nation", "CAST(2 * n_nationkey AS BIGINT) AS DistrictTermID",
           "CAST(n_nationkey AS BIGINT) AS DistrictID",
           "CASE n_nationkey % 3 WHEN 0 THEN '2016-17' WHEN 1 THEN '2015-16' ELSE 'Fall' END AS Name",
           "0 AS Active"),
    ],
    "User": [_s("part", "p_partkey AS UserID", "p_partkey % 25 AS DistrictID",
                "'T' || CAST(p_partkey AS STRING) AS Code",
                "split_part(p_name, ' ', 1) AS NameFirst", "p_brand AS NameLast")],
    "ClassUser": [_s("part", "p_partkey AS ClassID", "p_partkey AS UserID",
                     "CAST(p_size % 7 AS BIGINT) AS ClassUserLOEID")],
    "ClassUserLOE": [_s("region", "CAST(r_regionkey AS BIGINT) AS ClassUserLOEID")],
    "ClassStudent": [
        _s("customer", "c_custkey % 100 AS ClassID", "c_custkey AS StudentID"),
        _s("customer", "(c_custkey + 10) % 100 AS ClassID", "c_custkey AS StudentID",
           where="c_acctbal > 5000"),
    ],
    "Program": [_s("supplier", "s_suppkey AS ProgramID",
                   "CASE s_suppkey % 4 WHEN 0 THEN 'IEP' WHEN 1 THEN 'ELL' WHEN 2 THEN 'Gifted' "
                   "ELSE 'Title I' END AS Name",
                   "CAST(s_nationkey AS BIGINT) AS DistrictID")],
    "StudentProgram": [
        _s("customer", "c_custkey AS StudentID", "c_custkey % 10 AS ProgramID"),
        _s("customer", "c_custkey AS StudentID", "(c_custkey + 3) % 10 AS ProgramID",
           where="c_mktsegment = 'BUILDING'"),
    ],
    "TestResultProgram": [
        _s("orders", "o_orderkey AS TestResultID", "o_custkey % 10 AS ProgramID"),
        _s("orders", "o_orderkey AS TestResultID", "(o_custkey + 3) % 10 AS ProgramID",
           where="o_orderpriority = '1-URGENT'"),
    ],
    "QTIOnlineTestSession": [_s(
        "events",
        "event_id AS QTIOnlineTestSessionID",
        "user_id AS StudentID",
        "ts - INTERVAL 1 MINUTE * CAST(floor(value * 10) AS BIGINT) AS StartDate",
        "ts AS LastLoginDate",
        "CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3 "
        "WHEN 'purchase' THEN 4 WHEN 'error' THEN 5 END AS StatusID",
    )],
}

LOGICAL_TABLES = tuple(BINDINGS)


def binding_config(base: ReportConfig = DEFAULT) -> ReportConfig:
    """The report constants re-pointed at ids and dates that exist in the
    synthetic tables (which hold 1995-2001 results and January 2024
    sessions).  Patterns, status codes and labels stay as they are."""
    return dataclasses.replace(
        base,
        usage_excluded_district_ids=(3, 4),
        a_beka_district_id=4,
        parcc_state_id=1,
        bank_ids={base.parcc_variant[0]: tuple(range(1, 26)),
                  base.other_variant[0]: tuple(range(21, 41))},
        term_date_rules=((dt.datetime(1998, 7, 30), "2017-18"),
                         (dt.datetime(1997, 7, 30), "2016-17")),
        detail_since=dt.datetime(1996, 8, 1),
        standards_since=dt.datetime(1997, 8, 1),
    )


# Report dates used with the synthetic tables.
ORDERS_AS_OF = dt.date(1998, 6, 17)
EVENTS_AS_OF = dt.date(2024, 1, 24)


def _select_sql(sel: Select) -> str:
    sql = "SELECT " + ", ".join(sel.exprs) + " FROM " + sel.source
    if sel.where:
        sql += " WHERE " + sel.where
    return sql


def table_sql(name: str) -> str:
    return " UNION ALL ".join(_select_sql(s) for s in BINDINGS[name])


def sql_ctes(names) -> str:
    """``WITH`` prefix defining the given logical tables for the oracle.

    ``User`` is quoted, since it is a reserved word in DuckDB."""
    parts = [f'"{n}" AS ({table_sql(n)})' for n in names]
    return "WITH " + ",\n".join(parts) + "\n"


def to_dataframe(spark, read_source, name: str):
    """Spark DataFrame for one logical table; ``read_source(table)`` returns
    the raw driver table."""
    out = None
    for sel in BINDINGS[name]:
        df = read_source(sel.source)
        if sel.where:
            df = df.where(sel.where)
        df = df.selectExpr(*sel.exprs)
        out = df if out is None else out.unionByName(df)
    return out
