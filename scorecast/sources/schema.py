"""Logical schema of the assessment tables: the columns the reports read.

Used to validate a production catalog (``check_catalog``) and to build
in-memory tables in tests.  Ids are ``bigint``, points and scores
``double``, timestamps carry no zone.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

SCHEMAS: dict[str, str] = {
    "State": "StateID bigint, Name string",
    "District": "DistrictID bigint, Name string, StateID bigint, DistrictGroupID bigint",
    "Student": ("StudentID bigint, Code string, DistrictID bigint, FirstName string, MiddleName string, "
                "LastName string, CurrentGradeID bigint, GenderID bigint, RaceID bigint"),
    "Gender": "GenderID bigint, Name string",
    "Race": "RaceID bigint, Name string",
    "Grade": "GradeID bigint, Name string",
    "Subject": "SubjectID bigint, Name string, GradeID bigint",
    "Bank": "BankID bigint, SubjectID bigint",
    "VirtualTest": ("VirtualTestID bigint, BankID bigint, Name string, AchievementLevelSettingID int, "
                    "VirtualTestSourceID int, VirtualTestType int"),
    "TestResult": ("TestResultID bigint, StudentID bigint, VirtualTestID bigint, SchoolID bigint, ClassID bigint, "
                   "UserID bigint, DistrictTermID bigint, UpdatedDate timestamp_ntz, ResultDate timestamp_ntz, "
                   "QTIOnlineTestSessionID bigint, BubbleSheetID bigint"),
    "TestResultScore": ("TestResultScoreID bigint, TestResultID bigint, ScoreRaw double, PointsPossible double, "
                        "ScoreScaled double, AchievementLevel int"),
    "TestResultSubScore": "TestResultScoreID bigint, Name string, ScoreScaled double, AchievementLevel int",
    "Answer": "TestResultID bigint, VirtualQuestionID bigint, PointsEarned double, PointsPossible double",
    "VirtualQuestion": "VirtualQuestionID bigint, VirtualTestID bigint, QTIItemID bigint",
    "QTIItem": "QTIItemID bigint",
    "VirtualQuestionStateStandard": "VirtualQuestionID bigint, StateStandardID bigint",
    "MasterStandard": "MasterStandardID bigint, Number string",
    "VirtualQuestionLessonOne": "VirtualQuestionID bigint, LessonOneID bigint",
    "LessonOne": "LessonOneID bigint, Name string",
    "School": "SchoolID bigint, Name string, DistrictID bigint",
    "Class": "ClassID bigint, Name string, SchoolID bigint, DistrictTermID bigint",
    "DistrictTerm": "DistrictTermID bigint, DistrictID bigint, Name string, Active int",
    "User": "UserID bigint, DistrictID bigint, Code string, NameFirst string, NameLast string",
    "ClassUser": "ClassID bigint, UserID bigint, ClassUserLOEID bigint",
    "ClassUserLOE": "ClassUserLOEID bigint",
    "ClassStudent": "ClassID bigint, StudentID bigint",
    "Program": "ProgramID bigint, Name string, DistrictID bigint",
    "StudentProgram": "StudentID bigint, ProgramID bigint",
    "TestResultProgram": "TestResultID bigint, ProgramID bigint",
    "QTIOnlineTestSession": ("QTIOnlineTestSessionID bigint, StudentID bigint, StartDate timestamp_ntz, "
                             "LastLoginDate timestamp_ntz, StatusID int"),
}


def column_names(table: str) -> list[str]:
    return [c.strip().split(" ")[0] for c in SCHEMAS[table].split(",")]


def check_catalog(cat, tables=None) -> dict[str, list[str]]:
    """Missing columns per table (empty dict: every table has what the
    reports read).  Only schemas are inspected; no data is read."""
    missing = {}
    for t in tables or SCHEMAS:
        have = set(cat[t].columns)
        lost = [c for c in column_names(t) if c not in have]
        if lost:
            missing[t] = lost
    return missing


def declared_types(table: str) -> dict[str, str]:
    return dict(part.strip().split(" ", 1) for part in SCHEMAS[table].split(","))


class Typed(NamedTuple):
    """``good`` rows in the declared types; ``rejects``: table, the columns that
    do not fit and the row as JSON; ``counts``: rows and rejected rows, known
    once ``good`` has been read (``counts.get``)."""

    good: DataFrame
    rejects: DataFrame
    counts: Observation


def typed(df: DataFrame, table: str) -> Typed:
    """``df`` cast to the declared types of ``table``, with the rows set apart
    that hold a value which is there but cannot be cast.

    Both frames are filters over one scan each; the counts come along with the
    reading of ``good`` (``observe``), with no pass of their own.  A null stays a
    null; columns that are not declared pass through."""
    declared, have = declared_types(table), dict(df.dtypes)
    change = {c: t for c, t in declared.items() if c in have and have[c] != t}
    failed = {c: F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(t).isNull() for c, t in change.items()}
    bad = F.array_compact(F.array(*[F.when(test, F.lit(c)) for c, test in failed.items()])) if failed else F.array().cast("array<string>")
    counts = Observation()
    seen = df.observe(counts, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum((F.size(bad) > 0).cast("long")), F.lit(0)).alias("rejected"))
    good = seen.where(F.size(bad) == 0).select(
        *[F.col(f"`{c}`").try_cast(change[c]).alias(c) if c in change else F.col(f"`{c}`") for c in df.columns])
    rejects = df.where(F.size(bad) > 0).select(F.lit(table).alias("table"), bad.alias("columns"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("row"))
    return Typed(good, rejects, counts)


def conform(df, table: str):
    """Cast the declared columns of ``table`` to their logical types (e.g.
    a JDBC ``datetime`` that arrives as a zoned timestamp becomes
    ``timestamp_ntz``); other columns pass through unchanged."""
    if table not in SCHEMAS:
        return df
    declared = declared_types(table)
    have = dict(df.dtypes)
    cols = []
    for c in df.columns:
        t = declared.get(c)
        cols.append(df[c].cast(t).alias(c) if t and have[c] != t else df[c])
    return df.select(*cols)
