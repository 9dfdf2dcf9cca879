"""Benchmark status: active-term roster and per-subject completion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, ReportConfig, validate_form
from ..functions.labels import form_letter
from ..functions.predicates import include_exclude
from ..operators.joins import exists_in
from ..operators.skew import split_join
from .extracts import _scope, scored_results

ROSTER_COLUMNS = ["School", "LastName", "FirstName", "MiddleName", "Code", "Grade"]


def status_roster(cat, district_id=None, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """The roster, sorted by school, grade, name and code."""
    return _roster(cat, district_id, cfg).orderBy("DistrictID", "School", "Grade", "LastName", "FirstName", "Code")


def _roster(cat, district_id=None, cfg: ReportConfig = DEFAULT, with_id: bool = False) -> DataFrame:
    """Distinct students enrolled in a class of an active term that has a
    teacher (with a user and a level-of-engagement record), with their
    current grade (left join: the grade may be missing).

    The teacher tables only test existence, so they enter as a semi join on
    the class instead of multiplying rows that DISTINCT then collapses."""
    term = cat["DistrictTerm"].where(F.col("Active") == 1).select("DistrictTermID")
    cls = cat["Class"].select("ClassID", "DistrictTermID", "SchoolID").join(term, "DistrictTermID", "left_semi")
    teachers = (cat["ClassUser"].select("ClassID", "UserID", "ClassUserLOEID")
                .join(cat["User"].select("UserID"), "UserID", "left_semi")
                .join(cat["ClassUserLOE"].select("ClassUserLOEID"), "ClassUserLOEID", "left_semi"))
    cls = exists_in(cls, teachers.select("ClassID"), "ClassID")
    sch = cat["School"].select("SchoolID", F.col("Name").alias("School"))
    s = _scope(cat["Student"].select("StudentID", "DistrictID", "LastName", "FirstName", "MiddleName", "Code",
                                     "CurrentGradeID"), "DistrictID", district_id)
    g = cat["Grade"].select(F.col("GradeID").alias("CurrentGradeID"), F.col("Name").alias("Grade"))
    df = (cls.join(sch, "SchoolID").join(cat["ClassStudent"].select("ClassID", "StudentID"), "ClassID")
          .join(s, "StudentID").join(g, "CurrentGradeID", "left"))
    return df.select("DistrictID", *(["StudentID"] if with_id else []), *ROSTER_COLUMNS).distinct()


def status_matrix(cat, district_id=None, form: str = "A", cfg: ReportConfig = DEFAULT, key: str = "code") -> DataFrame:
    """Roster plus a Yes/No column per configured subject: does the
    student (matched within the district by ``key``: student code, as the
    original does, or student id) have a benchmark score of that subject on
    the requested form?

    The original looked every student up in the score list (students x
    scores); here the scores are reduced to one row per (district, code)
    with one flag per subject, then left-joined to the roster."""
    form = validate_form(form)
    by = {"code": ("StudentCode", "Code"), "id": ("StudentID", "StudentID")}[key]
    scores = scored_results(cat, include_exclude("TestName", cfg.status_include, cfg.status_exclude),
                            term_filter=F.col("Active") == 1, district_id=district_id)
    f = form_letter("TestName", True, cfg)
    flags = scores.groupBy(F.col("TermDistrictID").alias("DistrictID"), F.col(by[0]).alias(by[1])).agg(
        *[F.max((F.col("Subject") == subject) & (f == form)).alias(f"_{col}") for col, subject in cfg.status_subjects])
    # A key shared by many students (a blank or placeholder code, or none) must
    # not meet them in one task; how many share one is found at run time.
    out = split_join(_roster(cat, district_id, cfg, by[1] == "StudentID"), flags, ["DistrictID", by[1]], "left")
    for col, _ in cfg.status_subjects:
        out = out.withColumn(col, F.when(F.col(f"_{col}"), F.lit("Yes")).otherwise(F.lit("No")))
    return (out.select("DistrictID", *ROSTER_COLUMNS, *[c for c, _ in cfg.status_subjects])
            .orderBy("DistrictID", "School", "Grade", "LastName", "FirstName", "Code"))
