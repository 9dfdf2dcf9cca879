"""Benchmark extract and state-test (PARCC) extract.

The original builds one workbook per district.  Every function here takes
``district_id``: ``None`` computes all districts in one pass (a
``DistrictID`` column, taken from the table that scopes that section),
an integer restricts to one district with an equality filter that Catalyst
pushes towards the scan.  Each section scopes through its own table (test
term, school, teacher, student, program), exactly as the original queries.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, ReportConfig, validate_district_id
from ..functions.dates import day_text, ts_literal
from ..functions.labels import form_letter, nav_grade, recode_values, school_year, strip_crlf, year_slice
from ..functions.predicates import include_exclude
from ..operators.joins import write_back
from ..operators.skew import split_join
from ..sources.catalog import Catalog


def _scope(df: DataFrame, col: str, district_id) -> DataFrame:
    district_id = validate_district_id(district_id)
    if district_id is None:
        return df
    return df.where(F.col(col) == F.lit(district_id))


def _lit_ts(v) -> Column:
    return ts_literal(v)


# ----------------------------------------------------------- variant -------

def state_test_of(state_id: Column, cfg: ReportConfig = DEFAULT) -> Column:
    """State test of a district's state (PARCC for the configured state,
    the other test otherwise -- a NULL state takes the otherwise branch)."""
    return F.when(state_id == cfg.parcc_state_id, F.lit(cfg.parcc_variant[0])).otherwise(
        F.lit(cfg.other_variant[0]))


def level_setting_of(state_id: Column, cfg: ReportConfig = DEFAULT) -> Column:
    return F.when(state_id == cfg.parcc_state_id, F.lit(cfg.parcc_variant[1])).otherwise(
        F.lit(cfg.other_variant[1]))


def district_variants(cat: Catalog, cfg: ReportConfig = DEFAULT) -> DataFrame:
    d = cat["District"]
    return d.select("DistrictID", F.col("Name").alias("DistrictName"), "StateID",
                    state_test_of(F.col("StateID"), cfg).alias("StateTest"),
                    level_setting_of(F.col("StateID"), cfg).alias("AchievementLevelSettingID"))


def state_variant(cat: Catalog, district_id, cfg: ReportConfig = DEFAULT) -> tuple[str, int]:
    """(state test, achievement-level setting) of one district: a one-row
    lookup, used to name the state-test sheet of a single-district extract."""
    d = validate_district_id(district_id)
    row = district_variants(cat, cfg).where(F.col("DistrictID") == d).select(
        "StateTest", "AchievementLevelSettingID").first()
    if row is None:
        return cfg.other_variant          # unknown state: the otherwise branch
    return row["StateTest"], row["AchievementLevelSettingID"]


def report_variant(cat: Catalog, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """Variant of every district with its number of students."""
    students = cat["Student"].groupBy("DistrictID").agg(F.count(F.lit(1)).alias("Students"))
    return (district_variants(cat, cfg).join(students, "DistrictID", "left")
            .select("DistrictID", "DistrictName", "StateID", "StateTest", "AchievementLevelSettingID",
                    F.coalesce("Students", F.lit(0)).alias("Students"))
            .orderBy("DistrictID"))


def _state_test_name_matches(name: Column, state_test: Column, cfg: ReportConfig) -> Column:
    """``name LIKE '20%-20%<test>%'`` for the district's own test."""
    out = None
    for test, _ in (cfg.parcc_variant, cfg.other_variant):
        cond = name.ilike(cfg.state_test_name_pattern.format(test=test))
        out = F.when(state_test == test, cond) if out is None else out.when(state_test == test, cond)
    return out


# ---------------------------------------------------------- snowflake ------

def with_test_chain(df: DataFrame, cat: Catalog) -> DataFrame:
    """Add test name, subject and grade: VirtualTest -> Bank -> Subject ->
    Grade, all inner.  The dimensions are joined to the fact one at a time
    (not pre-joined): Catalyst estimates a join of two tables as the product
    of their sizes, so a pre-joined dimension chain never looks small enough
    to broadcast, while each single dimension does when it is small."""
    vt = cat["VirtualTest"].select("VirtualTestID", "BankID", F.col("Name").alias("TestName"),
                                   "AchievementLevelSettingID")
    b = cat["Bank"].select("BankID", "SubjectID")
    sub = cat["Subject"].select("SubjectID", F.col("Name").alias("Subject"), "GradeID")
    gr = cat["Grade"].select("GradeID", F.col("Name").alias("Grade"))
    return (df.join(vt, "VirtualTestID").join(b, "BankID").join(sub, "SubjectID").join(gr, "GradeID")
            .drop("BankID", "SubjectID", "GradeID"))


def _students(cat):
    return cat["Student"].select("StudentID", F.col("Code").alias("StudentCode"),
                                 F.col("FirstName").alias("StudentFirstName"),
                                 F.col("LastName").alias("StudentLastName"))


def _teachers(cat):
    return cat["User"].select("UserID", F.col("Code").alias("TeacherCode"),
                              F.col("NameFirst").alias("TeacherFirstName"),
                              F.col("NameLast").alias("TeacherLastName"))


def with_class_term(df: DataFrame, cat: Catalog, how: str = "inner") -> DataFrame:
    """Add class name and its term (name, district, active flag).

    ``how="left"`` keeps rows without a match and sets the class *and* term
    columns only when both the class and its term exist (the pair is inner
    among itself), so the two single-dimension joins behave like one left
    join to the class-term pair."""
    c = cat["Class"].select("ClassID", F.col("Name").alias("ClassName"), "DistrictTermID")
    t = cat["DistrictTerm"].select("DistrictTermID", F.col("DistrictID").alias("TermDistrictID"),
                                   F.col("Name").alias("TermName"), "Active")
    if how == "inner":
        return df.join(c, "ClassID").join(t, "DistrictTermID").drop("DistrictTermID")
    t = t.withColumn("_term_found", F.lit(True))
    out = df.join(c, "ClassID", "left").join(t, "DistrictTermID", "left")
    found = F.col("_term_found").isNotNull()
    return (out.withColumn("ClassName", F.when(found, F.col("ClassName")))
            .drop("DistrictTermID", "_term_found"))


def scored_results(cat: Catalog, test_filter: Column, result_filter: Column | None = None,
                   term_filter: Column | None = None, district_id=None) -> DataFrame:
    """Score x result x test chain x student x school x class/term x teacher
    (the 11-table star of the local-assessment detail).

    The results are cut first -- by date, test and term (a single district
    included) -- and only then meet the scores, the other fact, and the
    students, the largest dimension.  Catalyst keeps this order without
    table statistics."""
    trs = cat["TestResultScore"].select("TestResultID", F.col("ScoreRaw").alias("TotalPointsEarned"),
                                        F.col("PointsPossible").alias("TotalPointsPossible"))
    tr = cat["TestResult"].select("TestResultID", "VirtualTestID", "StudentID", "SchoolID", "ClassID",
                                  "UserID", "UpdatedDate", "ResultDate")
    if result_filter is not None:
        tr = tr.where(result_filter)
    sch = cat["School"].select("SchoolID", F.col("Name").alias("School"))
    df = with_class_term(with_test_chain(tr, cat).where(test_filter), cat)
    if term_filter is not None:
        df = df.where(term_filter)
    df = _scope(df, "TermDistrictID", district_id)
    df = df.join(sch, "SchoolID").join(_teachers(cat), "UserID")
    return df.join(trs, "TestResultID").join(_students(cat), "StudentID")


DETAIL_COLUMNS = [
    "ResultDate", "DistrictTerm", "TestName", "Subject", "Grade", "Form", "School",
    "UserID", "TeacherCode", "TeacherFirstName", "TeacherLastName", "ClassID", "ClassName",
    "StudentID", "StudentCode", "StudentFirstName", "StudentLastName",
    "TotalPointsEarned", "TotalPointsPossible",
]


def detail_rows(cat: Catalog, district_id=None, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """The rows of the local-assessment detail, unsorted, with the columns
    that sort them (``_UpdatedDate``, ``_TestResultID``)."""
    df = scored_results(cat, include_exclude("TestName", cfg.detail_include, cfg.detail_exclude),
                        F.col("ResultDate") > _lit_ts(cfg.detail_since), district_id=district_id)
    return df.select(
        F.col("TermDistrictID").alias("DistrictID"), F.col("UpdatedDate").alias("_UpdatedDate"),
        F.col("TestResultID").alias("_TestResultID"),
        day_text("UpdatedDate", padded=False).alias("ResultDate"),
        school_year("TermName", "UpdatedDate", cfg).alias("DistrictTerm"),
        "TestName", "Subject", "Grade", form_letter("TestName", True, cfg).alias("Form"),
        *DETAIL_COLUMNS[6:])


def detail_order() -> list:
    """Newest first per district.  TestResultID breaks ties, so the range
    partitioning of a global sort can split a district or a date that holds
    a large share of the rows."""
    return [F.col("DistrictID"), F.desc("_UpdatedDate"), F.col("_TestResultID")]


def local_benchmark_detail(cat: Catalog, district_id=None, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """One labelled row per benchmark score since the configured date, newest
    first: form letter, normalised school year, ``M/d/yyyy`` date."""
    return detail_rows(cat, district_id, cfg).orderBy(*detail_order()).select("DistrictID", *DETAIL_COLUMNS)


# ---------------------------------------------------------- state test -----

def _state_scores_base(cat: Catalog, test_filter: Column) -> DataFrame:
    """State-test results cut by test first, then joined to their scores."""
    trs = cat["TestResultScore"].select("TestResultID", F.col("ScoreScaled").alias("ScaledScore"),
                                        "AchievementLevel")
    tr = cat["TestResult"].select("TestResultID", "VirtualTestID", "StudentID", "SchoolID")
    sch = cat["School"].select("SchoolID", F.col("Name").alias("SchoolName"),
                               F.col("DistrictID").alias("SchoolDistrictID"))
    df = with_test_chain(tr, cat).where(test_filter).join(sch, "SchoolID")
    return df.join(trs, "TestResultID").join(_students(cat), "StudentID")


def state_test_extract(cat: Catalog, district_id=None, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """State-test scores of the benchmark extract: each district gets the
    test of its own state (name pattern and achievement-level setting)."""
    v = district_variants(cat, cfg).select(F.col("DistrictID").alias("SchoolDistrictID"), "StateTest",
                                           F.col("AchievementLevelSettingID").alias("_level"))
    name = F.col("TestName")
    variants = (cfg.parcc_variant, cfg.other_variant)
    # any state's test first; which one counts is known with the district
    any_test = reduce(lambda a, b: a | b, [
        name.ilike(cfg.state_test_name_pattern.format(test=test)) & (F.col("AchievementLevelSettingID") == level)
        for test, level in variants])
    df = _scope(_state_scores_base(cat, any_test), "SchoolDistrictID", district_id).join(v, "SchoolDistrictID")
    df = df.where(_state_test_name_matches(name, F.col("StateTest"), cfg)
                  & (F.col("AchievementLevelSettingID") == F.col("_level")))
    return df.select(F.col("SchoolDistrictID").alias("DistrictID"), "StateTest",
                     year_slice("TestName").alias("Year"), "TestName", "Subject", "Grade", "SchoolID",
                     "SchoolName", "StudentID", "StudentCode", "StudentFirstName", "StudentLastName",
                     "ScaledScore", "AchievementLevel")


def state_scores(cat: Catalog, district_id=None, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """PARCC extract score sheet: PARCC tests without ``N/A``, navigation
    grade and subject recode.  ``SchoolID`` carries the school *name*, as
    in the original sheet."""
    test, level = cfg.parcc_variant
    name = F.col("TestName")
    wanted = (include_exclude(name, (cfg.state_test_name_pattern.format(test=test),), cfg.state_score_exclude)
              & (F.col("AchievementLevelSettingID") == level))
    df = _scope(_state_scores_base(cat, wanted), "SchoolDistrictID", district_id)
    return df.select(F.col("SchoolDistrictID").alias("DistrictID"), year_slice(name).alias("Year"), "TestName",
                     recode_values("Subject", cfg.subject_recodes).alias("Subject"), "Grade",
                     nav_grade(name, F.col("Grade"), cfg).alias("NAVGrade"),
                     F.col("SchoolName").alias("SchoolID"), "StudentID", "StudentCode",
                     "StudentFirstName", "StudentLastName", "ScaledScore",
                     F.col("AchievementLevel").alias("ProfLevel"))


def cluster_ratio(cat: Catalog, district_id=None, cfg: ReportConfig = DEFAULT,
                  per_row_output: bool = True) -> DataFrame:
    """Sub-score clusters of PARCC results with the cluster's numerator and
    denominator repeated on each row of its (test, school, cluster) group.

    NUM: sum of scores for ``Scale Score`` clusters, else the number of
    scores equal to 1; DIV: number of non-NULL scores.  Results are cut by
    test before they meet scores and sub-scores; the chain runs once
    (``operators.joins.write_back``)."""
    test, level = cfg.parcc_variant
    tr = cat["TestResult"].select("TestResultID", "VirtualTestID", "DistrictTermID", "StudentID",
                                  "SchoolID", "ClassID", "UserID")
    trs = cat["TestResultScore"].select("TestResultScoreID", "TestResultID")
    vt = (cat["VirtualTest"].where(F.col("Name").ilike(cfg.state_test_name_pattern.format(test=test))
                                   & (F.col("AchievementLevelSettingID") == level))
          .select("VirtualTestID", F.col("Name").alias("TestName")))
    term = cat["DistrictTerm"].select("DistrictTermID", "DistrictID")
    dist = cat["District"].select("DistrictID")
    sch = cat["School"].select("SchoolID", F.col("Name").alias("School"))
    cls = cat["Class"].select("ClassID", F.col("Name").alias("ClassName"))
    sub = cat["TestResultSubScore"].select("TestResultScoreID", F.col("Name").alias("ClusterName"),
                                           F.col("ScoreScaled").alias("Score"))
    # Student and teacher only have to exist (unique keys): semi joins.
    df = tr.join(vt, "VirtualTestID").join(term, "DistrictTermID").join(dist, "DistrictID")
    df = _scope(df, "DistrictID", district_id)
    df = (df.join(sch, "SchoolID").join(cls, "ClassID")
          .join(cat["User"].select("UserID"), "UserID", "left_semi")
          .join(cat["Student"].select("StudentID"), "StudentID", "left_semi")
          .join(trs, "TestResultID").join(sub, "TestResultScoreID"))
    score = F.col("Score")
    per_row = F.when(F.col("ClusterName").contains("Scale Score"), score).otherwise(
        F.when(score == 1, F.lit(1.0)).otherwise(F.lit(0.0)))
    keys = ["DistrictID", "TestName", "School", "ClusterName"]
    if not per_row_output:
        # One row per group (the de-duplicated variant); NULL keys excluded,
        # as the original's grouping drops them.
        known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        return df.where(known).groupBy(*keys).agg(F.coalesce(F.sum(per_row), F.lit(0.0)).alias("NUM"),
                                                  F.count(score).alias("DIV"))
    df = write_back(df, keys, ["ClassID", "ClassName"], {"NUM": per_row, "DIV": score.isNotNull().cast("bigint")})
    return df.select("DistrictID", "TestName", "School", "ClassID", "ClassName", "ClusterName", "NUM", "DIV")


# ---------------------------------------------------------- dimensions -----

def student_gender(cat: Catalog, district_id=None) -> DataFrame:
    s = _scope(cat["Student"], "DistrictID", district_id)
    g = cat["Gender"].select("GenderID", F.col("Name").alias("Gender"))
    return s.join(g, "GenderID").select("DistrictID", "StudentID", "Gender")


def student_race(cat: Catalog, district_id=None) -> DataFrame:
    s = _scope(cat["Student"], "DistrictID", district_id)
    r = cat["Race"].select("RaceID", F.col("Name").alias("Race"))
    return s.join(r, "RaceID").select("DistrictID", "StudentID", "Race")


def student_program(cat: Catalog, district_id=None) -> DataFrame:
    """Programs of students, scoped by the *program's* district."""
    p = _scope(cat["Program"], "DistrictID", district_id).select(
        "ProgramID", "DistrictID", F.col("Name").alias("Program"))
    return cat["StudentProgram"].join(p, "ProgramID").select("DistrictID", "StudentID", "Program")


def student_dimension(cat: Catalog, district_id=None) -> DataFrame:
    """The three listings in long form: (district, student, dimension, value)."""
    parts = [student_gender(cat, district_id).select("DistrictID", "StudentID", F.lit("Gender").alias("Dimension"),
                                                      F.col("Gender").alias("Value")),
             student_race(cat, district_id).select("DistrictID", "StudentID", F.lit("Race").alias("Dimension"),
                                                    F.col("Race").alias("Value")),
             student_program(cat, district_id).select("DistrictID", "StudentID", F.lit("Program").alias("Dimension"),
                                                       F.col("Program").alias("Value"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ----------------------------------------------------- standards family ----

GROUP_COLUMNS = ["TermName", "TestName", "Subject", "Grade", "SchoolName", "UserID", "TeacherCode",
                 "TeacherFirstName", "TeacherLastName", "ClassID", "ClassName"]


RESULT_KEYS = ["DistrictID", "VirtualTestID", "SchoolID", "UserID", "ClassID"]


def staged_results(cat: Catalog, district_id=None, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """Benchmark results since the standards date of teachers in the
    district: ids only (names are attached to the sums, see ``_points_by``).
    The selective test chain comes first.  It is an inner join: the original
    enriched it with a left update, but its test-name filter then drops every
    row the chain did not match, so the result is the same."""
    tr = (cat["TestResult"].where(F.col("ResultDate") > _lit_ts(cfg.standards_since))
          .select("TestResultID", "VirtualTestID", "SchoolID", "UserID", "ClassID", "UpdatedDate"))
    df = with_test_chain(tr, cat).where(include_exclude("TestName", cfg.standards_include, cfg.standards_exclude))
    u = _scope(cat["User"].select("UserID", "DistrictID"), "DistrictID", district_id)
    return df.join(u, "UserID").select("TestResultID", "UpdatedDate", *RESULT_KEYS)


def _with_names(df: DataFrame, cat: Catalog) -> DataFrame:
    """Names for the ids of ``RESULT_KEYS``: test chain and teacher (inner),
    school (left), class and term (left pair)."""
    sch = cat["School"].select("SchoolID", F.col("Name").alias("SchoolName"))
    df = with_test_chain(df, cat).drop("AchievementLevelSettingID").join(_teachers(cat), "UserID")
    df = df.join(sch, "SchoolID", "left")
    return with_class_term(df, cat, "left").drop("TermDistrictID", "Active")


def _points_by(cat, district_id, cfg, bridge, tag_table, tag_key, tag_col, staged=None) -> DataFrame:
    """Points per group and tag; an answer under two standards counts under
    both.  Points are truncated to whole numbers per answer, as in the
    original staging table.

    Sums and maxima compose, so each step aggregates before the next one
    multiplies or widens rows: answers meet the staged results unmultiplied
    (the one large shuffle) and are summed per (ids, question); those sums
    fan out over the bridge and are summed per (ids, tag); only then come the
    names, and a last sum over them."""
    td = staged if staged is not None else staged_results(cat, district_id, cfg)
    a = cat["Answer"].select("TestResultID", "VirtualQuestionID",
                             F.col("PointsEarned").cast("int").alias("PointsEarned"),
                             F.col("PointsPossible").cast("int").alias("PointsPossible"))
    sums = [F.min("FirstDate").alias("FirstDate"), F.max("LastDate").alias("LastDate"),
            F.sum("PointsEarned").alias("PointsEarned"), F.sum("PointsPossible").alias("PointsPossible")]
    td = td.select("*", F.col("UpdatedDate").alias("FirstDate"), F.col("UpdatedDate").alias("LastDate"))
    df = split_join(a, td, ["TestResultID"]).groupBy(*RESULT_KEYS, "VirtualQuestionID").agg(*sums)
    vq = cat["VirtualQuestion"].select("VirtualQuestionID", "QTIItemID")
    item = cat["QTIItem"].select("QTIItemID")
    bridge_key = "StateStandardID" if bridge == "VirtualQuestionStateStandard" else "LessonOneID"
    br = cat[bridge].select("VirtualQuestionID", F.col(bridge_key).alias("_tag_key"))
    tag = cat[tag_table].select(F.col(tag_key).alias("_tag_key"), F.col(tag_col).alias("Tag"))
    df = (df.join(vq, "VirtualQuestionID").join(item, "QTIItemID", "left_semi")
          .join(br, "VirtualQuestionID").join(tag, "_tag_key").groupBy(*RESULT_KEYS, "Tag").agg(*sums))
    return _with_names(df, cat).groupBy("DistrictID", *GROUP_COLUMNS, "Tag").agg(
        F.min("FirstDate").alias("EarliestDate"), F.max("LastDate").alias("MostRecentDate"),
        F.sum("PointsEarned").cast("bigint").alias("TotalPointsEarned"),
        F.sum("PointsPossible").cast("bigint").alias("TotalPointsPossible"))


def _label_summary(df: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Form letter (unguarded) and school year on the aggregated rows --
    after grouping, so equal labels may repeat."""
    return (df.withColumn("Form", form_letter("TestName", False, cfg))
            .withColumn("TermName", school_year("TermName", "MostRecentDate", cfg)))


def standards_summary(cat: Catalog, district_id=None, cfg: ReportConfig = DEFAULT,
                      staged: DataFrame | None = None) -> DataFrame:
    """Points earned and possible per class, teacher, test and standard.
    ``staged``: a precomputed ``staged_results`` (shared with the skills
    summary by the report runner)."""
    df = _points_by(cat, district_id, cfg, "VirtualQuestionStateStandard", "MasterStandard",
                    "MasterStandardID", "Number", staged)
    df = _label_summary(df, cfg).withColumnRenamed("Tag", "StandardNbr")
    return df.select("DistrictID", "TermName", "TestName", "Subject", "Grade", "Form", "SchoolName", "UserID",
                     "TeacherCode", "TeacherFirstName", "TeacherLastName", "ClassID", "ClassName",
                     "StandardNbr", "TotalPointsEarned", "TotalPointsPossible")


def standards_dates(cat: Catalog, district_id=None, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """First and last result date behind each row of ``standards_summary``
    (the report itself shows neither)."""
    df = _points_by(cat, district_id, cfg, "VirtualQuestionStateStandard", "MasterStandard", "MasterStandardID", "Number")
    return df.select("DistrictID", "TestName", "ClassID", "UserID", F.col("Tag").alias("StandardNbr"),
                     F.date_format("EarliestDate", "yyyy-MM-dd").alias("FirstDate"),
                     F.date_format("MostRecentDate", "yyyy-MM-dd").alias("LastDate"))


def skills_summary(cat: Catalog, district_id=None, cfg: ReportConfig = DEFAULT,
                   staged: DataFrame | None = None) -> DataFrame:
    """As ``standards_summary`` per skill; line breaks are removed from the
    skill name after grouping on the raw name."""
    df = _points_by(cat, district_id, cfg, "VirtualQuestionLessonOne", "LessonOne", "LessonOneID", "Name",
                    staged)
    df = _label_summary(df, cfg).withColumn("Skills", strip_crlf("Tag"))
    return df.select("DistrictID", "TermName", "TestName", "Subject", "Grade", "Form", "SchoolName", "UserID",
                     "TeacherCode", "TeacherFirstName", "TeacherLastName", "ClassID", "ClassName",
                     "Skills", "TotalPointsEarned", "TotalPointsPossible")


DEMOGRAPHICS = ("Gender", "Race", "Program")


def _bank_filter(bank: Column, state_test: Column, cfg: ReportConfig) -> Column:
    out = None
    for test, ids in cfg.bank_ids.items():
        cond = (state_test == test) & bank.isin(list(ids))
        out = cond if out is None else out | cond
    return out


def _with_tags(df: DataFrame, cat: Catalog, demographics) -> DataFrame:
    """One row per row of ``df`` and demographic value: gender and race by
    their ids, programs by the list of them.  A missing dimension row drops
    only that demographic, as an inner join would."""
    tags = []
    for d in ("Gender", "Race"):
        if d in demographics:
            dim = cat[d].select(F.col(f"{d}ID"), F.col("Name").alias(f"_{d}_name"), F.lit(True).alias(f"_{d}_ok"))
            df = df.join(dim, f"{d}ID", "left")
            tags.append(F.struct(F.lit(d).alias("Demographic"), F.col(f"_{d}_name").alias("Value"),
                                 F.col(f"_{d}_ok").isNotNull().alias("ok")))
    tags = F.filter(F.array(*tags), lambda t: t["ok"]) if tags else None
    if "Program" in demographics:
        own = F.transform(F.coalesce("_programs", F.array().cast("array<string>")), lambda name: F.struct(
            F.lit("Program").alias("Demographic"), name.alias("Value"), F.lit(True).alias("ok")))
        tags = own if tags is None else F.concat(tags, own)
    return df.select("*", F.inline(tags))


def demographic_rows(cat: Catalog, district_id=None, cfg: ReportConfig = DEFAULT,
                     demographics=DEMOGRAPHICS) -> DataFrame:
    """Points per school, test, demographic value and standard for the
    district's state-test banks, unsorted.

    The six near-identical queries of the original (three demographics x
    two states) are one plan, and the results chain runs once: results are
    filtered to the banks of their district's state test; answers join them
    on (result, question) with the question's test equal to the result's
    test.  Points are summed by ids before they fan out over the standards and
    again before they fan out over demographic values; a result is known by
    its school, test, gender, race and list of programs, of which there are few,
    and only those asked for.  Names come after the last large sum."""
    tr = cat["TestResult"].select("TestResultID", "VirtualTestID", "SchoolID", "StudentID")
    vt = cat["VirtualTest"].select("VirtualTestID", "BankID")
    banks = reduce(lambda a, b: a | b, [F.col("BankID").isin(list(ids)) for ids in cfg.bank_ids.values()])
    s = _scope(cat["Student"].select("StudentID", "DistrictID", "GenderID", "RaceID"), "DistrictID", district_id)
    v = district_variants(cat, cfg).select("DistrictID", "StateTest")
    # any state's banks first; which ones count is known with the district
    results = (tr.join(vt.where(banks), "VirtualTestID").join(s, "StudentID").join(v, "DistrictID")
               .where(_bank_filter(F.col("BankID"), F.col("StateTest"), cfg)))
    ids = ["DistrictID", "SchoolID", "VirtualTestID", *[f"{d}ID" for d in ("Gender", "Race") if d in demographics]]
    if "Program" in demographics:
        p = cat["Program"].select("ProgramID", F.struct("Name").alias("_name"))
        programs = (cat["TestResultProgram"].select("TestResultID", "ProgramID").join(p, "ProgramID")
                    .groupBy("TestResultID").agg(F.array_sort(F.collect_list("_name")).alias("_names")))
        # a struct keeps programs without a name in the list
        results = results.join(programs, "TestResultID", "left").withColumn("_programs", F.col("_names.Name"))
        ids.append("_programs")
    vq = cat["VirtualQuestion"].select("VirtualQuestionID", "VirtualTestID")
    vqss = cat["VirtualQuestionStateStandard"].select("VirtualQuestionID", "StateStandardID")
    ms = cat["MasterStandard"].select(F.col("MasterStandardID").alias("StateStandardID"), "Number")
    sch = cat["School"].select("SchoolID", F.col("Name").alias("School"))
    name = cat["VirtualTest"].select("VirtualTestID", F.col("Name").alias("TestName"))
    a = cat["Answer"].select("TestResultID", "VirtualQuestionID", "PointsEarned", "PointsPossible")
    sums = [F.sum("PointsEarned").alias("PointsEarned"), F.sum("PointsPossible").alias("PointsPossible")]
    df = split_join(a, results.select("TestResultID", *ids), ["TestResultID"]).groupBy(*ids, "VirtualQuestionID").agg(*sums)
    df = (df.join(vq, ["VirtualQuestionID", "VirtualTestID"]).join(vqss, "VirtualQuestionID").groupBy(*ids, "StateStandardID").agg(*sums))
    df = _with_tags(df, cat, demographics).groupBy("DistrictID", "SchoolID", "VirtualTestID", "Demographic", "Value", "StateStandardID").agg(*sums)
    return df.join(ms, "StateStandardID").join(sch, "SchoolID").join(name, "VirtualTestID").groupBy(*DEMOGRAPHIC_KEYS).agg(*sums)


DEMOGRAPHIC_KEYS = ["DistrictID", "School", "TestName", "Demographic", "Value", "Number"]


def standards_by_demographic(cat: Catalog, district_id=None, cfg: ReportConfig = DEFAULT,
                             demographics=DEMOGRAPHICS) -> DataFrame:
    """``demographic_rows`` in report order."""
    return demographic_rows(cat, district_id, cfg, demographics).orderBy(
        "DistrictID", "Demographic", "School", "TestName", "Number", "Value")
