"""Label and predicate views used by the extracts, exposed on their own so
that each rule can be checked over whole tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, ReportConfig, validate_district_id
from ..functions.labels import form_letter, school_year
from ..functions.predicates import include_exclude, like_all
from ..sources.catalog import Catalog


def form_labels(cat: Catalog, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """Guarded and unguarded form letter of every test name."""
    vt = cat["VirtualTest"]
    return vt.select("VirtualTestID", F.col("Name").alias("TestName"),
                     form_letter("Name", True, cfg).alias("FormGuarded"),
                     form_letter("Name", False, cfg).alias("FormUnguarded"))


def term_labels(cat: Catalog, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """School year of every result: its class term name normalised with the
    result's update date."""
    tr = cat["TestResult"].select("TestResultID", "ClassID", "UpdatedDate")
    c = cat["Class"].select("ClassID", "DistrictTermID")
    t = cat["DistrictTerm"].select("DistrictTermID", F.col("Name").alias("TermName"))
    df = tr.join(c, "ClassID").join(t, "DistrictTermID")
    return df.select("TestResultID", "TermName",
                     F.date_format("UpdatedDate", "yyyy-MM-dd HH:mm:ss").alias("UpdatedDate"),
                     school_year("TermName", "UpdatedDate", cfg).alias("SchoolYear"))


def pattern_flags(cat: Catalog, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """Every test name against each report's include/exclude patterns."""
    n = F.col("Name")
    parcc = cfg.state_test_name_pattern.format(test=cfg.parcc_variant[0])
    other = cfg.state_test_name_pattern.format(test=cfg.other_variant[0])
    return cat["VirtualTest"].select(
        "VirtualTestID", n.alias("TestName"),
        include_exclude(n, cfg.detail_include, cfg.detail_exclude).alias("detail_ok"),
        include_exclude(n, cfg.standards_include, cfg.standards_exclude).alias("standards_ok"),
        include_exclude(n, cfg.status_include, cfg.status_exclude).alias("status_ok"),
        like_all(n, cfg.usage_benchmark_include).alias("usage_benchmark_ok"),
        include_exclude(n, (parcc,), cfg.state_score_exclude).alias("parcc_score_ok"),
        n.ilike(other).alias("other_state_test"))


def district_results(cat: Catalog, district_id, since: dt.datetime) -> DataFrame:
    """Results per student of one district since a date.  Both values are
    bound as named SQL parameters (never pasted into the text)."""
    district_id = validate_district_id(district_id)
    return cat.spark.sql(
        """SELECT s.StudentID, s.Code AS StudentCode, count(*) AS Results
           FROM {tr} tr JOIN {s} s ON s.StudentID = tr.StudentID
           WHERE s.DistrictID = :district AND tr.ResultDate > CAST(:since AS TIMESTAMP_NTZ)
           GROUP BY s.StudentID, s.Code""",
        args={"district": district_id, "since": since.strftime("%Y-%m-%d %H:%M:%S")},
        tr=cat["TestResult"], s=cat["Student"])
