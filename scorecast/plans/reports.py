"""Whole reports: every section of a report as a named table, and a runner
that writes them.

* ``usage_report``: the weekly usage report (all clients).
* ``benchmark_extract``: the benchmark extract of one district (or all).
* ``parcc_extract``: the state-test (PARCC) extract.
* ``benchmark_status``: the completion matrix for one form.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, ReportConfig, validate_district_id, validate_form
from ..functions.dates import period_table
from ..sources.catalog import Catalog
from ..sources.sinks import Sheet, hadoop_path, materialize, report_path, write_report, write_sheets
from ..sources.versions import publish
from ..sources.workbook import round_trip, write_workbooks
from . import extracts, status, usage


def usage_report(cat: Catalog, as_of: dt.date, cfg: ReportConfig = DEFAULT,
                 share: bool = False) -> dict[str, DataFrame]:
    """All sections of the weekly usage report.  They share one
    ``WeeklyUsage``: with ``share`` its period-tagged bases (results and
    sessions already joined to their dimensions) are checkpointed once and
    every section aggregates them."""
    u = usage.WeeklyUsage(cat, as_of, cfg, share=share)
    return {
        "# of Results by Date": u.results_by_date(),
        "# of Results by Date (excluding clients)": u.results_by_date(exclude_clients=True),
        "# of Results by Date totals": u.results_by_date_total(),
        "# of Results by Date change": u.period_change(),
        "# of Results by Client": u.results_by_client(),
        "# of Benchmarks by Client": u.benchmarks_by_client(),
        "# of Online by Start Date": u.sessions_by_date("StartDate"),
        "# of Online by Last Login Date": u.sessions_by_date("LastLoginDate"),
        "# of Online by Hour": u.sessions_by_hour(),
        "# of Data Locker by Date": u.entry_by_date(),
        "# of Data Locker by Client": u.entry_by_client(),
    }


def demographic_sheets(cat: Catalog, district_id=None, cfg: ReportConfig = DEFAULT,
                       share: bool = True) -> dict[str, Sheet]:
    """The three standards-by-X sheets from ONE plan: the long form is
    computed once (checkpointed into the shared folder when ``share``) and
    split by demographic, each sheet naming its value column after it."""
    long = extracts.demographic_rows(cat, district_id, cfg)
    if share:
        long = materialize(cat.spark, long)
    sheets = {}
    for d in extracts.DEMOGRAPHICS:
        rows = long.where(F.col("Demographic") == d).select(
            "DistrictID", "School", "TestName", F.col("Value").alias(d), "Number", "PointsEarned", "PointsPossible")
        sheets[f"Standards by {d}"] = Sheet(rows, ("DistrictID", "School", "TestName", "Number", d))
    return sheets


def benchmark_extract(cat: Catalog, district_id=None, cfg: ReportConfig = DEFAULT,
                      share: bool = False) -> dict[str, DataFrame | Sheet]:
    """All sheets of the benchmark extract.  For one district the state-test
    sheet is named after the district's test (PARCC / PSSA); for all
    districts it is "State Test" with a StateTest column.  The
    points-by-program sheet is produced for every variant."""
    state_sheet = "State Test" if district_id is None else extracts.state_variant(cat, district_id, cfg)[0]
    # standards and skills start from the same results (ids only; re-scanning
    # them is cheaper than keeping them)
    staged = extracts.staged_results(cat, district_id, cfg)
    return {
        "Local Benchmarks": Sheet(extracts.detail_rows(cat, district_id, cfg), tuple(extracts.detail_order())),
        state_sheet: extracts.state_test_extract(cat, district_id, cfg),
        "Standards": extracts.standards_summary(cat, district_id, cfg, staged),
        "Skills": extracts.skills_summary(cat, district_id, cfg, staged),
        "Gender": extracts.student_gender(cat, district_id),
        "Race": extracts.student_race(cat, district_id),
        "Program": extracts.student_program(cat, district_id),
        **demographic_sheets(cat, district_id, cfg, share),
    }


def parcc_extract(cat: Catalog, district_id=None, cfg: ReportConfig = DEFAULT) -> dict[str, DataFrame]:
    return {
        "Score": extracts.state_scores(cat, district_id, cfg),
        "Cluster": extracts.cluster_ratio(cat, district_id, cfg),
        "Gender": extracts.student_gender(cat, district_id),
        "Race": extracts.student_race(cat, district_id),
        "Program": extracts.student_program(cat, district_id),
    }


def benchmark_status(cat: Catalog, district_id, form: str, cfg: ReportConfig = DEFAULT) -> dict[str, DataFrame]:
    return {"Students": status.status_matrix(cat, district_id, validate_form(form), cfg)}


# Sections written only when non-empty (as the original guarded them).
GUARDED = ("Local Benchmarks", "Standards", "Skills")


def district_name(cat: Catalog, district_id) -> str:
    """Name of one district (a one-row lookup for the output name)."""
    d = validate_district_id(district_id)
    row = cat["District"].where(F.col("DistrictID") == d).select("Name").first()
    if row is None:
        raise ValueError(f"unknown district {d}")
    return row["Name"]


def _whole(spark, path: str) -> str:
    """The path with its scheme, as executors need it."""
    fs, p = hadoop_path(spark, path)
    return fs.makeQualified(p).toString()


def workbook_clients(cat: Catalog, as_of: dt.date, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """The weekly usage report's client sheets written as a workbook; results
    by client read back from it."""
    u = usage.WeeklyUsage(cat, as_of, cfg, share=True)
    return round_trip({"# of Results by Client": u.results_by_client(), "# of Benchmarks by Client": u.benchmarks_by_client()}, "# of Results by Client")


def workbook_scores(cat: Catalog, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """State scores and student sheets written as one workbook a district; the
    scores of all districts read back from them."""
    sheets = {k: x for k, x in parcc_extract(cat, None, cfg).items() if k in ("Score", "Gender")}
    return round_trip(sheets, "Score", "DistrictID")


def run(kind: str, cat: Catalog, out_root: str, *, district_id=None, as_of: dt.date | None = None,
        form: str = "B", cfg: ReportConfig = DEFAULT, fmt: str = "parquet", versioned: bool = False) -> dict[str, str]:
    """Build and write one report; returns {sheet: path}.

    ``fmt="xlsx"`` writes workbooks, one a district for all districts, and
    returns {"": their folder}.  ``versioned`` keeps the report below
    ``versions`` and switches to it in one step (``sources.versions``);
    workbooks are always written this way."""
    spark = cat.spark

    def write(sheets, out, guarded=(), by=None, title="report"):
        if fmt == "xlsx":
            return {"": publish(spark, out, lambda folder: write_workbooks(sheets, _whole(spark, folder), "DistrictID" if by else None, title, guarded))}
        if versioned:
            made: dict = {}
            folder = publish(spark, out, lambda folder: made.update(write_sheets(sheets, folder, fmt, guarded, by)))
            return {name: f"{folder}/{x}" for name, x in made.items()}
        return write_report(sheets, out, fmt, guarded, by)

    if kind == "usage":
        as_of = as_of or dt.date.today()
        end = period_table(cat.spark, as_of, cfg)._report_periods[0][3]
        out = report_path(out_root, cfg.usage_report_name, end=end)
        return write(usage_report(cat, as_of, cfg, share=True), out, title="Usage")
    # the id keeps districts apart whose names differ only in punctuation
    name = "All Districts" if district_id is None else f"{validate_district_id(district_id)} {district_name(cat, district_id)}"

    def by_district(sheets):  # all-districts output: one folder per district
        if district_id is not None:
            return None
        return {k: ["DistrictID"] for k, x in sheets.items()
                if "DistrictID" in (x.rows if isinstance(x, Sheet) else x).columns}

    if kind == "benchmark":
        sheets = benchmark_extract(cat, district_id, cfg, share=True)
        out = report_path(out_root, cfg.benchmark_extract_name, district=name)
        return write(sheets, out, GUARDED, by_district(sheets), name)
    if kind == "parcc":
        sheets = parcc_extract(cat, district_id, cfg)
        out = report_path(out_root, cfg.parcc_extract_name, district=name)
        return write(sheets, out, (), by_district(sheets), name)
    if kind == "status":
        as_of = as_of or dt.date.today()
        out = report_path(out_root, cfg.status_report_name, district=name,
                          form=validate_form(form), date=as_of)
        return write(benchmark_status(cat, district_id, form, cfg), out, title=name)
    raise ValueError(f"unknown report {kind!r}")
