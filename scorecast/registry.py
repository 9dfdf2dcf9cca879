"""Registered queries: key -> (spark, sf_dir) -> DataFrame, and the oracle
SQL for each key.  Every query reads the driver tables of ``sf_dir``
through the binding catalog, so its work grows with the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import oracle
from .plans import extracts, labels, reports, staging, status, usage
from .sources.binding import EVENTS_AS_OF, ORDERS_AS_OF, binding_config
from .sources.catalog import BindingCatalog

CFG = binding_config()
# Report parameters used with the synthetic tables.
PARAM_DISTRICT = 5
STATUS_FORM = "A"


_CATALOGS: dict = {}


def _cat(spark: SparkSession, sf_dir: str) -> BindingCatalog:
    """One catalog per (session, folder): table schemas are read once."""
    key = (id(spark), sf_dir)
    cat = _CATALOGS.get(key)
    if cat is None or cat.spark is not spark:
        cat = _CATALOGS[key] = BindingCatalog(spark, sf_dir)
    return cat


def _q(fn, *args, **kw) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark, sf_dir):
        return fn(_cat(spark, sf_dir), *args, **kw)
    run.__name__ = getattr(fn, "__name__", "query")
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    A, E = ORDERS_AS_OF, EVENTS_AS_OF
    return {
        "period_windows": _q(usage.period_windows, CFG),
        "usage_results_by_client": _q(usage.results_by_client, A, CFG),
        "usage_results_by_date": _q(usage.results_by_date, A, CFG),
        "usage_results_by_date_excl": _q(usage.results_by_date, A, CFG, exclude_clients=True),
        "usage_results_by_date_total": _q(usage.results_by_date_total, A, CFG),
        "usage_results_by_date_wide": _q(usage.results_by_date_wide, A, CFG),
        "usage_results_by_client_wide": _q(usage.wide, A, "by_client_wide", CFG),
        "benchmarks_by_client_wide": _q(usage.wide, A, "benchmarks_by_client_wide", CFG),
        "entry_by_client_wide": _q(usage.wide, A, "entry_by_client_wide", CFG),
        "sessions_by_start_date_wide": _q(usage.wide, E, "sessions_by_date_wide", CFG, "StartDate"),
        "sessions_by_hour_wide": _q(usage.wide, E, "sessions_by_hour_wide", CFG),
        "usage_period_change": _q(usage.period_change_report, A, CFG),
        "dense_daily_counts": _q(usage.dense_daily_counts, A, CFG),
        "benchmarks_by_client_total": _q(usage.benchmarks_by_client, A, CFG),
        "entry_by_date": _q(usage.entry_by_date, A, CFG),
        "entry_by_client": _q(usage.entry_by_client, A, CFG),
        "sessions_by_start_date": _q(usage.sessions_by_date, E, "StartDate", CFG),
        "sessions_by_login_date": _q(usage.sessions_by_date, E, "LastLoginDate", CFG),
        "sessions_by_hour": _q(usage.sessions_by_hour, E, CFG),
        "form_label": _q(labels.form_labels, CFG),
        "term_label": _q(labels.term_labels, CFG),
        "pattern_filter": _q(labels.pattern_flags, CFG),
        "param_filter": _q(labels.district_results, PARAM_DISTRICT, CFG.detail_since),
        "report_variant": _q(extracts.report_variant, CFG),
        "detail_star_join": _q(extracts.local_benchmark_detail, None, CFG),
        "state_test_extract": _q(extracts.state_test_extract, None, CFG),
        "state_scores": _q(extracts.state_scores, None, CFG),
        "student_gender": _q(extracts.student_gender, None),
        "student_race": _q(extracts.student_race, None),
        "student_program": _q(extracts.student_program, None),
        "student_dimension": _q(extracts.student_dimension, None),
        "standards_summary": _q(extracts.standards_summary, None, CFG),
        "standards_dates": _q(extracts.standards_dates, None, CFG),
        "skills_summary": _q(extracts.skills_summary, None, CFG),
        "standards_by_demographic": _q(extracts.standards_by_demographic, None, CFG),
        "standards_by_gender": _q(extracts.standards_by_demographic, None, CFG, ("Gender",)),
        "standards_by_race": _q(extracts.standards_by_demographic, None, CFG, ("Race",)),
        "standards_by_program": _q(extracts.standards_by_demographic, None, CFG, ("Program",)),
        "cluster_ratio": _q(extracts.cluster_ratio, None, CFG),
        "cluster_ratio_groups": _q(extracts.cluster_ratio, None, CFG, False),
        "staged_clients": _q(staging.staged_clients, A, CFG),
        "window_totals": _q(staging.totals_of_all_windows, CFG),
        "workbook_clients": _q(reports.workbook_clients, A, CFG),
        "workbook_scores": _q(reports.workbook_scores, CFG),
        "status_roster": _q(status.status_roster, None, CFG),
        "status_matrix": _q(status.status_matrix, None, STATUS_FORM, CFG),
    }


def oracle_sql() -> dict[str, str]:
    out = {"period_windows": oracle.period_windows_sql(CFG)}
    weekly, sessions = oracle.usage_sql(CFG, ORDERS_AS_OF), oracle.sessions_sql(CFG, EVENTS_AS_OF)
    out.update({**weekly, **sessions, **oracle.wide_sql(weekly, sessions, CFG)})
    out.update(oracle.extracts_sql(CFG))
    out.update(oracle.status_sql(CFG, STATUS_FORM))
    out.update(oracle.labels_sql(CFG, PARAM_DISTRICT))
    out["staged_clients"], out["window_totals"] = out["usage_results_by_client"], oracle.window_totals_sql(CFG)
    out["workbook_clients"], out["workbook_scores"] = out["usage_results_by_client"], out["state_scores"]
    return out
