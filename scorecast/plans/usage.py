"""Weekly usage report: results and online sessions this week, last week and
the same week last year.

The original runs nine queries once per period (27 round trips).  Here every
section is one plan: the fact is cut to the three report weeks (a literal
OR of three ranges pushed into the scan), tagged with its period(s) by a
broadcast range join against the 3-row period table, joined to its
dimensions and grouped by ``period`` plus the section's keys.  Output is long form (a ``period``
column); the ``*_wide`` forms give the side-by-side layout.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, ReportConfig
from ..functions.dates import august_first_last_year, day_text, hour_label, iso_day, period_table, with_periods
from ..functions.predicates import any_not_null, not_in
from ..operators.aggregates import count_where, share_of_total, with_total_row
from ..operators.periods import assign_periods, densify_days, period_change
from ..sources.catalog import Catalog

RESULT_MEASURES = ["Total", "OnlineTests", "BubbleSheets"]
CLIENT_MEASURES = ["TotalResults", "OnlineTests", "BubbleSheets"]


def periods_for(cat: Catalog, as_of: dt.date, cfg: ReportConfig = DEFAULT) -> DataFrame:
    return period_table(cat.spark, as_of, cfg)


def _districts(cat: Catalog, cfg: ReportConfig) -> DataFrame:
    d = cat["District"].select("DistrictID", F.col("Name").alias("District"), "StateID", "DistrictGroupID")
    return d.where(~F.col("District").ilike(cfg.demo_district_pattern))


def _client_kept(cfg: ReportConfig):
    """Row survives the named-client exclusions: ids, group ids (a NULL
    group fails, as with SQL ``NOT IN``) and a name pattern."""
    return (not_in("DistrictID", cfg.usage_excluded_district_ids)
            & not_in("DistrictGroupID", cfg.usage_excluded_group_ids)
            & ~F.col("District").ilike(cfg.frog_street_pattern))


class WeeklyUsage:
    """All sections of the weekly usage report for one report date.

    Two period-tagged bases feed every section: results (TestResult x
    VirtualTest x Student x District x State) and online sessions
    (per timestamp column, x Student x District).  Each is built once per
    instance; with ``share=True`` (the report runner) each base is also
    checkpointed into the shared folder, so the dimension joins -- the
    student join is a shuffle join at scale -- run once for all sections
    instead of once per section."""

    def __init__(self, cat: Catalog, as_of: dt.date, cfg: ReportConfig = DEFAULT, share: bool = False):
        self.cat, self.as_of, self.cfg, self.share = cat, as_of, cfg, share
        self.periods = periods_for(cat, as_of, cfg)
        self._results = None
        self._sessions: dict[str, DataFrame] = {}

    def _keep(self, df: DataFrame) -> DataFrame:
        if not self.share:
            return df
        from ..sources.sinks import materialize
        return materialize(self.cat.spark, df)

    # ------------------------------------------------------------ bases ----

    def results(self) -> DataFrame:
        """Results tagged with the period(s) their UpdatedDate falls in,
        with test, district and state; demo districts removed."""
        if self._results is None:
            cat, cfg = self.cat, self.cfg
            tr = cat["TestResult"].select("TestResultID", "VirtualTestID", "StudentID", "UpdatedDate",
                                          "QTIOnlineTestSessionID", "BubbleSheetID")
            tr = assign_periods(tr, "UpdatedDate", self.periods)
            vt = cat["VirtualTest"].select("VirtualTestID", F.col("Name").alias("TestName"),
                                           "VirtualTestSourceID", "VirtualTestType")
            s = cat["Student"].select("StudentID", "DistrictID")
            st = cat["State"].select("StateID", F.col("Name").alias("State"))
            self._results = self._keep(
                tr.join(vt, "VirtualTestID").join(s, "StudentID")
                .join(_districts(cat, cfg), "DistrictID").join(st, "StateID"))
        return self._results

    def sessions(self, ts_col: str) -> DataFrame:
        """Online sessions tagged by the period of ``ts_col``, with district."""
        if ts_col not in self._sessions:
            cat = self.cat
            q = cat["QTIOnlineTestSession"].select("StudentID", ts_col, "StatusID")
            q = assign_periods(q, ts_col, self.periods)
            s = cat["Student"].select("StudentID", "DistrictID")
            self._sessions[ts_col] = self._keep(
                q.join(s, "StudentID").join(_districts(cat, self.cfg), "DistrictID"))
        return self._sessions[ts_col]

    def scored(self) -> DataFrame:
        """Online or bubble-sheet results only."""
        return self.results().where(any_not_null("BubbleSheetID", "QTIOnlineTestSessionID"))

    def entries(self) -> DataFrame:
        """Data-entry results (configured test source and types)."""
        cfg = self.cfg
        return self.results().where((F.col("VirtualTestSourceID") == cfg.data_entry_source_id)
                                    & F.col("VirtualTestType").isin(list(cfg.data_entry_test_types)))

    # ---------------------------------------------------------- by date ----

    def by_date(self, exclude_clients: bool = False) -> DataFrame:
        base = self.scored()
        if exclude_clients:
            base = base.where(_client_kept(self.cfg))
        base = base.withColumn("day", F.to_date("UpdatedDate"))
        return (base.groupBy("period", "period_ord", "day").agg(
            F.count("TestResultID").alias("Total"),
            count_where(F.col("QTIOnlineTestSessionID").isNotNull(), "OnlineTests"),
            count_where(F.col("BubbleSheetID").isNotNull(), "BubbleSheets"))
            .withColumn("Date", day_text("day")))

    def results_by_date(self, exclude_clients: bool = False) -> DataFrame:
        """Results per day: total, online, bubble sheet.  Days sort by date
        (the original sorted the ``MM/dd/yyyy`` text, wrong across a year
        end)."""
        return (self.by_date(exclude_clients).orderBy("period_ord", "day")
                .select("period", "Date", *RESULT_MEASURES))

    def section_totals(self) -> DataFrame:
        """Period totals of both by-date tables (all clients, excluding
        named clients) from ONE pass over the weekly results: the exclusion
        is a condition inside the counts, not a second scan.  Every period
        gets a row, zeros when it is empty."""
        kept = F.coalesce(_client_kept(self.cfg), F.lit(False)) & F.col("TestResultID").isNotNull()
        qti, bub = F.col("QTIOnlineTestSessionID").isNotNull(), F.col("BubbleSheetID").isNotNull()
        sums = self.scored().groupBy("period").agg(
            F.count("TestResultID").alias("all_Total"), count_where(qti, "all_OnlineTests"),
            count_where(bub, "all_BubbleSheets"), count_where(kept, "excluding_clients_Total"),
            count_where(kept & qti, "excluding_clients_OnlineTests"),
            count_where(kept & bub, "excluding_clients_BubbleSheets"))
        # at most one row per period: the bounded (broadcast) side of a right
        # join that keeps every period
        t = F.broadcast(sums).join(self.periods.select("period", "period_ord"), "period", "right")
        sections = [F.struct(F.lit(sec).alias("section"),
                             *[F.coalesce(F.col(f"{sec}_{m}"), F.lit(0)).cast("bigint").alias(m)
                               for m in RESULT_MEASURES])
                    for sec in ("all", "excluding_clients")]
        return t.select("period", "period_ord", F.inline(F.array(*sections)))

    def results_by_date_total(self) -> DataFrame:
        """The total row under each by-date table; an empty period gives a
        row of zeros."""
        return (self.section_totals().orderBy("section", "period_ord")
                .select("section", "period", *RESULT_MEASURES))

    def period_change(self) -> DataFrame:
        """Weekly and yearly change of the period totals of both tables."""
        return (period_change(self.section_totals(), ["section"], RESULT_MEASURES, self.cfg.period_labels)
                .orderBy("section", "measure"))

    def results_by_date_wide(self) -> DataFrame:
        """Side-by-side layout of the three by-date tables (the original
        placed them next to each other).  Row ``n`` is day ``n`` of every
        period's calendar (week start = row 0), with missing days as zero
        counts, so the same weekday sits on the same row in every period."""
        codes = {lab: lab.lower().replace(" ", "_") for lab in self.cfg.period_labels}
        code = F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])[F.col("period")]
        dense = densify_days(self.by_date().drop("period_ord", "Date"), self.periods, "day", RESULT_MEASURES)
        dense = dense.join(F.broadcast(self.periods.select("period", "week_start")), "period")
        df = dense.select(code.alias("period_code"), F.datediff("day", "week_start").alias("row"),
                          day_text("day").alias("Date"), *RESULT_MEASURES)
        wide = df.groupBy("row").pivot("period_code", list(codes.values())).agg(
            F.max("Date").alias("Date"), *[F.max(m).alias(m) for m in RESULT_MEASURES])
        return wide.orderBy("row")

    def side_by_side(self, section: DataFrame, order: list, columns: list[str]) -> DataFrame:
        """The periods of a section next to each other, as the original's
        sheets have them: row ``n`` holds the ``n``-th row of every period in
        the section's own order, NULL where a period has fewer rows.
        ``section`` is aggregated and has ``period``; ``order`` decides."""
        codes = {lab: lab.lower().replace(" ", "_") for lab in self.cfg.period_labels}
        code = F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])[F.col("period")]
        place = F.row_number().over(Window.partitionBy("period").orderBy(*order)) - 1
        ranked = section.select(code.alias("period_code"), place.alias("row"), *columns)
        return ranked.groupBy("row").pivot("period_code", list(codes.values())).agg(
            *[F.first(c).alias(c) for c in columns]).orderBy("row")

    def by_client_wide(self) -> DataFrame:
        rows = share_of_total(self.by_client(), "TotalResults", ["period"], "share")
        return self.side_by_side(rows, [F.desc("TotalResults"), "State", "District"], ["State", "District", *CLIENT_MEASURES, "share"])

    def benchmarks_by_client_wide(self) -> DataFrame:
        rows = with_total_row(self.by_client(True), self.periods, {"State": "Total", "District": ""}, CLIENT_MEASURES)
        order = [F.desc(F.col("row_kind") == "total"), F.desc("TotalResults"), "State", "District"]
        return self.side_by_side(rows, order, ["State", "District", *CLIENT_MEASURES])

    def sessions_by_date_wide(self, ts_col: str = "StartDate") -> DataFrame:
        rows, label = self._sessions_by_day(ts_col)
        return self.side_by_side(rows, ["day"], [label, "TotalOnlineTests", *[n for n, _ in self.cfg.session_statuses]])

    def sessions_by_hour_wide(self) -> DataFrame:
        return self.side_by_side(self._sessions_by_hour(), [F.desc("NumberOfSessions"), "Hour"], self._hour_columns())

    def entry_by_client_wide(self) -> DataFrame:
        return self.side_by_side(self._entry_by_client(), [F.desc("Total"), "State", "District"], ["State", "District", "Total"])

    def dense_daily_counts(self) -> DataFrame:
        """Results per day with every calendar day of each period present
        (start to end inclusive), missing days 0."""
        counts = self.by_date().drop("period_ord", "Date")
        return (densify_days(counts, self.periods, "day", RESULT_MEASURES)
                .orderBy("period_ord", "day").select("period", iso_day("day").alias("day"), *RESULT_MEASURES))

    # -------------------------------------------------------- by client ----

    def by_client(self, benchmarks_only: bool = False) -> DataFrame:
        base = self.scored()
        if benchmarks_only:
            base = base.where(F.col("TestName").ilike(self.cfg.usage_benchmark_include[0]))
        return base.groupBy("period", "period_ord", "State", "District").agg(
            F.count(F.lit(1)).alias("TotalResults"),
            count_where(F.col("QTIOnlineTestSessionID").isNotNull(), "OnlineTests"),
            count_where(F.col("BubbleSheetID").isNotNull(), "BubbleSheets"))

    def results_by_client(self) -> DataFrame:
        """Results per state and district with the district's share of the
        period's results.  Sorted by count descending (ties by name)."""
        df = share_of_total(self.by_client(), "TotalResults", ["period"], "share")
        return (df.orderBy("period_ord", F.desc("TotalResults"), "State", "District")
                .select("period", "State", "District", *CLIENT_MEASURES, "share"))

    def benchmarks_by_client(self) -> DataFrame:
        """Benchmark results per client with a ``Total`` row first in every
        period (a zero row when the period is empty)."""
        df = with_total_row(self.by_client(True), self.periods, {"State": "Total", "District": ""},
                            CLIENT_MEASURES)
        return (df.orderBy("period_ord", F.desc(F.col("row_kind") == "total"), F.desc("TotalResults"),
                           "State", "District")
                .select("period", "row_kind", "State", "District", *CLIENT_MEASURES))

    # ------------------------------------------------------- data entry ----

    def entry_by_date(self) -> DataFrame:
        """Data-entry results per day, with the period total row."""
        base = self.entries().withColumn("day", F.to_date("UpdatedDate"))
        df = (base.groupBy("period", "period_ord", "day").agg(F.count("TestResultID").alias("Total"))
              .withColumn("Date", day_text("day")))
        df = with_total_row(df, self.periods, {"Date": "Total"}, ["Total"], carry=("day",))
        return (df.orderBy("period_ord", F.col("row_kind") == "total", "day")
                .select("period", "row_kind", "Date", "Total"))

    def _entry_by_client(self) -> DataFrame:
        return (self.entries().groupBy("period", "period_ord", "State", "District")
                .agg(F.count("TestResultID").alias("Total")))

    def entry_by_client(self) -> DataFrame:
        return (self._entry_by_client().orderBy("period_ord", F.desc("Total"), "State", "District")
                .select("period", "State", "District", "Total"))

    # ---------------------------------------------------------- sessions ----

    def _sessions_by_day(self, ts_col: str) -> tuple[DataFrame, str]:
        q = self.sessions(ts_col).withColumn("day", F.to_date(ts_col))
        df = q.groupBy("period", "period_ord", "day").agg(
            F.count(F.lit(1)).alias("TotalOnlineTests"),
            *[count_where(F.col("StatusID") == code, name) for name, code in self.cfg.session_statuses])
        label = "DateStarted" if ts_col == "StartDate" else "DateLastLogIn"
        return df.withColumn(label, day_text("day")), label

    def sessions_by_date(self, ts_col: str = "StartDate") -> DataFrame:
        """Online sessions per day (by start or by last login) and status."""
        df, label = self._sessions_by_day(ts_col)
        return (df.orderBy("period_ord", "day")
                .select("period", label, "TotalOnlineTests", *[n for n, _ in self.cfg.session_statuses]))

    def _hour_columns(self) -> list[str]:
        names = [g.name for g in self.cfg.client_groups()]
        shares = [g.share_name for g in self.cfg.client_groups()]
        return ["Hour", "NumberOfSessions", *names, "Others", *shares, "pct_Others"]

    def _sessions_by_hour(self) -> DataFrame:
        groups = self.cfg.client_groups()
        q = self.sessions("LastLoginDate").withColumn("Hour", hour_label("LastLoginDate", self.cfg.hour_shift_hours))

        def member(g):
            return F.col(g.column).ilike(g.value) if g.pattern else F.col(g.column) == g.value
        df = q.groupBy("period", "period_ord", "Hour").agg(
            F.count(F.lit(1)).alias("NumberOfSessions"), *[count_where(member(g), g.name) for g in groups])
        n = F.col("NumberOfSessions").cast("double")
        others = F.col("NumberOfSessions") - reduce(lambda a, b: a + b, [F.col(g.name) for g in groups])
        df = df.select("*", others.alias("Others"))
        return df.select("*", *[F.try_divide(F.col(src).cast("double"), n).alias(dst) for src, dst in
                                [*((g.name, g.share_name) for g in groups), ("Others", "pct_Others")]])

    def sessions_by_hour(self) -> DataFrame:
        """Sessions per (shifted) login hour, split by the configured client
        groups, with each group's share.  ``Others`` may go negative when
        groups overlap."""
        return (self._sessions_by_hour().orderBy("period_ord", F.desc("NumberOfSessions"), "Hour")
                .select("period", *self._hour_columns()))


# One function per section (each builds its own plan; the report runner uses
# one shared WeeklyUsage instead).

def results_by_date(cat: Catalog, as_of: dt.date, cfg: ReportConfig = DEFAULT,
                    exclude_clients: bool = False) -> DataFrame:
    return WeeklyUsage(cat, as_of, cfg).results_by_date(exclude_clients)


def results_by_date_total(cat: Catalog, as_of: dt.date, cfg: ReportConfig = DEFAULT) -> DataFrame:
    return WeeklyUsage(cat, as_of, cfg).results_by_date_total()


def results_by_date_wide(cat: Catalog, as_of: dt.date, cfg: ReportConfig = DEFAULT) -> DataFrame:
    return WeeklyUsage(cat, as_of, cfg).results_by_date_wide()


def period_change_report(cat: Catalog, as_of: dt.date, cfg: ReportConfig = DEFAULT) -> DataFrame:
    return WeeklyUsage(cat, as_of, cfg).period_change()


def dense_daily_counts(cat: Catalog, as_of: dt.date, cfg: ReportConfig = DEFAULT) -> DataFrame:
    return WeeklyUsage(cat, as_of, cfg).dense_daily_counts()


def results_by_client(cat: Catalog, as_of: dt.date, cfg: ReportConfig = DEFAULT) -> DataFrame:
    return WeeklyUsage(cat, as_of, cfg).results_by_client()


def benchmarks_by_client(cat: Catalog, as_of: dt.date, cfg: ReportConfig = DEFAULT) -> DataFrame:
    return WeeklyUsage(cat, as_of, cfg).benchmarks_by_client()


def entry_by_date(cat: Catalog, as_of: dt.date, cfg: ReportConfig = DEFAULT) -> DataFrame:
    return WeeklyUsage(cat, as_of, cfg).entry_by_date()


def entry_by_client(cat: Catalog, as_of: dt.date, cfg: ReportConfig = DEFAULT) -> DataFrame:
    return WeeklyUsage(cat, as_of, cfg).entry_by_client()


def sessions_by_date(cat: Catalog, as_of: dt.date, ts_col: str = "StartDate",
                     cfg: ReportConfig = DEFAULT) -> DataFrame:
    return WeeklyUsage(cat, as_of, cfg).sessions_by_date(ts_col)


def sessions_by_hour(cat: Catalog, as_of: dt.date, cfg: ReportConfig = DEFAULT) -> DataFrame:
    return WeeklyUsage(cat, as_of, cfg).sessions_by_hour()


def wide(cat: Catalog, as_of: dt.date, section: str, cfg: ReportConfig = DEFAULT, *args) -> DataFrame:
    """The side-by-side layout of a section, by method name."""
    return getattr(WeeklyUsage(cat, as_of, cfg), section)(*args)


def period_windows(cat: Catalog, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """The three report periods for every date on which results were
    updated (a calendar of report windows), with August 1 of the year before
    (the start of the completion report's window)."""
    days = cat["TestResult"].select(F.to_date("UpdatedDate").alias("as_of")).distinct()
    return (with_periods(days, "as_of", cfg).orderBy("as_of", "period_ord")
            .select(iso_day("as_of").alias("as_of"), "period", "period_ord",
                    iso_day("week_start").alias("week_start"), iso_day("week_end").alias("week_end"),
                    iso_day(august_first_last_year("as_of")).alias("since")))
