"""Daily partial sums of the usage report, kept and extended day by day.

``DailyStore`` holds counts per (day, state, district); they are additive, so a
batch of new rows is summed alone and only the stretches (months, or single
days) that it touches are read again, merged and written.  A manifest names the
folder that counts for each stretch; it is switched in one step (``sources.versions``), and it remembers the
batches, so that one that comes twice counts once.  Rows that change come as
a batch with the old rows taken away (``sign=-1``) and the new ones added.

Report weeks are open intervals between two midnights, so rows at midnight
exactly are counted apart: a week is the sum of its days without the midnight
rows of the first.  Any number of weeks are answered from running sums with
two lookups each (``window_totals``).
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, ReportConfig
from ..functions.dates import iso_day, period_table, with_periods
from ..functions.predicates import any_not_null
from ..operators.aggregates import count_where, share_of_total
from ..sources.catalog import Catalog
from ..sources.sinks import drop_path, hadoop_path
from ..sources.versions import current, publish
from .usage import CLIENT_MEASURES, _districts

KEYS = ["day", "midnight", "State", "District"]
_MANIFEST = "stretch date, folder string"


def daily_partials(cat: Catalog, cfg: ReportConfig = DEFAULT, results: DataFrame | None = None, sign: int = 1) -> DataFrame:
    """Online and bubble-sheet results of ``results`` (by default the table
    TestResult) counted per day, midnight or not, state and district; rows
    without a date are in no week and left out."""
    tr = (results if results is not None else cat["TestResult"]).select(
        "TestResultID", "StudentID", "VirtualTestID", "UpdatedDate", "QTIOnlineTestSessionID", "BubbleSheetID")
    tr = tr.where(any_not_null("BubbleSheetID", "QTIOnlineTestSessionID") & F.col("UpdatedDate").isNotNull())
    st = cat["State"].select("StateID", F.col("Name").alias("State"))
    base = (tr.join(cat["VirtualTest"].select("VirtualTestID"), "VirtualTestID").join(cat["Student"].select("StudentID", "DistrictID"), "StudentID")
            .join(_districts(cat, cfg), "DistrictID").join(st, "StateID"))
    counts = base.groupBy(F.to_date("UpdatedDate").alias("day"), (F.date_trunc("day", "UpdatedDate") == F.col("UpdatedDate")).alias("midnight"),
                          "State", "District").agg(
        F.count(F.lit(1)).alias("TotalResults"), count_where(F.col("QTIOnlineTestSessionID").isNotNull(), "OnlineTests"),
        count_where(F.col("BubbleSheetID").isNotNull(), "BubbleSheets"))
    return counts.select(*KEYS, *[(F.col(m) * sign).alias(m) for m in CLIENT_MEASURES])


def merged(partials: DataFrame) -> DataFrame:
    return partials.groupBy(*KEYS).agg(*[F.sum(m).alias(m) for m in CLIENT_MEASURES])


class DailyStore:
    """Daily partials in ``root``: ``manifest`` (versioned) and ``data``, a
    file for each ``stretch`` of days ("day" or "month") that has rows."""

    def __init__(self, spark: SparkSession, root: str, stretch: str = "month"):
        self.spark, self.root, self.stretch = spark, root.rstrip("/"), stretch

    def _stretch(self, day):
        return F.to_date(F.date_trunc(self.stretch, day))

    def _state(self) -> tuple[DataFrame, set[str], str | None]:
        """(manifest, batches seen, its folder)."""
        try:
            folder = current(self.spark, f"{self.root}/manifest")
        except FileNotFoundError:
            return self.spark.createDataFrame([], _MANIFEST), set(), None
        seen = {r["batch"] for r in self.spark.read.schema("batch string").parquet(f"{folder}/batches").collect()}
        return self.spark.read.schema(_MANIFEST).parquet(f"{folder}/days"), seen, folder

    def days(self, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
        """The partials from ``first`` to ``last`` (all without them); files of
        other stretches are not touched."""
        manifest, _, _ = self._state()
        wanted, inside = F.lit(True), F.lit(True)
        if first is not None:
            wanted = (F.col("stretch") >= self._stretch(F.lit(first))) & (F.col("stretch") <= F.lit(last))
            inside = (F.col("day") >= F.lit(first)) & (F.col("day") <= F.lit(last))
        return self._read(manifest.where(wanted)).where(inside)

    def _read(self, manifest: DataFrame) -> DataFrame:
        rows = manifest.collect()                # a row a stretch
        if not rows:
            return self.spark.createDataFrame([], self.schema())
        paths = sorted(f"{self.root}/data/{r['folder']}/stretch={r['stretch'].isoformat()}" for r in rows)
        found = self.spark.read.schema(self.schema()).option("basePath", f"{self.root}/data").parquet(*paths)
        return found.select(*KEYS, *CLIENT_MEASURES)

    @staticmethod
    def schema() -> str:
        return "day date, midnight boolean, State string, District string, " + ", ".join(f"{m} long" for m in CLIENT_MEASURES)

    def apply(self, batch: str, *partials: DataFrame) -> list[dt.date]:
        """Add the partials of a batch; returns the stretches that it touched
        (none if the batch was there before).  A run that stops leaves the store as
        it was."""
        manifest, seen, _ = self._state()
        if batch in seen:
            return []
        new = partials[0]
        for p in partials[1:]:
            new = new.unionByName(p)
        folder = f"batch={uuid.uuid4().hex}"      # a partition column, so that the days of several read as one table
        path = f"{self.root}/data/{folder}"
        try:
            # the batch's own sums first: they say what to read again
            staged = f"{path}-new"
            merged(new).write.parquet(staged)
            fresh = self.spark.read.schema(self.schema()).parquet(staged)
            touched = sorted(r["stretch"] for r in fresh.select(self._stretch(F.col("day")).alias("stretch")).distinct().collect())
            if touched:
                old = self._read(manifest.where(F.col("stretch").isin(touched)))
                both = merged(old.unionByName(fresh)).where(" OR ".join(f"{m} != 0" for m in CLIENT_MEASURES))
                both.withColumn("stretch", self._stretch(F.col("day"))).hint("rebalance", "stretch").write.partitionBy("stretch").parquet(path)
            drop_path(self.spark, staged)
        except BaseException:
            for gone in (path, f"{path}-new"):
                drop_path(self.spark, gone)
            raise
        days = self.spark.createDataFrame([(d, folder) for d in touched if self._has(path, d)], _MANIFEST)
        kept = manifest.where(~F.col("stretch").isin(touched)) if touched else manifest

        def write(to: str) -> None:
            kept.unionByName(days).coalesce(1).write.parquet(f"{to}/days")
            self.spark.createDataFrame([(b,) for b in sorted(seen | {batch})], "batch string").coalesce(1).write.parquet(f"{to}/batches")
        publish(self.spark, f"{self.root}/manifest", write)
        return touched

    def _has(self, path: str, stretch: dt.date) -> bool:
        """A stretch whose counts are all taken away has no folder."""
        fs, p = hadoop_path(self.spark, f"{path}/stretch={stretch.isoformat()}")
        return fs.exists(p)


def in_week(start, end):
    """Partials inside the open interval between two midnights."""
    return (F.col("day") >= start) & (F.col("day") < end) & ~((F.col("day") == start) & F.col("midnight"))


def clients_of_week(store: DailyStore, as_of: dt.date, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """``usage.results_by_client`` from the store: only the days of the three
    report weeks are read."""
    periods = period_table(store.spark, as_of, cfg)
    days = None
    for r in periods.collect():
        week = store.days(r["week_start"], r["week_end"] - dt.timedelta(days=1)).withColumn("period", F.lit(r["period"]))
        days = week if days is None else days.unionByName(week)
    weeks = periods.select("period", "period_ord", "week_start", "week_end")
    tagged = days.join(F.broadcast(weeks), "period").where(in_week(F.col("week_start"), F.col("week_end")))
    sums = tagged.groupBy("period", "period_ord", "State", "District").agg(*[F.sum(m).alias(m) for m in CLIENT_MEASURES])
    return (share_of_total(sums.where("TotalResults > 0"), "TotalResults", ["period"], "share")
            .orderBy("period_ord", F.desc("TotalResults"), "State", "District").select("period", "State", "District", *CLIENT_MEASURES, "share"))


def staged_clients(cat: Catalog, as_of: dt.date, cfg: ReportConfig = DEFAULT, root: str | None = None) -> DataFrame:
    """Results by client out of a store that is filled in three batches: older
    results, later ones, and stragglers whose dates lie in both."""
    from ..session import checkpoint_dir
    from ..sources.sinks import materialize
    root = root or f"{checkpoint_dir(cat.spark).rstrip('/')}/daily-{uuid.uuid4().hex}"
    store, tr = DailyStore(cat.spark, root), cat["TestResult"]
    late = F.pmod(F.xxhash64("TestResultID"), F.lit(10)) == 0
    old = F.coalesce(F.col("UpdatedDate") < F.lit(as_of - dt.timedelta(days=200)), F.lit(False))
    for name, rows in (("old", tr.where(old & ~late)), ("new", tr.where(~old & ~late)), ("late", tr.where(late))):
        store.apply(name, daily_partials(cat, cfg, rows))
    out = materialize(cat.spark, clients_of_week(store, as_of, cfg))
    drop_path(cat.spark, root)
    return out


def window_totals(days: DataFrame, windows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and the measures' totals of each window (week_start, week_end),
    whatever their number: running sums of the days per state on a calendar
    without gaps, looked up at both ends by equality."""
    span = windows.agg(F.min("week_start").alias("lo"), F.max("week_end").alias("hi")).first()
    if span["lo"] is None:
        return windows.select(*keys, *[F.lit(0).cast("long").alias(m) for m in CLIENT_MEASURES])
    lo, hi = span["lo"] - dt.timedelta(days=1), span["hi"]
    state = days.where((F.col("day") > F.lit(lo)) & (F.col("day") < F.lit(hi))).groupBy("day", "State").agg(
        *[F.sum(m).alias(m) for m in CLIENT_MEASURES], *[F.sum(F.when(F.col("midnight"), F.col(m)).otherwise(0)).alias(f"_at_{m}") for m in CLIENT_MEASURES])
    calendar = state.select("State").distinct().select("State", F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("day"))
    to_here = Window.partitionBy("State").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    running = (calendar.join(state, ["State", "day"], "left").groupBy("State", "day").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for m in CLIENT_MEASURES for c in (m, f"_at_{m}")]).select(
        "State", "day", *[F.sum(m).over(to_here).alias(m) for m in CLIENT_MEASURES], *[f"_at_{m}" for m in CLIENT_MEASURES]))
    # a week has the days from its first to the one before its last, less the first midnight's rows
    first = running.select("State", F.col("day").alias("_first"), *[F.col(f"_at_{m}").alias(f"_midnight_{m}") for m in CLIENT_MEASURES])
    before = running.select("State", F.date_add("day", 1).alias("_first"), *[F.col(m).alias(f"_before_{m}") for m in CLIENT_MEASURES])
    last = running.select("State", F.date_add("day", 1).alias("_end"), *[F.col(m).alias(f"_last_{m}") for m in CLIENT_MEASURES])
    weeks = windows.select("week_start", "week_end").distinct()
    ends = weeks.join(last, F.col("week_end") == F.col("_end")).join(
        before.join(first, ["State", "_first"]).withColumnRenamed("State", "_state"), (F.col("week_start") == F.col("_first")) & (F.col("State") == F.col("_state")))
    sums = ends.groupBy("week_start", "week_end").agg(
        *[F.sum(F.col(f"_last_{m}") - F.col(f"_before_{m}") - F.col(f"_midnight_{m}")).alias(m) for m in CLIENT_MEASURES])
    return windows.join(sums, ["week_start", "week_end"], "left").select(*keys, *[F.coalesce(m, F.lit(0)).cast("long").alias(m) for m in CLIENT_MEASURES])


def totals_of_all_windows(cat: Catalog, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """Results in each of the three weeks of every possible report date."""
    days = cat["TestResult"].select(F.to_date("UpdatedDate").alias("as_of")).distinct().where("as_of IS NOT NULL")
    windows = with_periods(days, "as_of", cfg)
    out = window_totals(daily_partials(cat, cfg), windows, ["as_of", "period", "period_ord"])
    return out.orderBy("as_of", "period_ord").select(iso_day("as_of").alias("as_of"), "period", *CLIENT_MEASURES)
