"""Calendar arithmetic of the weekly usage report, as Column expressions.

Weeks run Friday to Friday.  ``weekday`` is Monday = 0 ... Sunday = 6.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, ReportConfig


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_literal(v) -> Column:
    """A zone-free timestamp literal.  Python datetimes are rendered as text
    and cast, so the session time zone never shifts them."""
    if isinstance(v, dt.datetime):
        text = v.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(v, dt.date):
        text = v.strftime("%Y-%m-%d 00:00:00")
    else:
        text = str(v)
    return F.lit(text).cast("timestamp_ntz")


def last_friday(d) -> Column:
    """Friday -> a week earlier; otherwise d - (weekday + 3) days.  On
    Saturday and Sunday this lands on the Friday *before* the previous one
    (kept on purpose: the report's 14-day weekend window)."""
    d = _c(d)
    wd = F.weekday(d)
    return F.when(wd == 4, F.date_sub(d, 7)).otherwise(F.date_sub(d, wd + 3))


def this_friday(d) -> Column:
    """The coming Friday, which may be ``d`` itself."""
    return F.next_day(F.date_sub(_c(d), 1), "FRI")


def friday_last_year(d) -> Column:
    """First Friday on or after the same calendar date a year earlier.
    ``add_months`` maps Feb 29 to Feb 28 instead of failing."""
    return this_friday(F.add_months(_c(d), -12))


def august_first_last_year(d) -> Column:
    return F.make_date(F.year(_c(d)) - 1, F.lit(8), F.lit(1))


def week_bounds(d, strict: bool = False) -> tuple[Column, Column]:
    d = _c(d)
    end = this_friday(d)
    start = F.date_sub(end, 7) if strict else last_friday(d)
    return start, end


def period_structs(as_of, cfg: ReportConfig = DEFAULT) -> Column:
    """Array of the three (period, period_ord, week_start, week_end) structs
    for one report date: this week, last week (ending where this week
    starts) and the same week last year."""
    cw_start, cw_end = week_bounds(as_of, cfg.strict_week)
    lw_start = F.date_sub(cw_start, 7) if cfg.strict_week else last_friday(cw_start)
    ly_start, ly_end = friday_last_year(cw_start), friday_last_year(cw_end)
    bounds = ((cw_start, cw_end), (lw_start, cw_start), (ly_start, ly_end))
    return F.array(*[
        F.struct(F.lit(label).alias("period"), F.lit(i + 1).alias("period_ord"),
                 s.alias("week_start"), e.alias("week_end"))
        for i, (label, (s, e)) in enumerate(zip(cfg.period_labels, bounds))
    ])


def with_periods(df: DataFrame, as_of_col: str = "as_of", cfg: ReportConfig = DEFAULT) -> DataFrame:
    """One row per (input row, period); a narrow transformation."""
    return df.select("*", F.inline(period_structs(F.col(as_of_col), cfg)))


def report_periods(as_of: dt.date, cfg: ReportConfig = DEFAULT) -> list[tuple]:
    """The three (period, period_ord, week_start, week_end) of one report
    date, computed on the driver from the same rules as ``period_structs``
    (a test checks both agree for every weekday, year ends and leap days).
    Knowing the dates while the plan is built lets each period become a
    literal range that reaches the Parquet scan."""
    def prev_friday(d):
        wd = d.weekday()
        return d - dt.timedelta(days=7 if wd == 4 else wd + 3)

    def coming_friday(d):
        return d + dt.timedelta(days=(4 - d.weekday()) % 7)

    def year_earlier(d):
        if (d.month, d.day) == (2, 29):  # like add_months: Feb 29 -> Feb 28
            return d.replace(year=d.year - 1, day=28)
        return d.replace(year=d.year - 1)

    cw_end = coming_friday(as_of)
    cw_start = cw_end - dt.timedelta(days=7) if cfg.strict_week else prev_friday(as_of)
    lw_start = cw_start - dt.timedelta(days=7) if cfg.strict_week else prev_friday(cw_start)
    bounds = ((cw_start, cw_end), (lw_start, cw_start),
              (coming_friday(year_earlier(cw_start)), coming_friday(year_earlier(cw_end))))
    return [(label, i + 1, s, e) for i, (label, (s, e)) in enumerate(zip(cfg.period_labels, bounds))]


def period_table(spark: SparkSession, as_of: dt.date, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """The 3-row period table for one report date, with timestamp bounds
    (midnight) ready for the strict interval predicate.  Built from
    literals: no job runs, and ``periods_of(table)`` returns the dates."""
    rows = report_periods(as_of, cfg)
    arr = F.array(*[F.struct(F.lit(p).alias("period"), F.lit(o).alias("period_ord"),
                             F.lit(s).cast("date").alias("week_start"), F.lit(e).cast("date").alias("week_end"))
                    for p, o, s, e in rows])
    df = (spark.range(1).select(F.inline(arr))
          .withColumn("start_ts", F.col("week_start").cast("timestamp_ntz"))
          .withColumn("end_ts", F.col("week_end").cast("timestamp_ntz")))
    df._report_periods = rows
    return df


def periods_of(periods: DataFrame):
    """Period dates of a table built by ``period_table`` (else None)."""
    return periods.__dict__.get("_report_periods")


def day_text(c, padded: bool = True) -> Column:
    """``MM/dd/yyyy`` (padded) or ``M/d/yyyy`` (unpadded) date text."""
    return F.date_format(_c(c), "MM/dd/yyyy" if padded else "M/d/yyyy")


def iso_day(c) -> Column:
    """``yyyy-MM-dd`` text of a date or timestamp."""
    return F.date_format(_c(c), "yyyy-MM-dd")


def hour_label(ts, shift_hours: int) -> Column:
    """``yyyy-MM-dd HH`` after a fixed shift in hours."""
    shifted = _c(ts) + F.make_dt_interval(F.lit(0), F.lit(shift_hours))
    return F.date_format(shifted, "yyyy-MM-dd HH")
