"""Period assignment, densification and period-over-period change."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import periods_of, ts_literal


def assign_periods(fact: DataFrame, ts_col: str, periods: DataFrame) -> DataFrame:
    """Tag each fact row with every period whose open interval
    ``start < ts < end`` contains it (periods may overlap: a row can land in
    several).

    When the period dates are known (tables from ``period_table``), the
    fact is first cut to the union of the intervals by a literal filter
    that Parquet pushdown and partition pruning apply at the scan, so only
    the report weeks are read.  The range join itself is a
    ``BroadcastNestedLoopJoin`` against the 3-row period table: a
    streaming pass over the remaining rows, no shuffle."""
    ts = F.col(ts_col)
    rows = periods_of(periods)
    if rows:
        cut = None
        for _, _, s, e in rows:
            c = (ts > ts_literal(s)) & (ts < ts_literal(e))
            cut = c if cut is None else cut | c
        fact = fact.where(cut)
    p = F.broadcast(periods.select("period", "period_ord", "week_start", "week_end",
                                   F.col("start_ts").alias("_ps"), F.col("end_ts").alias("_pe")))
    return (fact.join(p, (ts > F.col("_ps")) & (ts < F.col("_pe")), "inner")
            .drop("_ps", "_pe"))


def densify_days(counts: DataFrame, periods: DataFrame, day_col: str, measures: list[str]) -> DataFrame:
    """Every day from week start to week end *inclusive* for every period,
    measures 0 where no row exists (a left join from the calendar)."""
    cal = periods.select("period", "period_ord",
                         F.explode(F.sequence("week_start", "week_end")).alias(day_col))
    # ``counts`` has one row per (period, day): at most 3 x 15 rows.
    out = cal.join(F.broadcast(counts), ["period", day_col], "left")
    return out.select("period", "period_ord", day_col,
                      *[F.coalesce(F.col(m), F.lit(0)).cast("bigint").alias(m) for m in measures])


def period_change(totals: DataFrame, keys: list[str], measures: list[str], labels) -> DataFrame:
    """Long rows (keys, measure, this, last_week, last_year, changes).

    ``totals`` holds one row per (keys, period) with the measures.  The
    periods are pivoted by conditional max (3 fixed labels, not a data-driven
    pivot); a change is ``(this - base) / base`` and NULL when the base is 0.
    """
    this_l, lw_l, ly_l = labels
    long = totals.select(*keys, "period", F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(m).cast("bigint").alias("value")) for m in measures
    ])).alias("_m")).select(*keys, "period", "_m.measure", "_m.value")

    def pick(label):
        return F.max(F.when(F.col("period") == label, F.col("value")))

    wide = long.groupBy(*keys, "measure").agg(
        pick(this_l).alias("this_week"), pick(lw_l).alias("last_week"), pick(ly_l).alias("last_year"))
    tw, lw, ly = F.col("this_week"), F.col("last_week"), F.col("last_year")
    return wide.select(
        *keys, "measure", "this_week", "last_week", "last_year",
        F.try_divide((tw - lw).cast("double"), lw.cast("double")).alias("weekly_change"),
        F.try_divide((tw - ly).cast("double"), ly.cast("double")).alias("yearly_change"),
    )
