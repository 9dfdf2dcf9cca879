"""Aggregation helpers: conditional counts, totals rows, shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_where(cond: Column, alias: str) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)``: 0, never NULL, in a group."""
    return F.count_if(cond).alias(alias)


def period_totals(df: DataFrame, periods: DataFrame, measures: list[str]) -> DataFrame:
    """Column totals per period, one row per period even when the period
    has no rows (then all zeros).  Built from the 3-row period table, so an
    empty period still gets its row."""
    # One row per period (at most 3): bounded, so it is the broadcast side
    # of a right outer join that keeps every period.
    sums = F.broadcast(df.groupBy("period").agg(*[F.sum(m).alias(m) for m in measures]))
    base = periods.select("period", "period_ord")
    return sums.join(base, "period", "right").select(
        "period", "period_ord",
        *[F.coalesce(F.col(m), F.lit(0)).cast("bigint").alias(m) for m in measures])


def share_of_total(df: DataFrame, measure: str, by: list[str], alias: str) -> DataFrame:
    """``measure / SUM(measure) OVER (PARTITION BY by)`` on an *aggregated*
    frame: the window runs over the groups (districts x periods), so the fact
    below is read once.  Not for raw facts."""
    total = F.sum(measure).over(Window.partitionBy(*by))
    return df.withColumn(alias, F.try_divide(F.col(measure).cast("double"), total.cast("double")))


def with_total_row(df: DataFrame, periods: DataFrame, label_cols: dict, measures: list[str],
                   carry: tuple = ()) -> DataFrame:
    """Append a per-period ``Total`` row (label columns set to constants,
    ``carry`` columns NULL) and a ``row_kind`` column ('total' / 'detail');
    sorting on ``row_kind`` places the total first or last."""
    tot = period_totals(df, periods, measures)
    types = dict(df.dtypes)
    tot = tot.select("period", "period_ord",
                     *[F.lit(v).cast("string").alias(k) for k, v in label_cols.items()],
                     *[F.lit(None).cast(types[c]).alias(c) for c in carry],
                     *measures, F.lit("total").alias("row_kind"))
    det = df.select("period", "period_ord", *label_cols.keys(), *carry, *measures,
                    F.lit("detail").alias("row_kind"))
    return det.unionByName(tot)
