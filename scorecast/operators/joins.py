"""Join helpers.

Broadcast policy: an explicit ``broadcast()`` hint is only put on tables
whose size is bounded *by construction*: the 3-row period table, totals
grouped by period (at most 3 rows) and per-(period, day) counts (at most
3 x 15 rows) -- row counts known when the plan is built.
Every catalog table (students, tests, schools, even districts) is joined
without a hint: Catalyst broadcasts it only when its size estimate (from
Parquet file sizes) is under ``spark.sql.autoBroadcastJoinThreshold``,
otherwise it plans a sort-merge join.  AQE re-checks the real size at
runtime and splits skewed partitions (``spark.sql.adaptive.skewJoin``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exists_in(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Keep ``left`` rows that have at least one match in ``right`` (an
    existence-only join).  Unlike an inner join it never multiplies
    ``left``, so no ``DISTINCT`` is needed afterwards."""
    return left.join(right, on, "left_semi")


def write_back(df: DataFrame, keys: list[str], carry: list[str], sums: dict) -> DataFrame:
    """``keys`` and ``carry`` of every row with the totals of its group
    (``SUM(...) OVER (PARTITION BY keys)``) in one pass over ``df``.

    ``sums`` maps a name to a column that is summed.  Rows that agree on
    ``keys`` and ``carry`` are alike in the output, so they are counted and
    summed first (map-side, then one shuffle of the partial sums).  The group
    totals are a window over that small frame -- one row per distinct
    ``carry`` of a group, never the raw rows -- and each row is then repeated
    as often as it was counted.  A group with a third of all rows costs no
    more than any other, and nothing is drawn at random.

    Rows with a NULL key get NULL totals (pandas ``groupby`` drops NULL keys
    the same way)."""
    small = df.groupBy(*keys, *carry).agg(
        F.count(F.lit(1)).alias("_copies"), *[F.sum(c).alias(f"_sum_{name}") for name, c in sums.items()])
    group = Window.partitionBy(*keys)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    totals = [F.when(known, F.coalesce(F.sum(f"_sum_{name}").over(group), F.lit(0))).alias(name) for name in sums]
    return (small.select(*keys, *carry, "_copies", *totals)
            .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies")))).drop("_copies", "_copy"))
