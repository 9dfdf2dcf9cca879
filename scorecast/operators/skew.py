"""Joins whose heavy keys are found and split at run time.

A mergeable frequent-items sketch (``approx_top_k``: one small sketch a task,
merged) gives the keys that hold more than ``1 / parts`` of the rows, and about
how many rows each has.  Rows of such a key take as many seats as it asks
for, by a hash of the row, and the other side's row of that key sits in each.
Keys that the sketch misjudges cost time, never rows: seats are assigned to both
sides from the same list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEATS, MOST = 16, 100_000     # parts a task of the join, and at most


def _tracked(parts: int) -> int:
    """Keys that a sketch tracks; it errs by about 4 / tracked of the rows."""
    return min(1_000_000, max(10_000, 8 * parts))


def key_hash(on: list[str]) -> Column:
    return F.xxhash64(*on)


def heavy_keys(df: DataFrame, on: list[str], parts: int) -> dict[int, int]:
    """{hash of a key: seats} of the keys with more than ``1 / parts`` of the
    rows, so fewer than ``parts`` of them, from one pass over the key columns."""
    found = df.select(key_hash(on).alias("h")).agg(
        F.expr(f"approx_top_k(h, {parts}, {_tracked(parts)})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return {x["item"]: -(-x["count"] * parts // found["n"]) for x in found["top"] or () if x["count"] * parts > found["n"]}


def split_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", parts: int | None = None) -> DataFrame:
    """``left.join(right, on, how)`` for inner and left joins in which a key of
    ``left`` may hold any share of its rows.

    A task of the join then has no more than about ``1 / parts`` of them from
    one key (by default ``SEATS`` times as many parts as shuffle partitions).  Rows
    of ``left`` that agree in every column stay together.  Columns other than
    ``on`` must differ in name."""
    if how not in ("inner", "left"):
        raise ValueError(f"a {how} join cannot be split")
    spark = left.sparkSession
    parts = min(MOST, parts or SEATS * int(spark.conf.get("spark.sql.shuffle.partitions")))
    heavy = heavy_keys(left, on, parts)
    if not heavy:
        return left.join(right, on, how)
    table = spark.createDataFrame(sorted(heavy.items()), "_h long, _seats long")      # below `parts` rows
    seats = lambda df: df.withColumn("_h", key_hash(on)).join(F.broadcast(table), "_h", "left").drop("_h")
    own = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns], F.lit(1)), F.coalesce("_seats", F.lit(1)))
    a = seats(left).withColumn("_seat", own).drop("_seats")
    b = seats(right).withColumn("_seat", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_seats", F.lit(1)) - 1))).drop("_seats")
    return a.join(b, [*on, "_seat"], how).drop("_seat")
