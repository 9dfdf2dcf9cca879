"""Split bounds for partitioned reads of a database table.

Equal ranges of a key give tasks of very unequal sizes where keys are dense in
some places and sparse in others.  Here the bounds are quantiles of the key,
taken from a mergeable sketch (KLL) over a column that is at hand, such as the
last snapshot of the table, so each split has about as many rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def equi_depth_bounds(keys: DataFrame, column: str, parts: int) -> list[int]:
    """Rising distinct bounds, at most ``parts`` - 1 of them, that cut the
    values of an integer column into splits of about equal row counts.  A value
    with more rows than a split has one to itself; null values do not count."""
    sketch = keys.where(F.col(column).isNotNull()).agg(
        F.kll_sketch_agg_bigint(F.col(column).cast("bigint"), F.lit(2_000)).alias("s"), F.count(F.lit(1)).alias("n"), F.min(column).alias("least"))
    ranks = [F.kll_sketch_get_quantile_bigint("s", F.lit(i / parts)) for i in range(1, parts)]
    row = sketch.where("n > 0").select(F.array(*ranks).alias("q"), "least").first()
    if row is None:
        return []
    bounds = []
    for q in row["q"]:
        # a bound that comes twice is a heavy value: it is cut off behind as well
        if bounds and q == bounds[-1]:
            q += 1
        if q > row["least"] and (not bounds or q > bounds[-1]):
            bounds.append(q)
    return bounds


def predicates(column: str, bounds: list[int]) -> list[str]:
    """SQL conditions, one a split; each row meets exactly one, null keys the first."""
    if not bounds:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(bounds, bounds[1:])]
    return [f"{column} < {bounds[0]} OR {column} IS NULL", *inner, f"{column} >= {bounds[-1]}"]
