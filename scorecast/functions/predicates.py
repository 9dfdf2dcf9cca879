"""Pattern and list predicates (SQL ``LIKE`` semantics, NULL-preserving)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def like_any(c, patterns) -> Column:
    """``c ILIKE p1 OR c ILIKE p2 ...``; NULL when ``c`` is NULL."""
    c = _c(c)
    return reduce(lambda a, b: a | b, [c.ilike(p) for p in patterns])


def like_all(c, patterns) -> Column:
    c = _c(c)
    return reduce(lambda a, b: a & b, [c.ilike(p) for p in patterns])


def include_exclude(c, include, exclude=()) -> Column:
    """Every include pattern matches and no exclude pattern does
    (``c LIKE i AND NOT (c LIKE x OR c LIKE y)``)."""
    cond = like_all(c, include)
    if exclude:
        cond = cond & ~like_any(c, exclude)
    return cond


def not_in(c, values) -> Column:
    """``NOT IN`` with SQL NULL semantics: a NULL ``c`` is dropped."""
    return ~_c(c).isin(list(values))


def any_not_null(*cols) -> Column:
    return reduce(lambda a, b: a | b, [_c(x).isNotNull() for x in cols])


def ts_between_open(ts, start, end) -> Column:
    """``start < ts < end``: both bounds strict."""
    ts = _c(ts)
    return (ts > _c(start)) & (ts < _c(end))
