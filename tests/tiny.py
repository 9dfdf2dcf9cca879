"""Hand-written in-memory tables for edge-case tests."""

from __future__ import annotations

import datetime as dt

from scorecast.sources.catalog import MemoryCatalog
from scorecast.sources.schema import SCHEMAS

T = dt.datetime


def catalog(spark, **tables):
    """Every logical table, empty unless given as a list of tuples."""
    dfs = {name: spark.createDataFrame(tables.get(name, []), ddl) for name, ddl in SCHEMAS.items()}
    return MemoryCatalog(spark, dfs)


def result(tid, student, test, ts, school=1, cls=1, user=1, term=1, online=True, bubble=False):
    return (tid, student, test, school, cls, user, term, ts, ts, tid if online else None, tid if bubble else None)
