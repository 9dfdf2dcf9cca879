"""Queries against their SQL on whole small tables."""

import duckdb
import pytest

from scorecast.llm import queries

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        duck.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    want = duck.execute(queries.oracle_sql()[name])
    names = [c[0] for c in want.description]
    got = queries.queries()[name](spark, DIR)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect()), key=str) == sorted(want.fetchall(), key=str)
