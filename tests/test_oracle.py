"""Every registered query against its DuckDB oracle on sf0.001 (the same
row-count / column / order-insensitive value check as the build driver)."""

import os

import duckdb
import pytest

from scorecast import registry as entry
from conftest import SF_SMALL

from tools.check_oracle import TABLES, digest

KEYS = sorted(entry.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(entry.oracle_sql()) == set(entry.queries())


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[key])
    o_cols, o_rows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(s_cols) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert digest(s_cols, s_rows)[0] == digest(o_cols, o_rows)[0]


def test_entry_smoke(spark):
    import __spark_entry__
    df = __spark_entry__.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["period", "State", "District", "TotalResults", "OnlineTests", "BubbleSheets", "share"]
