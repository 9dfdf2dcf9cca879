"""Row order of the sorted sections (the oracle check ignores order) and
typing of source tables."""

import json
import datetime as dt

import pytest

from scorecast.plans import extracts, status, usage
from scorecast.registry import CFG, _cat
from scorecast.sources.catalog import ParquetCatalog
from scorecast.sources.binding import ORDERS_AS_OF
from scorecast.sources.schema import conform

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def cat(spark):
    return _cat(spark, SF)


def test_clients_sorted_by_count_desc(cat):
    rows = usage.results_by_client(cat, ORDERS_AS_OF, CFG).collect()
    order = {p: i for i, p in enumerate(CFG.period_labels)}
    keys = [(order[r.period], -r.TotalResults, r.State, r.District) for r in rows]
    assert keys == sorted(keys)


def test_days_sorted_by_date(cat):
    rows = usage.results_by_date(cat, ORDERS_AS_OF, CFG).collect()
    order = {p: i for i, p in enumerate(CFG.period_labels)}
    keys = [(order[r.period], dt.datetime.strptime(r.Date, "%m/%d/%Y")) for r in rows]
    assert keys == sorted(keys)


def test_detail_newest_first_per_district(cat):
    rows = extracts.local_benchmark_detail(cat, None, CFG).select("DistrictID", "ResultDate").collect()
    keys = [(r.DistrictID, -dt.datetime.strptime(r.ResultDate, "%m/%d/%Y").toordinal()) for r in rows]
    assert keys == sorted(keys)


def test_roster_order(cat):
    rows = status.status_roster(cat, None, CFG).collect()
    keys = [tuple("" if v is None else v for v in (r.DistrictID, r.School, r.Grade, r.LastName, r.FirstName, r.Code))
            for r in rows]
    # NULLs sort first, as in the original
    assert keys == sorted(keys)


def test_conform_casts_declared_columns(spark):
    df = spark.createDataFrame([(1, "2018-03-05 02:15:00", "x")], "TestResultID int, UpdatedDate string, extra string")
    out = dict(conform(df, "TestResult").dtypes)
    assert out == {"TestResultID": "bigint", "UpdatedDate": "timestamp_ntz", "extra": "string"}


def test_parquet_catalog_reads_written_tables(spark, tmp_path):
    cat = _cat(spark, "/root/testdata/sf0.001")
    cat["District"].write.parquet(str(tmp_path / "District"))
    pc = ParquetCatalog(spark, str(tmp_path), typed=True)
    assert pc["District"].count() == 25
    assert dict(pc["District"].dtypes)["DistrictID"] == "bigint"


def test_typed_read_sets_rows_apart(spark):
    from scorecast.sources.schema import typed
    rows = [("1", "2018-03-07 10:00:00", "7", "x"), ("2", "not a date", "8", "y"), ("3", None, None, "z"), ("four", "2018-02-30", "99999999999999999999", "w"),
            (None, "2018-03-08", "", "v")]
    df = spark.createDataFrame(rows, "TestResultID string, UpdatedDate string, StudentID string, Other string")
    got = typed(df, "TestResult")
    good = got.good.collect()
    assert got.counts.get == {"rows": 5, "rejected": 3}
    assert dict(got.good.dtypes) == {"TestResultID": "bigint", "UpdatedDate": "timestamp_ntz", "StudentID": "bigint", "Other": "string"}
    assert [(r["TestResultID"], r["StudentID"], r["Other"]) for r in good] == [(1, 7, "x"), (3, None, "z")]
    bad = {json.loads(r["row"])["Other"]: set(r["columns"]) for r in got.rejects.collect()}
    assert bad == {"y": {"UpdatedDate"}, "w": {"TestResultID", "UpdatedDate", "StudentID"}, "v": {"StudentID"}}
    same = typed(got.good, "TestResult")
    assert same.rejects.count() == 0 and same.good.count() == 2
