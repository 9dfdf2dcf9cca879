"""Workbooks: every cell comes back, in order; large files and sheets go on."""

import datetime as dt
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from scorecast.plans import reports
from scorecast.registry import CFG, _cat
from scorecast.sources import workbook as W
from scorecast.sources.sinks import Sheet
from scorecast.sources.versions import current

KINDS = "id long, text string, x double, n decimal(12,3), ok boolean, day date, at timestamp_ntz, District int"
ODD = [None, "", " a  b ", "<&>\"'", "line\nline\r\n\ttab", "\x00\x1f", "_x0041_", "é😀", "=1+1", "x" * 40_000]


def rows(n):
    return [(i, ODD[i % len(ODD)], [None, 0.1, -1e300, float("inf"), 3.0][i % 5], None if i % 4 == 0 else i * 0 + __import__("decimal").Decimal("12.345"),
             [None, True, False][i % 3], None if i % 6 == 0 else dt.date(1901 + i % 200, 2, 1 + i % 28),
             None if i % 7 == 0 else dt.datetime(2018, 3, 7, i % 24, i % 60, 59, 123000), [None, 5, 7, 5][i % 4]) for i in range(n)]


def frame(spark, n):
    return spark.createDataFrame(rows(n), KINDS).repartition(4)


def test_every_cell_comes_back(spark, tmp_path):
    df = frame(spark, 60)
    W.write_workbooks({"All: of/it": Sheet(df, (F.desc("id"),)), "Empty": df.limit(0), "Guarded": df.limit(0)}, str(tmp_path / "w"), skip_if_empty=("Guarded",))
    assert os.listdir(tmp_path / "w") == ["report.xlsx"]
    got = W.read_sheet(spark, str(tmp_path / "w"), "All: of/it", df.schema).collect()
    assert [tuple(r) for r in got] == rows(60)[::-1]
    with zipfile.ZipFile(tmp_path / "w" / "report.xlsx") as z:
        assert z.testzip() is None
        book = z.read("xl/workbook.xml").decode()
        assert 'name="All_ of_it"' in book and 'name="Empty"' in book and "Guarded" not in book
        from xml.etree.ElementTree import fromstring
        for name in z.namelist():
            if name.endswith((".xml", ".rels")):
                fromstring(z.read(name))


def test_a_workbook_a_district_in_order(spark, tmp_path):
    df = frame(spark, 400)
    extra = spark.createDataFrame([(5, "a"), (9, "b")], "District int, note string")
    out = str(tmp_path / "w")
    W.write_workbooks({"Rows": Sheet(df, ("id",)), "Notes": extra}, out, "District", sheet_rows=30, file_rows=60)
    W.register(spark)
    read = spark.read.format("workbook").load(out).collect()
    files = {r["file"].split(" (")[0] for r in read}
    assert files == {"5", "7", "9", "null"} and len(os.listdir(out)) > 4       # the large one in several files
    want = {str(d): [r[0] for r in rows(400) if r[7] == d] for d in (5, 7)} | {"null": [r[0] for r in rows(400) if r[7] is None]}
    for file, ids in want.items():
        parts = {}
        for r in read:
            if r["file"].split(" (")[0] == file and r["sheet"] == "Rows" and r["row"] > 0:
                parts.setdefault(r["file"], []).append(int(r["cells"][0]))
        assert all(p == sorted(p) for p in parts.values())
        assert sorted(x for p in parts.values() for x in p) == ids
    assert sorted(tuple(r) for r in W.read_sheet(spark, out, "Notes", extra.schema).collect()) == [(5, "a"), (9, "b")]


def test_failed_write_leaves_no_file(spark, tmp_path):
    bad = spark.range(20).select(F.expr("if(id = 13, raise_error('no'), id)").alias("a"))
    with pytest.raises(Exception):
        W.write_workbooks({"A": bad}, str(tmp_path / "w"))
    assert not os.path.exists(tmp_path / "w") or os.listdir(tmp_path / "w") == []


def test_names():
    assert W.sheet_names(["# of Results by Date (excluding clients)", "# of Results by Date (excluding others)", "a/b", "A_B", ""]) == [
        "# of Results by Date (excluding", "# of Results by Date (exclu (2)", "a_b", "A_B (2)", "Sheet"]
    assert len({W.file_name(x) for x in ("St. Mary", "St/ Mary", "St: Mary", "x" * 400, "x" * 401)}) == 5


def test_reports_as_workbooks(spark, tmp_path):
    cat = _cat(spark, SF_SMALL)
    written = reports.run("parcc", cat, str(tmp_path), cfg=CFG, fmt="xlsx")[""]
    out = written.rsplit("/versions/", 1)[0]
    assert current(spark, out) == written
    score = reports.parcc_extract(cat, None, CFG)["Score"]
    n = score.groupBy("DistrictID").count().count()
    files = [f for f in os.listdir(written) if f.endswith(".xlsx")]
    assert len(files) >= n > 1
    assert W.read_sheet(spark, written, "Score", score.schema).count() == score.count()
    reports.run("status", cat, str(tmp_path), cfg=CFG, fmt="xlsx", district_id=5, form="A", as_of=dt.date(1998, 6, 17))
