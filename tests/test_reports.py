"""Report runners and sinks on the sf0.001 binding."""

import tempfile

from scorecast.plans import reports, usage
from scorecast.registry import CFG, _cat
from scorecast.sources.binding import ORDERS_AS_OF
from scorecast.sources.schema import check_catalog

from conftest import SF_SMALL


def test_binding_has_every_logical_column(spark):
    assert check_catalog(_cat(spark, SF_SMALL)) == {}


def test_usage_report_written_equals_direct(spark):
    cat = _cat(spark, SF_SMALL)
    out = tempfile.mkdtemp(prefix="scorecast-test-")
    written = reports.run("usage", cat, out, as_of=ORDERS_AS_OF, cfg=CFG)
    assert len(written) == 11
    got = spark.read.parquet(written["# of Results by Client"])
    direct = usage.results_by_client(cat, ORDERS_AS_OF, CFG)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, direct.collect()))


def test_district_extract_and_status(spark):
    cat = _cat(spark, SF_SMALL)
    out = tempfile.mkdtemp(prefix="scorecast-test-")
    written = reports.run("benchmark", cat, out, district_id=8, cfg=CFG)
    assert "Gender" in written and "Standards by Program" in written
    # district 8 is in region 3: not the binding's PARCC state, so the
    # state-test sheet is named after the other test
    assert "PSSA" in written and "Form_B_Data_2017_18" in written["Gender"]
    for name, path in written.items():
        ids = {r.DistrictID for r in spark.read.parquet(path).select("DistrictID").distinct().collect()}
        assert ids <= {8}, name
    st = reports.run("status", cat, out, district_id=8, form="A", cfg=CFG)
    df = spark.read.parquet(st["Students"])
    assert set(df.columns) >= {"Code", "ELA", "Math"}
    assert {r.ELA for r in df.collect()} <= {"Yes", "No"}


def test_all_district_extract_is_partitioned_by_district(spark):
    cat = _cat(spark, SF_SMALL)
    out = tempfile.mkdtemp(prefix="scorecast-test-")
    written = reports.run("parcc", cat, out, cfg=CFG)
    import os
    parts = os.listdir(written["Score"])
    assert any(p.startswith("DistrictID=") for p in parts)


def test_command_line(spark, capsys):
    import json
    from scorecast.__main__ import main
    out = tempfile.mkdtemp(prefix="scorecast-cli-")
    main(["parcc", "--binding", SF_SMALL, "--out", out, "--district", "8", "--format", "csv"])
    written = json.loads(capsys.readouterr().out)
    assert set(written) == {"Score", "Cluster", "Gender", "Race", "Program"}
    df = spark.read.option("header", True).csv(written["Gender"])
    assert "StudentID" in df.columns
