"""Written reports: nothing stale, the order kept in the files, one write."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from scorecast.plans import reports
from scorecast.registry import CFG, _cat
from scorecast.sources.sinks import Sheet, write_report


def test_empty_rerun_leaves_nothing(spark, tmp_path):
    out = str(tmp_path / "report")
    full, none = spark.range(5).toDF("a"), spark.range(0).toDF("a")
    for fmt in ("parquet", "csv"):
        assert set(write_report({"One": full, "Two": full}, out, fmt, skip_if_empty=("One",))) == {"One", "Two"}
        assert os.path.isdir(f"{out}/One")
        assert set(write_report({"One": none, "Two": none}, out, fmt, skip_if_empty=("One",))) == {"Two"}
        assert sorted(x for x in os.listdir(out) if not x.startswith(".")) == ["Two"]
    assert os.listdir(tmp_path) == ["report"]
    by = {"One": ["a"]}
    assert write_report({"One": none.withColumn("b", F.lit(1))}, out, skip_if_empty=("One",), partition_by=by) == {}


def _files(path):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.startswith("part-")]


def test_all_district_sheets_are_in_order_in_every_file(spark, tmp_path):
    import datetime as dt
    written = reports.run("benchmark", _cat(spark, SF_SMALL), str(tmp_path), cfg=CFG)
    files = _files(written["Local Benchmarks"])
    assert files
    for f in files:
        days = [dt.datetime.strptime(r[0], "%m/%d/%Y") for r in spark.read.parquet(f).select("ResultDate").collect()]
        assert days == sorted(days, reverse=True), f
    for d in ("Gender", "Race", "Program"):
        for f in _files(written[f"Standards by {d}"]):
            keys = [tuple(r) for r in spark.read.parquet(f).select("School", "TestName", "Number", d).collect()]
            assert keys == sorted(keys), f


def test_no_global_sort_under_the_rebalance(spark):
    sheet = Sheet(spark.range(10).select((F.col("id") % 2).alias("k"), F.col("id").alias("_id")), (F.desc("_id"),))
    plan = sheet.frame_by(["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan and "true\n" not in [x for x in plan.split("\n") if "Sort" in x]
    assert plan.index("Sort") < plan.index("RebalancePartitions") and plan.count("Sort") == 1
    assert sheet.frame_by(["k"]).columns == ["k"]


def test_districts_that_differ_in_punctuation_have_their_own_folder():
    from scorecast.sources.sinks import report_path
    a, b = (report_path("/r", "{district} Form", district=f"{i} {n}") for i, n in ((1, "St. Mary"), (2, "St Mary")))
    assert a != b
