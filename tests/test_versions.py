"""A report is replaced in one step: wherever a run stops, readers see the old
one whole or the new one whole."""

import os

import pytest

from scorecast.sources import versions
from scorecast.sources.sinks import write_report, write_sheets


def sheets(spark, n):
    return {"One": spark.range(n).toDF("a"), "Two": spark.range(n * 2).toDF("b")}


def seen(spark, out):
    return versions.read_sheet(spark, out, "One").count(), versions.read_sheet(spark, out, "Two").count()


def test_readers_follow_the_pointer(spark, tmp_path):
    out = str(tmp_path / "r")
    with pytest.raises(FileNotFoundError):
        versions.current(spark, out)
    for n in (3, 4, 5, 6):
        before = versions.current(spark, out) if n > 3 else None
        versions.publish(spark, out, lambda folder: write_sheets(sheets(spark, n), folder))
        assert seen(spark, out) == (n, 2 * n)
        assert before is None or os.path.isdir(before)              # a reader of the last one can finish
    assert len(os.listdir(f"{out}/versions")) == versions.KEEP
    assert sorted(x for x in os.listdir(out) if not x.startswith(".")) == ["CURRENT", "versions"]


@pytest.mark.parametrize("step", ["first sheet", "all sheets", "switch", "prune"])
def test_a_run_that_stops_anywhere(spark, tmp_path, monkeypatch, step):
    out = str(tmp_path / "r")
    versions.publish(spark, out, lambda folder: write_sheets(sheets(spark, 3), folder))

    def stop(*a, **k):
        raise KeyboardInterrupt(step)

    def write(folder):
        new = sheets(spark, 7)
        write_sheets({"One": new["One"]}, folder)
        if step == "first sheet":
            stop()
        write_sheets({"Two": new["Two"]}, folder)
        if step == "all sheets":
            stop()
    if step in ("switch", "prune"):
        monkeypatch.setattr(versions, f"_{step}", stop)
    with pytest.raises(KeyboardInterrupt):
        versions.publish(spark, out, write)
    assert seen(spark, out) == ((7, 14) if step == "prune" else (3, 6))
    monkeypatch.undo()
    versions.publish(spark, out, lambda folder: write_sheets(sheets(spark, 9), folder))
    assert seen(spark, out) == (9, 18)


def test_plain_folders_come_back_after_a_failure(spark, tmp_path):
    out = str(tmp_path / "r")
    write_report(sheets(spark, 3), out)
    with pytest.raises(Exception):
        write_report({**sheets(spark, 5), "Bad": spark.range(3).selectExpr("raise_error('no') AS a")}, out)
    assert spark.read.parquet(f"{out}/One").count() == 3 and os.listdir(tmp_path) == ["r"]
