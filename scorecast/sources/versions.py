"""Reports that are replaced in one step.

A report lives in ``out``: every run writes a folder of its own below
``versions``, and the file ``CURRENT`` names the one that readers take.  It is
switched last, by an atomic rename over the old file (FileContext, OVERWRITE).
A reader sees the old report whole or the new one whole, wherever a run stops.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .sinks import drop_path, hadoop_path, sheet_folder

KEEP = 2      # versions that stay, so that readers of the last one can finish


def _pointer(spark: SparkSession, out: str):
    return hadoop_path(spark, f"{out.rstrip('/')}/CURRENT")


def current(spark: SparkSession, out: str) -> str:
    """The folder of the report that counts now."""
    fs, path = _pointer(spark, out)
    if not fs.exists(path):
        raise FileNotFoundError(f"no report in {out}")
    stream = fs.open(path)
    try:
        name = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    return f"{out.rstrip('/')}/versions/{name}"


def publish(spark: SparkSession, out: str, write: Callable[[str], None], keep: int = KEEP) -> str:
    """Let ``write`` fill a new folder, then make it the current one.  If it
    fails, its folder goes and the old report stays."""
    name = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    folder = f"{out.rstrip('/')}/versions/{name}"
    try:
        write(folder)
        _switch(spark, out, name)
    except BaseException:
        drop_path(spark, folder)
        raise
    _prune(spark, out, name, keep)
    return folder


def _switch(spark: SparkSession, out: str, name: str) -> None:
    fs, path = _pointer(spark, out)
    _, fresh = hadoop_path(spark, f"{out.rstrip('/')}/.current-{name}")
    stream = fs.create(fresh, True)
    stream.write(bytearray(name.encode()))
    stream.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(path).toUri(), spark._jsc.hadoopConfiguration())
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    context.rename(fresh, path, how)


def _prune(spark: SparkSession, out: str, name: str, keep: int) -> None:
    """Older versions beyond ``keep``; folders of runs that are not done are
    younger than the current one and stay."""
    fs, path = hadoop_path(spark, f"{out.rstrip('/')}/versions")
    old = sorted(f.getPath().getName() for f in fs.listStatus(path) if f.getPath().getName() <= name)
    for gone in old[:-keep]:
        drop_path(spark, f"{out.rstrip('/')}/versions/{gone}")


def read_sheet(spark: SparkSession, out: str, sheet: str, fmt: str = "parquet") -> DataFrame:
    """One sheet of the current report."""
    return spark.read.format(fmt).option("header", True).load(f"{current(spark, out)}/{sheet_folder(sheet)}")
