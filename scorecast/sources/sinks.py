"""Report sinks: a report is a set of named tables written side by side.

The original wrote spreadsheet workbooks (one sheet per section).  Here a
report ``{sheet name: DataFrame or Sheet}`` is written as one folder per sheet
under the report folder (Parquet by default, CSV with a header row as an
option).  A run writes a fresh folder beside the old one and then takes its
place, so a report never holds a sheet of an earlier run.  Each sheet is
written once, by the executors in parallel; nothing is collected.
"""

from __future__ import annotations

import os
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir


@dataclass(frozen=True)
class Sheet:
    """Rows with the order of the report; columns named with a leading
    underscore only sort."""

    rows: DataFrame
    order: tuple

    def columns(self) -> list[str]:
        return [c for c in self.rows.columns if not c.startswith("_")]

    def frame(self) -> DataFrame:
        """All rows in order."""
        return self.rows.orderBy(*self.order).select(*self.columns())

    def frame_by(self, cols: list[str]) -> DataFrame:
        """Gathered by ``cols`` and in order inside every task.

        REBALANCE: AQE gathers each value into few, evenly sized tasks (few
        files per folder) and splits a value that is too large for one task.
        The sort is the last step, so the order reaches the files, and there
        is no global sort below that the exchange would undo."""
        return self.rows.hint("rebalance", *cols).sortWithinPartitions(*cols, *self.order).select(*self.columns())


def sheet_folder(name: str) -> str:
    """Folder name for a sheet title ('# of Results by Date' ->
    'of_Results_by_Date')."""
    s = re.sub(r"[^0-9A-Za-z]+", "_", name).strip("_")
    return s or "sheet"


def report_path(root: str, template: str, **params) -> str:
    """Output location from a name template, e.g.
    ``report_path(root, "{district} Form {form} Benchmark Status {date}", ...)``."""
    return os.path.join(root, sheet_folder(template.format(**params)))


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) as Hadoop has them."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def drop_path(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


def write_report(sheets: dict, out: str, fmt: str = "parquet", skip_if_empty: tuple = (),
                 partition_by: dict | None = None) -> dict[str, str]:
    """Write every sheet and put the report in the place of an earlier one.

    Sheets named in ``skip_if_empty`` are there only if they have a row; the
    written files tell (a read of the first rows), so no sheet is computed
    twice or kept aside.  ``partition_by`` maps a sheet to partition columns
    (e.g. DistrictID for an all-districts extract, so each district's rows
    sit in their own folder, in the sheet's order).  Returns {sheet: path}."""
    if not sheets:
        return {}
    some = next(iter(sheets.values()))
    spark, fresh = (some.rows if isinstance(some, Sheet) else some).sparkSession, f"{out.rstrip('/')}._{uuid.uuid4().hex}"
    try:
        written = write_sheets(sheets, fresh, fmt, skip_if_empty, partition_by)
        _replace(spark, fresh, out)
    except BaseException:
        drop_path(spark, fresh)
        raise
    return {name: os.path.join(out, folder) for name, folder in written.items()}


def _replace(spark: SparkSession, fresh: str, out: str) -> None:
    """Put ``fresh`` in the place of ``out``.  The old report is set aside and
    comes back if the new one cannot take its place (``versions.publish`` has no
    moment without a report)."""
    fs, target = hadoop_path(spark, out)
    _, source = hadoop_path(spark, fresh)
    _, aside = hadoop_path(spark, f"{fresh}.old")
    fs.mkdirs(source)
    fs.mkdirs(target.getParent())
    old = fs.exists(target)
    if old and not fs.rename(target, aside):
        raise OSError(f"could not set {out} aside")
    if not fs.rename(source, target):
        if old:
            fs.rename(aside, target)
        raise OSError(f"could not move {fresh} to {out}")
    if old:
        fs.delete(aside, True)


def write_sheets(sheets: dict, fresh: str, fmt: str = "parquet", skip_if_empty: tuple = (), partition_by: dict | None = None) -> dict[str, str]:
    """Write every sheet into a new folder: {sheet: its folder there}."""
    written = {}
    for name, sheet in sheets.items():
        cols = (partition_by or {}).get(name)
        if isinstance(sheet, Sheet):
            df = sheet.frame_by(cols) if cols else sheet.frame()
        else:
            df = sheet.hint("rebalance", *cols) if cols else sheet
        spark = df.sparkSession
        folder = sheet_folder(name)
        path = os.path.join(fresh, folder)
        w = df.write.partitionBy(*cols) if cols else df.write
        (w.option("header", True) if fmt == "csv" else w).format(fmt).save(path)
        if name in skip_if_empty and spark.read.schema(df.schema).format(fmt).option("header", True).load(path).isEmpty():
            drop_path(spark, path)
            continue
        written[name] = folder
    return written


def materialize(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder
    (``spark.checkpoint.dir``) and return a DataFrame that reads it.

    Cuts the lineage of a table several report sections read: each section
    starts from the checkpointed files (on storage every executor reaches),
    so a lost executor never forces the upstream scan and joins to re-run.
    With ``spark.cleaner.referenceTracking.cleanCheckpoints`` the files go
    away once the DataFrame is no longer referenced."""
    checkpoint_dir(spark)
    return df.checkpoint(eager=True)
