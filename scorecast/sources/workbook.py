"""Spreadsheet workbooks as a Spark data source (``format("workbook")``).

Writing: all sheets of a report become one frame of rows (file, sheet, order,
cells).  Rows are dealt by file and sorted, and each task streams its rows into
one zip archive after the other, sheet by sheet, so a task holds one row at a
time.  Tasks write under names of their own; the commit moves the files of the
attempts that count into place, an abort removes the others.  A file whose
sheets have very many rows is cut into numbered files, written by several
tasks; a sheet that is longer than a sheet may be goes on in the next one.

Reading: one task a file, rows in order as (file, sheet, row, cells).

Cells are text, numbers, booleans, dates or times (to the millisecond); a
null is an empty cell.  Paths are any that ``pyarrow.fs`` knows.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import sys
import uuid
import zipfile
import zlib
from dataclasses import dataclass, field
from xml.sax.saxutils import escape

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .sinks import Sheet, drop_path, materialize

SHEET_ROWS = 1_048_575       # rows of a sheet below its header, as spreadsheet programs allow
FILE_ROWS = 1_000_000        # rows of a sheet in one file, about

_CELLS = "array<struct<kind:string,value:string>>"
ROWS = "file string, sheet string, row long, cells array<string>"

# Fixed parts of the format.
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_DOC = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_TYPE = "application/vnd.openxmlformats-officedocument.spreadsheetml"
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
_STYLES = (f'{_HEAD}<styleSheet xmlns="{_MAIN}"><fonts count="1"><font/></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders>'
           '<cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="3"><xf/><xf numFmtId="14" applyNumberFormat="1"/>'
           '<xf numFmtId="22" applyNumberFormat="1"/></cellXfs></styleSheet>')
_DAY_ZERO = dt.date(1899, 12, 30)


def _filesystem(path: str):
    from pyarrow.fs import FileSystem, LocalFileSystem
    if path.startswith("file:"):
        return LocalFileSystem(), "/" + path[5:].lstrip("/")
    return FileSystem.from_uri(path) if "://" in path else (LocalFileSystem(), path)


_BAD = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]|_x[0-9A-Fa-f]{4}_")


def _text(value: str) -> str:
    """Text of a cell; what XML cannot hold is written as _xHHHH_."""
    if _BAD.search(value):
        value = _BAD.sub(lambda m: f"_x{ord(m[0]):04X}_" if len(m[0]) == 1 else "_x005F" + m[0], value)
    return escape(value).replace("\r", "&#13;")


_ESCAPED = re.compile("_x([0-9A-Fa-f]{4})_")


def _cell(kind: str, value: str | None) -> str:
    if value is None:
        return "<c/>"
    if kind == "n":
        return f"<c><v>{value}</v></c>"
    if kind == "b":
        return f'<c t="b"><v>{int(value == "true")}</v></c>'
    if kind == "d":
        return f'<c s="1"><v>{(dt.date.fromisoformat(value) - _DAY_ZERO).days}</v></c>'
    if kind == "t":
        at = dt.datetime.fromisoformat(value) - dt.datetime.combine(_DAY_ZERO, dt.time())
        return f'<c s="2"><v>{at / dt.timedelta(days=1)!r}</v></c>'
    return f'<c t="inlineStr"><is><t xml:space="preserve">{_text(value)}</t></is></c>'


def sheet_names(names: list[str]) -> list[str]:
    """Names that a workbook may hold: 31 characters, none of []:*?/\\, no two
    alike but for case."""
    out, seen = [], set()
    for name in names:
        base = re.sub(r"[\[\]:*?/\\]", "_", name).strip("'") or "Sheet"
        new, n = base[:31], 1
        while new.lower() in seen:
            n += 1
            new = f"{base[:31 - len(str(n)) - 3]} ({n})"
        seen.add(new.lower())
        out.append(new)
    return out


def file_name(name: str) -> str:
    """A file's name for a value of the column that tells files apart."""
    clean = re.sub(r"[^0-9A-Za-z ._-]+", "_", name).strip(" .") or "_"
    return clean[:150] if clean == name and len(name) <= 150 else f"{clean[:150]}-{zlib.crc32(name.encode()):08x}"


class _Workbook:
    """One archive while it is written.  ``sheets`` are (name, header, guarded)."""

    def __init__(self, stream, sheets: list, longest: int):
        self.zip = zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED, compresslevel=4)
        self.sheets, self.longest, self.entries, self.next = sheets, longest, [], 0
        self.part, self.now, self.n = None, -1, 0

    def row(self, sheet: int, cells: list) -> None:
        if sheet < 0:                      # only says that the file is there
            return
        if sheet != self.now or self.n == self.longest:
            if sheet != self.now:
                self._headers(sheet)
            self._open(sheet)
        self.n += 1
        self._put(cells)

    def _headers(self, before: int) -> None:
        """Sheets without rows are there with their header, unless guarded."""
        while self.next < before:
            if not self.sheets[self.next][2]:
                self._open(self.next)
            self.next += 1
        self.next = before + 1

    def _open(self, sheet: int) -> None:
        self._end()
        name, header, _ = self.sheets[sheet]
        self.entries.append(name)
        self.now, self.n = sheet, 0
        # force_zip64: the size is not known beforehand
        self.part = self.zip.open(f"xl/worksheets/sheet{len(self.entries)}.xml", "w", force_zip64=True)
        self.part.write(f'{_HEAD}<worksheet xmlns="{_MAIN}"><sheetData>'.encode())
        self._put([{"kind": "s", "value": c} for c in header])

    def _put(self, cells: list) -> None:
        self.part.write(("<row>" + "".join(_cell(c["kind"], c["value"]) for c in cells) + "</row>\n").encode("utf-8", "replace"))

    def _end(self) -> None:
        if self.part is not None:
            self.part.write(b"</sheetData></worksheet>")
            self.part.close()
            self.part = None

    def close(self) -> None:
        self._headers(len(self.sheets))
        if not self.entries:
            self._open(0)                  # a workbook has one sheet at least
        self._end()
        names, n = sheet_names(self.entries), len(self.entries)
        put = lambda path, text: self.zip.writestr(path, _HEAD + text)
        put("[Content_Types].xml", f'<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            '<Default Extension="xml" ContentType="application/xml"/>'
            f'<Override PartName="/xl/workbook.xml" ContentType="{_TYPE}.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="{_TYPE}.styles+xml"/>'
            + "".join(f'<Override PartName="/xl/worksheets/sheet{i + 1}.xml" ContentType="{_TYPE}.worksheet+xml"/>' for i in range(n)) + "</Types>")
        put("_rels/.rels", f'<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_DOC}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        put("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_DOC}"><sheets>' + "".join(
            f'<sheet name="{escape(x, {chr(34): "&quot;"})}" sheetId="{i + 1}" r:id="rId{i + 1}"/>' for i, x in enumerate(names)) + "</sheets></workbook>")
        put("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PACKAGE}/relationships">' + "".join(
            f'<Relationship Id="rId{i + 1}" Type="{_DOC}/worksheet" Target="worksheets/sheet{i + 1}.xml"/>' for i in range(n))
            + f'<Relationship Id="rId{n + 1}" Type="{_DOC}/styles" Target="styles.xml"/></Relationships>')
        self.zip.writestr("xl/styles.xml", _STYLES)
        # which sheet of the report each sheet belongs to
        self.zip.writestr("docProps/sheets.json", json.dumps(self.entries))
        self.zip.close()


@dataclass
class Written(WriterCommitMessage):
    files: list = field(default_factory=list)      # (temporary path, final name)


class WorkbookWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.path, self.sheets = options["path"].rstrip("/"), json.loads(options["sheets"])
        self.longest = int(options.get("sheet_rows", SHEET_ROWS))

    def write(self, iterator):
        fs, root = _filesystem(self.path)
        temporary, done = f"{root}/_temporary", []
        fs.create_dir(temporary, recursive=True)
        now = book = stream = None
        for batch in iterator:
            for file, part, sheet, cells in zip(*(batch.column(c).to_pylist() for c in ("file", "part", "sheet", "cells"))):
                if (file, part) != now:
                    if book is not None:
                        book.close()
                        stream.close()
                    now = (file, part)
                    at, name = f"{temporary}/{uuid.uuid4().hex}", file_name(file) + (f" ({part + 1})" if part else "")
                    done.append((at, f"{root}/{name}.xlsx"))
                    stream = fs.open_output_stream(at)
                    book = _Workbook(stream, self.sheets, self.longest)
                book.row(sheet, cells)
        if book is not None:
            book.close()
            stream.close()
        return Written(done)

    def commit(self, messages):
        fs, root = _filesystem(self.path)
        for message in messages:
            for at, name in message.files if message is not None else ():
                fs.move(at, name)
        fs.create_dir(f"{root}/_temporary", recursive=True)
        fs.delete_dir(f"{root}/_temporary")

    def abort(self, messages):
        fs, root = _filesystem(self.path)
        fs.create_dir(f"{root}/_temporary", recursive=True)
        fs.delete_dir(f"{root}/_temporary")


@dataclass
class _File(InputPartition):
    path: str


class WorkbookReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.sheet = options["path"].rstrip("/"), options.get("sheet")

    def partitions(self):
        from pyarrow.fs import FileSelector
        fs, root = _filesystem(self.path)
        return [_File(f.path) for f in sorted(fs.get_file_info(FileSelector(root)), key=lambda f: f.path) if f.path.endswith(".xlsx")] or [_File("")]

    def read(self, partition):
        if not partition.path:
            return
        fs, _ = _filesystem(self.path)
        file = partition.path.rsplit("/", 1)[-1][:-5]
        with fs.open_input_file(partition.path) as f, zipfile.ZipFile(f) as z:
            for i, name in enumerate(json.loads(z.read("docProps/sheets.json"))):
                if self.sheet in (None, name):
                    with z.open(f"xl/worksheets/sheet{i + 1}.xml") as part:
                        for n, cells in enumerate(_read_rows(part)):
                            yield file, name, n, cells


def _read_rows(part):
    from xml.etree.ElementTree import iterparse
    tag = f"{{{_MAIN}}}"
    for _, row in iterparse(part):
        if row.tag == f"{tag}row":
            yield [_value(c, tag) for c in row.iter(f"{tag}c")]
            row.clear()


def _value(c, tag: str):
    text = c.find(f"{tag}is/{tag}t")
    if text is not None:
        return _ESCAPED.sub(lambda m: chr(int(m[1], 16)), text.text or "")
    v = c.find(f"{tag}v")
    if v is None:
        return None
    if c.get("t") == "b":
        return "true" if v.text == "1" else "false"
    if c.get("s") == "1":
        return (_DAY_ZERO + dt.timedelta(days=int(v.text))).isoformat()
    if c.get("s") == "2":
        at = dt.datetime.combine(_DAY_ZERO, dt.time()) + dt.timedelta(milliseconds=round(float(v.text) * 86_400_000))
        return at.isoformat(" ")
    return v.text


class WorkbookSource(DataSource):
    @classmethod
    def name(cls):
        return "workbook"

    def schema(self):
        return ROWS

    def reader(self, schema):
        return WorkbookReader(dict(self.options))

    def writer(self, schema, overwrite):
        return WorkbookWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make the format known to the session.  The classes travel by value, so
    that executors need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(WorkbookSource)


def _cells(df: DataFrame, columns: list[str]) -> Column:
    def one(name: str) -> Column:
        kind, c = df.schema[name].dataType, F.col(f"`{name}`")
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            fine = c.isNull() | (~F.isnan(c) & (F.abs(c) < float("inf")))       # others have no number in a sheet
            return F.struct(F.when(fine, F.lit("n")).otherwise("s").alias("kind"), c.cast("string").alias("value"))
        k = ("n" if isinstance(kind, T.NumericType) else "b" if isinstance(kind, T.BooleanType) else "d" if isinstance(kind, T.DateType)
             else "t" if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else "s")
        return F.struct(F.lit(k).alias("kind"), c.cast("string").alias("value"))
    return F.array(*[one(c) for c in columns]).cast(_CELLS)


def write_workbooks(sheets: dict, out: str, file_by: str | None = None, file: str = "report", skip_if_empty: tuple = (),
                    sheet_rows: int = SHEET_ROWS, file_rows: int = FILE_ROWS) -> None:
    """Write ``{sheet name: DataFrame or Sheet}`` as workbooks into ``out``.

    With ``file_by`` each value of that column has a workbook of its own;
    sheets without the column, and all sheets without ``file_by``, go into the
    workbook ``file``.  Rows keep the order of their sheet.  A sheet without
    rows has its header only, or is missing if it is one of ``skip_if_empty``.
    A null value of ``file_by`` counts as the text "null"."""
    first = next(iter(sheets.values()))
    spark = (first.rows if isinstance(first, Sheet) else first).sparkSession
    register(spark)
    heads, parts, single = [], [], file_by is None
    for i, (name, sheet) in enumerate(sheets.items()):
        df = sheet.frame() if isinstance(sheet, Sheet) else sheet
        heads.append((name, df.columns, name in skip_if_empty))
        own = file_by is not None and file_by in df.columns
        single |= not own
        label = F.coalesce(F.col(f"`{file_by}`").cast("string"), F.lit("null")) if own else F.lit(file)
        # the frame is in order, and so are these numbers
        parts.append(df.select(label.alias("file"), F.lit(i).alias("sheet"), F.monotonically_increasing_id().alias("ordinal"), _cells(df, df.columns).alias("cells")))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    rows = materialize(spark, rows)
    # rows of a file in runs of their order: cut where a file gets too long
    rows = rows.withColumn("run", F.expr(f"ordinal div {max(1, file_rows // 2)}L"))
    each = rows.groupBy("file", "sheet", "run").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("file", "sheet").orderBy("run")) - F.col("n")
    cuts = each.withColumn("part", F.floor(before / file_rows).cast("int")).filter("part > 0").select("file", "sheet", "run", "part")
    rows = (rows.join(cuts, ["file", "sheet", "run"], "left")
            .select("file", F.coalesce("part", F.lit(0)).alias("part"), "sheet", "ordinal", "cells"))
    if single:                             # the workbook is there even without rows
        rows = rows.unionByName(spark.range(1).select(F.lit(file).alias("file"), F.lit(0).alias("part"), F.lit(-1).alias("sheet"),
                                                      F.lit(0).cast("long").alias("ordinal"), F.array().cast(_CELLS).alias("cells")))
    (rows.repartition("file", "part").sortWithinPartitions("file", "part", "sheet", "ordinal")
     .write.format("workbook").mode("append").option("sheets", json.dumps(heads)).option("sheet_rows", sheet_rows).save(out))


def read_sheet(spark: SparkSession, path: str, sheet: str, schema: T.StructType) -> DataFrame:
    """The rows of one sheet of all workbooks in ``path``, columns by place,
    cast to ``schema``; parts of a sheet in later files and sheets included."""
    register(spark)
    rows = spark.read.format("workbook").option("sheet", sheet).load(path).filter("row > 0")
    return rows.select(*[F.get("cells", F.lit(i)).cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])


def round_trip(sheets: dict, sheet: str, file_by: str | None = None) -> DataFrame:
    """A report written as workbooks into the shared folder, one of its sheets
    read back from them."""
    from ..session import checkpoint_dir
    frame = sheets[sheet].rows.select(*sheets[sheet].columns()) if isinstance(sheets[sheet], Sheet) else sheets[sheet]
    spark = frame.sparkSession
    out = f"{checkpoint_dir(spark).rstrip('/')}/workbooks-{uuid.uuid4().hex}"
    write_workbooks(sheets, out, file_by)
    back = materialize(spark, read_sheet(spark, out, sheet, frame.schema))
    drop_path(spark, out)
    return back
