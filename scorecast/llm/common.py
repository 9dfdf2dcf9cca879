"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
import io
import os
import tempfile
import uuid
import zipfile
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

# the characters [\x20\x09-\x0D], the only white space of this package
SPACES = " \t\n\x0b\x0c\r"

#: A Bloom filter never takes more than this many bits (32 MB), whatever the
#: input.  Beyond it more rows pass by mistake, and an exact step follows.
MAX_BLOOM_BITS = 1 << 28
_BUCKET = 1 << 15  # bits in one row of a filter (4 KB)


_SHIPPED: dict = {}
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers: its sources go to
    the executors once per application, as with ``--py-files``."""
    sc = spark.sparkContext
    # texts travel in batches of a bounded size, however long they are; a value
    # that the session sets itself stays
    if spark.conf.get(_BATCH) == "67108864b":
        spark.conf.set(_BATCH, "8m")
    if _SHIPPED.get(sc.applicationId):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    top = os.path.dirname(here)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for folder in (top, here):
            for name in sorted(os.listdir(folder)):
                if name.endswith(".py") and (folder == here or name in ("__init__.py", "session.py")):
                    path = os.path.join(folder, name)
                    with open(path) as f:
                        z.writestr(zipfile.ZipInfo(os.path.relpath(path, os.path.dirname(top))), f.read())
    path = os.path.join(tempfile.mkdtemp(), f"scorecast_llm_{zlib.crc32(buf.getvalue()):08x}.zip")
    with open(path, "wb") as f:
        f.write(buf.getvalue())
    sc.addPyFile(path)
    _SHIPPED[sc.applicationId] = True


_HELD: dict = {}


def held(key, make):
    """What ``make()`` gives, kept in this Python worker for its next tasks:
    one object at a time, whichever operator it belongs to."""
    if key not in _HELD:
        let_go()
        _HELD[key] = make()
    return _HELD[key]


def let_go() -> None:
    """Called by tasks that keep nothing, so that a reused worker does not hold
    the tables and freed memory of another operator."""
    _HELD.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):      # another C library
        pass


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared checkpoint folder (reliable
    checkpoint: it survives lost executors, and its files go away once the
    frame is no longer referenced, if the session cleans checkpoints)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written as Parquet into a new shared folder and read again, and
    that folder, for the caller to drop once nothing reads the frame."""
    folder = scratch(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder), folder


def _hadoop(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def make_folder(spark: SparkSession, folder: str) -> None:
    fs, path = _hadoop(spark, folder)
    fs.mkdirs(path)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder that ``scratch`` named, with all in it."""
    fs, path = _hadoop(spark, folder)
    fs.delete(path, True)


def filesystem(folder: str):
    """(pyarrow file system, path) of a folder that executors share."""
    from pyarrow.fs import FileSystem, LocalFileSystem
    if folder.startswith("file:"):
        return LocalFileSystem(), "/" + folder[5:].lstrip("/")
    return FileSystem.from_uri(folder) if "://" in folder else (LocalFileSystem(), folder)


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def bloom_bits(n_rows: int, bits_per_row: int = 16) -> int:
    """A power of two near ``bits_per_row * n_rows``, within the bounds."""
    bits = _BUCKET
    while bits < n_rows * bits_per_row and bits < MAX_BLOOM_BITS:
        bits *= 2
    return bits


def _cells(key: Column, bits: int) -> tuple[Column, Column, Column]:
    """Block and two bit places of a 64-bit key: all bits of a key lie in
    one 4 KB block, so one lookup answers a probe."""
    h = F.xxhash64(key)
    return (F.pmod(h, F.lit(bits // _BUCKET)), F.pmod(F.shiftright(h, 20), F.lit(_BUCKET)),
            F.pmod(F.shiftright(h, 40), F.lit(_BUCKET)))


def bloom_of(keys: DataFrame, key: str, bits: int, at_least: int = 1) -> DataFrame:
    """Blocked Bloom filter of ``keys[key]`` as rows (block, bitmap); with
    ``at_least=2`` only cells that two or more rows hit are set.

    At most ``bits / 8`` bytes in all, so it may be broadcast."""
    block, p1, p2 = _cells(F.col(key), bits)
    cells = keys.select(F.explode(F.array(block * _BUCKET + p1, block * _BUCKET + p2)).alias("_cell"))
    if at_least > 1:
        # two rows of one key hit the same two cells, so both count twice;
        # a key whose two places coincide also does, and just shuffles
        cells = cells.groupBy("_cell").count().filter(F.col("count") >= at_least)
    return (cells.groupBy(F.expr(f"_cell div {_BUCKET}").alias("_block"))
            .agg(F.bitmap_construct_agg(F.col("_cell") % _BUCKET).alias("_bitmap")))


def _bit(bitmap: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (place % 8).cast("int")) == 1


def maybe_in(df: DataFrame, key: Column, bloom: DataFrame, bits: int, flag: str) -> DataFrame:
    """``df`` with the boolean ``flag``: false only if ``key`` is surely not
    in the filter.  The filter is broadcast: its size is bounded by ``bits``."""
    block, p1, p2 = _cells(key, bits)
    hit = _bit(F.col("_bitmap"), F.col("_p1")) & _bit(F.col("_bitmap"), F.col("_p2"))
    return (df.withColumns({"_b": block, "_p1": p1, "_p2": p2})
            .join(F.broadcast(bloom), F.col("_b") == F.col("_block"), "left")
            .withColumn(flag, F.coalesce(hit, F.lit(False)))
            .drop("_b", "_p1", "_p2", "_block", "_bitmap"))


def without(df: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose ``key`` is not in ``gone[key]``, columns
    unchanged.  Rows outside a Bloom filter of the keys pass straight through;
    the others are checked by an anti join.  Null keys stay."""
    bits = bloom_bits(gone.count())
    gone = gone.select(F.col(key).alias("key"))
    # the row as one value, so that its names clash with nothing here
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(key).alias("key"))
    marked = maybe_in(rows, F.xxhash64("key"), bloom_of(gone.select(F.xxhash64("key").alias("h")), "h", bits), bits, "maybe")
    asked = marked.filter("maybe").join(gone, "key", "left_anti")
    return marked.filter("not maybe").select("row.*").unionByName(asked.select("row.*"))


def named_rows(df: DataFrame, id_col: str, text_col: str, name: str) -> DataFrame:
    """``df`` with a column ``name`` that tells rows apart: the id (a long)
    where it is the only one of its kind, else, for null and repeated ids, a
    hash of id and text below all usual ids.  Rows alike in both share it."""
    twice = cut(df.groupBy(F.col(id_col).alias("key")).count().filter("count > 1 and key is not null").select("key"))
    bits = bloom_bits(twice.count())
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(id_col).cast("long").alias("key"),
                     F.xxhash64(F.col(id_col), F.lit(7), F.col(text_col)).alias("hash"))
    marked = maybe_in(rows, F.xxhash64("key"), bloom_of(twice.select(F.xxhash64("key").alias("h")), "h", bits), bits, "maybe")
    hashed = F.col("hash").bitwiseOR(F.lit(-(1 << 63)))           # always negative
    sure = marked.filter(~F.col("maybe")).select("row.*", F.coalesce("key", hashed).alias(name))
    asked = marked.filter("maybe").join(twice.withColumn("again", F.lit(True)), "key", "left").select(
        "row.*", F.when(F.col("again"), hashed).otherwise(F.coalesce("key", hashed)).alias(name))
    return sure.unionByName(asked)


def attach(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int,
           parts: int = 10_000) -> DataFrame:
    """Left join of ``rows`` with one-row-per-key ``groups``, safe for hot keys.

    A group whose ``size`` is over ``total / parts`` rows is hot.  At most
    ``parts`` groups can be, so they are broadcast; all others meet their
    rows in a shuffle where no key holds more than ``1 / parts`` of them."""
    limit = max(1000, total // parts)
    hot = groups.filter(F.col(size) > limit)
    mark = hot.select(*keys, F.lit(True).alias("_hot"))
    tagged = rows.join(F.broadcast(mark), keys, "left")
    a = tagged.filter(F.col("_hot")).drop("_hot").join(F.broadcast(hot), keys, "left")
    b = tagged.filter(F.col("_hot").isNull()).drop("_hot").join(groups.filter(F.col(size) <= limit), keys, "left")
    return a.unionByName(b)


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with the column ``_rank``: 1, 2, 3... in the order given, over
    all rows, with no window over the whole table.

    Rows are cut into ranges by a sampled range partitioning, sorted inside
    and checkpointed, so that places inside a range are fixed; the driver sees
    one count a partition."""
    placed = cut(df.repartitionByRange(*order).sortWithinPartitions(*order))
    placed = placed.withColumn("_at", F.monotonically_increasing_id())
    part, inside = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    ahead, before = [], 0
    for p, n in sorted(tuple(r) for r in placed.groupBy(part.alias("p")).count().collect()):
        ahead.append((p, before))
        before += n
    starts = df.sparkSession.createDataFrame(ahead, "_part long, _ahead long")
    return (placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
            .withColumn("_rank", F.col("_ahead") + inside + 1).drop("_part", "_ahead", "_at"))
