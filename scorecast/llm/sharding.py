"""Sharding by proportional stratified interleaving, DataFrame functions only.

Rows are shuffled by a seeded hash within each source and ranked there; row
``r`` of the ``n`` rows of a source gets the fractional rank ``(r - 1/2) / n``.
Sorted by fractional rank, any contiguous run of rows has the mixture of the
whole, so the sorted order is cut into shards of equal row counts.

No window ever holds a source or the whole table.  Ranks come from two
levels: each source is split into hash buckets whose row counts are summed up
to offsets, and rows are numbered inside a bucket.  The order by fractional
rank is split the same way into ranges; how many rows lie before a range
follows from the sources' sizes by integer arithmetic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, text_or_empty

ROWS_PER_BUCKET = 20_000


def shard(docs: DataFrame, n_shards: int = 40, seed: int = 17, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: id, size, text_crc32, shard, slot.

    Shard sizes differ by one row at most, and each shard has every source's
    share up to one row.  ``size`` is the text's UTF-8 bytes (null: 0) plus
    16.  A null source is a source of its own.  Repeated rows each get a slot;
    rows that tie in hash and id are alike, so their order does not matter.
    Empty texts and extra columns change nothing; an empty table gives no rows.
    """
    h = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("")))), 1, 15), 16, 10).cast("long")
    key = F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit("null"))
    n_rows = docs.count()
    n_buckets = max(1, -(-n_rows // ROWS_PER_BUCKET))
    span = -(-(1 << 60) // n_buckets)
    bucket = F.expr(f"_h div {span}L")
    text = text_or_empty(text_col)
    rows = (docs.select(key.alias("_source"), h.alias("_h"), F.col(id_col).alias("_id"),
                        (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
            .withColumn("_bucket", bucket))

    # 1. rank within the source
    counts = cut(docs.select(key.alias("_source"), h.alias("_h")).withColumn("_bucket", bucket)
                 .groupBy("_source", "_bucket").agg(F.count(F.lit(1)).alias("_n")))
    by_source = Window.partitionBy("_source")
    offsets = counts.select(
        "_source", "_bucket", F.sum("_n").over(by_source).alias("_total"),
        (F.sum("_n").over(by_source.orderBy("_bucket")) - F.col("_n")).alias("_before"))
    inside = Window.partitionBy("_source", "_bucket").orderBy("_h", F.col("_id").asc_nulls_last(), "text_crc32", "size")
    ranked = rows.join(offsets, ["_source", "_bucket"]).withColumn("_rank", F.col("_before") + F.row_number().over(inside))

    # 2. place in the order by fractional rank (2 r - 1) / (2 n)
    ranked = ranked.withColumn("_range", F.expr(f"((2 * _rank - 1) * {n_buckets}L) div (2 * _total)"))
    sizes = counts.groupBy("_source").agg(F.sum("_n").alias("_total"))
    # rows of a source before range k: ceil(2 n k / ranges) div 2
    before = lambda k: f"(((2 * _total * {k} + {n_buckets - 1}L) div {n_buckets}L) div 2)"
    large = (sizes.filter(F.col("_total") >= n_buckets)
             .select("_total", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_buckets - 1).cast("long"))).alias("_range"))
             .select("_range", F.expr(f"{before('(_range + 1)')} - {before('_range')}").alias("_n")))
    small = (sizes.filter(F.col("_total") < n_buckets)
             .select("_total", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_total"))).alias("_r"))
             .select(F.expr(f"((2 * _r - 1) * {n_buckets}L) div (2 * _total)").alias("_range"), F.lit(1).cast("long").alias("_n")))
    ranges = large.unionByName(small).groupBy("_range").agg(F.sum("_n").alias("_n"))
    # one row per range: n_rows / ROWS_PER_BUCKET of them
    ranges = ranges.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_ahead"))
    order = Window.partitionBy("_range").orderBy(
        (2 * F.col("_rank") - 1) / (2 * F.col("_total")).cast("double"), "_source", "_rank")
    placed = ranked.join(ranges, "_range").withColumn("_place", F.col("_ahead") + F.row_number().over(order) - 1)

    # 3. cut: shard s holds the places from ceil(s n / shards)
    shard_no = F.expr(f"(_place * {n_shards}L) div {max(n_rows, 1)}L")
    start = F.expr(f"(shard * {max(n_rows, 1)}L + {n_shards - 1}L) div {n_shards}L")
    return (placed.withColumn("shard", shard_no.cast("int")).withColumn("slot", F.col("_place") - start)
            .select(F.col("_id").alias(id_col), "size", "text_crc32", "shard", F.col("slot").cast("long")))
