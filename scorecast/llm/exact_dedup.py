"""Exact dedup by two-pass Bloom filtering, with DataFrame functions only.

Pass 1 reads every text and counts the cells of a blocked Bloom filter that
its hash hits; cells hit twice make the filter of *possibly repeated* hashes.
Pass 2 reads every text again: rows outside the filter are unique and pass
straight through, without a shuffle; the others shuffle as narrow rows (key,
digest, length), never as texts, and are grouped exactly by digest.

The filter is broadcast.  Its size is 16 bits a row, never over 32 MB
(``common.MAX_BLOOM_BITS``); past that bound more unique rows take the exact
path by mistake, and the result is the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, attach, bloom_bits, bloom_of, cut, maybe_in, text_or_empty


def normalised(text: str):
    """The text without any character of ``[\\x20\\x09-\\x0D]``; null is empty."""
    return F.translate(text_or_empty(text), SPACES, "")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after deleting every white-space
    character; a null text is empty, and all empty texts are one group.  The
    row with the most code points in its original text stays, then the
    smallest id (a null id counts as larger than all others).  Of rows that
    repeat an id and a text, exactly one is kept.  Other columns are ignored.  Empty table: no rows.
    """
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("_id"), normalised(text_col).alias("_norm"), F.length(text).alias("_len"))

    n = docs.count()
    bits = bloom_bits(n)
    hashes = docs.select(F.xxhash64(normalised(text_col)).alias("_h"))
    repeated = bloom_of(hashes, "_h", bits, at_least=2)

    probed = (maybe_in(rows.withColumn("_h", F.xxhash64("_norm")), F.col("_h"), repeated, bits, "_maybe")
              .select("_id", F.sha2("_norm", 256).alias("_sha"), "_len", "_maybe"))
    probed = cut(probed)  # narrow rows; the texts are not read again

    alone = probed.filter(~F.col("_maybe")).select(
        F.col("_id").alias(id_col), F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.col("_sha").alias("text_sha256"))

    # rows that repeat id, digest and length are one row with a count
    maybe = (probed.filter("_maybe").groupBy("_sha", "_id", "_len").agg(F.count(F.lit(1)).alias("_n")))
    # order: longest first, then the smallest id, null ids last
    best = F.max_by(F.col("_id"), F.struct(F.col("_len"), F.col("_id").isNull().cast("int") * -1, -F.col("_id")))
    groups = maybe.groupBy("_sha").agg(F.sum("_n").alias("group_size"), best.alias("keep_id"),
                                       F.max("_len").alias("_best_len"))
    groups = cut(groups.filter("group_size > 1"))
    together = attach(maybe, groups, ["_sha"], "group_size", n)
    copies = F.explode(F.sequence(F.lit(1), F.col("_n")))
    stays = F.col("group_size").isNull() | (F.col("_id").eqNullSafe(F.col("keep_id")) & (F.col("_len") == F.col("_best_len")))
    together = together.select("*", copies.alias("_copy")).select(
        F.col("_id").alias(id_col),
        F.when(F.col("group_size").isNull(), F.col("_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (stays & (F.col("_copy") == 1)).alias("kept"), F.col("_sha").alias("text_sha256"))
    return alone.unionByName(together)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, all columns unchanged.

    Dropped ids leave by an anti join on the id; rows whose id repeats are
    told apart by their text digest."""
    found = exact_dedup(docs, id_col, text_col)
    gone = cut(found.groupBy(F.col(id_col).alias("gid"), F.col("text_sha256").alias("gsha")).agg(
        F.max("kept").alias("stays"), F.count(F.lit(1)).alias("n")).filter("not stays or n > 1"))
    bits = bloom_bits(gone.count())
    # the row as one value, so that its names clash with nothing here
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"), normalised(text_col).alias("norm"))
    marked = maybe_in(rows, F.xxhash64("id"), bloom_of(gone.select(F.xxhash64("gid").alias("h")), "h", bits), bits, "maybe")
    rest = marked.filter("maybe").select("row", "id", F.sha2("norm", 256).alias("sha"), F.length(text_or_empty(F.col(f"row.`{text_col}`"))).alias("len"))
    rest = rest.join(gone, F.col("id").eqNullSafe(F.col("gid")) & (F.col("sha") == F.col("gsha")), "left")
    # rows that repeat a kept id and text: one of the longest
    once = rest.filter("stays").groupBy("id", "sha").agg(F.max_by("row", "len").alias("row"))
    return marked.filter("not maybe").select("row.*").unionByName(
        rest.filter("gsha is null").select("row.*")).unionByName(once.select("row.*"))
