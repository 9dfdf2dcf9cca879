"""Corpus pipeline: toxicity, exact dedup, near-duplicate classes, benchmark
decontamination, tokens.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir),
works on all that its predecessor kept, and returns a DataFrame that is written
as Parquet and reread as the next one's ``docs``.  All but the last return the
columns of ``documents``, unchanged, for the rows they keep.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorecast.llm import bpe, decontaminate, exact_dedup, jaccard_join, toxicity
from scorecast.llm.common import cut, drop_folder, named_rows, scratch, table, without
from scorecast.llm.queries import public_vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more leave."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays."""
    return exact_dedup.drop_copies(docs)


def _rows_without(docs: DataFrame, find) -> DataFrame:
    """``docs`` without the rows that ``find`` names.  Rows go by their own
    name, not by an id that may be null or repeat."""
    rows = named_rows(docs, "doc_id", "text", "__row")
    return without(rows, cut(find(rows).distinct()), "__row").drop("__row")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of similar texts (five-word shingles, Jaccard similarity
    0.8 or more) one row stays, that with the smallest id (rows whose id is null
    or repeats before the others); texts without words are in no class and
    stay.  Rows alike in id and text count as one."""
    def find(rows):
        found = jaccard_join.jaccard_classes(rows, k=5, num=80, den=100, id_col="__row")
        return found.filter("n_shingles > 0 and __row != component_id").select("__row")
    return _rows_without(docs, find)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage leave."""
    return _rows_without(docs, lambda rows: decontaminate.leaks(rows, table(spark, sf_dir, "benchmark"), id_col="__row").select("__row"))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and the digest of what they decode to."""
    out = bpe.encode(docs, public_vocabulary("word_bpe_49k.json"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("jaccard_join", drop_near_copies),
          ("decontamination", drop_leaks), ("bpe", to_tokens)]

# a trained model and a vocabulary file decide: SQL cannot express the rows
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result goes through a Parquet table
    in the shared checkpoint folder.  A stage's table goes once the next one is
    written; the last one stays until that folder is cleaned."""
    docs, folder, last = table(spark, sf_dir, "documents"), scratch(spark, "pipeline"), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if last:
            drop_folder(spark, last)
        last = f"{folder}/{name}"
    return docs
