"""Connected components by alternating star contractions.

A round first contracts the edges of each task among themselves (one edge a
node stays, to the smallest node it reaches), then hooks each node's neighbours
to the smallest node around it.  Edges only shrink towards stars; few edges
need one task and no round at all.  Rounds grow with the logarithm of the
graph's diameter.  Edges and labels stay distributed; the driver sees one
count and one checksum a round.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, cut, drop_folder, ship, stored

TASK = 1_000_000      # edges that a task contracts at a time


def join_up(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``label`` (each place's smallest known place of its group, flat) after
    the places ``i`` and ``j`` have been connected."""
    while True:
        a, b = label[i], label[j]
        if (a == b).all():
            return label
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def _contract(batches):
    """Edges (u, v) of a task -> (node, smallest node that it reaches)."""
    held, n = [], 0

    def out():
        u, v = (np.concatenate([np.asarray(b.column(c)) for b in held]) for c in (0, 1))
        nodes, place = np.unique(np.concatenate((u, v)), return_inverse=True)
        label = join_up(np.arange(len(nodes)), place[:len(u)], place[len(u):])
        some = np.flatnonzero(label != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[some]), pa.array(nodes[label[some]])], ["u", "v"])
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= 2 * TASK:
            held, n = [out()], 0       # what is joined goes on with the rest
            n = held[0].num_rows
            if n >= TASK:
                yield held[0]
                held, n = [], 0
    if held:
        yield out()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every end of ``edges(u, v)``, checkpointed; the
    component is its smallest node.  Loops and repeated edges change nothing;
    rows with a null end are not links.  Each round is written to the shared
    folder and dropped after the next."""
    spark = edges.sparkSession
    ship(spark)
    e, folder = stored(edges.filter("u is not null and v is not null and u != v").select(F.col("u").cast("long"), F.col("v").cast("long")), "edges")
    before = None
    while True:
        state = e.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)).alias("s")).first()
        n, last = state["n"], folder
        tasks = -(-n // TASK) or 1
        near = e.coalesce(tasks).mapInArrow(_contract, "u long, v long")
        if tasks == 1 or (n, state["s"]) == before:
            e = near if tasks == 1 else e
            out = cut(e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
            drop_folder(spark, folder)
            return out
        before = (n, state["s"])
        e, folder = stored(_small_star(_large_star(near, n), n), "edges")
        drop_folder(spark, last)


def _large_star(e: DataFrame, n: int) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("size"))
    return (attach(both, low, ["u"], "size", 2 * n).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u != v").distinct())


def _small_star(e: DataFrame, n: int) -> DataFrame:
    # u > v in every edge
    low = e.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("size"))
    hooked = attach(e, low, ["u"], "size", n)
    return (hooked.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
