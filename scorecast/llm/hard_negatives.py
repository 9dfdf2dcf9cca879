"""Hard-negative mining with exact integer scores from a residue number system.

1. Components become integers.  A score is an inner product of integers: the
   matrices of components modulo several small primes are multiplied in
   float32, where every partial sum stays below 2**24 and so is exact, and the
   signed score is put together from its residues (Chinese remaindering in
   balanced mixed-radix digits).  As many primes are taken as the largest
   component asks for.
2. Anchors, a stated query set, lie as files of bounded size in the shared
   folder.  Each task goes through its rows in blocks, and for a block through
   the anchor files; nothing is broadcast, and a task holds one block of rows
   and one of anchors.  From a block go on only the rows that can count: the
   first positives of each anchor, and in the second pass the first negatives
   of each window.
3. The few rows of each block are ranked per anchor by Spark.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, drop_folder, filesystem, scratch, ship

BLOCK = 32_768       # rows that a task holds at a time
ANCHORS = 2_048      # anchors in a file
_ROWS, _SOME = 4_096, 512     # rows and anchors that are multiplied at a time
#: Scores must stay below this bound; it is checked against the data.
MOST = 1 << 52

# the largest primes below 512; fixed values, enough for scores up to MOST
PRIMES = (509, 503, 499, 491, 487, 479, 467)


class Residues:
    """Inner products of integer vectors with ``dim`` components of absolute
    value up to ``most``."""

    def __init__(self, dim: int, most: int):
        reach, n = 1, 0
        while reach <= 2 * max(1, dim) * most * most + 1:
            if n == len(PRIMES):
                raise ValueError(f"components up to {most} give scores of 2**52 and more; scale the vectors down")
            reach, n = reach * PRIMES[n], n + 1
        self.primes = PRIMES[:max(1, n)]
        # inverses[i][j]: of prime j modulo prime i
        self.inverse = [[pow(q, -1, p) for q in self.primes[:i]] for i, p in enumerate(self.primes)]

    def split(self, x: np.ndarray) -> list[np.ndarray]:
        """Balanced residues of integer-valued doubles, a float32 matrix a prime."""
        return [(x - p * np.rint(x / p)).astype(np.float32) for p in self.primes]

    def scores(self, a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
        """Exact inner products of all rows of ``a`` with all of ``b``."""
        digits = []
        for i, p in enumerate(self.primes):
            step = ((1 << 24) - 1) // ((p + 1) // 2) ** 2        # so many products sum up exactly
            r = np.zeros((len(a[i]), len(b[i])), np.int32)
            for k in range(0, a[i].shape[1], step):
                r = (r + (a[i][:, k: k + step] @ b[i][:, k: k + step].T).astype(np.int32)) % p
            for q, inv, d in zip(self.primes, self.inverse[i], digits):
                r = (r - d) * inv % p
            r[r > p // 2] -= p
            digits.append(r)
        out = digits[-1].astype(np.int64)
        for p, d in zip(self.primes[-2::-1], digits[-2::-1]):
            out *= p
            out += d
        return out


def _matrix(column: pa.Array, dim: int, scale: int) -> np.ndarray:
    """floor(scale * x) of every component; shorter vectors end in zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    size = np.diff(column.offsets.to_numpy())
    if len(size) and (size == dim).all():
        return np.floor(scale * flat.reshape(len(size), dim))
    out = np.zeros((len(size), dim))
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return np.floor(scale * out)


def first_of(group: np.ndarray, score: np.ndarray, ident: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of each group: highest score, then smallest id."""
    order = np.lexsort((ident, -score, group))
    g = group[order]
    begin = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1]))) if len(g) else np.zeros(0, int)
    inside = np.arange(len(g)) - np.repeat(begin, np.diff(np.append(begin, len(g))))
    return order[inside < k]


def first_in_windows(group: np.ndarray, score: np.ndarray, ident: np.ndarray, of: np.ndarray, top: np.ndarray, low: tuple[int, int], k: int) -> np.ndarray:
    """Places of the rows that are among the first ``k`` of a window.  Window i
    holds the rows of group ``of[i]`` with a score of at most ``top[i]`` and at
    least the share ``low`` of it."""
    if not len(score) or not len(of):
        return np.zeros(0, int)
    order = np.lexsort((ident, -score, group))
    g, s = group[order], score[order]
    high = max(int(s.max()), int(top.max()))
    wide = high - min(int(s.min()), int(top.min())) + 1
    at = np.searchsorted(g * wide + (high - s), of * wide + (high - top))
    take = (at[:, None] + np.arange(k)).ravel()
    of, top = np.repeat(of, k), np.repeat(top, k)
    there = take < len(s)
    take, of, top = take[there], of[there], top[there]
    good = (g[take] == of) & (low[1] * s[take] >= low[0] * top)
    return order[np.unique(take[good])]


def _blocks(batches) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        for i in range(0, batch.num_rows, BLOCK):
            held.append(batch.slice(i, BLOCK))
            n += held[-1].num_rows
            if n >= BLOCK:
                yield pa.Table.from_batches(held).combine_chunks()
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def _column(table: pa.Table, name: str) -> pa.Array:
    return table.column(name).chunk(0) if table.column(name).num_chunks == 1 else pa.concat_arrays(table.column(name).chunks)


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return _column(table, name).to_numpy(zero_copy_only=False)


def _files(folder: str) -> Iterator[pa.Table]:
    import pyarrow.parquet as pq
    from pyarrow.fs import FileSelector
    fs, path = filesystem(folder)
    for f in sorted(fs.get_file_info(FileSelector(path)), key=lambda f: f.path):
        if f.base_name.endswith(".parquet"):
            # a plain read of one file, a bounded number of rows
            table = pq.ParquetFile(f.path, filesystem=fs).read()
            if table.num_rows:
                yield table


def _top(s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``k`` highest of each row; of equal ones the first."""
    n = s.shape[1]
    if s.size and int(np.abs(s).max()) >= (1 << 62) // max(1, n):
        s = np.unique(s, return_inverse=True)[1].reshape(s.shape)
    key = s * n + np.arange(n - 1, -1, -1)
    take = np.argpartition(key, n - k, axis=1)[:, n - k:] if n > k else np.broadcast_to(np.arange(n), s.shape)
    return np.repeat(np.arange(len(s)), take.shape[1]), take.ravel()


def _positives(folder: str, dim: int, most: int, scale: int, k: int):
    """Rows (id, label, vec) -> (a, positive_id, positive_score)."""
    def run(batches):
        rns = Residues(dim, most)
        for block in _blocks(batches):
            ident, label = _numbers(block, "id"), _numbers(block, "label")
            order = np.lexsort((ident, label))
            ident, label = ident[order], label[order]
            rows = rns.split(_matrix(_column(block, "vec"), dim, scale)[order])
            for part in _files(folder):
                a, a_id, a_label = (_numbers(part, c) for c in ("a", "id", "label"))
                anchors = rns.split(_matrix(_column(part, "vec"), dim, scale))
                got_a, got_id, got_score = [], [], []
                for value in np.unique(a_label):
                    lo, hi = np.searchsorted(label, value), np.searchsorted(label, value, "right")
                    mine = np.flatnonzero(a_label == value)
                    for i in range(0, len(mine) if hi > lo else 0, _SOME):
                        some = mine[i: i + _SOME]
                        left = [m[some] for m in anchors]
                        for j in range(lo, hi, _ROWS):
                            end = min(j + _ROWS, hi)
                            s = rns.scores(left, [m[j:end] for m in rows])
                            # one more than asked for: the anchor itself may be there
                            own = np.flatnonzero(np.isin(a_id[some], ident[j:end]))
                            same = a_id[some][own, None] == ident[j:end]
                            extra = int(same.sum(1).max()) if len(own) else 0
                            r, c = _top(s, k + extra)
                            keep = a_id[some][r] != ident[j:end][c]
                            got_a.append(a[some][r[keep]])
                            got_id.append(ident[j:end][c[keep]])
                            got_score.append(s[r, c][keep])
                if got_a:
                    g, i, s = np.concatenate(got_a), np.concatenate(got_id), np.concatenate(got_score)
                    best = first_of(g, s, i, k)
                    yield pa.RecordBatch.from_arrays([pa.array(g[best]), pa.array(i[best]), pa.array(s[best])], ["a", "positive_id", "positive_score"])
    return run


def _negatives(folder: str, dim: int, most: int, scale: int, k: int, low: tuple[int, int]):
    """Rows (id, label, vec) -> (a, negative_id, negative_score), those that are
    among the block's first in a window of the anchor."""
    def run(batches):
        rns = Residues(dim, most)
        for block in _blocks(batches):
            ident, label = _numbers(block, "id"), _numbers(block, "label")
            rows = rns.split(_matrix(_column(block, "vec"), dim, scale))
            for part in _files(folder):
                a, a_label = _numbers(part, "a"), _numbers(part, "label")
                anchors = rns.split(_matrix(_column(part, "vec"), dim, scale))
                tops = _column(part, "tops")
                top, n_tops = tops.flatten().to_numpy(zero_copy_only=False), np.diff(tops.offsets.to_numpy())
                of = np.repeat(np.arange(len(a)), n_tops)
                begin = np.cumsum(n_tops) - n_tops
                # every anchor here has a positive: windows reach from the least to the largest
                least, largest = np.minimum.reduceat(top, begin), np.maximum.reduceat(top, begin)
                got_a, got_r, got_s = [], [], []
                for i in range(0, len(a), _SOME):
                    left = [m[i: i + _SOME] for m in anchors]
                    for j in range(0, len(ident), _ROWS):
                        s = rns.scores(left, [m[j: j + _ROWS] for m in rows])
                        hit = s <= largest[i: i + _SOME, None]
                        hit &= low[1] * s >= low[0] * least[i: i + _SOME, None]
                        hit &= a_label[i: i + _SOME, None] != label[j: j + _ROWS]
                        r, c = np.nonzero(hit)
                        mine = (of >= i) & (of < i + _SOME)
                        best = first_in_windows(r + i, s[r, c], ident[j + c], of[mine], top[mine], low, k)
                        got_a.append(r[best] + i)
                        got_r.append(c[best] + j)
                        got_s.append(s[r[best], c[best]])
                g, r, s = np.concatenate(got_a), np.concatenate(got_r), np.concatenate(got_s)
                best = first_in_windows(g, s, ident[r], of, top, low, k)
                yield pa.RecordBatch.from_arrays([pa.array(a[g[best]]), pa.array(ident[r[best]]), pa.array(s[best])],
                                                 ["a", "negative_id", "negative_score"])
    return run


def _write(anchors: DataFrame, folder: str, n: int) -> str:
    anchors.repartition(max(1, -(-n // ANCHORS))).write.option("maxRecordsPerFile", ANCHORS).parquet(folder)
    return folder


def mine(vectors: DataFrame, is_anchor: Column, label: Column, scale: int = 256, positives: int = 5, negatives: int = 5,
         low: tuple[int, int] = (80, 100), id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` and ``label`` are columns of ``vectors``.  A component x counts
    as floor(scale x) and a score is the integer inner product with the anchor;
    order is by score, highest first, then by smaller id.  Positives of an anchor
    are its first rows of the same label with another id; for each, the first
    rows of another label with ``low[0] positive_score <= low[1] negative_score
    <= low[1] positive_score`` are ranked from 1.

    Rows with a null id, label or vector, or with a null or non-finite
    component, take no part.  Vectors of unequal lengths compare as if the
    shorter ended in zeros; an empty one scores 0.  A row that repeats an id is
    a row of its own, but never a positive of an anchor with that id.  Scores
    that could reach 2**52 raise ValueError.  Without anchors, positives or
    negatives: no rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vec_col).alias("vec"),
                           is_anchor.alias("is_anchor"))
            .filter("id is not null and label is not null and vec is not null").filter(finite))
    seen = rows.agg(F.coalesce(F.max(F.size("vec")), F.lit(0)).alias("dim"), F.sum(F.col("is_anchor").cast("long")).alias("n"),
                    F.max(F.array_max(F.transform("vec", lambda x: F.abs(x.cast("double"))))).alias("most")).first()
    dim, most, n = max(1, seen["dim"]), int(scale * (seen["most"] or 0.0)) + 1, seen["n"] or 0
    Residues(dim, most)                    # raises where scores do not fit
    folder = scratch(spark, "anchors")
    anchors = rows.filter("is_anchor").select(F.monotonically_increasing_id().alias("a"), "id", "label", "vec")
    schema = "a long, positive_id long, positive_score long"
    files = _write(anchors, f"{folder}/all", n)
    rows = rows.select("id", "label", "vec")
    best = Window.partitionBy("a").orderBy(F.col("positive_score").desc(), "positive_id")
    found = rows.mapInArrow(_positives(files, dim, most, scale, positives), schema)
    positive = cut(found.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= positives))
    named = spark.read.parquet(files)
    paired = cut(named.select("a", F.col("id").alias("anchor_id")).join(positive.drop("_n"), "a"))
    tops = positive.groupBy("a").agg(F.collect_list("positive_score").alias("tops"))
    files = _write(named.join(tops, "a").select("a", "label", "vec", "tops"), f"{folder}/ranked", n)
    found = rows.mapInArrow(_negatives(files, dim, most, scale, negatives, low), "a long, negative_id long, negative_score long")
    inside = ((low[0] * F.col("positive_score") <= low[1] * F.col("negative_score"))
              & (F.col("negative_score") <= F.col("positive_score")))
    order = Window.partitionBy("a", "positive_id", "_p").orderBy(F.col("negative_score").desc(), "negative_id")
    # positives that share an id are told apart by their place
    pairs = paired.withColumn("_p", F.row_number().over(Window.partitionBy("a").orderBy(F.col("positive_score").desc(), "positive_id")))
    out = cut(pairs.join(found, "a").filter(inside).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
              .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
    drop_folder(spark, folder)
    return out
