"""Importance resampling towards a target distribution, on hashed n-grams.

1. Each text is normalised to its words joined by one space and scanned once;
   the running CRC-32 is stored at every word's start and end.  The CRC of any
   n-gram follows from two of these prefixes: with ``R(i)`` the CRC of the text
   before the n-gram, ``R(j)`` that of the text to its end and ``L`` its bytes,
   ``crc = R(j) ^ shift_L(R(i))``, where ``shift_L`` (the effect of ``L`` zero
   bytes) is a linear map over GF(2), held as byte tables.  No n-gram is built
   as a string.
2. Bucket counts of the corpus and of the target are summed per task and then
   over the tasks, over all texts; a bucket's gain is its log ratio.
3. A second scan sums the gains of each document's features, a Gumbel number
   from its id's hash is added, and the highest scores are drawn.  A score at
   which surely enough documents lie is found by a quantile sketch; only the
   documents from there on are put in order.
"""

from __future__ import annotations

import zlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, numbered, ship
from . import words as W

_U32 = np.uint32
_SHORT = 64          # byte lengths with a shift table of their own

# words are runs of 0-9, a-z (A-Z is lowered first) and bytes from 0x80 on
_SPACE = np.ones(256, bool)
_SPACE[0x30:0x3A] = _SPACE[0x61:0x7B] = _SPACE[0x80:] = False


def _times(columns: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A GF(2) matrix, given by its 32 columns, times each value."""
    out = np.zeros_like(x)
    for bit in range(32):
        out ^= np.where(x >> _U32(bit) & _U32(1), columns[bit], _U32(0))
    return out


def _tables(columns: np.ndarray) -> np.ndarray:
    """The map as four tables by byte: (4, 256)."""
    value = np.arange(256, dtype=_U32)
    return np.stack([_times(columns, value << _U32(8 * b)) for b in range(4)])


class Shift:
    """The effect of appended zero bytes on CRC-32 values (reflected, polynomial
    0xEDB88320), without the initial and final inversion."""

    def __init__(self):
        value = np.arange(256, dtype=_U32)
        for _ in range(8):
            value = np.where(value & _U32(1), value >> _U32(1) ^ _U32(0xEDB88320), value >> _U32(1))
        self.byte = value
        unit = _U32(1) << np.arange(32, dtype=_U32)
        one, now, short = self.step(unit), unit, []
        for _ in range(_SHORT):
            short.append(_tables(now))
            now = _times(one, now)
        self.short = np.stack(short).ravel()
        self.long = [now]                      # columns for 64, 128, 256... bytes
        self.long_tables = [_tables(now)]

    def step(self, crc: np.ndarray) -> np.ndarray:
        """One zero byte more."""
        return self.byte[crc & _U32(255)] ^ crc >> _U32(8)

    def __call__(self, crc: np.ndarray, n: np.ndarray) -> np.ndarray:
        """``crc`` shifted by ``n`` bytes, one by one."""
        at, out = (n % _SHORT) * 1024, np.zeros_like(crc)
        for b in range(4):
            out ^= self.short[at + (256 * b + (crc >> _U32(8 * b) & _U32(255)))]
        rest, k = n // _SHORT, 0
        where = np.flatnonzero(rest)
        while len(where):
            if k == len(self.long):
                self.long.append(_times(self.long[-1], self.long[-1]))
                self.long_tables.append(_tables(self.long[-1]))
            hit = where[rest[where] >> k & 1 == 1]
            part, t = out[hit], self.long_tables[k]
            out[hit] = t[0][part & 255] ^ t[1][part >> 8 & 255] ^ t[2][part >> 16 & 255] ^ t[3][part >> 24]
            k += 1
            where = where[rest[where] >> k > 0]
        return out


_SHIFT: list = []


def _shift() -> Shift:
    if not _SHIFT:
        _SHIFT.append(Shift())
    return _SHIFT[0]


def ngram_crcs(column: pa.Array, n: int):
    """For the texts of a column: (first, [crc of 1-grams, ..., of n-grams]).

    ``first`` has the index of each text's first word; the k-gram at place i
    begins with word i (those that run into the next text are for the caller
    to leave out)."""
    shift = _shift()
    data, start, end, first = W.bounds(column, True, _SPACE)
    if not len(start):
        return first, [np.zeros(0, _U32)] * n
    # the scan: one space before each word, then the running CRC behind it
    size = end - start + 1
    to = np.cumsum(size)
    text = np.full(int(to[-1]), 0x20, np.uint8)
    inside = np.ones(len(text), bool)
    inside[to - size] = False
    solid = np.zeros(len(data) + 1, np.int8)
    np.add.at(solid, start, 1)
    np.add.at(solid, end, -1)
    text[inside] = data[np.cumsum(solid[:-1], dtype=np.int8) > 0]
    view, edge = memoryview(text.tobytes()), [0, *to.tolist()]
    crc = np.fromiter(accumulate(map(view.__getitem__, map(slice, edge, edge[1:])), lambda c, w: zlib.crc32(w, c), initial=0),
                      _U32, len(to) + 1)
    # the prefix that ends with the space before each word
    ones = _U32(0xFFFFFFFF)
    before, after = shift.step(crc[:-1] ^ ones ^ _U32(0x20)) ^ ones, crc[1:]
    begin = to - size + 1
    return first, [after[k:] ^ shift(before[:len(before) - k], to[k:] - begin[:len(begin) - k]) for k in range(n)]


def _last(first: np.ndarray, k: int) -> np.ndarray:
    """Where each text's (k+1)-grams end, at least where they begin."""
    return np.maximum(first[:-1], first[1:] - k)


def _count(n: int, buckets: int):
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for i, j in W.slices(batch.column(0)):
                first, grams = ngram_crcs(batch.column(0).slice(i, j - i), n)
                for k, crc in enumerate(grams):
                    # a k-gram belongs to a text unless one of the next texts begins inside
                    ours = np.zeros(len(crc) + 1, np.int64)
                    np.add.at(ours, np.minimum(first[:-1], len(crc)), 1)
                    np.add.at(ours, np.minimum(_last(first, k), len(crc)), -1)
                    total += np.bincount(crc[np.cumsum(ours[:-1]) > 0] % buckets, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])
    return run


def bucket_counts(docs: DataFrame, n: int = 3, buckets: int = 10_000, text_col: str = "text") -> np.ndarray:
    """How many features of all texts fall in each bucket.  A task sends at most
    one row a bucket, and the driver receives one sum a bucket."""
    ship(docs.sparkSession)
    rows = (docs.select(F.col(text_col).alias("text")).mapInArrow(_count(n, buckets), "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(target share / corpus share)) with one added to each bucket."""
    s, t = corpus.astype(float), target.astype(float)
    k = float(len(s))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + k) / ((s + 1) * (t.sum() + k)))).astype(np.int64)


def _weigh(gain: np.ndarray, n: int):
    def run(batches):
        for batch in batches:
            for i, j in W.slices(batch.column(1)):
                part = batch.slice(i, j - i)
                first, grams = ngram_crcs(part.column(1), n)
                n_words = np.diff(first)
                features, weight = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
                for k, crc in enumerate(grams):
                    sums = np.concatenate(([0], np.cumsum(gain[crc % len(gain)])))
                    lo, hi = np.minimum(first[:-1], len(crc)), np.minimum(_last(first, k), len(crc))
                    features += hi - lo
                    weight += sums[hi] - sums[lo]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n_words.astype(np.int64)), pa.array(features), pa.array(weight)],
                                                 ["id", "n_words", "n_features", "weight"])
    return run


def importance(docs: DataFrame, target: DataFrame, n: int = 3, buckets: int = 10_000, seed: int = 42,
               id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_features, weight, score.

    Words are runs of digits, letters a-z (A-Z lowered) and non-ASCII
    characters; features are all runs of 1 to ``n`` words, repeats counted.
    ``weight`` sums the gains of a text's features (0 without any) and
    ``score`` adds the Gumbel number of the id.  Null and empty texts have no
    features.  A null id is hashed as an empty one; rows that repeat an id
    share its Gumbel number.  Empty tables count as no features.
    """
    gain = gains(bucket_counts(docs, n, buckets, text_col), bucket_counts(target, n, buckets, target_col))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _weigh(gain, n), "id long, n_words long, n_features long, weight long")
    seeded = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(seeded, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    return rows.select(F.col("id").alias(id_col), "n_words", "n_features", "weight", (F.col("weight") + noise).alias("score"))


def resample(docs: DataFrame, target: DataFrame, num: int = 5, den: int = 100, min_words: int = 20, n: int = 3,
             buckets: int = 10_000, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """``importance`` and ``rank``: of the N rows with at least ``min_words``
    words, the floor(num N / den) highest scores are ranked 1, 2, 3...; all
    other ranks are null.  Ties go to the smaller id, null ids last; rows alike
    in both take their ranks in any order.  Empty table: no rows.
    """
    rows = cut(importance(docs, target, n, buckets, seed, id_col, text_col, target_col))
    fit = F.col("n_words") >= min_words
    share = num / den
    seen = rows.filter(fit).agg(F.count(F.lit(1)).alias("n"),
                                F.percentile_approx("score", max(0.0, 1 - share - 0.01), 10_000).alias("from")).first()
    draw = seen["n"] * num // den
    if not draw:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    # the sketch errs by n / 10,000 ranks at most, the margin is n / 100, so at least `draw` rows lie here
    high = F.coalesce(fit & (F.col("score") >= seen["from"]), F.lit(False))
    ranked = numbered(rows.filter(high), F.col("score").desc(), F.col(id_col).asc_nulls_last())
    rank = F.when(F.col("_rank") <= draw, F.col("_rank"))
    return (ranked.withColumn("rank", rank.cast("long")).drop("_rank")
            .unionByName(rows.filter(~high).withColumn("rank", F.lit(None).cast("long"))))


def drawn(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The documents that ``resample`` draws, columns unchanged.  Where an id
    repeats, all its rows come if one of them is drawn."""
    id_col = options.get("id_col", "doc_id")
    ids = resample(docs, target, **options).filter("rank is not null").select(F.col(id_col).alias("_drawn")).distinct()
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(id_col).alias("_id"))
    return row.join(ids, F.col("_id").eqNullSafe(F.col("_drawn")), "left_semi").select("_row.*")
