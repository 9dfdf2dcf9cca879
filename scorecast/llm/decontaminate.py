"""Benchmark decontamination with SimHash windows and Hamming blocks.

For every benchmark item a window of its size (in word shingles) slides over
each document.  A window is compared by its 64-bit SimHash; fingerprints are
indexed by four blocks of 16 bits.  Every window within ``RADIUS`` = 19 bits of
an item differs from it by at most four bits in some block (20 differing bits
would be needed to spread five over each); two of these bits are changed on the
item's side, in the index, and two on the window's side, in the lookup, so
that the index stays small.  Candidates within the radius are decided by exact weighted
similarity of their shingle bags: sum of minima over sum of maxima, where a
shingle weighs as many bytes as its words have.

A window that shares no shingle with an item has similarity 0 with it, so
only windows around shared shingles are fingerprinted.

One pass over the documents, no shuffle.  Items go to the workers in blocks of
at most ``BLOCK_BYTES`` of text, one pass a block, so a broadcast is bounded
however large the benchmark is.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, ship, text_or_empty
from . import words as W

RADIUS, BLOCKS, NEAR = 19, 4, 2        # 2 * NEAR = RADIUS // BLOCKS
BLOCK_BYTES = 4 << 20
_U = np.uint64
_MASKS = np.array([sum(1 << b for b in c) for n in range(NEAR + 1) for c in combinations(range(16), n)], np.int32)

RESULT = "item_id long, start_word int, n_words int, hamming int, similarity double"


def shingles(hashes: np.ndarray, sizes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, weight) of a text's shingles; fewer than ``k`` words are one."""
    n = len(hashes)
    if n == 0:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    k = min(k, n)
    total = np.concatenate(([0], np.cumsum(sizes)))
    return W.runs(hashes, k), total[k:] - total[:-k]


def simhash(h: np.ndarray, weight: np.ndarray, begin: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints of the windows of ``size`` shingles that begin at ``begin``."""
    bits = np.unpackbits(W.mix(h).view(np.uint8).reshape(-1, 8), axis=1).astype(np.int64) * 2 - 1
    total = np.concatenate((np.zeros((1, 64), np.int64), np.cumsum(bits * weight[:, None], axis=0)))
    return np.packbits(total[begin + size] > total[begin], axis=1).view(_U).ravel()


def similarity(h1, w1, h2, w2) -> float:
    """Weighted similarity of two bags of shingles."""
    keys, back = np.unique(np.concatenate((h1, h2)), return_inverse=True)
    a = np.bincount(back[:len(h1)], w1, len(keys))
    b = np.bincount(back[len(h1):], w2, len(keys))
    top = np.maximum(a, b).sum()
    return float(np.minimum(a, b).sum() / top) if top else 0.0


class Items:
    """The items of one block: shingles, and indexes of each size, in arrays."""

    def __init__(self, rows: list[tuple[int, str]], k: int):
        w = W.split(pa.array([t for _, t in rows], pa.string()), True)
        size = w.end - w.start
        self.id, self.by_size, self.tables, h, weight = [], {}, {}, [], []
        for (item, _), a, b in zip(rows, w.first[:-1], w.first[1:]):
            x, y = shingles(w.hash[a:b], size[a:b], k)
            if len(x):
                self.by_size.setdefault((len(x), min(k, int(b - a))), []).append(len(self.id))
                self.id.append(item)
                h.append(x)
                weight.append(y.astype(np.int32))
        self.at = np.concatenate(([0], np.cumsum([len(x) for x in h], dtype=np.int64)))
        self.h = np.concatenate(h) if h else np.zeros(0, _U)
        self.w = np.concatenate(weight) if h else np.zeros(0, np.int32)
        self.keys = sorted(self.by_size)
        self.by_size = {key: np.array(self.by_size[key], np.int32) for key in self.keys}
        # for each known shingle, the sizes of the items that hold it
        of = np.empty(len(self.id), np.int32)
        for n, key in enumerate(self.keys):
            of[self.by_size[key]] = n
        of = np.repeat(of, np.diff(self.at))
        order = np.lexsort((of, self.h))
        x, y = self.h[order], of[order]
        new = np.concatenate(([True], (x[1:] != x[:-1]) | (y[1:] != y[:-1]))) if len(x) else np.zeros(0, bool)
        x, self.key_of = x[new], y[new]
        first = np.concatenate(([True], x[1:] != x[:-1])) if len(x) else np.zeros(0, bool)
        self.known = x[first]
        self.known_at = np.append(np.flatnonzero(first), len(x))
        self.lengths = sorted({k for _, k in self.keys})

    def bag(self, m: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.at[m], self.at[m + 1]
        return self.h[a:b], self.w[a:b]

    def sizes_of(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``h``, number of a size), for known shingles."""
        at = np.searchsorted(self.known, h)
        n = self.known_at[at + 1] - self.known_at[at]
        take = np.arange(n.sum()) + np.repeat(self.known_at[at] - np.cumsum(n) + n, n)
        return np.repeat(np.arange(len(h)), n), self.key_of[take]

    def table(self, key):
        """(block value, item) pairs sorted by value, with fingerprints."""
        if key not in self.tables:
            members = self.by_size[key]
            prints = np.array([simhash(*self.bag(m), np.array([0]), key[0])[0] for m in members], _U)
            value = np.concatenate([_near_values(prints, b).ravel() for b in range(BLOCKS)])
            owner = np.tile(np.repeat(np.arange(len(members), dtype=np.int32), len(_MASKS)), BLOCKS)
            order = np.argsort(value, kind="stable")
            self.tables[key] = (members, prints, value[order], owner[order])
        return self.tables[key]

    def near(self, key, prints: np.ndarray):
        """(window, item, distance) of all pairs within the radius."""
        members, own, value, owner = self.table(key)
        pairs = []
        for i in range(0, len(prints), 512):
            for b in range(BLOCKS):
                part = _near_values(prints[i: i + 512], b)
                lo, hi = np.searchsorted(value, part, "left").ravel(), np.searchsorted(value, part, "right").ravel()
                count = hi - lo
                at = np.arange(count.sum()) + np.repeat(lo - np.cumsum(count) + count, count)
                window = np.repeat(np.arange(part.size) // len(_MASKS) + i, count)
                pairs.append(np.unique(window * len(members) + owner[at]))
        pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        window, item = pairs // len(members), pairs % len(members)
        distance = np.bitwise_count(prints[window] ^ own[item])
        ok = distance <= RADIUS
        return window[ok], members[item[ok]], distance[ok]


def _near_values(prints: np.ndarray, b: int) -> np.ndarray:
    """Block ``b`` of each fingerprint with up to ``NEAR`` bits changed."""
    part = ((prints >> _U(16 * b)) & _U(0xFFFF)).astype(np.int32)
    return (part[:, None] ^ _MASKS[None, :]) + np.int32(b << 16)


def _search(items: Items, w: W.Words, a: int, b: int, hits: np.ndarray, k: int, least: float, found: dict, doc: int) -> None:
    """Windows of one document around the shared shingles ``hits`` (of ``k``
    words, counted within the document)."""
    h, weight = shingles(w.hash[a:b], (w.end - w.start)[a:b], k)
    place, number = items.sizes_of(h[hits])
    for n in np.unique(number).tolist():
        key = items.keys[n]
        if key[1] != k:
            continue
        size = min(key[0], len(h))
        at = hits[place[number == n]]
        begin = np.unique(np.clip((at[:, None] - np.arange(size)[None, :]).ravel(), 0, len(h) - size))
        # runs of windows, so that long documents cost what their hits cost
        for run in np.split(begin, np.flatnonzero(np.diff(begin) > size) + 1):
            lo, hi = int(run[0]), int(run[-1]) + size
            prints = simhash(h[lo:hi], weight[lo:hi], run - lo, size)
            for i, item, distance in zip(*items.near(key, prints)):
                p = int(run[i])
                s = similarity(h[p: p + size], weight[p: p + size], *items.bag(item))
                best = found.get((doc, item))
                if s >= least and (best is None or s > best[3]):
                    found[doc, item] = (p, size + k - 1, int(distance), s)


def _scan(shared, k: int, least: float):
    def run(batches):
        rows = shared.value
        items = held(("items", hash(tuple(rows)), k), lambda: Items(rows, k))
        for batch in batches:
            for i, j in W.slices(batch.column(1)):
                w = W.split(batch.column(1).slice(i, j - i), True)
                found: dict = {}
                owner = np.repeat(np.arange(j - i), np.diff(w.first))
                for size in items.lengths:                     # of a shingle: k, or less for tiny items
                    h = W.runs(w.hash, size)
                    at = np.minimum(np.searchsorted(items.known, h), len(items.known) - 1)
                    hit = np.flatnonzero((items.known[at] == h) & (owner[:len(h)] == owner[size - 1:]))
                    for part in np.split(hit, np.flatnonzero(np.diff(owner[hit])) + 1) if len(hit) else ():
                        d = int(owner[part[0]])
                        a, b = int(w.first[d]), int(w.first[d + 1])
                        _search(items, w, a, b, part - a, size, least, found, d)
                keys = sorted(found, key=lambda x: (x[0], x[1]))
                if keys:
                    cols = list(zip(*(found[x] for x in keys)))
                    ids = batch.column(0).slice(i, j - i).take(pa.array([d for d, _ in keys]))
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array([items.id[m] for _, m in keys], pa.int64()), pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()),
                         pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.float64())],
                        ["id", "item_id", "start_word", "n_words", "hamming", "similarity"])
    return run


def leaks(docs: DataFrame, benchmark: DataFrame, k: int = 5, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document row and benchmark item that it holds: id, item_id,
    start_word, n_words, hamming, similarity of the best (then first) window.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered; shingles have ``k``
    words, and a shorter item is one shingle of its words.  A document with
    fewer shingles than an item is one window.  Null texts, empty texts and
    items without words match nothing.  Repeated document rows are reported
    once each; repeated items too.  Null ids stay null.  Other columns are
    ignored.  Empty tables give no rows."""
    spark = docs.sparkSession
    ship(spark)
    items = benchmark.select(F.col(item_col).cast("long").alias("i"), text_or_empty(item_text).alias("t"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0)).alias("n")).first()["n"]
    n_blocks = max(1, -(-total // block_bytes))
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {src.schema['id'].dataType.simpleString()}, {RESULT}"
    out = spark.createDataFrame([], schema)
    for b in range(n_blocks):
        rows = items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n_blocks)) == b).orderBy("i", "t").collect()   # at most about block_bytes
        rows = [(r["i"], r["t"]) for r in rows if r["t"].strip(" \t\n\x0b\x0c\r")]
        if rows:
            out = out.unionByName(src.mapInArrow(_scan(spark.sparkContext.broadcast(rows), k, least), schema))
    return out.withColumnRenamed("id", id_col)
