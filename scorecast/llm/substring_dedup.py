"""Repeated passages by prefix-partitioned suffix trees.

Two windows of ``size`` words are equal when their suffixes share a node of
that depth in the tree of all suffixes; the deep internal nodes are the
repeats.  The tree is sparse and never built as a whole:

1. *Sparse suffixes.*  In each window the smallest ``PREFIX``-word hashes are
   its anchors (equal windows have equal anchors), about one position in
   seven.  A suffix begins at each anchor; it also carries the words before it
   that a window over it can reach.  A prefix of ``PREFIX`` words that only one
   suffix has is a leaf: no window over it repeats, and it goes no further.
2. *Prefix partitions.*  The other suffixes are counted by prefix.  A group of
   up to ``GROUP`` suffixes is one subtree.  Larger groups are split by longer
   prefixes: by the words up to half a window's reach to the right, for windows
   that begin near the anchor, and by those to the left, for the others.  What is
   still too large then is split by whole windows.
3. *Subtrees.*  A task sorts the suffixes of its groups by their words, and the
   longest common prefixes of neighbours give the nodes of every depth; the same
   is done for the words before the anchors.  Windows that begin ``o`` words
   before the anchor are equal when their suffixes share a node of depth
   ``size - o`` and, to the left, one of depth ``o``.  All of them but the first
   in the corpus repeat.
4. *Whole windows* are internal nodes themselves, however many suffixes they
   have: only their first suffix is asked for.  A batch sends its own first one,
   and a task lets them pass one by one, in order.

Words are compared as words; hashes only choose anchors and partitions.
Exact copies of whole texts are one document from the start.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import attach, bloom_bits, bloom_of, cut, drop_folder, let_go, maybe_in, ship, stored, text_or_empty
from . import words as W

PREFIX = 6
GROUP = 150_000            # suffixes of a subtree: about 90 MB of words and their numbers
MOST_GROUPS = 1_000_000    # groups that are split by longer prefixes, at most; beyond it ``GROUP`` grows
SLICE = 4_000_000          # bytes of text in which repeats are known without an exchange
CHUNK = 60_000             # suffixes whose subtrees a task builds together
_U = np.uint64
_LAST = (1 << 63) - 1      # stands for a null id: after all others


def _running(x: np.ndarray, k: int, op) -> np.ndarray:
    """op over x[i: i + k] for every i with a whole run."""
    n, size, part = len(x) - k + 1, 1, x
    while 2 * size <= k:
        part = op(part[:-size], part[size:])
        size *= 2
    return op(part[:n], part[k - size: k - size + n])


def anchors(w: W.Words, size: int, prefix: int = PREFIX) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word index, hash, document row) of the anchors of a batch."""
    doc = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    n = len(doc) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, _U), np.zeros(0, np.int64)
    h = W.runs(w.hash, prefix)
    span = size - prefix + 1
    least = _running(h, span, np.minimum)                    # one for each window
    least[doc[:n] != doc[size - 1:]] = 0                     # windows across two texts
    padded = np.concatenate((np.zeros(span - 1, _U), least, np.zeros(span - 1, _U)))
    at = np.flatnonzero((_running(padded, span, np.maximum) == h) & (h != 0))
    return at, h[at], doc[at]


# kind 0: contest, 1: marker, 2: known
_CONTEST = "key long, id long, tie long, number int, kind int, n long"


def _anchor_rows(size: int):
    """The prefix of each suffix.  Of a prefix that a batch has several times
    one marker is sent; its suffixes are known to go on."""
    def run(batches):
        for batch in batches:
            for i, j in W.slices(batch.column(2), SLICE):
                ids, tie = (batch.column(c).slice(i, j - i).to_numpy(zero_copy_only=False) for c in (0, 1))
                at, h, doc = anchors(W.split(batch.column(2).slice(i, j - i)), size)
                if not len(at):
                    continue
                number = np.arange(len(at)) - np.searchsorted(doc, doc, "left")
                _, back, n = np.unique(h, return_inverse=True, return_counts=True)
                known = n[back] > 1
                mark = np.flatnonzero(known)[np.unique(back[known], return_index=True)[1]]
                key = np.where(known, W.mix(h + number.astype(_U) + _U(i)), h)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate((key, h[mark])).view(np.int64)), pa.array(np.concatenate((ids[doc], ids[doc[mark]]))),
                     pa.array(np.concatenate((tie[doc], tie[doc[mark]]))), pa.array(np.concatenate((number, number[mark])).astype(np.int32)),
                     pa.array(np.concatenate((known * 2, np.ones(len(mark), int))).astype(np.int32)),
                     pa.array(np.concatenate((1 - known, n[back[mark]])).astype(np.int64))], ["key", "id", "tie", "number", "kind", "n"])
    return run


class _Shared:
    """The shared anchors of a slice of texts, and the words around them."""

    def __init__(self, batch: pa.RecordBatch, i: int, j: int, size: int):
        self.ids, self.tie = (batch.column(c).slice(i, j - i).to_numpy(zero_copy_only=False) for c in (0, 1))
        self.w = w = W.split(batch.column(2).slice(i, j - i))
        at, h, doc = anchors(w, size)
        shared = batch.column(3).slice(i, j - i)
        begin = np.searchsorted(doc, np.arange(j - i), "left")
        good = np.sort(np.repeat(begin, np.diff(shared.offsets.to_numpy())) + shared.flatten().to_numpy(zero_copy_only=False))
        self.at, self.key, self.doc = at[good], h[good], doc[good]
        reach = size - PREFIX
        self.left = np.minimum(self.at - w.first[self.doc], reach)
        self.right = np.minimum(w.first[self.doc + 1] - self.at, size)

    def prefix(self, before: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash of the ``n`` words from ``before`` words before each anchor,
        whether the text has them)."""
        h = W.runs(self.w.hash, n)
        there = (self.left >= before) & (self.right >= n - before)
        return h[np.where(there, self.at - before, 0)] if len(h) else np.zeros(len(self.at), _U), there


def _isin(x: np.ndarray, some: np.ndarray) -> np.ndarray:
    if not len(some):
        return np.zeros(len(x), bool)
    return some[np.minimum(np.searchsorted(some, x), len(some) - 1)] == x


def _halves(size: int) -> tuple[tuple[int, int, int, int], ...]:
    """Longer prefixes: (words before the anchor, words, first offset, last)."""
    half = (size + PREFIX) // 2
    return (0, half, 0, size - half), (size - half + 1, size - half + 1 + PREFIX, size - half + 1, size - PREFIX)


def _longer(size: int, hot):
    """Counts of the longer prefixes of suffixes whose group is too large."""
    def run(batches):
        for batch in batches:
            for i, j in W.slices(batch.column(2), SLICE):
                x = _Shared(batch, i, j, size)
                large = _isin(x.key, hot.value)
                for before, n, *_ in _halves(size):
                    key, there = x.prefix(before, n)
                    key, count = np.unique(key[large & there], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(count)], ["key", "n"])
    return run


# level 0 and 1: suffixes of a subtree, for windows that begin low to high words before the anchor (at start);
# level 2: a window; level 3: known repeats from start to stop
_SUFFIX = "level int, key long, low int, high int, id long, tie long, start int, stop int, n_left int, words string"


def _suffix_rows(size: int, hot, hotter):
    def run(batches):
        for batch in batches:
            for i, j in W.slices(batch.column(2), SLICE):
                x = _Shared(batch, i, j, size)
                if not len(x.at):
                    continue
                text, begin, end = _plain(x.w)
                large, out = _isin(x.key, hot.value), []
                here = np.flatnonzero(~large)
                out.append(_rows(x, here, 0, x.key[here], 0, size - PREFIX, _cut(text, begin, end, x.at[here] - x.left[here], x.at[here] + x.right[here])))
                windows = []
                for before, n, low, high in _halves(size) if large.any() else ():
                    key, there = x.prefix(before, n)
                    there &= large
                    still = there & _isin(key, hotter.value)
                    here = np.flatnonzero(there & ~still)
                    out.append(_rows(x, here, 1, key[here], low, high, _cut(text, begin, end, x.at[here] - x.left[here], x.at[here] + x.right[here])))
                    for o in range(low, high + 1):
                        here = np.flatnonzero(still & (x.left >= o) & (x.right >= size - o))
                        windows.append((here, x.at[here] - o))
                if windows:
                    # a window over several anchors is one
                    at, one = np.unique(np.concatenate([w[1] for w in windows]), return_index=True)
                    out += _windows(x, np.concatenate([w[0] for w in windows])[one], at, size, text, begin, end)
                for b in out:
                    if b.num_rows:
                        yield b
    return run


def _plain(w: W.Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All words with one space behind each, and where each begins and ends."""
    size = w.end - w.start
    end = np.cumsum(size + 1) - 1
    begin = end - size
    text = np.full(int(end[-1]) + 1 if len(end) else 0, 32, np.uint8)
    text[np.arange(size.sum()) + np.repeat(begin - np.cumsum(size) + size, size)] = w.data[np.arange(size.sum()) + np.repeat(w.start - np.cumsum(size) + size, size)]
    return text.tobytes(), begin, end


def _cut(text: bytes, begin, end, a: np.ndarray, b: np.ndarray) -> list[bytes]:
    """The words [a, b) of each row."""
    return [text[x:y] for x, y in zip(begin[a].tolist(), end[b - 1].tolist())] if len(a) else []


def _rows(x: _Shared, here: np.ndarray, level: int, key, low: int, high: int, words: list, start=None, stop=None) -> pa.RecordBatch:
    n, doc = len(here), x.doc[here]
    start = x.at[here] - x.w.first[doc] if start is None else start
    const = lambda v: pa.array(np.full(n, v, np.int32))
    return pa.RecordBatch.from_arrays(
        [const(level), pa.array(np.asarray(key).view(np.int64)), const(low), const(high), pa.array(x.ids[doc]), pa.array(x.tie[doc]),
         pa.array(start.astype(np.int32)), pa.array((start if stop is None else stop).astype(np.int32)), pa.array(x.left[here].astype(np.int32)),
         pa.array(words if words else [None] * n, pa.binary()).cast(pa.string())], [c.split()[0] for c in _SUFFIX.split(", ")])


def _windows(x: _Shared, here: np.ndarray, at: np.ndarray, size: int, text, begin, end) -> list[pa.RecordBatch]:
    """Whole windows: the first of each in this batch, and the known repeats,
    those that follow each other as one."""
    order = np.lexsort((at, x.tie[x.doc[here]], x.ids[x.doc[here]]))
    here, at = here[order], at[order]
    words, seen, first = _cut(text, begin, end, at, at + size), set(), np.zeros(len(here), bool)
    for n, word in enumerate(words):
        if word not in seen:
            seen.add(word)
            first[n] = True
    h = W.runs(x.w.hash, size)
    start = at[first] - x.w.first[x.doc[here[first]]]
    out = [_rows(x, here[first], 2, h[at[first]], -1, -1, [w for w, f in zip(words, first) if f], start, start + size)]
    here, at = here[~first], at[~first]
    if len(at):
        new = np.concatenate(([True], (x.doc[here[1:]] != x.doc[here[:-1]]) | (at[1:] != at[:-1] + 1)))
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(at)) - 1
        first_word = x.w.first[x.doc[here[head]]]
        out.append(_rows(x, here[head], 3, W.mix(at[head].astype(_U)), -2, -2, [], at[head] - first_word, at[tail] + size - first_word))
    return out


def word_numbers(w: W.Words) -> np.ndarray:
    """A number for each word; equal numbers mean equal words."""
    _, first, number = np.unique(w.hash, return_index=True, return_inverse=True)
    like = first[number]
    size = w.end - w.start
    same = size == size[like]
    padded = np.concatenate((w.data, np.zeros(8, np.uint8)))
    eight = np.ndarray((len(w.data) + 1,), "<u8", padded, strides=(1,))
    live, at = np.flatnonzero(same & (like != np.arange(len(like)))), 0
    while len(live):
        left = size[live] - at
        mask = ~_U(0) >> ((_U(8) - np.minimum(left, 8).astype(_U)) * _U(8))
        equal = (eight[w.start[live] + at] & mask) == (eight[w.start[like[live]] + at] & mask)
        same[live[~equal]] = False
        live = live[equal & (left > 8)]
        at += 8
    if same.all():
        return number
    raw, names = w.data.tobytes(), {}
    return np.array([names.setdefault(raw[a:b], len(names)) for a, b in zip(w.start.tolist(), w.end.tolist())], np.int64)


class Tree:
    """The nodes of the subtrees of some suffixes, from their sorted words and
    the longest common prefixes of neighbours."""

    def __init__(self, group: np.ndarray, words: np.ndarray):
        self.order = np.lexsort((*words.T[::-1], group))
        rows, g = words[self.order], group[self.order]
        self.common = np.where(g[1:] == g[:-1], np.logical_and.accumulate(rows[1:] == rows[:-1], axis=1).sum(1), -1)

    def node(self, depth: int) -> np.ndarray:
        """The node of each suffix at a depth."""
        out = np.empty(len(self.order), np.int64)
        out[self.order] = np.concatenate(([0], np.cumsum(self.common < depth)))
        return out


def subtree_repeats(group, low, high, rank, n_left, words: pa.Array, size: int) -> np.ndarray:
    """(suffixes, offsets) booleans: whether the window that begins so many
    words before the anchor has an equal one of a lower ``rank`` in its group."""
    w, reach = W.split(words), size - PREFIX
    number, m = word_numbers(w), len(group)
    n_right = np.diff(w.first) - n_left
    # a missing word equals no other
    none = -1 - np.arange(m * size, dtype=np.int64).reshape(m, size)

    def around(begin, step, n, have):
        at, col = begin[:, None] + step * np.arange(n), np.arange(n)
        return np.where(col < have[:, None], number[np.clip(at, 0, len(number) - 1)], none[:, :n])
    anchor = w.first[:-1] + n_left
    right, left = Tree(group, around(anchor, 1, size, n_right)), Tree(group, around(anchor - 1, -1, reach, n_left))
    out = np.zeros((m, reach + 1), bool)
    for o in range(reach + 1):
        here = np.flatnonzero((low <= o) & (o <= high) & (n_left >= o) & (n_right >= size - o))
        node = left.node(o)[here] * (m + 1) + right.node(size - o)[here]
        order = np.lexsort((rank[here], node))
        again = np.concatenate(([False], node[order][1:] == node[order][:-1])) if len(here) else np.zeros(0, bool)
        out[here[order[again]], o] = True
    return out


def _later(rows: pa.Table, state: dict) -> pa.Table:
    """The windows of rows of level 2, sorted by key, id, tie and start, that
    are not the first with their words; ``state`` has those of the last key."""
    again = []
    for key, words in zip(rows.column("key").to_pylist(), rows.column("words").to_pylist()):
        if state.get("key") != key:
            state.clear()
            state["key"], state["seen"] = key, set()
        again.append(words in state["seen"])
        state["seen"].add(words)
    return rows.filter(pa.array(again, pa.bool_()))


def _subtrees(size: int):
    """Rows sorted by key, low, id, tie and start -> (id, tie, start, stop)."""
    def spans(t: pa.Table) -> pa.RecordBatch:
        col = {c: t.column(c).to_numpy() for c in ("key", "low", "high", "id", "tie", "start", "n_left")}
        new = np.concatenate(([True], (col["key"][1:] != col["key"][:-1]) | (col["low"][1:] != col["low"][:-1])))
        rank = np.empty(len(new), np.int64)
        rank[np.lexsort((col["start"], col["tie"], col["id"]))] = np.arange(len(new))
        words = t.column("words").combine_chunks()
        again = subtree_repeats(np.cumsum(new), col["low"], col["high"], rank, col["n_left"], words, size)
        # windows that follow each other are one span
        padded = np.pad(again, ((0, 0), (1, 1)))
        row, near = np.nonzero(padded[:, 1:] & ~padded[:, :-1])
        far = np.nonzero(padded[:, :-1] & ~padded[:, 1:])[1] - 1
        return pa.RecordBatch.from_arrays(
            [pa.array(col["id"][row]), pa.array(col["tie"][row]), pa.array((col["start"][row] - far).astype(np.int32)),
             pa.array((col["start"][row] - near + size).astype(np.int32))], ["id", "tie", "start", "stop"])

    def run(batches):
        let_go()
        held, n, state = [], 0, {}
        for batch in batches:
            level = batch.column(0).to_numpy()
            if (level > 1).any():
                whole = pa.Table.from_batches([batch.filter(pa.array(level == 2))])
                known = pa.Table.from_batches([batch.filter(pa.array(level == 3))])
                for t in (_later(whole, state), known):
                    yield from t.select(["id", "tie", "start", "stop"]).to_batches()
                batch = batch.filter(pa.array(level < 2))
            if not batch.num_rows:
                continue
            held.append(batch)
            n += batch.num_rows
            if n >= CHUNK:
                t = pa.Table.from_batches(held).combine_chunks()
                key, low = t.column("key").to_numpy(), t.column("low").to_numpy()
                # the last group may go on
                end = int(np.flatnonzero((key != key[-1]) | (low != low[-1]))[-1]) + 1 if ((key != key[-1]) | (low != low[-1])).any() else 0
                if end:
                    yield spans(t.slice(0, end))
                held = t.slice(end).combine_chunks().to_batches()
                n = t.num_rows - end
        if n:
            yield spans(pa.Table.from_batches(held))
    return run


def _documents(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(texts that are no copy of an earlier whole text, all rows): id, tie,
    text, copied.  ``tie`` tells apart rows that repeat an id."""
    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("id"), F.col(id_col).alias("own"),
                      text_or_empty(text_col).alias("text"))
    narrow = cut(src.select("id", F.sha2("text", 256).alias("sha")))
    n = max(1, narrow.count())
    twice = cut(narrow.groupBy("id").count().filter("count > 1").select("id"))
    bits = bloom_bits(twice.count())
    src = maybe_in(src, F.xxhash64("id"), bloom_of(twice.select(F.xxhash64("id").alias("h")), "h", bits), bits, "again")
    src = src.withColumn("tie", F.when(F.col("again"), F.xxhash64("text")).otherwise(F.lit(0).cast("long")))

    groups = cut(narrow.groupBy("sha").agg(F.min("id").alias("lead"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    copies = cut(attach(narrow, groups, ["sha"], "n", n).filter("lead < id").select("id", "sha").distinct())
    bits = bloom_bits(copies.count())
    src = maybe_in(src, F.xxhash64("id"), bloom_of(copies.select(F.xxhash64("id").alias("h")), "h", bits), bits, "maybe")
    sure = src.filter(~F.col("maybe")).select("id", "own", "tie", "text", "again", F.lit(False).alias("copied"))
    asked = src.filter("maybe").withColumn("sha", F.sha2("text", 256)).join(
        copies.withColumn("copied", F.lit(True)), ["id", "sha"], "left").select(
        "id", "own", "tie", "text", "again", F.coalesce("copied", F.lit(False)).alias("copied"))
    rows = sure.unionByName(asked)
    texts = rows.filter(~F.col("copied")).select("id", "tie", "text", "again")
    # rows that repeat an id and a text are one document
    texts = texts.filter(~F.col("again")).unionByName(texts.filter("again").dropDuplicates(["id", "tie"]))
    return texts.select("id", "tie", "text"), rows.drop("again")


def _with_lists(rows: DataFrame, lists: DataFrame, name: str, others: bool) -> DataFrame:
    """``rows`` with the list of their document; texts of documents that have
    none do not shuffle (``others``: they come along with a null list)."""
    bits = bloom_bits(lists.count())
    marked = maybe_in(rows, F.xxhash64("id"), bloom_of(lists.select(F.xxhash64("id").alias("h")), "h", bits), bits, "some")
    found = marked.filter("some").drop("some").join(lists, ["id", "tie"], "left" if others else "inner")
    if not others:
        return found
    return found.unionByName(marked.filter(~F.col("some")).drop("some").withColumn(name, F.lit(None).cast(lists.schema[name].dataType)))


def repeats(docs: DataFrame, size: int = 20, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, ranges): all rows as id, own (id as given), tie, text, copied;
    and for documents with repeats id, tie, spans: array of start * 2^32 + stop
    in words, each covered by windows that also start earlier."""
    spark = docs.sparkSession
    texts, rows = _documents(docs, id_col, text_col)
    over = Window.partitionBy("key")
    votes = F.sum(F.when(F.col("kind") == 1, 2).when(F.col("kind") == 0, 1).otherwise(0)).over(over)
    marked, folder = stored(
        texts.mapInArrow(_anchor_rows(size), _CONTEST).withColumn("votes", votes).withColumn("total", F.sum("n").over(over))
        .filter("kind = 2 or votes > 1").select("key", "id", "tie", "number", "kind", "total"), "suffixes")
    limit = max(GROUP, marked.count() // MOST_GROUPS)
    hot = _keys(marked.filter(F.col("total") > limit).select("key").distinct())
    shared = cut(marked.filter("kind != 1").groupBy("id", "tie").agg(F.collect_set("number").alias("shared")))
    drop_folder(spark, folder)

    source = _with_lists(texts, shared, "shared", False).select("id", "tie", "text", "shared")
    hot_b, longer = spark.sparkContext.broadcast(hot), np.zeros(0, _U)
    if len(hot):
        counts = source.mapInArrow(_longer(size, hot_b), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
        longer = _keys(counts.filter(F.col("n") > limit).select("key"))
    suffixes = source.mapInArrow(_suffix_rows(size, hot_b, spark.sparkContext.broadcast(longer)), _SUFFIX)
    found = (suffixes.repartition("key", "low").sortWithinPartitions("key", "low", "id", "tie", "start")
             .mapInArrow(_subtrees(size), "id long, tie long, start int, stop int"))
    span = F.shiftleft(F.col("start").cast("long"), 32) + F.col("stop")
    return rows, cut(found.groupBy("id", "tie").agg(F.collect_set(span).alias("spans")))


def _keys(keys: DataFrame) -> np.ndarray:
    """Sorted keys of groups over the limit: at most ``MOST_GROUPS``, by their size."""
    return np.sort(keys.toPandas()["key"].to_numpy(np.int64).view(_U))


def _report(size: int):
    def run(batches):
        for batch in batches:
            col = batch.column(1)
            out = []
            for i, j in W.slices(col):
                w = W.split(col.slice(i, j - i))
                raw = w.data.tobytes()
                for r in range(j - i):
                    a, b = int(w.first[r]), int(w.first[r + 1])
                    n, spans = b - a, batch.column(3)[i + r]
                    keep = np.ones(n, bool)
                    if batch.column(2)[i + r].as_py():
                        keep[:] = n < size
                    elif spans.is_valid:
                        s = spans.values.to_numpy(zero_copy_only=False)
                        edge = np.zeros(n + 1, np.int64)
                        np.add.at(edge, s >> 32, 1)
                        np.add.at(edge, s & 0xFFFFFFFF, -1)
                        keep = np.cumsum(edge)[:n] == 0
                    stay = np.flatnonzero(keep) + a
                    text = b" ".join([raw[x:y] for x, y in zip(w.start[stay].tolist(), w.end[stay].tolist())])
                    out.append((n, n - len(stay), text))
            cols = list(zip(*out)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                                              pa.array([hashlib.sha256(x).hexdigest() for x in cols[2]], pa.string()),
                                              pa.array([x.decode("utf-8", "replace") for x in cols[2]], pa.string())],
                                             ["own", "n_words", "n_removed", "kept_sha256", "kept"])
    return run


def remove_repeats(docs: DataFrame, size: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, kept_sha256, kept.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.  Removed is each word
    covered by a window of ``size`` words whose sequence also starts earlier:
    at a smaller id, or earlier in the same document; windows are judged on
    the input.  ``kept`` holds the other words joined by one space.  A null
    text has no words; texts shorter than a window lose nothing; a null id
    comes after all others.  Rows that repeat an id and a text are one
    document and get the same result; rows that repeat an id with another
    text are ordered by a hash of it.  Other columns are ignored.  Empty
    table: no rows."""
    ship(docs.sparkSession)
    rows, ranges = repeats(docs, size, id_col, text_col)
    full = _with_lists(rows, ranges, "spans", True).select("own", "text", "copied", "spans")
    out = full.mapInArrow(_report(size), "own long, n_words long, n_removed long, kept_sha256 string, kept string")
    return out.withColumnRenamed("own", id_col)
