"""Toxicity by a bidirectional GRU with attention pooling, in numpy.

A word's input is the embedding of its hash plus those of its character
three- and four-grams.  A gated recurrent network reads each window of words in both
directions; attention over the states gives the window's score, and the
highest-scoring of all overlapping windows gives the text's score.

Training is multiple-instance learning in one task, on a bounded sample of
labelled documents (``TRAIN`` of each class, ``TRAIN_BYTES`` of text): in each epoch the window of a
document that now scores highest, and one at random, learn its label.  The
model has a fixed size and goes to the workers in a broadcast.  Scoring is one
Arrow pass over the texts, without a shuffle: input projections are computed
once for each distinct word of a slice, and all windows of a slice advance
through the recurrence together.
"""

from __future__ import annotations

import pickle
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import let_go, ship, text_or_empty
from . import words as W

TRAIN = 2_000                 # labelled documents of each class that training takes at most
TRAIN_BYTES = 8 << 20         # and bytes of their texts, of each class
SLICE = 500_000               # bytes of text that are held as words at a time
WINDOW, STRIDE = 32, 24       # words
WORDS, GRAMS = 1 << 13, 1 << 14
DIM, HIDDEN, EPOCHS, STEPS, BATCH, RATE = 8, 8, 6, 280, 128, 0.02   # more epochs where six have fewer steps
_U = np.uint64
_f = np.float32


class Inputs(NamedTuple):
    """Distinct words of some texts, and their windows."""
    word: np.ndarray       # bucket of each distinct word
    tri: np.ndarray        # character gram buckets of the distinct words, one after the other
    tri_at: np.ndarray     # where each word's grams begin; one more at the end
    of: np.ndarray         # distinct word at each word position; one more for padding
    start: np.ndarray      # first position of each window
    size: np.ndarray       # words in it
    doc: np.ndarray        # row of its text


def inputs(column: pa.Array) -> Inputs:
    """The inputs of all texts, built a slice at a time."""
    parts = [_inputs(column.slice(i, j - i)) for i, j in W.slices(column, SLICE)] or [_inputs(column)]
    if len(parts) == 1:
        return parts[0][1]
    rows = np.cumsum([0] + [j - i for i, j in W.slices(column, SLICE)])
    hashes, parts = [h for h, _ in parts], [p for _, p in parts]
    known, first, of = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
    tri_at = np.concatenate([p.tri_at[:-1] for p in parts]) + np.repeat(np.cumsum([0] + [len(p.tri) for p in parts[:-1]]), [len(h) for h in hashes])
    n = np.concatenate([np.diff(p.tri_at) for p in parts])[first]
    take = np.arange(n.sum()) + np.repeat(tri_at[first] - np.cumsum(n) + n, n)
    at, words = np.cumsum([0] + [len(p.of) - 1 for p in parts]), np.split(of, np.cumsum([len(h) for h in hashes])[:-1])
    return Inputs(
        np.concatenate([p.word for p in parts])[first], np.concatenate([p.tri for p in parts])[take], np.concatenate(([0], np.cumsum(n))),
        np.concatenate([w[p.of[:-1]].astype(np.int32) for w, p in zip(words, parts)] + [np.array([len(known)], np.int32)]),
        np.concatenate([p.start + a for p, a in zip(parts, at)]), np.concatenate([p.size for p in parts]), np.concatenate([p.doc + r for p, r in zip(parts, rows)]))


def _inputs(column: pa.Array) -> tuple[np.ndarray, Inputs]:
    w = W.split(column, True)
    _, first, of = np.unique(w.hash, return_index=True, return_inverse=True)
    begin, size = w.start[first], (w.end - w.start)[first]
    # the bytes of each distinct word between two marks
    at = np.concatenate(([0], np.cumsum(size + 2)))
    marked = np.full(at[-1], 94, np.int64)
    marked[at[1:] - 1] = 36
    body = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    marked[np.repeat(at[:-1] + 1, size) + body] = w.data[np.repeat(begin, size) + body]
    # a word of n bytes has n trigrams, then n - 1 four-grams
    grams = 2 * size - 1
    tri_at = np.concatenate(([0], np.cumsum(grams)))
    k, of_word = np.arange(tri_at[-1]) - np.repeat(tri_at[:-1], grams), np.repeat(size, grams)
    four = k >= of_word
    q = np.repeat(at[:-1], grams) + np.where(four, k - of_word, k)
    marked = np.append(marked, 0)
    h = marked[q] << 24 | marked[q + 1] << 16 | marked[q + 2] << 8 | np.where(four, marked[np.minimum(q + 3, len(marked) - 1)], 0)
    tri = (W.mix(h.astype(_U)) % _U(GRAMS)).astype(np.int32)
    n = np.diff(w.first)
    windows = np.where(n > WINDOW, -(-(n - WINDOW) // STRIDE) + 1, (n > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(n)), windows)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(windows) - windows, windows)
    shift = np.minimum(number * STRIDE, np.maximum(n[doc] - WINDOW, 0))
    return w.hash[first], Inputs((w.hash[first] % _U(WORDS)).astype(np.int32), tri, tri_at, np.append(of, len(first)).astype(np.int32),
                                 w.first[doc] + shift, np.minimum(n[doc], WINDOW), doc)


def grams_of(inp: Inputs, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the grams of some words, and how many each word has."""
    n = inp.tri_at[words + 1] - inp.tri_at[words]
    return np.arange(n.sum()) + np.repeat(inp.tri_at[words] - np.cumsum(n) + n, n), n


class Model:
    """Parameters: embeddings, and for each direction input weights (DIM, 3 H),
    recurrent weights (H, 3 H), biases (3 H), attention and output (H, 2)."""

    def __init__(self, rng: np.random.Generator):
        g = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(_f)
        self.p = {"word": (0.1 * rng.standard_normal((WORDS, DIM))).astype(_f), "tri": (0.1 * rng.standard_normal((GRAMS, DIM))).astype(_f), "b": np.zeros(1, _f)}
        for d in "fb":
            self.p |= {f"x{d}": g(DIM, 3 * HIDDEN), f"h{d}": g(HIDDEN, 3 * HIDDEN), f"c{d}": np.zeros(3 * HIDDEN, _f), f"o{d}": g(HIDDEN, 2)}

    def embed(self, inp: Inputs, words: np.ndarray) -> np.ndarray:
        """One vector for each of these distinct words; the word after the
        last is padding, all zeros."""
        p, real = self.p, words < len(inp.word)
        x = np.zeros((len(words), DIM), _f)
        words = words[real]
        if len(words):
            at, n = grams_of(inp, words)
            x[real] = p["word"][inp.word[words]] + np.add.reduceat(p["tri"][inp.tri[at]], np.cumsum(n) - n, axis=0) / np.sqrt(n)[:, None].astype(_f)
        return x

    def run(self, x: np.ndarray, rows: np.ndarray, size: np.ndarray, keep: bool = False):
        """Logits of windows: ``rows`` are distinct words (windows, WINDOW),
        padded at the end.  ``keep`` returns what the gradient needs, too."""
        p, steps = self.p, rows.shape[1]
        scores, tape = [], {}
        ragged = bool((size < steps).any())
        for d in "fb":
            proj = x @ p[f"x{d}"] + p[f"c{d}"]
            u, out = p[f"h{d}"], np.empty((steps, len(rows), 2), _f)
            h = np.zeros((len(rows), HIDDEN), _f)
            states = []
            for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
                a = proj[rows[:, t]]
                r = h @ u
                zr = 1 / (1 + np.exp(-(a[:, : 2 * HIDDEN] + r[:, : 2 * HIDDEN])))
                z, reset = zr[:, :HIDDEN], zr[:, HIDDEN:]
                n = np.tanh(a[:, 2 * HIDDEN:] + reset * r[:, 2 * HIDDEN:])
                new = n + z * (h - n)
                if ragged:
                    new = np.where((size > t)[:, None], new, h)
                if keep:
                    states.append((t, h, zr, n, r[:, 2 * HIDDEN:], new))
                h = new
                out[t] = h @ p[f"o{d}"]
            scores.append(out)
            tape[d] = states
        both = scores[0] + scores[1]
        att = both[:, :, 0]
        if ragged:
            att = np.where(np.arange(steps)[:, None] < size, att, _f(-1e9))
        att = np.exp(att - att.max(0))
        att /= att.sum(0)
        logit = (att * both[:, :, 1]).sum(0) + p["b"][0]
        return (logit, att, both, tape) if keep else logit

    def gradient(self, inp: Inputs, which: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
        p = self.p
        rows = window_rows(inp, which)
        size = inp.size[which]
        words, rows = np.unique(rows, return_inverse=True)
        rows = rows.reshape(len(which), -1)
        x = self.embed(inp, words)
        logit, att, both, tape = self.run(x, rows, size, True)
        g = {k: np.zeros_like(v) for k, v in p.items() if k not in ("word", "tri")}
        dl = ((1 / (1 + np.exp(-logit)) - y) * weight / weight.sum()).astype(_f)
        g["b"][0] = dl.sum()
        value = both[:, :, 1]
        dvalue = att * dl
        datt = att * (value - (att * value).sum(0)) * dl
        dx = np.zeros_like(x)
        live = np.arange(rows.shape[1])[:, None] < size
        for d in "fb":
            u, out = p[f"h{d}"], p[f"o{d}"]
            dh = np.zeros((len(which), HIDDEN), _f)
            dproj = np.zeros((len(x), 3 * HIDDEN), _f)
            for t, h, zr, n, rn, new in reversed(tape[d]):
                ds = np.stack((datt[t], dvalue[t]), 1)
                g[f"o{d}"] += new.T @ ds
                dh = dh + ds @ out.T
                on = live[t][:, None]
                dn_ = np.where(on, dh, 0)
                z, reset = zr[:, :HIDDEN], zr[:, HIDDEN:]
                dz = dn_ * (h - n) * z * (1 - z)
                dn = dn_ * (1 - z) * (1 - n * n)
                dr = dn * rn * reset * (1 - reset)
                da = np.concatenate((dz, dr, dn), 1)
                drec = np.concatenate((dz, dr, dn * reset), 1)
                g[f"h{d}"] += h.T @ drec
                np.add.at(dproj, rows[:, t], da)
                dh = np.where(on, dn_ * z, dh) + drec @ u.T
            g[f"x{d}"] = x.T @ dproj
            g[f"c{d}"] = dproj.sum(0)
            dx += dproj @ p[f"x{d}"].T
        real = words < len(inp.word)
        words, dx = words[real], dx[real]
        at, n = grams_of(inp, words)
        g["word"], g["tri"] = np.zeros_like(p["word"]), np.zeros_like(p["tri"])
        np.add.at(g["word"], inp.word[words], dx)
        np.add.at(g["tri"], inp.tri[at], np.repeat(dx / np.sqrt(n)[:, None].astype(_f), n, axis=0))
        return g


def window_rows(inp: Inputs, which: np.ndarray) -> np.ndarray:
    at = inp.start[which][:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < inp.size[which][:, None]
    return inp.of[np.where(inside, at, len(inp.of) - 1)]


def window_logits(model: Model, inp: Inputs, step: int = 4096) -> np.ndarray:
    x = model.embed(inp, np.arange(len(inp.word) + 1))
    order = np.argsort(inp.size, kind="stable")        # short windows together
    out = np.empty(len(order), _f)
    for i in range(0, len(order), step):
        part = order[i: i + step]
        out[part] = model.run(x, window_rows(inp, part), inp.size[part])
    return out


def train(texts: list[str], labels: list[int], seed: int = 5) -> Model | None:
    """None unless both labels occur."""
    y = np.array(labels, _f)
    if len(set(labels)) < 2:
        return None
    rng = np.random.default_rng(seed)
    model, inp = Model(rng), inputs(pa.array(texts, pa.string()))
    _log_odds(model, inp, y)
    first = np.searchsorted(inp.doc, np.arange(len(y)), "left")
    count = np.searchsorted(inp.doc, np.arange(len(y)), "right") - first
    full = np.flatnonzero(count)
    if len(set(y[full].tolist())) < 2:
        return None
    m, v = ({k: np.zeros_like(p) for k, p in model.p.items()} for _ in range(2))
    step = 0
    share = [(y[full] == 1).sum(), 2 * (y[full] == 0).sum()]          # windows of each label in an epoch
    epochs = max(EPOCHS, -(-STEPS // -(-int(sum(share)) // BATCH)))
    for epoch in range(epochs):
        logit = window_logits(model, inp)
        best = np.lexsort((-logit, inp.doc))[first[full]]
        # the best window learns the label of its text; a random window only
        # teaches that clean texts are clean everywhere
        other = first[full] + rng.integers(0, count[full])
        clean = y[full] == 0
        which = np.concatenate((best, other[clean]))
        label = np.concatenate((y[full], np.zeros(clean.sum(), _f)))
        order = rng.permutation(len(which))
        for i in range(0, len(order), BATCH):
            part = order[i: i + BATCH]
            # both labels weigh the same
            weight = np.where(label[part] == 1, share[1] / max(1, share[0]), 1.0).astype(_f)
            g = model.gradient(inp, which[part], label[part], weight)
            step += 1
            rate = RATE * (1 - epoch / (epochs + 1))
            for k, d in g.items():
                m[k] += 0.1 * (d - m[k])
                v[k] += 0.01 * (d * d - v[k])
                model.p[k] -= (rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-6)).astype(_f)
    return model


def _log_odds(model: Model, inp: Inputs, y: np.ndarray) -> None:
    """First dimension of the embeddings: smoothed log odds of toxic texts
    among those that hold the bucket, so that training starts near evidence."""
    begin = np.full(len(y), len(inp.of), np.int64)
    end = np.zeros(len(y), np.int64)
    np.minimum.at(begin, inp.doc, inp.start)
    np.maximum.at(end, inp.doc, inp.start + inp.size)
    counts = {"word": np.zeros((2, WORDS)), "tri": np.zeros((2, GRAMS))}
    for d in range(len(y)):
        words = np.unique(inp.of[begin[d]: end[d]]) if end[d] > begin[d] else np.zeros(0, np.int64)
        counts["word"][int(y[d]), np.unique(inp.word[words])] += 1
        at, _ = grams_of(inp, words)
        counts["tri"][int(y[d]), np.unique(inp.tri[at])] += 1
    share = [max(1, (y == c).sum()) for c in (0, 1)]
    for k, c in counts.items():
        odds = np.log((c[1] + 0.5) / (share[1] + 1)) - np.log((c[0] + 0.5) / (share[0] + 1))
        model.p[k][:, 0] = (np.clip(odds, -3, 3) * np.minimum(1, c.sum(0) / 10) / 3).astype(_f)


def _score(shared):
    def run(batches):
        model = shared.value
        let_go()
        for batch in batches:
            for i, j in W.slices(batch.column(1), SLICE):
                score = np.zeros(j - i)
                if model is not None:
                    inp = inputs(batch.column(1).slice(i, j - i))
                    best = np.full(j - i, -np.inf)
                    np.maximum.at(best, inp.doc, window_logits(model, inp).astype(np.float64))
                    score = 1 / (1 + np.exp(-best))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(score)], ["id", "score"])
    return run


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept from training: crc32 of the id's text mod 5 is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        most: int = TRAIN) -> Model | None:
    """The model trained on at most ``most`` documents of each class: those
    with the smallest hash of their id, never held-out ones.  Labels that are
    not 0 or 1, null ids and ids that repeat with both labels are left out."""
    known = (labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(id_col)
             .agg(F.min(label_col).alias("lo"), F.max(label_col).alias("hi")).filter("lo = hi").filter(~held_out(id_col)))
    ids = []
    for c in (0, 1):
        part = known.filter(F.col("lo") == c).select(id_col, "lo").orderBy(F.xxhash64(F.col(id_col)), id_col).limit(most)
        ids += [(r[0], int(r[1])) for r in part.collect()]            # bounded by `most`
    if not ids:
        return None
    spark = docs.sparkSession
    ship(spark)
    wanted = spark.createDataFrame(ids, f"{id_col} long, _label int")
    # an id that repeats comes once, before the texts meet in one task
    rows = (docs.select(F.col(id_col).cast("long").alias(id_col), text_or_empty(text_col).alias("text")).join(F.broadcast(wanted), id_col)
            .groupBy(id_col, "_label").agg(F.min("text").alias("text")).select(F.xxhash64(id_col).alias("h"), id_col, "text", "_label").repartition(1))
    found = rows.mapInArrow(_train, "model binary").collect()
    return pickle.loads(bytes(found[0]["model"])) if found else None


def _train(batches):
    """The sample's rows -> one row with the trained model, or none.  One task
    trains, on an executor: the driver gets the model and no text.  Of each
    class the texts come in the order of the ids' hashes, until the next one
    would pass ``TRAIN_BYTES`` (the first comes in any case)."""
    let_go()
    rows = {0: [], 1: []}
    for batch in batches:
        for part in [batch.slice(i, 64) for i in range(0, batch.num_rows, 64)]:
            for h, i, text, label in zip(*(part.column(c).to_pylist() for c in range(4))):
                rows[label].append((h, i, text))
            for label in rows:
                rows[label] = _within(sorted(rows[label]))
    texts = sorted((i, text, label) for label, part in rows.items() for _, i, text in part)
    model = train([t for _, t, _ in texts], [c for _, _, c in texts])
    if model is not None:
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])


def _within(rows: list[tuple]) -> list[tuple]:
    total = np.cumsum([len(r[2].encode()) for r in rows])
    return rows[:max(1, int(np.searchsorted(total, TRAIN_BYTES, "right")))]


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, score, predicted.

    ``score`` is 0 to 1, the highest of all windows; null and empty texts and
    texts without words score 0, and so does everything without a model.
    Repeated rows repeat, null ids stay null, other columns are ignored; an
    empty table gives no rows."""
    ship(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    out = src.mapInArrow(_score(docs.sparkSession.sparkContext.broadcast(model)), f"id {kind}, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int")).withColumnRenamed("id", id_col)


def keep_clean(docs: DataFrame, model: Model | None, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, columns unchanged."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            text = pa.RecordBatch.from_arrays([batch.column(at), batch.column(at)], ["id", "text"])
            score = [x for part in _score(shared)([text]) for x in part.column(1).to_pylist()]
            yield batch.filter(pa.array([x < threshold for x in score], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
