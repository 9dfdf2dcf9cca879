"""BPE encoding and decoding with a minimal acyclic transducer lexicon.

The chunks between white space of the whole corpus are counted, and the words
of the most frequent ones (a bounded number, ``LEXICON``) are encoded once and compiled into a minimal
acyclic automaton: words share prefixes and suffixes, and the sum of the
outputs on a word's arcs is its number, which points at its ids.  The arrays
go to the shared folder; each worker maps its copy into memory.  All words of
a batch walk the automaton together, one byte a step; words outside it are
merged exactly, pair by pair, by the merge ranks.  The lexicon changes only
the speed, never an id.

The vocabulary is a `tokenizers` JSON file of the kind: NFC, white space to
spaces, lower case; split into contractions, letters, single digits and other
runs; bytes as characters; BPE with the word end ``</w>``; no decoder.
"""

from __future__ import annotations

import json
import mmap
import os
import re
import sys
import tempfile
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, filesystem, held, let_go, make_folder, scratch, ship, text_or_empty
from . import words as W

LEXICON = 131_072     # chunks whose words make the automaton, at most

# White_Space of Unicode, as ranges for a class
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_BIG = np.int32(2**31 - 1)


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level BPE:
    printable Latin-1 stands for itself, the rest follows from U+0100 on."""
    same = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in same else chr(next(spare)) for b in range(256)]


# Letters and digits that Unicode 16.0 added, as first-last code
# points, and the lower case of new capitals up to 17.0; the tokenizers library
# knows them, Python's table does not.
_NEW = {
    "L": "1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D4A-10D65 10D6F-10D85 10EC2-10EC4 11380-11389 1138B-1138B 1138E-1138E "
         "11390-113B5 113B7-113B7 113D1-113D1 113D3-113D3 11BC0-11BE0 13460-143FA 16100-1611D 16D40-16D6C 18CFF-18CFF 1E5D0-1E5ED 1E5F0-1E5F0",
    "N": "10D40-10D49 116D0-116E3 11BF0-11BF9 16130-16139 16D70-16D79 1CCF0-1CCF9 1E5F1-1E5FA",
}
_LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5,
          **{c: c + 27 for c in range(0x16EA0, 0x16EB9)}, **{c: c + 32 for c in range(0x10D50, 0x10D66)}}
_CAPITALS = re.compile("[" + "".join(map(chr, _LOWER)) + "Σ]")
_LOWER[ord("Σ")] = ord("σ")     # character by character: no final form of sigma


def _width(text: str) -> int:
    """At least the bytes that Python stores a character of the text in: below
    2 all characters are below U+0100, below 4 all are below U+10000."""
    return sys.getsizeof(text) // max(1, len(text))


def _class(kind: str, last: int) -> str:
    """The characters of a general category up to ``last``, as ranges."""
    inside = np.fromiter((unicodedata.category(chr(c))[0] == kind for c in range(0x110000)), bool, 0x110000)
    for part in _NEW[kind].split():
        a, b = (int(x, 16) for x in part.split("-"))
        inside[a: b + 1] = True
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside[: last + 1], [False])).astype(np.int8)))
    return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()))


class Vocabulary:
    """What a vocabulary file says."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        model = spec["model"]
        vocab = model["vocab"]
        self.token = [""] * (1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]))
        for t, i in vocab.items():
            self.token[i] = t
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for t, i in self.special.items():
            self.token[i] = t
        self.special_re = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # texts below U+10000 take a pattern of bit maps only
        self.word, self.word_wide = (
            re.compile(pattern.replace(r"\p{L}", _class("L", last)).replace(r"\p{N}", _class("N", last)).replace(r"\s", _WHITE))
            for last in (0xFFFF, 0x10FFFF))
        end, chars = model["end_of_word_suffix"], byte_characters()
        self.inner = np.array([vocab[c] for c in chars], np.int32)
        self.final = np.array([vocab[c + end] for c in chars], np.int32)
        self.size = len(self.token)
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        left, right = (np.array([vocab[p[i]] for p in pairs], np.int64) for i in (0, 1))
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        key = left * self.size + right
        order = np.argsort(key, kind="stable")
        self.pair_key, self.pair_rank = key[order], order.astype(np.int32)

    def words(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            if _width(text) > 1 and _CAPITALS.search(text):
                text = text.translate(_LOWER)
        text = text.lower()
        return (self.word if _width(text) < 4 else self.word_wide).findall(text)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where((self.pair_key[at] == key) & (a >= 0) & (b >= 0), self.pair_rank[at], _BIG)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Exact BPE of each word, again and again the leftmost pair of least
        rank: (number of ids of each word, all ids)."""
        size = np.array([len(w) for w in words], np.int64)
        n = np.zeros(len(words), np.int64)
        found, low = [], 0
        for high in (4, 8, 16, 32, 64):
            which = np.flatnonzero((size > low) & (size <= high))
            for part in np.array_split(which, len(which) // 20_000 + 1):
                if len(part):
                    s = self._merge_rows([words[i] for i in part.tolist()], size[part], high)
                    n[part] = (s >= 0).sum(1)
                    found.append((part, s[s >= 0]))
            low = high
        for i in np.flatnonzero(size > 64).tolist():
            s = self._merge_long(words[i])
            n[i] = len(s)
            found.append((np.array([i]), s))
        begin = np.cumsum(n) - n
        flat = np.empty(int(n.sum()), np.int32)
        for part, ids in found:
            flat[ragged(begin[part], n[part])] = ids
        return n, flat

    def _merge_rows(self, words: list[bytes], size: np.ndarray, width: int) -> np.ndarray:
        raw = np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), np.uint8).reshape(len(words), width)
        cols, out = np.arange(width), np.full((len(words), width), -1, np.int32)
        s = np.where(cols < size[:, None] - 1, self.inner[raw], np.where(cols == size[:, None] - 1, self.final[raw], -1)).astype(np.int32)
        r, where = self.ranks(s[:, :-1], s[:, 1:]), np.arange(len(words))
        while len(s):
            j = r.argmin(1)
            rank = r[np.arange(len(s)), j]
            done = rank == _BIG
            if done.any():
                out[where[done]] = s[done]
                s, r, j, rank, where = s[~done], r[~done], j[~done], rank[~done], where[~done]
                if not len(s):
                    break
            at = np.arange(len(s))
            s[at, j] = self.made[rank]
            shift = np.minimum(cols + (cols > j[:, None]), width - 1)
            s = np.take_along_axis(s, shift, 1)
            s[:, -1] = -1
            r = np.take_along_axis(r, np.minimum(shift[:, :-1], width - 2), 1)
            r[:, -1] = _BIG
            r[at, j] = self.ranks(s[at, j], s[at, j + 1])
            left = at[j > 0]
            r[left, j[left] - 1] = self.ranks(s[left, j[left] - 1], s[left, j[left]])
        return out

    def _merge_long(self, word: bytes) -> np.ndarray:
        """The same for a long word, with a heap of pairs and linked symbols."""
        import heapq
        raw = np.frombuffer(word, np.uint8)
        s = self.inner[raw]
        s[-1] = self.final[raw[-1]]
        first = self.ranks(s[:-1], s[1:])
        s, n = s.tolist(), len(word)
        nxt, prv, heap = [*range(1, n), -1], [*range(-1, n - 1)], []
        for i in np.flatnonzero(first != _BIG):
            heap.append((int(first[i]), int(i), s[i], s[i + 1]))
        heapq.heapify(heap)
        table = self.lookup()
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            k = nxt[i]
            if s[i] != a or k < 0 or s[k] != b:
                continue
            s[i], s[k] = int(self.made[rank]), -1
            nxt[i] = nxt[k]
            if nxt[k] >= 0:
                prv[nxt[k]] = i
            for x, y in ((prv[i], i), (i, nxt[i])):
                if x >= 0 and y >= 0:
                    found = table.get((s[x], s[y]))
                    if found is not None:
                        heapq.heappush(heap, (found, x, s[x], s[y]))
        return np.array([x for x in s if x >= 0], np.int32)

    def lookup(self) -> dict:
        if not hasattr(self, "_lookup"):
            self._lookup = {(int(k) // self.size, int(k) % self.size): int(r) for k, r in zip(self.pair_key, self.pair_rank)}
        return self._lookup


# ---- the automaton ---------------------------------------------------------

def compile_lexicon(words: list[bytes]) -> dict[str, np.ndarray]:
    """Minimal acyclic automaton of sorted distinct words: arcs sorted by
    (state, byte) with target and output; ``final`` marks accepting states.
    A word's number in sorted order is the sum of its arcs' outputs."""
    register: dict[tuple, int] = {}
    arcs: list[list[tuple[int, int]]] = []      # of frozen states
    count: list[int] = []                       # words below each state
    accept: list[bool] = []

    def freeze(node) -> int:
        final, out = node
        key = (final, *(x for arc in out for x in arc))
        state = register.get(key)
        if state is None:
            state = register[key] = len(arcs)
            arcs.append(out)
            accept.append(final)
            count.append(final + sum(count[t] for _, t in out))
        return state

    path: list[list] = [[False, []]]            # nodes of the last word, open
    last = b""
    for word in words:
        common = 0
        for x, y in zip(last, word):
            if x != y:
                break
            common += 1
        while len(path) > common + 1:
            node = path.pop()
            path[-1][1].append((last[len(path) - 1], freeze(node)))
        for _ in word[common:]:
            path.append([False, []])
        path[-1][0] = True
        last = word
    while len(path) > 1:
        node = path.pop()
        path[-1][1].append((last[len(path) - 1], freeze(node)))
    root = freeze(path[0])
    key, target, output = [], [], []
    for state, out in enumerate(arcs):
        before = int(accept[state])
        for label, to in out:
            key.append(state * 256 + label)
            target.append(to)
            output.append(before)
            before += count[to]
    return {"key": np.array(key, np.int64), "target": np.array(target, np.int32), "output": np.array(output, np.int32),
            "final": np.array(accept, np.uint8), "root": np.array([root], np.int32)}


def walk(auto: dict[str, np.ndarray], words: list[bytes]) -> np.ndarray:
    """The number of each word, -1 for words outside the lexicon."""
    out = np.full(len(words), -1, np.int64)
    if not len(auto["key"]) or not words:
        return out
    size = np.array([len(w) for w in words], np.int64)
    start = np.cumsum(size) - size
    data = np.frombuffer(b"".join(words), np.uint8)
    live = np.flatnonzero(size > 0)
    state = np.full(len(live), auto["root"][0], np.int64)
    total = np.zeros(len(live), np.int64)
    step = 0
    while len(live):
        key = state * 256 + data[start[live] + step]
        at = np.minimum(np.searchsorted(auto["key"], key), len(auto["key"]) - 1)
        ok = auto["key"][at] == key
        live, at = live[ok], at[ok]
        state, total = auto["target"][at].astype(np.int64), total[ok] + auto["output"][at]
        step += 1
        ends = size[live] == step
        good = ends & (auto["final"][state] == 1)
        out[live[good]] = total[good]
        live, state, total = live[~ends], state[~ends], total[~ends]
    return out


def save(arrays: dict[str, np.ndarray], folder: str, name: str) -> None:
    """One file: a JSON header of names, types and places, then the arrays."""
    head, at, parts = {}, 0, []
    for k, v in arrays.items():
        raw = np.ascontiguousarray(v).tobytes()
        pad = -len(raw) % 64
        head[k] = (v.dtype.str, at, len(v))
        parts.append(raw + b"\0" * pad)
        at += len(raw) + pad
    text = json.dumps(head).encode()
    text += b" " * (-(len(text) + 8) % 64)
    fs, root = filesystem(folder)
    with fs.open_output_stream(f"{root}/{name}", compression=None) as f:
        f.write(len(text).to_bytes(8, "little") + text + b"".join(parts))


def load(folder: str, name: str) -> dict[str, np.ndarray]:
    """The arrays, memory-mapped from the worker's own copy, which has no name
    any more once it is mapped."""
    fs, root = filesystem(folder)
    with fs.open_input_file(f"{root}/{name}") as f, tempfile.NamedTemporaryFile(delete=False) as copy:
        while part := f.read(1 << 20):
            copy.write(part)
    with open(copy.name, "rb") as f:
        data = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
    os.unlink(copy.name)
    n = int.from_bytes(data[:8], "little")
    return {k: np.frombuffer(data, np.dtype(t), count, 8 + n + at) for k, (t, at, count) in json.loads(data[8:8 + n]).items()}


# ---- workers ---------------------------------------------------------------

CHUNK = 64            # bytes of a chunk that may belong to the lexicon, at most


def _count_chunks(batches):
    let_go()
    for batch in batches:
        found: Counter = Counter()
        for text in batch.column(0):
            found.update(text.as_py().split())
        yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["chunk", "n"])


def ragged(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... (size[0] of them), begin[1], ..."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + size, size)


class Encoder:
    def __init__(self, vocabulary: Vocabulary, auto: dict[str, np.ndarray]):
        self.v, self.auto = vocabulary, auto

    def pieces(self, text: str) -> list:
        """The words of a text; special tokens as their ids."""
        v = self.v
        if v.special_re is None or not any(x in text for x in v.special):
            return v.words(text)
        out, at = [], 0
        for m in v.special_re.finditer(text):
            out += v.words(text[at:m.start()])
            out.append(v.special[m.group()])
            at = m.end()
        return out + v.words(text[at:])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """(offsets, ids) of the texts, and what the ids decode to."""
        words: list = []
        ends = [0]
        for t in texts:
            words += self.pieces(t)
            ends.append(len(words))
        code = dict.fromkeys(words)                      # each distinct word once
        distinct = list(code)
        code = dict(zip(distinct, range(len(distinct))))
        raw = [w.encode("utf-8", "replace") if type(w) is str else b"" for w in distinct]
        number = walk(self.auto, raw)
        size, begin = np.ones(len(raw), np.int64), np.zeros(len(raw), np.int64)
        known, first = number >= 0, self.auto["first"]
        begin[known] = first[number[known]]
        size[known] = first[number[known] + 1] - begin[known]
        other = [i for i in np.flatnonzero(~known).tolist() if raw[i]]
        n, merged = self.v.merge([raw[i] for i in other])
        base = len(self.auto["ids"])
        begin[other], size[other] = base + np.cumsum(n) - n, n
        special = [i for i, w in enumerate(distinct) if type(w) is int] if self.v.special_re is not None else []
        begin[special] = base + len(merged) + np.arange(len(special))
        store = np.concatenate((self.auto["ids"], merged, np.array([distinct[i] for i in special], np.int32)))
        codes = np.fromiter(map(code.__getitem__, words), np.int64, len(words))
        offsets = np.concatenate(([0], np.cumsum(size[codes])))[ends]
        ids = store[ragged(begin, size)].tolist()           # of each distinct word
        edge = np.concatenate(([0], np.cumsum(size))).tolist()
        said = [decode(self.v, ids[a:b]) for a, b in zip(edge, edge[1:])]
        spoken = list(map(said.__getitem__, codes.tolist()))
        texts = [" ".join(spoken[a:b]) for a, b in zip(ends, ends[1:])]
        return offsets, store[ragged(begin[codes], size[codes])], texts


def decode(vocabulary: Vocabulary, ids) -> str:
    """Without a decoder, the tokens joined by spaces."""
    return " ".join(map(vocabulary.token.__getitem__, ids))


def _encode(broadcast, folder: str, name: str):
    def run(batches):
        encoder = held(("encoder", folder), lambda: Encoder(Vocabulary(broadcast.value), load(folder, name)))
        for batch in batches:
            column = batch.column(1)
            for i, j in W.slices(column):
                offsets, ids, text = encoder.encode(column.slice(i, j - i).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), lists, pa.array(text, pa.string())], ["id", "ids", "decoded"])
    return run


def _most_frequent(counts: DataFrame, most: int) -> list[str]:
    """The most frequent chunks, at most ``most`` of them: all above a
    threshold that a histogram of the counts in fine logarithmic steps gives.
    Chunks that occur once or twice or have over ``CHUNK`` bytes never belong."""
    counts = cut(counts.filter((F.col("n") > 2) & (F.octet_length("chunk") <= CHUNK)).withColumn("step", F.floor(F.log2("n") * 16).cast("int")))
    steps = sorted(((r["step"], r["count"]) for r in counts.groupBy("step").count().collect()), reverse=True)   # below 1024 rows
    room, least = most, None
    for step, n in steps:
        if n > room:
            break
        room, least = room - n, step
    if least is None:
        return []
    return counts.filter(F.col("step") >= least).select("chunk").toPandas()["chunk"].tolist()


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", lexicon: int = LEXICON) -> DataFrame:
    """One row per row of ``docs``: id, ids (array of int), decoded.

    ``vocabulary`` is the path of a vocabulary file on the driver; what it
    says goes to the workers in a broadcast (its size does not grow with the
    data).  A null text is empty; empty texts have no ids and decode to the
    empty string.  Strings of special tokens in a text become their ids.
    Repeated rows repeat; null ids stay null; other columns are ignored; an
    empty table gives no rows."""
    spark = docs.sparkSession
    ship(spark)
    with open(vocabulary, "rb") as f:
        raw = f.read()
    shared = spark.sparkContext.broadcast(raw)
    v = Vocabulary(raw)
    text = text_or_empty(text_col).alias("text")
    counts = docs.select(text).mapInArrow(_count_chunks, "chunk string, n long").groupBy("chunk").agg(F.sum("n").alias("n"))
    words = sorted({w.encode("utf-8", "replace") for chunk in _most_frequent(counts, lexicon) for w in v.words(chunk)})
    arrays = compile_lexicon(words)
    n, ids = v.merge(words)
    arrays["first"], arrays["ids"] = np.concatenate(([0], np.cumsum(n))).astype(np.int32), ids
    folder = scratch(spark, "bpe")
    make_folder(spark, folder)
    save(arrays, folder, "lexicon")
    src = docs.select(F.col(id_col).alias("id"), text)
    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(_encode(shared, folder, "lexicon"), f"id {kind}, ids array<int>, decoded string").withColumnRenamed("id", id_col)
