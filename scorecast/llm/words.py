"""Words and word hashes of many texts at once, in numpy.

A word is a run of characters other than ``[\\x20\\x09-\\x0D]``.  These are
ASCII, so words are found in the UTF-8 bytes of an Arrow column without
decoding.  Hashes are 64 bits, computed eight bytes of every word at a time.
"""

from __future__ import annotations

from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_U = np.uint64
_M1, _M2, _M3 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix64 finaliser)."""
    x = (x ^ (x >> _U(30))) * _M2
    x = (x ^ (x >> _U(27))) * _M3
    return x ^ (x >> _U(31))


class Words(NamedTuple):
    data: np.ndarray    # the UTF-8 bytes of all texts, one after the other
    start: np.ndarray   # first byte of each word
    end: np.ndarray     # byte after each word
    first: np.ndarray   # texts + 1: index of each text's first word
    hash: np.ndarray    # 64-bit hash of each word


def slices(column: pa.Array, max_bytes: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Row ranges [i, j) of about ``max_bytes`` bytes, one row at least."""
    if not len(column):
        return
    import pyarrow.compute as pc
    size = np.concatenate(([0], np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))))
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(size, size[i] + max_bytes, "right")) - 1)
        yield i, min(j, len(column))
        i = j


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string array (null: empty), and where each text begins."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8, int(at[-1] - at[0]), int(at[0])) if data and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def bounds(column: pa.Array, fold: bool, space: np.ndarray = _SPACE) -> tuple[np.ndarray, ...]:
    """(data, start, end, first) as in ``Words``; ``space`` tells for each byte
    value whether it separates words."""
    data, at = _bytes(column)
    if fold:
        data = _FOLD[data]
    solid = ~space[data]
    before = np.empty(len(solid) + 1, bool)
    before[0] = False
    before[1:] = solid
    before[at[:-1]] = False            # texts lie side by side
    start = np.flatnonzero(solid & ~before[:-1])
    after = np.empty(len(solid) + 1, bool)
    after[:-1] = solid
    after[at] = False
    end = np.flatnonzero(solid & ~after[1:]) + 1
    return data, start, end, np.searchsorted(start, at, "left")


def split(column: pa.Array, fold: bool = False) -> Words:
    """The words of every text; ``fold`` lowers A-Z first."""
    data, start, end, first = bounds(column, fold)
    return Words(data, start, end, first, _hash(data, start, end))


def _hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    left = end - start
    h = mix(left.astype(_U) * _M1 + _U(1))
    live = np.arange(len(start))
    at = start
    while len(live):
        take = left[live]
        cut = np.minimum(take, 8).astype(_U)
        value = eight[at] & (~_U(0) >> ((_U(8) - cut) * _U(8)))
        h[live] = mix((h[live] ^ value) * _M1)
        more = take > 8
        live = live[more]
        at = at[more] + 8
        left[live] -= 8
    return h


_R = _U(0xD6E8FEB86659FD93)


def runs(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each ``k`` consecutive word hashes, len(h) - k + 1 of them
    (across texts, too: the caller takes those within one)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    powers, done, out, part, size = _R, 0, None, h, 1
    # binary doubling: part covers `size` words, out covers `done` words
    rest = k
    with np.errstate(over="ignore"):
        while rest:
            if rest & 1:
                out = part[:] if out is None else out[: len(h) - done - size + 1] * powers + part[done: done + len(h) - done - size + 1]
                done += size
            rest >>= 1
            if rest:
                part = part[: len(h) - 2 * size + 1] * powers + part[size:]
                powers = powers * powers
                size *= 2
        return mix(out[:n] + _U(k))
