"""Near-duplicate vectors by a pivot-permutation index.

1. Equal vectors become one node.  Reference points (pivots) are distinct
   vectors of a bounded sample, no two of them similar; their number grows with
   the square root of the nodes.  A node is described by its ``k`` nearest
   pivots.
2. Inverted lists: a node is listed under its pivots.  Two nodes are candidates
   if they share ``share`` pivots; they are compared in the list of the smallest
   one they share, and only there.  Inside a list, nodes meet on equal sets of
   further pivots; where many do, the list is compared block by block instead
   and the shared pivots are counted afterwards.  A list over a memory budget
   is dealt to pairs of blocks.
3. Candidates are verified by their cosine in doubles.  A list sends on, for
   each node, its number of links and one edge, never its pairs.
4. Dense groups need no pairs at all.  A leader is a sampled vector with
   several others within half the angle of the threshold; leaders lie at more
   than twice that angle from each other.  All nodes within half the angle of
   a leader are linked, by the triangle inequality: they are counted as a
   ball.  Only the nodes just outside a ball are compared with it, and all
   that can be linked to it are.
"""

from __future__ import annotations

import hashlib
import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, cut, ship
from .components import components, join_up

PIVOTS = 4_096             # pivots, at most
SAMPLE = 16 << 20          # bytes of sampled vectors that reach the driver, about
LIST = 8 << 20             # bytes of vectors in a block of a list
_BASE = 1 << 16
_SEED = 20_011


def _matrix(vectors, size: int) -> np.ndarray:
    """Unit vectors in doubles, of vectors of one length held as bytes."""
    x = np.frombuffer(b"".join(vectors), np.float32 if size == 4 else np.float64).reshape(len(vectors), -1).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _describe(size: int):
    """(id, vec) -> id, 128 bits that stand for the vector, its bytes; null bytes
    for vectors that link with nothing."""
    kind = np.float32 if size == 4 else np.float64

    def run(batches):
        for batch in batches:
            vec, out = batch.column(1), []
            flat, at = vec.values, vec.offsets.to_numpy()
            values = flat.to_numpy(zero_copy_only=False).astype(kind) + kind(0)      # no negative zeros
            fine = np.isfinite(values) & ~flat.is_null().to_numpy(zero_copy_only=False)
            bad, some = (np.concatenate(([0], np.cumsum(x))) for x in (~fine, values != 0))
            good = (vec.is_valid().to_numpy(zero_copy_only=False) & (bad[at[1:]] == bad[at[:-1]]) & (some[at[1:]] > some[at[:-1]]))
            for a, b, ok in zip(at[:-1], at[1:], good):
                raw = values[a:b].tobytes() if ok else None
                out.append((*np.frombuffer(hashlib.blake2b(raw, digest_size=16).digest(), np.int64).tolist(), raw) if ok else (0, 0, None))
            d1, d2, raw = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(raw, pa.binary())],
                                             ["id", "d1", "d2", "vec"])
    return run


class Index:
    """Pivots and leaders for each length of vectors, from the sample."""

    def __init__(self, sample: dict[int, np.ndarray], n_pivots: int, cos: float, k: int, share: int):
        self.k, self.share, self.cos = k, share, cos
        angle = math.acos(cos)
        self.near, self.far = math.cos(angle / 2) + 1e-4, math.cos(1.5 * angle) - 1e-4
        self.n_pivots, self.pivots, self.leaders = n_pivots, {}, {}
        for dim, u in sample.items():
            self.pivots[dim] = _apart(u, cos, n_pivots).astype(np.float32)
            inside = np.concatenate([(u[i: i + 512] @ u.T >= self.near).sum(1) for i in range(0, len(u), 512)])
            dense = np.argsort(-inside, kind="stable")[: int((inside >= 4).sum())]
            self.leaders[dim] = _apart(u[dense], math.cos(2 * angle) - 0.02, len(u)).astype(np.float32)

    def of(self, dim: int) -> tuple[np.ndarray, np.ndarray]:
        if dim not in self.pivots:             # a length that the sample lacks: random directions
            rng = np.random.default_rng([_SEED, dim])
            x = rng.standard_normal((min(64, self.n_pivots), dim))
            self.pivots[dim] = (x / np.sqrt((x * x).sum(1, keepdims=True))).astype(np.float32)
            self.leaders[dim] = self.pivots[dim][:0]
        return self.pivots[dim], self.leaders[dim]

    def place(self, u: np.ndarray):
        """(pivots of each vector in rising order; ball of each or -1; pairs
        (vector, leader) that are outside the ball and may have links into it)."""
        pivots, leaders = self.of(u.shape[1])
        k, x = min(self.k, len(pivots)), u.astype(np.float32)
        perm = np.empty((len(u), k), np.int64)
        for i in range(0, len(u), 1024):
            s = x[i: i + 1024] @ pivots.T
            perm[i: i + 1024] = np.sort(np.argpartition(-s, k - 1, axis=1)[:, :k], axis=1)
        if not len(leaders):
            return perm, np.full(len(u), -1), (np.zeros(0, int), np.zeros(0, int))
        s = x @ leaders.T
        ball = np.where(s.max(1) >= self.near, s.argmax(1), -1)
        who, which = np.nonzero((s >= self.far) & (ball < 0)[:, None])
        return perm, ball, (who, which)


def _apart(u: np.ndarray, cos: float, most: int) -> np.ndarray:
    """The first vectors in order that are less similar than ``cos`` to all taken before."""
    out, n = np.zeros_like(u[:most]), 0
    for x in u:
        if n == most:
            break
        if not n or float((out[:n] @ x).max()) < cos:
            out[n] = x
            n += 1
    return out[:n]


# A list's name: vector length, then 2 p + 1 for pivot p, or 2 l for leader l.
def _list(dim: int, number, leader: bool):
    return (dim << 32) + 2 * np.asarray(number, np.int64) + (0 if leader else 1)


def _seats(index: Index, size: int, batch: pa.RecordBatch):
    """For the nodes of a batch: (row, list, role, rows' pivots), one entry for
    each list that a node is in; role 0: in the ball, 1: near it, 2: candidate."""
    vecs = batch.column("vec").to_pylist()
    dims = np.array([len(v) // size for v in vecs])
    row, lists, role = [], [], []
    perms = np.full((len(vecs), index.k), -1, np.int64)
    for dim in np.unique(dims):
        mine = np.flatnonzero(dims == dim)
        perm, ball, (who, which) = index.place(_matrix([vecs[i] for i in mine], size))
        perms[mine, :perm.shape[1]] = perm
        held = np.flatnonzero(ball >= 0)
        row += [mine[held], mine[who]]
        lists += [_list(dim, ball[held], True), _list(dim, which, True)]
        role += [np.zeros(len(held), int), np.ones(len(who), int)]
        free = np.flatnonzero(ball < 0)
        for c in range(max(1, perm.shape[1] - index.share + 1)):       # the smallest of `share` pivots
            row.append(mine[free])
            lists.append(_list(dim, perm[free, c], False))
            role.append(np.full(len(free), 2))
    return np.concatenate(row), np.concatenate(lists), np.concatenate(role), perms


def _sizes(index, size: int):
    """Nodes -> (list, role, n, bytes, m, rep) summed for each batch."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            row, lists, role, _ = _seats(index.value, size, batch)
            m, rep = (batch.column(c).to_numpy()[row] for c in ("m", "rep"))
            length = np.array([len(v) for v in batch.column("vec").to_pylist()])[row]
            order = np.lexsort((role, lists))
            lists, role = lists[order], role[order]
            at = np.flatnonzero(np.concatenate(([True], (lists[1:] != lists[:-1]) | (role[1:] != role[:-1]))))
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
                    lists[at], role[at], np.diff(np.append(at, len(lists))), np.add.reduceat(length[order], at), np.add.reduceat(m[order], at),
                    np.minimum.reduceat(rep[order], at))], ["list", "role", "n", "bytes", "m", "rep"])
    return run


def _deal(index, size: int, blocks: dict, balls: dict):
    """Nodes -> rows (list, tile, side, role, d1, d2, rep, m, n, ball, perm, vec).

    A list of one block is tile 0.  Of a larger one, tile (i, j) holds the
    blocks i and j; for a ball, block i of its nodes and block j of those near."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            row, lists, role, perms = _seats(index.value, size, batch)
            d1 = batch.column("d1").to_numpy()
            src, lst, tile, side, rl = [], [], [], [], []

            def put(at, t, s, r):
                src.append(row[at])
                lst.append(lists[at])
                tile.append(t)
                side.append(s)
                rl.append(np.full(len(at), r))
            n_in, n_near, n_free = (np.array([blocks.get((x, r), 1 if r == 2 else 0) for x in lists.tolist()], np.int64) for r in (0, 1, 2))
            mine = (d1[row] & 0x7FFFFFFFFFFFFFFF) % np.maximum(1, np.choose(role, (n_in, n_near, n_free)))
            inside = np.flatnonzero(role == 0)
            put(inside, d1[row[inside]] | 1 << 62, np.zeros(len(inside), np.int64), 3)      # the count of the ball
            for r, other in ((0, n_near), (1, n_in)):
                at = np.flatnonzero(role == r)
                at, j = np.repeat(at, other[at]), np.concatenate([np.arange(x) for x in other[at]] or [np.zeros(0, int)])
                put(at, (mine[at] << 24) + j if r == 0 else (j << 24) + mine[at], np.full(len(at), r), r)
            at = np.flatnonzero(role == 2)
            at, j = np.repeat(at, n_free[at]), np.concatenate([np.arange(x) for x in n_free[at]] or [np.zeros(0, int)])
            lo, hi = np.minimum(mine[at], j), np.maximum(mine[at], j)
            put(at, (lo << 24) + hi, (mine[at] != lo).astype(np.int64), 2)
            src, lst, tile, side, rl = map(np.concatenate, (src, lst, tile, side, rl))
            ball = np.zeros((len(src), 2), np.int64)
            counted = np.flatnonzero(rl == 3)
            ball[counted] = [balls[x] for x in lst[counted].tolist()] or ball[:0]
            m, rep = batch.column("m").to_numpy()[src], batch.column("rep").to_numpy()[src]
            vec = batch.column("vec").take(pa.array(src))
            import pyarrow.compute as pc
            vec = pc.if_else(pa.array(rl == 3), pa.scalar(None, vec.type), vec)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lst), pa.array(tile), pa.array(side), pa.array(rl), batch.column("d1").take(pa.array(src)), batch.column("d2").take(pa.array(src)),
                 pa.array(rep), pa.array(m), pa.array(ball[:, 0]), pa.array(ball[:, 1]),
                 pa.array([p.tobytes() for p in perms.astype(np.uint16)[src]], pa.binary()), vec],
                ["list", "tile", "side", "role", "d1", "d2", "rep", "m", "ball_m", "ball_rep", "perm", "vec"])
    return run


_DEALT = ("list long, tile long, side long, role long, d1 long, d2 long, rep long, m long, ball_m long, ball_rep long, "
          "perm binary, vec binary")


class _Found:
    """Links of the nodes of a tile: how many, and one edge each."""

    def __init__(self, m: np.ndarray):
        self.m, self.n, self.label = m, np.zeros(len(m), np.int64), np.arange(len(m))

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        np.add.at(self.n, i, self.m[j])
        np.add.at(self.n, j, self.m[i])
        self.label = join_up(self.label, i, j)


def _shared(perm: np.ndarray, i: np.ndarray, j: np.ndarray, p: int, share: int) -> np.ndarray:
    """Whether the pairs share so many pivots, and ``p`` is the smallest of them."""
    out = np.zeros(len(i), bool)
    for a in range(0, len(i), 1 << 16):
        x, y = perm[i[a: a + (1 << 16)]], perm[j[a: a + (1 << 16)]]
        both = (x[:, :, None] == y[:, None, :]).any(2) & (x >= 0)
        out[a: a + (1 << 16)] = (both.sum(1) >= share) & ~(both & (x < p)).any(1)
    return out


def compare_list(u: np.ndarray, m: np.ndarray, perm: np.ndarray, side: np.ndarray, p: int, cos: float, share: int) -> _Found:
    """Links of a tile of pivot ``p``'s list; with two sides, across them only."""
    found, n, two = _Found(m), len(u), bool(side.any() and not side.all())
    # meeting keys: `share` - 1 further pivots, all greater than p
    keys, who = [], []
    for c in combinations(range(perm.shape[1]), share - 1):
        there = np.flatnonzero(perm[:, c[0]] > p if c else np.ones(n, bool))
        code = np.zeros(len(there), np.int64)
        for x in c:
            code = code * _BASE + perm[there, x]
        keys.append(code)
        who.append(there)
    keys, who = np.concatenate(keys), np.concatenate(who)
    order = np.lexsort((who, keys))
    keys, who = keys[order], who[order]
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, int)
    length = np.diff(np.append(at, len(keys)))
    if 20 * int((length * (length - 1)).sum()) >= n * (n - 1):
        # dense: cosines of all, then the shared pivots of the similar pairs
        for a in range(0, n, 64):
            s = u[a: a + 64] @ u[a:].T
            i, j = np.nonzero(s >= cos - 1e-9)
            i, j = i[j > i], j[j > i]
            i, j = i + a, j + a
            if two:
                i, j = i[side[i] != side[j]], j[side[i] != side[j]]
            _verify(found, u, perm, i, j, p, cos, share)
        return found
    # sparse: pairs inside each run of equal keys, a bounded number at a time
    run = np.repeat(np.arange(len(at)), length)
    later = at[run] + length[run] - np.arange(len(run)) - 1         # nodes behind this one in its run
    total = np.concatenate(([0], np.cumsum(later)))
    a = 0
    pairs = []
    while a < len(run):
        b = max(a + 1, int(np.searchsorted(total, total[a] + (1 << 18), "right")) - 1)
        n_a = later[a:b]
        left = np.repeat(np.arange(a, b), n_a)
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(n_a) - n_a, n_a)
        i, j = who[left], who[right]
        if two:
            i, j = i[side[i] != side[j]], j[side[i] != side[j]]
        good = np.einsum("ij,ij->i", u[i], u[j]) >= cos
        pairs.append(np.minimum(i, j)[good] * n + np.maximum(i, j)[good])
        a = b
    # a pair meets on several keys; it is one link.  These are the links only
    # of a list that is not dense.
    once = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
    _verify(found, u, perm, once // n, once % n, p, cos, share)
    return found


def _verify(found: _Found, u, perm, i, j, p, cos, share) -> None:
    for a in range(0, len(i), 1 << 16):
        x, y = i[a: a + (1 << 16)], j[a: a + (1 << 16)]
        good = _shared(perm, x, y, p, share)
        x, y = x[good], y[good]
        good = np.einsum("ij,ij->i", u[x], u[y]) >= cos
        found.add(x[good], y[good])


def compare_ball(u: np.ndarray, m: np.ndarray, side: np.ndarray, cos: float) -> _Found:
    """Links between the nodes of a ball (side 0) and those near it (side 1)."""
    found, ins, near = _Found(m), np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    for a in range(0, len(ins), 512):
        i, j = np.nonzero(u[ins[a: a + 512]] @ u[near].T >= cos)
        found.add(ins[a: a + 512][i], near[j])
    return found


def _compare(size: int, cos: float, share: int):
    """Rows of ``_deal``, sorted by list and tile -> (d1, d2, n, u, v)."""
    def result(held: list):
        d1, d2, rep, m, side, role, name, perm, vec = zip(*held)
        u, m, side = _matrix(vec, size), np.array(m), np.array(side)
        if role[0] == 2:
            got = compare_list(u, m, np.frombuffer(b"".join(perm), np.uint16).reshape(len(held), -1).astype(np.int64), side,
                               (name[0] & 0xFFFFFFFF) >> 1, cos, share)
        else:
            got = compare_ball(u, m, side, cos)
        some = np.flatnonzero(got.n)
        rep = np.array(rep)
        return [(d1[i], d2[i], int(got.n[i]), int(rep[i]), int(rep[got.label[i]])) for i in some.tolist()]

    def run(batches):
        now, held = None, []
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["role"] == 3:
                    out.append((r["d1"], r["d2"], r["ball_m"] - r["m"], r["rep"], r["ball_rep"]))
                    continue
                if (r["list"], r["tile"]) != now:
                    out += result(held) if len(held) > 1 else []
                    now, held = (r["list"], r["tile"]), []
                held.append((r["d1"], r["d2"], r["rep"], r["m"], r["side"], r["role"], r["list"], r["perm"], r["vec"]))
            if out:
                yield _rows(out)
        yield _rows(result(held) if len(held) > 1 else [])
    return run


def _rows(rows: list) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["d1", "d2", "n", "u", "v"])


def near_duplicates(vectors: DataFrame, cos: float = 0.9, k: int = 10, share: int = 3, id_col: str = "vec_id",
                    vec_col: str = "embedding") -> DataFrame:
    """One row per row of ``vectors``: id, n_links, component_id, kept.

    Rows whose vectors are found to have a cosine of ``cos`` or more are linked;
    ``n_links`` is the number of other rows linked to a row, ``component_id`` the
    smallest id reachable, ``kept`` whether that is the row's own.  No pair below
    ``cos`` links; pairs that share fewer than ``share`` of their ``k`` nearest
    pivots are not found.  Equal vectors always are.

    Vectors that are null, empty or zero, or hold null or non-finite components,
    link with nothing, nor do vectors of unequal lengths with each other.  Rows
    with a null id take no part: no links, a null component, kept.  Rows that
    repeat an id count as rows of their own but are one node of the component.
    Empty table: no rows.  ``cos`` is 0.8 or more, ``share`` 2 to 4.
    """
    if not 0.8 <= cos < 1 or not 2 <= share <= 4:
        raise ValueError("cos must be from 0.8 to below 1, share from 2 to 4")
    spark = vectors.sparkSession
    ship(spark)
    kind = dict(vectors.dtypes)[vec_col]
    size = 4 if kind == "array<float>" else 8
    src = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(f"array<{'float' if size == 4 else 'double'}>").alias("vec"))
    described = src.mapInArrow(_describe(size), "id long, d1 long, d2 long, vec binary")
    nodes = cut(described.filter("vec is not null and id is not null").groupBy("d1", "d2")
                .agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("m"), F.first("vec").alias("vec")))
    rows = cut(described.select("id", "d1", "d2", F.col("vec").isNotNull().alias("fine")))
    seen = nodes.agg(F.count(F.lit(1)).alias("n"), F.max(F.length("vec")).alias("bytes")).first()
    n = max(1, seen["n"])
    n_pivots = min(PIVOTS, max(64, 1 << math.ceil(math.log2(math.sqrt(n)))))
    picked = max(n_pivots, min(6 * n_pivots, SAMPLE // (2 * max(1, seen["bytes"] or 1))))
    sample: dict = {}
    hashed = nodes.select(F.xxhash64("d1", "d2", F.lit(_SEED)).alias("h"), "vec").filter(F.pmod("h", F.lit(n)) < picked)
    for r in sorted(hashed.collect(), key=lambda r: r["h"]):
        sample.setdefault(len(r["vec"]) // size, []).append(bytes(r["vec"]))
    index = spark.sparkContext.broadcast(Index({d: _matrix(v, size) for d, v in sample.items()}, n_pivots, cos, k, share))

    # a row for each list and role: as many as there are pivots and leaders
    sizes = (nodes.mapInArrow(_sizes(index, size), "list long, role long, n long, bytes long, m long, rep long")
             .groupBy("list", "role").agg(F.sum("bytes").alias("bytes"), F.sum("m").alias("m"), F.min("rep").alias("rep")))
    balls, blocks = {}, {}
    for r in sizes.filter(f"role < 2 or bytes > {LIST}").collect():
        if r["role"] == 0:
            balls[r["list"]] = (r["m"], r["rep"])
        blocks[r["list"], r["role"]] = -(-r["bytes"] // LIST)
    dealt = nodes.mapInArrow(_deal(index, size, blocks, balls), _DEALT)
    found = cut(dealt.repartition("list", "tile").sortWithinPartitions("list", "tile")
                .mapInArrow(_compare(size, cos, share), "d1 long, d2 long, n long, u long, v long"))

    # an id that repeats with another vector ties the nodes of its vectors
    many = rows.filter("fine and id is not null").groupBy("id").agg(F.min(F.struct("d1", "d2")).alias("lo"), F.max(F.struct("d1", "d2")).alias("hi"))
    tied = (rows.filter("fine").join(many.filter("lo < hi").select("id"), "id").join(nodes.select("d1", "d2", "rep"), ["d1", "d2"])
            .select(F.col("id").alias("u"), F.col("rep").alias("v")))
    comp = components(found.select("u", "v").unionByName(tied))
    links = found.groupBy("d1", "d2").agg(F.sum("n").alias("n"))
    label = cut(nodes.select("d1", "d2", "rep", "m").join(links, ["d1", "d2"], "left").join(comp, F.col("rep") == F.col("node"), "left").select(
        "d1", "d2", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"), "m"))
    listed = attach(rows.filter("fine and id is not null").select("id", "d1", "d2"), label, ["d1", "d2"], "m", n)
    alone = rows.filter("not fine or id is null").join(comp, F.col("id") == F.col("node"), "left").select(
        "id", F.lit(0).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    out = listed.select("id", "n_links", "component_id").unionByName(alone)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
