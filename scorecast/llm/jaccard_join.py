"""Similarity join on word-shingle sets: size-banded tiles, bitmap bounds.

1. Sizes are cut into bands so that two sets that reach the similarity lie in
   one band or in neighbouring ones.  Sets that are similar differ in at most
   ``D`` shingles (by their sizes).  Shingles are dealt by hash into more than
   ``D`` segments, so similar sets agree on whole segments: (bands, segment, its
   content) is a key on which they meet.  Segments that hold next to nothing
   say little and make no key; where so many do that no other segment surely
   agrees, the set is dealt again (see ``Bands.keys``).  Similar sets always
   meet.  Sets that merely share a passage do not, however common it is: what
   is common in a bounded sample does not count as content of a segment.
2. The sets around a key are chained to the smallest of them, and connected
   components of these chains are the candidate clusters: similar sets are in
   one cluster.  No pairs are made here.
3. Each set is first compared with one other only, the one that most of its
   chains lead to.  In clusters of copies this joins nearly all.
4. Clusters in which not all are joined become tiles; a large one is cut into
   cells by size band, by joined group and by hash, and tiles are pairs of cells
   in the same band or in neighbouring ones, but not of one group.  The sets of
   a tile meet in one task, each once, with their sorted shingle arrays.
5. In a tile a set is compared with those not yet joined to it.  Sizes bound the
   overlap first, then the bit count of the XOR of hashed parity bitmaps, which
   is at most the number of differing shingles; what remains is decided by exact
   intersection of the sorted arrays.  Only links that join two groups leave the
   task, fewer than sets in the tile.
6. Connected components of the links are the classes.
"""

from __future__ import annotations

import math
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import attach, bloom_bits, bloom_of, cut, let_go, maybe_in, ship
from .components import components
from . import words as W

_U = np.uint64
TILE = 2_000_000      # shingles in a tile: 16 MB of arrays
THIN = 1              # a segment with so many shingles or fewer makes no key...
LARGE = 100           # ...in a set of so many shingles, where the similarity is so low that no segments would be left: an empty one
RARE, SPREAD = 0.9, 2.0    # see Bands._segments
#: Dealings of a set, until one surely has a key that a similar set shares:
#: whether shingles common in the sample count for nothing, and whether a
#: segment must be empty to be thin.
SCHEMES = ((True, False), (True, False), (True, True), (True, True), (False, False), (False, False), (False, False), (False, False))
SAMPLE, COMMON, MOST_COMMON = 4_096, 4, 1 << 19      # documents; those that hold a common shingle; common shingles kept


class Bands:
    """Size bands and segments for similarity ``num / den``."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.edge, self.count = [1], {}

    def band(self, n: int) -> int:
        e = self.edge
        while e[-1] <= n:
            e.append(e[-1] * self.den // self.num + 1)
        return int(np.searchsorted(e, n, "right")) - 1

    def tiles(self, n: int) -> list[tuple[int, int, int, int]]:
        """(tile, segments, thin, D) of the two tiles that a set of ``n`` shingles
        is in; D is the most shingles that a similar set of the tile differs in."""
        b = self.band(n)
        self.band(self.edge[b + 1])          # one band further is known
        e = self.edge
        out = [self._tile(b, n, e[b + 1] - 1)]
        if self.den * (e[b + 1] - 1) >= self.num * e[b + 1]:   # a pair across the edge can exist
            self.band(e[b + 2])
            out.append(self._tile(b + 1, n, e[b + 2] - 1))
        return out

    def _tile(self, tile: int, n: int, largest: int) -> tuple[int, int, int, int]:
        other = min(n * self.den // self.num, largest)
        return tile, *self._segments(largest), (n + other) * (self.den - self.num) // (self.den + self.num)

    def _segments(self, largest: int) -> tuple[int, int]:
        """More than the largest sets of a tile can differ in, by as many as are
        likely to be thin in a set of which some shingles are common."""
        if largest not in self.count:
            least = 2 * largest * (self.den - self.num) // (self.den + self.num) + 1
            for few in (THIN, 0) if largest >= LARGE else (THIN,):
                s, best, room = least, (-math.inf, least), False
                while s < 2 * least + 8:
                    thin = math.exp(-largest / s) * (1 + few * largest / s)
                    room |= s * (1 - thin) > least
                    rate = RARE * largest / s
                    thin = math.exp(-rate) * (1 + few * rate)
                    spare = s * (1 - thin) - SPREAD * math.sqrt(s * thin * (1 - thin)) - least
                    best = max(best, (spare, s))
                    if spare >= 0:
                        break
                    s += max(1, s // 64)
                if room:
                    break
            self.count[largest] = best[1], few
        return self.count[largest]

    def keys(self, s: np.ndarray, common: np.ndarray) -> np.ndarray:
        """The keys of a set in all its tiles.

        Two similar sets differ in at most D of the S segments of a dealing, so
        S - D agree, in content and thus in being thin.  If a set has T thin
        segments and S - D - T is positive, it has a key in this dealing that
        every similar set has, too, if that one is dealt this way.  A set goes
        from dealing to dealing until this holds; of two sets the first one to
        stop is met by the other.  A set for which it never holds at last takes
        the thin segments, too, each with one of another dealing."""
        out, dealt = [], {}
        for tile, segments, few, differ in self.tiles(len(s)):
            for number, (rare, empty) in enumerate(SCHEMES):
                if number not in dealt:
                    dealt[number] = _dealing(s, number, common if rare else None)
                keys, thin = _segment_keys(*dealt[number], tile, segments, number, 0 if empty else few)
                out.append(keys[~thin])
                if segments - differ - int(thin.sum()) > 0:
                    break
            else:
                keys, thin = _segment_keys(*dealt[number], tile, segments, number + 1, few)
                other, _ = _segment_keys(*dealt[number - 1], tile, segments, number + 2, few)
                out += [keys[~thin], W.mix(keys[thin][:, None] + other[None, :]).ravel()]
        return np.concatenate(out)


def shingle_sets(column: pa.Array, k: int, fold: bool = True) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text of a column."""
    for i, j in W.slices(column):
        w = W.split(column.slice(i, j - i), fold)
        runs = W.runs(w.hash, k)
        for a, b in zip(w.first[:-1], w.first[1:]):
            if b - a >= k:
                yield np.unique(runs[a: b - k + 1])
            elif b > a:
                yield W.runs(w.hash[a:b], b - a)
            else:
                yield runs[:0]


def _cuts(segments: int, cache: dict = {}) -> np.ndarray:  # noqa: B006
    if segments not in cache:
        if len(cache) > 4096:
            cache.clear()
        cache[segments] = np.array([(s << 64) // segments for s in range(1, segments)], dtype=_U)
    return cache[segments]


def _dealing(s: np.ndarray, number: int, common: np.ndarray | None):
    """A set in the order of one dealing: values, running sum of their hashes,
    running number of those that count as content."""
    rare = np.ones(len(s), np.int64)
    if common is not None and len(common):
        rare = (common[np.minimum(np.searchsorted(common, s), len(common) - 1)] != s).astype(np.int64)
    if number:
        s = W.mix(s + _U(number * 0x9E3779B9))
        order = np.argsort(s)
        s, rare = s[order], rare[order]
    return s, np.concatenate((np.zeros(1, _U), np.cumsum(W.mix(s ^ W._M1), dtype=_U))), np.concatenate(([0], np.cumsum(rare)))


def _segment_keys(s, total, rare, tile: int, segments: int, scheme: int, few: int) -> tuple[np.ndarray, np.ndarray]:
    """The key of each segment, and which segments are thin."""
    at = np.concatenate(([0], np.searchsorted(s, _cuts(segments)), [len(s)]))
    content = total[at[1:]] - total[at[:-1]]
    name = np.arange(segments, dtype=_U) * W._M3 + _U((tile * 2654435761 + segments * 31 + scheme) & 0xFFFFFFFF)
    return W.mix(W.mix(name) ^ content), rare[at[1:]] - rare[at[:-1]] <= few


def _identity(s: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    if not len(s):
        return 0, 0
    n = _U(len(s))
    a = W.mix(np.array([np.sum(W.mix(s * W._M1 + _U(1)), dtype=_U) + n]))[0]
    b = W.mix(np.array([np.sum(W.mix(s ^ W._M2), dtype=_U) ^ n]))[0]
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def _describe(k: int):
    def run(batches):
        let_go()
        for batch in batches:
            out = [(len(s), *_identity(s)) for s in shingle_sets(batch.column(1), k)]
            cols = list(zip(*out)) if out else [[] for _ in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in cols)], ["id", "n", "s1", "s2"])
    return run


def _shingles(k: int):
    """The shingles of each text, each once."""
    def run(batches):
        for batch in batches:
            for s in shingle_sets(batch.column(0), k):
                for i in range(0, len(s), 1 << 16):
                    yield pa.RecordBatch.from_arrays([pa.array(s[i: i + (1 << 16)].view(np.int64))], ["x"])
    return run


def _keys(k: int, num: int, den: int, common):
    """Texts -> chains (direct, key, a, b, n).  A set a that is alone or the
    smallest around a key in its batch goes on to the other batches with the
    key; the others are chained to it directly, over n keys."""
    def run(batches):
        let_go()
        bands, known = Bands(num, den), common.value
        for batch in batches:
            keys, who, rows, done = [], [], 0, set()
            for s in shingle_sets(batch.column(0), k):
                if not len(s):
                    continue
                s1 = _identity(s)[0]
                if s1 in done:
                    continue
                done.add(s1)
                got = bands.keys(s, known)
                keys.append(got)
                who.append(np.full(len(got), s1, np.int64))
                rows += len(got)
                if rows > 500_000:
                    yield _star(keys, who)
                    keys, who, rows, done = [], [], 0, set()
            if rows:
                yield _star(keys, who)
    return run


def _star(keys: list, who: list) -> pa.RecordBatch:
    key, b = np.concatenate(keys).view(np.int64), np.concatenate(who)
    order = np.lexsort((b, key))
    key, b = key[order], b[order]
    new = np.concatenate(([True], key[1:] != key[:-1]))
    a = b[np.flatnonzero(new)][np.cumsum(new) - 1]
    pairs, n = np.unique(np.stack((a, b))[:, ~new & (a != b)], axis=1, return_counts=True)
    u, v = pairs
    name = W.mix(W.mix(u.view(_U)) + v.view(_U)).view(np.int64)
    direct = np.concatenate((np.zeros(int(new.sum()), bool), np.ones(len(u), bool)))
    return pa.RecordBatch.from_arrays(
        [pa.array(direct), pa.array(np.concatenate((key[new], name))), pa.array(np.concatenate((b[new], u))), pa.array(np.concatenate((b[new], v))),
         pa.array(np.concatenate((np.ones(int(new.sum()), np.int64), n)))], ["direct", "key", "a", "b", "n"])


def _arrays(k: int):
    """(rep, text, seats) -> one row (tile, side, known, rep, s1, arr) a seat of
    the text's own set."""
    def run(batches):
        let_go()
        for batch in batches:
            for i, (s, seats) in enumerate(zip(shingle_sets(batch.column(1), k), batch.column(2).to_pylist())):
                s1 = _identity(s)[0]
                mine = [x for x in seats if x["s1"] == s1]
                for j in range(0, len(mine), 256):
                    part = mine[j: j + 256]
                    rep, arr = batch.column(0)[i].as_py(), s.tobytes()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x[c] for x in part], pa.int64()) for c in ("tile", "side", "known")]
                        + [pa.array([rep] * len(part), pa.int64()), pa.array([s1] * len(part), pa.int64()), pa.array([arr] * len(part), pa.binary())],
                        ["tile", "side", "known", "rep", "s1", "arr"])
    return run


def bitmaps(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """One row of ``bits`` bits a set: bit b is the parity of the number of
    shingles that hash to it."""
    out = np.empty((len(sets), bits // 64), _U)
    step = max(1, (1 << 22) // bits)
    for i in range(0, len(sets), step):
        part = sets[i: i + step]
        row = np.repeat(np.arange(len(part)), [len(s) for s in part])
        place = (np.concatenate(part) & _U(bits - 1)).astype(np.int64)
        odd = np.bincount(row * bits + place, minlength=len(part) * bits).astype(np.uint8) & 1
        out[i: i + len(part)] = np.packbits(odd.reshape(len(part), bits), axis=1).view(_U)
    return out


def tile_links(sets: list[np.ndarray], side: np.ndarray, num: int, den: int, known: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links (i, j) that connect all similar sets of a tile; with two sides,
    only pairs across them are compared.  Sets of one ``known`` group are
    connected already."""
    n = np.array([len(s) for s in sets])
    order = np.argsort(n, kind="stable")
    n, side = n[order], side[order]
    sets = [sets[i] for i in order]
    most = 2 * int(n[-1]) * (den - num) // (den + num)      # shingles that similar sets differ in
    bits = 256
    while bits < 64 * most and bits < 1 << 14 and bits * len(sets) < 1 << 27:
        bits *= 2
    maps = bitmaps(sets, bits)
    group = np.arange(len(sets)) if known is None else np.unique(known[order], return_inverse=True)[1]
    across, out = bool(side.any() and not side.all()), []
    for i in range(len(sets) - 1):
        end = int(np.searchsorted(n, int(n[i]) * den // num, "right"))   # sizes bound the overlap
        at = np.arange(i + 1, end)
        keep = group[i + 1: end] != group[i]
        if across:
            keep &= side[i + 1: end] != side[i]
        at = at[keep]
        if not len(at):
            continue
        differ = np.bitwise_count(maps[at] ^ maps[i]).sum(1, dtype=np.int64)
        total = n[at] + n[i]
        for j in at[(total - differ) * (num + den) >= 2 * num * total].tolist():
            if group[j] == group[i]:
                continue
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if den * both >= num * (int(n[i] + n[j]) - both):
                group[group == group[j]] = group[i]
                out.append((int(order[i]), int(order[j])))
    return out


def _compare(num: int, den: int):
    """Rows of ``_arrays``, sorted by tile -> links (u, v)."""
    def links(held: dict):
        rows = list(held.values())
        if len(rows) < 2:
            return []
        found = tile_links([x[3] for x in rows], np.array([x[0] for x in rows]), num, den, np.array([x[1] for x in rows]))
        return [(rows[i][2], rows[j][2]) for i, j in found]

    def run(batches):
        let_go()
        now, held = None, {}
        for batch in batches:
            out = []
            for tile, side, known, rep, s1, arr in zip(*(batch.column(c).to_pylist() for c in range(5)), batch.column(5)):
                if tile != now:
                    out += links(held)
                    now, held = tile, {}
                # rows that repeat an id and a text are one set
                held.setdefault((rep, s1), (side, known, rep, np.frombuffer(arr.as_buffer(), _U).copy()))
            if out:
                yield _links(out)
        yield _links(links(held))
    return run


def _links(rows: list) -> pa.RecordBatch:
    u, v = zip(*rows) if rows else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def _common(src: DataFrame, n_rows: int, k: int) -> np.ndarray:
    """Shingles that several documents of a bounded sample hold.  They decide
    only which segments make keys, never a link."""
    some = src.filter(F.pmod(F.xxhash64("id", F.length("text")), F.lit(max(1, n_rows))) < SAMPLE).select("text")
    found = (some.mapInArrow(_shingles(k), "x long").groupBy("x").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= COMMON)
             .orderBy(F.col("n").desc(), "x").limit(MOST_COMMON).select("x").toPandas())
    return np.sort(found["x"].to_numpy(np.int64).view(_U))


def jaccard_classes(docs: DataFrame, k: int = 3, num: int = 90, den: int = 100, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id.

    A text's set: distinct ``k``-word shingles of the words
    ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered; with fewer words, the whole
    sequence as one.  Rows link when ``den * |A & B| >= num * |A | B|``;
    ``component_id`` is the smallest id reachable.  A null text or one
    without words has an empty set and links with nothing.  Rows that repeat
    an id are one node, whose links are those of all its rows.  A null id
    keeps its row; it takes the component of its set, or null if alone.
    Ids are integers.  Empty table: no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    g = int(np.gcd(num, den))
    num, den = num // g, den // g
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = cut(src.mapInArrow(_describe(k), "id long, n long, s1 long, s2 long"))
    n_rows = rows.count()
    same = ["n", "s1", "s2"]
    # one node per distinct set: its smallest id
    sets = cut(rows.filter("n > 0").groupBy(*same).agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("size"))
               .filter("rep is not null"))

    common = spark.sparkContext.broadcast(_common(src, n_rows, k))
    chains = src.select("text").mapInArrow(_keys(k, num, den, common), "direct boolean, key long, a long, b long, n long")
    around = Window.partitionBy("direct", "key")      # a key has one row a batch at most
    chains = cut(chains.withColumn("lo", F.min("a").over(around)).filter("direct or lo != a")
                 .select(F.when(F.col("direct"), F.col("a")).otherwise(F.col("lo")).alias("u"), F.col("b").alias("v"), "n")
                 .groupBy("u", "v").agg(F.sum("n").alias("n")))
    links = cut(_first_links(chains, sets, src, k, num, den))
    nodes = cut(sets.join(components(links), F.col("rep") == F.col("node"), "left")
                .select("rep", "s1", "n", F.coalesce("component", "rep").alias("known")))
    # chains between sets that are not joined yet
    end = lambda c: nodes.select(F.col("s1").alias(c), F.col("known").alias(f"known_{c}"))
    across = (chains.join(end("v"), "v").join(end("u"), "u").filter("known_u != known_v")
              .select(F.col("known_u").alias("u"), F.col("known_v").alias("v")).distinct())
    members = cut(nodes.join(components(across), F.col("known") == F.col("node")).select("rep", "s1", "n", "known", F.col("component").alias("c")))
    links = cut(links.unionByName(_tiles(members, src, k, num, den)))
    # an id that repeats with another text ties the sets of its texts
    many = rows.filter("n > 0").groupBy("id").agg(F.min("s1").alias("lo"), F.max("s1").alias("hi")).filter("lo < hi").select("id")
    tied = rows.select("id", *same).join(many, "id").join(sets.select(*same, "rep"), same)
    comp = components(links.unionByName(tied.select(F.col("id").alias("u"), F.col("rep").alias("v"))))

    label = sets.select(*same, "rep", "size").join(comp, F.col("rep") == F.col("node"), "left").select(
        *same, F.coalesce("component", "rep").alias("component_id"), "size")
    linked = attach(rows.filter("n > 0").select("id", *same), label, same, "size", max(1, n_rows))
    empty = rows.filter("n = 0").select("id", "n").join(
        comp.select(F.col("node"), F.col("component")), F.col("id") == F.col("node"), "left").select(
        "id", "n", F.coalesce("component", "id").alias("component_id"))
    return linked.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                         F.coalesce("component_id", "id").alias("component_id")).unionByName(
        empty.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id"))


def _first_links(chains: DataFrame, sets: DataFrame, src: DataFrame, k: int, num: int, den: int, limit: int = TILE // 16) -> DataFrame:
    """Links (u, v) of each set with the one that most of its keys lead to.

    A set that many lead to is a hot key: its tile is cut into as many as its
    sets need, and it goes to each."""
    best = chains.groupBy("v").agg(F.max_by("u", F.struct("n", "u")).alias("u"))
    known = sets.select("rep", "s1", "n")
    best = cut(best.join(known.withColumnRenamed("s1", "v"), "v"))
    star = cut(best.groupBy("u").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("size"))
               .withColumn("tiles", F.ceil(F.col("total") / limit).cast("long")))
    tile = lambda part: F.xxhash64(F.col("u"), part)
    around = attach(best, star, ["u"], "size", max(1, best.count())).select(
        "rep", F.col("v").alias("s1"), tile(F.pmod(F.xxhash64("v"), F.col("tiles"))).alias("tile"), F.lit(1).cast("long").alias("side"))
    centre = (known.join(star.withColumnRenamed("u", "s1"), "s1").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
              .select("rep", "s1", F.xxhash64("s1", "part").alias("tile"), F.lit(0).cast("long").alias("side")))
    # every set is a group of its own here
    return _meet(around.unionByName(centre).withColumn("known", F.xxhash64("rep", "s1")), src, k, num, den)


def _meet(seats: DataFrame, src: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Links among the sets seated (rep, s1, tile, side, known).  A text goes
    once to its seats, and from there its array to each of them."""
    seats = cut(seats.groupBy("rep").agg(F.collect_list(F.struct("s1", "tile", "side", "known")).alias("seats")))
    # a Bloom filter lets the other texts go before they are shuffled
    bits = bloom_bits(seats.count())
    some = maybe_in(src, F.xxhash64("id"), bloom_of(seats.select(F.xxhash64("rep").alias("h")), "h", bits), bits, "maybe").filter("maybe")
    rows = (some.select("id", "text").join(seats, F.col("id") == F.col("rep")).select("rep", "text", "seats")
            .mapInArrow(_arrays(k), "tile long, side long, known long, rep long, s1 long, arr binary")
            .repartition("tile").sortWithinPartitions("tile"))
    return rows.mapInArrow(_compare(num, den), "u long, v long").distinct()


def _tiles(members: DataFrame, src: DataFrame, k: int, num: int, den: int, limit: int = TILE) -> DataFrame:
    """Links (u, v) among the members (rep, s1, n, c, known) of candidate clusters."""
    total = cut(members.groupBy("c").agg(F.sum("n").alias("total"), F.min("n").alias("least")))
    small = members.join(total.filter(F.col("total") <= limit), "c").select(
        "rep", "s1", "known", F.col("c").alias("tile"), F.lit(0).cast("long").alias("side"))
    # a large cluster: cells by size band (in steps of the similarity, from
    # its smallest set), joined group and hash; small groups share cells
    band = F.floor(F.log(F.col("n") / F.col("least")) / math.log(den / num) + 1e-9).cast("int")
    large = members.join(total.filter(F.col("total") > limit), "c").withColumn("band", band)
    homes = (large.groupBy("c", "band", "known").agg(F.sum("n").alias("_n")).filter(F.col("_n") > limit // 4)
             .select("c", "band", "known", F.col("known").alias("home")))
    large = cut(large.join(homes, ["c", "band", "known"], "left"))
    cells = cut(large.groupBy("c", "band", "home").agg(F.sum("n").alias("n"))
                .withColumn("blocks", F.ceil(F.col("n") / (limit // 2)).cast("int")))
    cell = F.xxhash64("c", "band", F.col("home").isNull(), "home", "block")
    one = cells.select("c", "band", "home", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")).withColumn("cell", cell)
    two = one.select("c", F.col("band").alias("band2"), F.col("home").alias("home2"), F.col("cell").alias("cell2"))
    pairs = (one.join(two, "c").filter("band2 = band and cell2 >= cell or band2 = band + 1")
             .filter("home is null or home2 is null or home != home2").withColumn("tile", F.xxhash64("cell", "cell2")))
    seat = lambda which, side: pairs.select(F.col(which).alias("cell"), "tile", F.lit(side).cast("long").alias("side"))
    seats = seat("cell", 0).unionByName(seat("cell2", 1).join(pairs.filter("cell = cell2").select("tile"), "tile", "left_anti"))
    placed = (large.join(cells.select("c", "band", F.col("home").alias("_home"), "blocks").withColumnRenamed("c", "_c").withColumnRenamed("band", "_band"),
                         (F.col("c") == F.col("_c")) & (F.col("band") == F.col("_band")) & F.col("home").eqNullSafe(F.col("_home")))
              .withColumn("block", F.pmod(F.xxhash64("rep", "s1"), F.col("blocks")).cast("int")).withColumn("cell", cell))
    seated = small.unionByName(placed.join(seats, "cell").select("rep", "s1", "known", "tile", "side"))
    return _meet(seated.select("rep", "s1", "tile", "side", "known"), src, k, num, den)
