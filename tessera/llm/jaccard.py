"""Exact n-gram Jaccard join of whole documents, with an R-tree of count vectors.

A document's set holds the hashes of its distinct shingles. Documents of one set
are a class, and classes are what is joined. Two classes link when their overlap
is at least ``percent`` of their union.

Blocks. Of any two linked sets, the first n - ceil(percent * n) + 1 shingles in
one order of all shingles have one in common, so only classes that share such a
key are compared. The order is by hash, with shingles last that many documents
share, by their counts; any order gives the same links, this one gives small
blocks. The list of common shingles has a fixed length (HOT_LIMIT).

Stars. In each block every class looks at the block's leader, the class whose
key comes earliest in its own order, so one that has little that is rare; it is
verified against the leader it shares most blocks with. This is linear in the
blocks and joins most groups of near copies. A shared key at places i and j
leaves room for min(n - i, m - j) common shingles; what needs more is left out.

R-tree. Blocks whose classes are then still of several components are joined with
themselves by R-trees, whatever their size. The shingles are hashed into GROUPS
groups, and a class is the point of its group counts: the sum of the coordinate
minima of two points bounds the overlap of the sets, and that of two boxes' upper
corners bounds the overlap of all sets below them. A tree is joined with itself
from its root; subtrees whose bound is below what their smallest sizes need, or
that lie in one component, are left out. Blocks of over TILE classes are cut into
tiles, each pair of tiles a tree of its own, and many small trees make a task. For
TURNS rounds a class is verified against PICKS partners only, which joins
components; then all pairs that survive, and survive finer counts, are verified on
the texts.

Memory: a task holds a bucket of keys, a tile pair or a batch of texts; the
driver holds the list of common shingles and counts. Hashes have 64 bits.

Defined cases: a null or empty text, or one without words, has an empty set, is
linked with nothing and is its own component; a document without an id has its
set's size, but takes no part in linking and has no component; repeated ids are
rows of their own, linked by their own sets; where no two documents share a key,
or there is one document only, nothing is linked; empty tables give no rows; other
columns are ignored, or kept by ``keep_one``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import words as W
from tessera.llm.components import components
from tessera.llm.shared import materialize, release, scratch

K, PERCENT = 5, 80
#: Common shingles that are ordered last, and in how many documents of LOCAL_BYTES of text a shingle counts as common.
HOT_LIMIT, HOT_LOCAL, LOCAL_BYTES = 1 << 17, 4, 8 << 20
#: Key rows that a bucket holds, classes of a block's tile, of a leaf, and coordinates of a point.
BUCKET_ROWS, TILE, LEAF, GROUPS = 1 << 20, 4096, 16, 128
UNBOUNDED = 65535 * GROUPS
#: Rows of small blocks that one task joins.
TREE_ROWS = 1 << 15
#: The finer groups of a pair that the trees let through are told by so many bits of a hash.
FINE_BITS = 10
#: Rounds in which a class of a larger block is verified against a few partners, before all that are left.
TURNS, PICKS = 2, 4
_KEY = np.dtype([("key", "<u8"), ("cls", "<i8"), ("n", "<i4"), ("pos", "<i4")])


def need(n: int | np.ndarray, m: int | np.ndarray, percent: int = PERCENT):  # noqa: ANN201
    """Least overlap of linked sets of n and m."""
    return -((-(n + m) * percent) // (100 + percent))


def sets_of(column: pa.Array, k: int = K) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """(from, to, sorted distinct shingle hashes of each) for runs of texts."""
    data, offsets = W.text_buffer(column)
    for lo, hi in W.chunks(offsets):
        w = W.words_of(data, offsets[lo : hi + 1])
        grams = W.gram_hashes(w.hash, k)
        out = []
        for i in range(hi - lo):
            a, b = int(w.first[i]), int(w.first[i + 1])
            if b - a >= k:
                g = np.sort(grams[a : b - k + 1])
                keep = np.empty(len(g), bool)
                keep[0] = True
                np.not_equal(g[1:], g[:-1], out=keep[1:])
                out.append(g[keep])
            else:
                out.append(W.whole_hash(w.hash[a:b]) if b > a else np.zeros(0, np.uint64))
        yield lo, hi, out


def class_of(s: np.ndarray) -> int:
    """A 64-bit id of a set, signed."""
    x = int(W.mix(s ^ np.uint64(0x6A09E667F3BCC909)).sum(dtype=np.uint64)) + len(s) * 0x9E3779B97F4A7C15
    return int(W.mix(np.array([x % (1 << 64)], np.uint64)).view(np.int64)[0])


def common_shingles(docs: DataFrame, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, and counts of the shingles that many documents share; HOT_LIMIT at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def counted() -> pa.RecordBatch:
            u, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            often = n >= HOT_LOCAL
            return pa.RecordBatch.from_arrays([pa.array(u[often].view(np.int64)), pa.array(n[often].astype(np.int64))], names=["h", "n"])

        for batch in batches:
            for _, _, sets in sets_of(batch.column("text"), k):
                held += sets
                size += sum(map(len, sets)) * 6
                if size >= LOCAL_BYTES:
                    yield counted()
                    held, size = [], 0
        yield counted()

    counts = docs.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "h").limit(HOT_LIMIT).toPandas()
    h, n = top["h"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64)
    order = np.argsort(h)
    return h[order], n[order]


def ordered_prefix(s: np.ndarray, hot: np.ndarray, rank: np.ndarray, percent: int) -> np.ndarray:
    """The first n - ceil(percent * n) + 1 shingles of a sorted set; hot marks the common ones, with their rank."""
    p = len(s) + ((-len(s) * percent) // 100) + 1
    if not hot.any():
        return s[:p]
    rare = s[~hot][:p]
    if len(rare) == p:
        return rare
    common = s[hot][np.lexsort((s[hot], rank[hot]))]
    return np.concatenate([rare, common[: p - len(rare)]])


def measured(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """doc_id, digest (of the text), n, cls and the keys of the first document of each class in its task, written to the shared folder."""
    hashes, counts = common_shingles(docs, k)
    ranks = np.empty(len(counts), np.int64)
    ranks[np.lexsort((hashes, counts))] = np.arange(len(counts))
    shared = docs.sparkSession.sparkContext.broadcast((hashes, ranks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, rank = shared.value
        seen: set[int] = set()
        for batch in batches:
            ids = batch.column("doc_id")
            for lo, hi, sets in sets_of(batch.column("text"), k):
                flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, flat), len(hot) - 1)
                    hit = hot[at] == flat
                else:
                    at, hit = np.zeros(len(flat), np.int64), np.zeros(len(flat), bool)
                ends = np.cumsum([0, *map(len, sets)])
                n, cls, keys = [], [], []
                for i, s in enumerate(sets):
                    n.append(len(s))
                    c = class_of(s) if len(s) else None
                    cls.append(c)
                    if c is None or c in seen or not ids[lo + i].is_valid:
                        keys.append(None)
                        continue
                    seen.add(c)
                    part = slice(ends[i], ends[i + 1])
                    keys.append(ordered_prefix(s, hit[part], rank[at[part]] if len(rank) else at[part], percent).tobytes())
                if len(seen) > 1_000_000:  # no more than a saving: a class may give its keys again
                    seen.clear()
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), batch.column("digest").slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), pa.array(keys, pa.binary())], names=["doc_id", "digest", "n", "cls", "keys"])

    source = docs.select("doc_id", "text", F.xxhash64("text").alias("digest"))
    return materialize(source.mapInArrow(run, "doc_id long, digest long, n long, cls long, keys binary"), "jaccard-sets"), shared, counts


def met_in_blocks(sets: DataFrame, shared, counts: np.ndarray, percent: int = PERCENT) -> DataFrame:  # noqa: ANN001
    """The blocks of classes with a common key: key, cls, n, free (what the key's place leaves of n), size and lead.

    Keys meet in buckets of packed rows. size is about that of the block, lead the
    block's leader, where the class may link with it.
    """
    rows = sets.agg(F.sum(F.octet_length("keys") / 8)).first()[0] or 0
    buckets = max(sets.sparkSession.sparkContext.defaultParallelism, int(rows // BUCKET_ROWS) + 1)
    salts = sets.sparkSession.sparkContext.broadcast((counts, np.maximum(1, -(-counts // TILE))))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, _ = shared.value
        _, split = salts.value

        def packed(held: list[np.ndarray]) -> pa.RecordBatch:
            rows = np.concatenate(held)
            at, hit = _places(hot, rows["key"])
            salt = np.zeros(len(rows), np.uint64)
            salt[hit] = rows["cls"][hit].view(np.uint64) % split[at[hit]].astype(np.uint64)
            to = (W.mix(rows["key"] + salt * np.uint64(0x632BE59BD9B4E019)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            rows, to = rows[order], to[order]
            cuts = np.flatnonzero(np.diff(to)) + 1
            return pa.RecordBatch.from_arrays([pa.array(to[np.concatenate([[0], cuts])]), pa.array([x.tobytes() for x in np.split(rows, cuts)], pa.binary())], names=["bucket", "rows"])

        held, size = [], 0
        for batch in batches:
            for keys, cls, n in zip(batch.column("keys"), batch.column("cls").to_pylist(), batch.column("n").to_pylist(), strict=True):
                key = np.frombuffer(keys.as_py(), np.uint64)
                row = np.empty(len(key), _KEY)
                row["key"], row["cls"], row["n"], row["pos"] = key, cls, n, np.arange(len(key))
                held.append(row)
                size += len(row)
                if size >= BUCKET_ROWS:
                    yield packed(held)
                    held, size = [], 0
        if held:
            yield packed(held)

    def meet(table: pa.Table) -> pa.Table:
        hot, _ = shared.value
        count, split = salts.value
        rows = np.concatenate([np.frombuffer(x.as_py(), _KEY) for x in table.column("rows")])
        rows = rows[np.lexsort((rows["cls"], rows["key"]))]
        fresh = np.ones(len(rows), bool)
        fresh[1:] = (rows["key"][1:] != rows["key"][:-1]) | (rows["cls"][1:] != rows["cls"][:-1])
        rows = rows[fresh]
        begins = np.ones(len(rows), bool)
        begins[1:] = rows["key"][1:] != rows["key"][:-1]
        run = np.cumsum(begins) - 1
        size = np.bincount(run)[run].astype(np.int64) if len(rows) else np.zeros(0, np.int64)
        at, hit = _places(hot, rows["key"])
        salted = np.zeros(len(rows), bool)
        salted[hit] = split[at[hit]] > 1  # the rest of such a block is in other buckets
        size[salted] = np.maximum(size[salted], count[at[salted]])
        keep = (size > 1) | salted
        rows, size, run, salted = rows[keep], size[keep], run[keep], salted[keep]
        n, free = rows["n"].astype(np.int64), rows["n"].astype(np.int64) - rows["pos"]

        def fits(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            return (100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])) & (np.minimum(free[x], free[y]) >= need(n[x], n[y], percent))

        # the leader stands earliest in the order of its own set: it has little that is rare
        by = np.lexsort((rows["cls"], rows["pos"], run))
        lead = np.empty(len(rows), np.int64)
        starts = np.flatnonzero(np.diff(run, prepend=-1))
        lead[:] = by[starts][np.cumsum(np.diff(run, prepend=-1) != 0) - 1] if len(rows) else 0
        me = np.arange(len(rows))
        star = me[(lead != me) & fits(me, lead)] if len(rows) else me
        led = np.zeros(len(rows), bool)
        led[star] = True
        # what no other class of the block comes near in size goes; in a salted block the rest is elsewhere
        by = np.lexsort((n, run))
        ok = np.zeros(len(rows), bool)
        x, y = by[:-1], by[1:]
        close = (run[x] == run[y]) & (100 * n[x] >= percent * n[y])
        ok[x[close]] = ok[y[close]] = True
        ok |= salted
        names = ("key", "cls", "n", "free", "size")
        cols = {k: pa.array(v[ok]) for k, v in zip(names, (rows["key"].view(np.int64), rows["cls"], n, free, size), strict=True)}
        return pa.table(cols | {"lead": pa.array(rows["cls"][lead][ok], mask=~led[ok])})

    dealt = sets.filter("keys is not null").select("keys", "cls", "n").mapInArrow(deal, "bucket long, rows binary")
    return materialize(dealt.groupBy("bucket").applyInArrow(meet, "key long, cls long, n long, free long, size long, lead long"), "jaccard-met")


def _places(values: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each of x stands in sorted values, and whether it does."""
    if not len(values):
        return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(values, x), len(values) - 1)
    return at, values[at] == x


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs, and how often each came."""
    if not len(a):
        return a, b, np.zeros(0, np.int64)
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    at = np.flatnonzero(new)
    return a[at], b[at], np.diff(np.append(at, len(a)))


def verified(pairs: DataFrame, texts: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """u, v of the pairs of classes (a, b) whose texts' sets link."""
    both = pairs.join(texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a")), "a").join(texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good: list[bool] = []
            step = 512
            for lo in range(0, batch.num_rows, step):
                some = batch.slice(lo, step)
                left = [s for _, _, sets in sets_of(some.column("text_a"), k) for s in sets]
                right = [s for _, _, sets in sets_of(some.column("text_b"), k) for s in sets]
                for x, y in zip(left, right, strict=True):
                    z = np.sort(np.concatenate([x, y]))
                    good.append(int((z[1:] == z[:-1]).sum()) >= need(len(x), len(y), percent))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["u", "v"]).filter(pa.array(good, pa.bool_()))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "u long, v long")


def points_of(texts: DataFrame, k: int = K) -> DataFrame:
    """cls, n, the packed group counts of its set, and finer ones (bytes; a group of more counts as 255)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, out, fine = [], [], []
            for _, _, sets in sets_of(batch.column("text"), k):
                n += map(len, sets)
                counts = [np.bincount((s >> np.uint64(64 - FINE_BITS)).astype(np.int64), minlength=1 << FINE_BITS) for s in sets]
                fine += [c.clip(0, 255).astype("u1").tobytes() for c in counts]
                coarse = [c.reshape(GROUPS, -1).sum(axis=1) for c in counts]
                # a set with a group beyond 16 bits gets the point that bounds nothing
                out += [(c if c.max() < 65536 else np.full(GROUPS, 65535)).astype("<u2").tobytes() for c in coarse]
            yield pa.RecordBatch.from_arrays([batch.column("cls"), pa.array(n, pa.int64()), pa.array(out, pa.binary()), pa.array(fine, pa.binary())], names=["cls", "n", "point", "fine"])

    return texts.mapInArrow(run, "cls long, n long, point binary, fine binary")


def bounded(pairs: DataFrame, points: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose finer counts allow the overlap they need; counts are smaller than texts, so texts move for these only."""
    both = pairs
    for c in "ab":
        both = both.join(points.select(F.col("cls").alias(c), F.col("n").alias(f"n{c}"), F.col("fine").alias(f"f{c}")), c)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (np.asarray(batch.column(c)) for c in ("na", "nb"))
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "u1").reshape(-1, 1 << FINE_BITS) for c in ("fa", "fb"))
            # what a full byte does not count may be common too
            most = np.minimum(x, y).sum(axis=1, dtype=np.int64) + np.minimum(n - x.sum(axis=1, dtype=np.int64), m - y.sum(axis=1, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(most >= need(n, m, percent), pa.bool_()))

    return both.select("a", "b", "na", "nb", "fa", "fb").mapInArrow(run, "a long, b long")


class RTree:
    """Points of group counts with their sizes and components, packed by sorting on the widest coordinate."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, free: np.ndarray, comps: np.ndarray, percent: int = PERCENT):
        self.points, self.sizes, self.free, self.comps, self.percent = points, sizes, free, comps, percent
        self.root = self._build(np.arange(len(points)))

    def _build(self, rows: np.ndarray) -> tuple:
        """(upper corner, least size, largest size, the only component or None, rows, children, most that can be common)"""
        some = self.points[rows]
        comp = self.comps[rows[0]] if (self.comps[rows] == self.comps[rows[0]]).all() else None
        box = some.max(axis=0), int(self.sizes[rows].min()), int(self.sizes[rows].max()), comp
        if len(rows) <= LEAF:
            return (*box, rows, (), int(self.free[rows].max()))
        spread = self.sizes[rows].max() - self.sizes[rows].min()
        ranges = some.max(axis=0).astype(np.int64) - some.min(axis=0)
        by = self.sizes[rows] if spread > 4 * ranges.max() else some[:, int(ranges.argmax())]
        order = rows[np.argsort(by, kind="stable")]
        half = len(order) // 2
        return (*box, rows, (self._build(order[:half]), self._build(order[half:])), int(self.free[rows].max()))

    def _apart(self, a: tuple, b: tuple) -> bool:
        """No point below a links with one below b in another component."""
        if a[3] is not None and a[3] == b[3]:
            return True
        if 100 * a[2] < self.percent * b[1] or 100 * b[2] < self.percent * a[1]:
            return True
        least = need(a[1], b[1], self.percent)
        # two points that bound nothing have UNBOUNDED in common
        return min(a[6], b[6]) < least or int(np.minimum(a[0], b[0]).sum(dtype=np.int64)) < min(least, UNBOUNDED)

    def pairs(self, side: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows that may link and are in different components; if sides are given, on different sides."""
        stack = [(self.root, self.root)]
        while stack:
            a, b = stack.pop()
            if self._apart(a, b):
                continue
            if a[5] and (len(a[4]) >= len(b[4]) or not b[5]):
                if a is b:
                    stack += [(a[5][0], a[5][0]), (a[5][0], a[5][1]), (a[5][1], a[5][1])]
                else:
                    stack += [(x, b) for x in a[5]]
                continue
            if b[5]:
                stack += [(a, x) for x in b[5]]
                continue
            x, y = np.repeat(a[4], len(b[4])), np.tile(b[4], len(a[4]))
            good = self.comps[x] != self.comps[y]
            if a is b:
                good &= x < y
            if side is not None:
                good &= side[x] != side[y]
            x, y = x[good], y[good]
            n, m = self.sizes[x], self.sizes[y]
            least = need(n, m, self.percent)
            good = (np.minimum(self.free[x], self.free[y]) >= least) & (100 * np.minimum(n, m) >= self.percent * np.maximum(n, m))
            x, y, least = x[good], y[good], least[good]
            good = np.minimum(self.points[x], self.points[y]).sum(axis=1, dtype=np.int64) >= np.minimum(least, UNBOUNDED)
            if good.any():
                yield x[good], y[good]


def open_rows(rows: DataFrame, roots: DataFrame, turn: int) -> DataFrame:
    """The rows of blocks that still hold several components, with their roots; asks, in one block of each class at a turn."""
    rooted = materialize(rows.join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left").withColumn("root", F.coalesce("root", "cls")), "jaccard-rows")
    several = rooted.groupBy("key").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).filter("r1 < r2").select("key")
    found = materialize(rooted.join(several, "key"), "jaccard-several")
    release(rooted)
    # each class asks for partners in one of its blocks only
    asked = found.groupBy("cls").agg(F.min_by("key", F.xxhash64("key", F.lit(turn))).alias("asked"))
    out = materialize(found.join(asked, "cls").select(*found.columns, (F.col("key") == F.col("asked")).alias("asks")), "jaccard-open")
    release(found)
    return out


def tree_pairs(rows: DataFrame, points: DataFrame, percent: int = PERCENT, picks: int | None = None, turn: int = 0) -> DataFrame:
    """a, b of the pairs of classes in a block, of different components, that may link.

    With picks, each class gets at most that many partners, of the block where it asks.
    """
    tiles = F.ceil(F.col("size") / TILE).cast("int")
    dealt = rows.withColumn("tiles", tiles).withColumn("own", F.pmod("cls", F.col("tiles")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).withColumn("t1", F.least("own", "other")).withColumn("t2", F.greatest("own", "other"))
    total = dealt.agg(F.count(F.lit(1))).first()[0]
    unit = F.xxhash64("key", "t1", "t2")
    dealt = dealt.withColumn("bucket", F.pmod(unit, F.lit(total // TREE_ROWS + 1)))
    dealt = dealt.join(points.select("cls", "point"), "cls").select("bucket", unit.alias("unit"), "own", "cls", "n", "free", "root", "asks", "point")

    def join_all(table: pa.Table) -> pa.Table:
        unit, cls, size, free, comp, own, asks = (np.asarray(table.column(c)) for c in ("unit", "cls", "n", "free", "root", "own", "asks"))
        points_ = np.frombuffer(b"".join(table.column("point").to_pylist()), "<u2").reshape(len(cls), GROUPS)
        order = np.argsort(unit, kind="stable")
        begin = np.flatnonzero(np.diff(unit[order], prepend=~unit[order[0]]))
        end = np.append(begin[1:], len(order))
        left, right = [], []
        # trees of a single leaf, all at once: each row with the one d places on
        fits = (end - begin) <= LEAF
        upto = np.repeat(np.where(fits, end, 0), end - begin)
        for d in range(1, LEAF):
            x = np.flatnonzero(np.arange(len(order)) + d < upto)
            x, y = order[x], order[x + d]
            good = comp[x] != comp[y]
            x, y = x[good], y[good]
            least = need(size[x], size[y], percent)
            good = (np.minimum(free[x], free[y]) >= least) & (100 * np.minimum(size[x], size[y]) >= percent * np.maximum(size[x], size[y]))
            x, y, least = x[good], y[good], least[good]
            good = np.minimum(points_[x], points_[y]).sum(axis=1, dtype=np.int64) >= least
            left.append(x[good])
            right.append(y[good])
        for lo, hi in zip(begin[~fits], end[~fits], strict=True):
            at = order[lo:hi]
            # a unit of two tiles joins one with the other, that of one tile itself
            apart = own[at] if (own[at] != own[at[0]]).any() else None
            for x, y in RTree(points_[at], size[at], free[at], comp[at], percent).pairs(apart):
                left.append(at[x])
                right.append(at[y])
        x, y = np.concatenate(left), np.concatenate(right)
        if picks is not None and len(x):
            # of each class, the partners that come first in this turn's order
            x, y = np.concatenate([x, y]), np.concatenate([y, x])
            x, y = x[asks[x]], y[asks[x]]
            order = np.lexsort((W.mix(cls[y].view(np.uint64) + np.uint64(turn)), x))
            x, y = x[order], y[order]
            begin = np.flatnonzero(np.diff(x, prepend=-1))
            nth = np.arange(len(x)) - np.repeat(begin, np.diff(np.append(begin, len(x))))
            x, y = x[nth < picks], y[nth < picks]
        a, b, _ = _distinct(np.minimum(cls[x], cls[y]), np.maximum(cls[x], cls[y]))
        return pa.table({"a": a, "b": b})

    return dealt.groupBy("bucket").applyInArrow(join_all, "a long, b long")


def document_components(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    sets, named = _components(docs, k, percent)
    own = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component_id", "doc_id"))
    return sets.join(named, "cls", "left").select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def keep_one(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """One document of each component, with all its columns: one of the least id.

    Documents without an id or without words are all kept, and of rows that repeat an
    id, those whose texts are not linked are each kept.
    """
    sets, named = _components(docs, k, percent)
    rows = sets.filter("doc_id is not null").join(named, "cls", "left")
    linked = rows.filter("cls is not null").groupBy("root").agg(F.min(F.struct("doc_id", "digest")).alias("k")).select("k.*", F.lit(True).alias("one"))
    keep = linked.unionByName(rows.filter("cls is null").select("doc_id", "digest", F.lit(False).alias("one")).distinct())
    keep = keep.select(F.struct("doc_id", "digest", "one").alias("k"))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("r"))
    digest = F.xxhash64("r.text")
    found = packed.join(keep, (F.col("r.doc_id") == F.col("k.doc_id")) & digest.eqNullSafe(F.col("k.digest")))
    kept = found.filter("k.one").groupBy("k.doc_id", "k.digest").agg(F.first("r").alias("r")).select("r")
    others = found.filter("not k.one").select("r").unionByName(packed.filter("r.doc_id is null"))
    return kept.unionByName(others).select(*[F.col(f"r.`{c}`").alias(c) for c in docs.columns])


def _links(docs: DataFrame, sets: DataFrame, classes: DataFrame, shared, counts: np.ndarray, k: int, percent: int) -> DataFrame:  # noqa: ANN001
    """node, root of the classes that are linked with another."""
    with scratch() as held:
        held.append(met := met_in_blocks(sets, shared, counts, percent))
        release(sets)
        stars = met.filter("lead is not null").groupBy("cls", "lead").agg(F.count(F.lit(1)).alias("c")).groupBy("cls").agg(F.max_by("lead", F.struct("c", "lead")).alias("lead"))
        stars = stars.select(F.least("cls", "lead").alias("a"), F.greatest("cls", "lead").alias("b")).distinct()
        named = met.select("cls").unionByName(met.filter("lead is not null").select(F.col("lead").alias("cls"))).distinct()
        # an id may stand for several texts: the set tells which is meant
        fetched = docs.join(named.join(classes, "cls"), F.col("doc_id") == F.col("first_id")).select("cls", "text")
        held.append(texts := materialize(_own_class(fetched, k), "jaccard-texts"))
        links = materialize(verified(stars, texts, k, percent), "jaccard-links")
        roots = components(links)
        rows = open_rows(met.drop("lead"), roots, 0)
        release(met)
        held.append(points := materialize(points_of(texts.join(rows.select("cls").distinct(), "cls", "left_semi"), k), "jaccard-points"))
        for turn in range(TURNS + 1):
            if rows.isEmpty():
                break
            held.append(pairs := materialize(bounded(tree_pairs(rows, points, percent, PICKS if turn < TURNS else None, turn).distinct(), points, percent), "jaccard-pairs"))
            found = materialize(verified(pairs, texts, k, percent), "jaccard-links")
            held += [rows, found]
            if found.isEmpty():
                if turn == TURNS:
                    break
                continue
            both = materialize(links.unionByName(found), "jaccard-links")
            release(links, roots, pairs)
            links, roots = both, components(both)
            if turn < TURNS:
                more = open_rows(rows.drop("root", "asks"), roots, turn + 1)
                release(rows)
                rows = more
        held += [rows, links]
        return roots


def _components(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """doc_id, digest, n and cls of every document; root and component_id of every class."""
    docs = docs.select("doc_id", "text")
    full, shared, counts = measured(docs, k, percent)
    sets = materialize(full.drop("keys"), "jaccard-documents")
    classes = materialize(sets.filter("cls is not null and doc_id is not null").groupBy("cls").agg(F.min("doc_id").alias("first_id")), "jaccard-classes")
    roots = _links(docs, full, classes, shared, counts, k, percent)
    least = classes.join(roots, F.col("cls") == F.col("node")).groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = roots.join(least, "root").select(F.col("node").alias("cls"), "root", "component_id")
    named = materialize(classes.join(linked, "cls", "left").select("cls", F.coalesce("root", "cls").alias("root"), F.coalesce("component_id", "first_id").alias("component_id")), "jaccard-named")
    release(roots, classes)
    return sets, named


def _own_class(fetched: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [class_of(s) if len(s) else None for _, _, sets in sets_of(batch.column("text"), k) for s in sets]
            yield batch.filter(pa.array([c == o for c, o in zip(batch.column("cls").to_pylist(), own, strict=True)], pa.bool_()))

    return fetched.mapInArrow(run, "cls long, text string").dropDuplicates(["cls"])
