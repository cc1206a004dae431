"""SimHash near-duplicates: BK-trees over the fingerprints that share some of their bits.

A fingerprint has a bit where over half of a text's word shingles have it in their
hash. Equal fingerprints are one class. Two that differ in up to ``radius`` bits agree
in all but ``radius`` of any B pieces that the 64 bits are cut into, so each class is
dealt to the groups of its values in every choice of B - radius pieces, and no link
lies outside all groups. B grows with the number of classes (pieces_for), so that
groups of unrelated fingerprints stay small.

A group of up to TREE classes is one BK-tree: a child hangs below its parent by its
Hamming distance, and a search follows only edges within the radius. Trees are
searched as they are built, and what is linked is joined at once, so a group gives
an edge for each class that has a link, not for each pair; a subtree whose
classes all belong to the searcher's component already is not entered.

A larger group is cut into shards of about TREE classes by hash, a tree each. Where
a first round of components leaves more than one component in such a group, every
shard's tree (of bounded size) goes to each of the group's other shards, whose classes are searched in it.

Defined cases: a null text, and one without words, has the fingerprint zero, which
links like any other; a text of fewer words than a shingle is one shingle. Rows
that repeat a doc_id are documents of their own; a null doc_id is left out of the
smallest id, and a component of nulls alone has a null id. Texts may be of any
length; one at a time is hashed whole. An empty table gives an empty result.
Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.components import components
from tessera.llm.shared import materialize, release
from tessera.llm.words import chunks, text_buffer, words_of

WORDS = 3
SEED = 42
RADIUS = 3
#: Classes of a tree.
TREE = 2048
#: Pieces that fingerprints are cut into, and the number of classes up to which a choice of pieces keeps groups of unrelated ones to some tens.
PIECES = ((4, 1 << 21), (5, 1 << 30), (6, 1 << 63))
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Shingles whose bits are spread out at once.
_SPREAD = 1 << 14


def _votes(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit, the least significant first."""
    out = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _SPREAD):
        out += np.unpackbits(hashes[at : at + _SPREAD].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return out


def fingerprints(column: pa.Array, k: int = WORDS, seed: int = SEED) -> np.ndarray:
    """The fingerprint of each text, as unsigned 64-bit integers."""
    data, offsets = text_buffer(column)
    out = np.zeros(len(offsets) - 1, np.uint64)
    weights = np.left_shift(np.uint64(1), np.arange(64, dtype=np.uint64))
    for lo, hi in chunks(offsets):
        piece = data[offsets[lo] : offsets[hi]]
        found = words_of(piece, offsets[lo : hi + 1] - offsets[lo])
        # the words joined by single spaces: each shingle is one slice
        joined = b" ".join(map(piece.tobytes().translate(_LOWER).__getitem__, map(slice, found.start.tolist(), found.end.tolist())))
        ends = np.cumsum(found.end - found.start + 1) - 1
        starts = ends - (found.end - found.start)
        for i, (a, b) in enumerate(zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True)):
            if a == b:
                continue
            last = min(b, a + k)
            cuts = map(slice, starts[a : max(b - k, a) + 1].tolist(), ends[last - 1 : b].tolist())
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(joined.__getitem__, cuts), repeat(seed)), np.uint64)
            out[lo + i] = weights[2 * _votes(hashes) > len(hashes)].sum(dtype=np.uint64)
    return out


def document_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fingerprints(batch.column("text")).view(np.int64))], names=["doc_id", "fp"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


class Tree:
    """A BK-tree of fingerprints that also joins what it finds linked."""

    def __init__(self, radius: int = RADIUS):
        self.radius = radius
        self.fps: list[int] = []
        self.below: list[dict[int, int]] = []
        self.whole: list[int | None] = []  # the class that all of a subtree is joined to, or None
        self.up: dict[int, int] = {}

    def top(self, x: int) -> int:
        up = self.up
        while (p := up.setdefault(x, x)) != x:
            up[x] = up[p]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.top(a), self.top(b)
        self.up[max(a, b)] = min(a, b)

    def add(self, fp: int) -> None:
        """Hang a fingerprint into the tree, below the child that has its distance."""
        new, at = len(self.fps), 0
        self.fps.append(fp)
        self.below.append({})
        self.whole.append(fp)
        if not new:
            return
        own = self.top(fp)
        while True:
            if self.whole[at] is not None and self.top(self.whole[at]) != own:
                self.whole[at] = None
            held = self.below[at].setdefault((fp ^ self.fps[at]).bit_count(), new)
            if held == new:
                return
            at = held

    def search(self, fp: int) -> None:
        """Join a fingerprint with all of the tree within the radius, but for subtrees that are joined with it already."""
        if not self.fps:
            return
        own, r, stack = self.top(fp), self.radius, [0]
        while stack:
            at = stack.pop()
            if self.whole[at] is not None and self.top(self.whole[at]) == own:
                continue
            d = (fp ^ self.fps[at]).bit_count()
            if d <= r:
                self.join(fp, self.fps[at])
                own = self.top(fp)
            stack += [i for e, i in self.below[at].items() if d - r <= e <= d + r]


def linked(fps: list[int], radius: int = RADIUS, tree: Tree | None = None) -> list[tuple[int, int]]:
    """(fingerprint, least of its component) for those of a group that have a link and are not the least."""
    tree = tree or Tree(radius)
    for fp in fps:
        tree.search(fp)
        tree.add(fp)
    return [(fp, t) for fp in fps if (t := tree.top(fp)) != fp]


def pieces_for(classes: int) -> int:
    return next(b for b, upto in PIECES if classes <= upto)


def group_keys(fp: str, pieces: int, radius: int = RADIUS) -> Column:
    """The keys of a fingerprint's groups: a hash of the choice and of the values of its pieces."""
    cuts = [64 * i // pieces for i in range(pieces + 1)]
    values = [F.shiftrightunsigned(F.col(fp), a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(cuts, cuts[1:], strict=False)]
    return F.array(*[F.xxhash64(F.lit(n), *[values[i] for i in chosen]) for n, chosen in enumerate(combinations(range(pieces), pieces - radius))])


def _runs(rows: DataFrame, keys: list[str], radius: int) -> DataFrame:
    """u, v: links found within each group of (keys, fp); many groups to a task, a group held by itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            out = []
            columns = [batch.column(k).to_pylist() for k in keys]
            for *now, fp in zip(*columns, batch.column("fp").to_numpy().view(np.uint64).tolist(), strict=True):
                if now != key:
                    if len(held) > 1:
                        out += linked(held, radius)
                    key, held = now, []
                held.append(fp)
            yield _edges(out)
        if len(held) > 1:
            yield _edges(linked(held, radius))

    dealt = rows.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, "u long, v long")


def _edges(links: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["u", "v"])


def _across(rows: DataFrame, radius: int) -> DataFrame:
    """u, v: links between shards of a group, for (key, shard, shards, fp, root): each shard's tree meets the classes of every later shard.

    Rows of a pair of shards come to one task, which holds two shards at most.
    """
    own = F.col("shard")
    pair = F.transform(F.sequence(F.lit(0), F.col("shards") - 1), lambda o: F.struct(F.least(own, o).alias("a"), F.greatest(own, o).alias("b")))
    dealt = rows.select("key", "shard", "fp", "root", F.explode(F.filter(pair, lambda p: p["a"] != p["b"])).alias("p")).select("key", "p.a", "p.b", "shard", "fp", "root")

    def found(first: list[tuple[int, int]], second: list[tuple[int, int]]) -> list[tuple[int, int]]:
        if len({r for _, r in first} | {r for _, r in second}) < 2:
            return []
        tree = Tree(radius)
        for fp, root in (*first, *second):
            tree.join(fp, root)
        for fp, _ in first:
            tree.add(fp)
        for fp, _ in second:
            tree.search(fp)
        return [(fp, t) for fp in {x for pair in (*first, *second) for x in pair} if (t := tree.top(fp)) != fp]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, ([], [])
        for batch in batches:
            out = []
            key_, a, b, shard = (batch.column(c).to_pylist() for c in ("key", "a", "b", "shard"))
            fps, roots = (batch.column(c).to_numpy().view(np.uint64).tolist() for c in ("fp", "root"))
            for *now, s, fp, root in zip(key_, a, b, shard, fps, roots, strict=True):
                if now != key:
                    out += found(*held)
                    key, held = now, ([], [])
                held[s == now[2]].append((fp, root))
            yield _edges(out)
        yield _edges(found(*held))

    return dealt.repartition("key", "a", "b").sortWithinPartitions("key", "a", "b").mapInArrow(run, "u long, v long")


def fingerprint_components(classes: DataFrame, radius: int = RADIUS, tree: int = TREE, pieces: int | None = None) -> DataFrame:
    """node, root for each of the distinct fingerprints fp that has a link; the root is one of the component."""
    n = classes.count()
    keyed = materialize(classes.select("fp", F.explode(group_keys("fp", pieces or pieces_for(n), radius)).alias("key")), "simhash-keys")
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    large = materialize(sizes.filter(F.col("n") > tree).select("key", F.ceil(F.col("n") / tree).cast("int").alias("shards")), "simhash-large")
    some = large.isEmpty()
    whole = keyed.withColumns({"shards": F.lit(1), "shard": F.lit(0)}) if some else keyed.join(large, "key", "left").withColumn("shard", F.pmod(F.xxhash64("fp"), F.coalesce("shards", F.lit(1))).cast("int"))
    edges = materialize(_runs(whole.select("key", "shard", "fp"), ["key", "shard"], radius), "simhash-edges")
    stars = components(edges, "simhash-components")
    if not some:
        members = materialize(keyed.join(large, "key").join(stars, F.col("fp") == F.col("node"), "left").select("key", "shards", F.pmod(F.xxhash64("fp"), "shards").cast("int").alias("shard"), "fp", F.coalesce("root", "fp").alias("root")), "simhash-members")
        open_ = members.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a < b").select("key")
        more = materialize(_across(members.join(open_, "key"), radius), "simhash-across")
        again = components(edges.unionByName(more), "simhash-components")
        release(stars, members, more)
        stars = again
    release(keyed, large, edges)
    return stars


def document_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (hexadecimal) and component_id, the smallest doc_id reachable by links, for every document."""
    rows = materialize(document_fingerprints(docs, doc_id, text), "simhash-fingerprints")
    classes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    stars = fingerprint_components(classes, radius)
    rooted = materialize(classes.join(stars, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "simhash-rooted")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = materialize(rooted.join(least, "root").select("fp", "component_id"), "simhash-named")
    release(classes, stars, rooted)
    return rows.join(named, "fp").select(F.col("doc_id").alias(doc_id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
