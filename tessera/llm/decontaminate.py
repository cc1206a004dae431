"""Benchmark decontamination by pigeonhole edit matching.

A test item of m code points may occur in a document with up to k = error_rate * m
edits. Cut into k + 1 pieces, at least one piece of it then occurs unchanged. All
pieces of a block of items are looked for in one pass over a document (an
Aho-Corasick automaton); around each hit, Myers' bit-parallel distance finds
where the whole item ends with the fewest edits, and the same from there
backwards where it starts.

Items are a stated query set: they are taken in blocks of at most BLOCK_CHARS
code points, each broadcast by itself, and every block is held against all
documents. Items and documents are compared in lower case, with each run of
white space as one space; places count code points of the document so changed.

Defined cases: a null or empty document has no match; a null item, and one without
anything but white space, matches nowhere; an item of fewer than SHORT code points
matches, with as many edits as its length allows, only what begins and ends between
words (at the text's ends, or beside anything but a letter, digit or underscore),
since a part of a word says nothing about a document; of equally good matches of an item, the first in the
document is given; items of equal text match alike; repeated documents are rows of their
own; a text of any length is searched whole; empty tables give no matches; other columns are ignored by ``matches`` and
kept by ``clean``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ERROR_RATE = 0.08
SHORT = 20
BLOCK_CHARS = 4 << 20
MATCHES = "item_id long, distance int, start int, end int"


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 pieces of nearly equal length, each with its place."""
    cuts = [len(item) * j // (k + 1) for j in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def masks(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | (1 << i)
    return out


def best_end(peq: dict[str, int], m: int, text: str, anchored: bool = False) -> tuple[int, int]:
    """Least edits of the pattern against what ends at some place of the text, and the first such place.

    The match may start anywhere, or, if anchored, only at the text's start.
    """
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best, where = m, 0
    get = peq.get
    carry = 1 if anchored else 0
    for j, c in enumerate(text, 1):
        eq = get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (~(xh | pv) & full)
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph = (ph << 1) | carry
        pv = ((mh << 1) | (~(xv | ph))) & full
        mv = ph & xv & full
        if score < best:
            best, where = score, j
    return best, where


def ends_within(peq: dict[str, int], m: int, text: str, k: int, anchored: bool = False) -> list[tuple[int, int]]:
    """(edits, end) of every end in the text where the pattern matches with at most k edits; as best_end otherwise."""
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    carry = 1 if anchored else 0
    out = []
    for j, c in enumerate(text, 1):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (~(xh | pv) & full)
        mh = pv & xh
        score += bool(ph & high) - bool(mh & high)
        ph = (ph << 1) | carry
        pv = ((mh << 1) | (~(xv | ph))) & full
        mv = ph & xv & full
        if score <= k:
            out.append((score, j))
    return out


def _of_word(c: str) -> bool:
    return c.isalnum() or c == "_"


def border(text: str, at: int) -> bool:
    """Whether a place is not inside a word: letters, digits and underscores on both sides."""
    return at in (0, len(text)) or not (_of_word(text[at - 1]) and _of_word(text[at]))


class Matcher:
    """A block of items, ready to be looked for."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float):
        import ahocorasick

        by_text: dict[str, list[int]] = {}
        for i, text in items:
            if n := normal(text):
                by_text.setdefault(n, []).append(i)
        self.items = [(t, ids, int(len(t) * error_rate), masks(t), masks(t[::-1])) for t, ids in by_text.items()]
        self.find = ahocorasick.Automaton()
        for n, (t, _, k, _, _) in enumerate(self.items):
            for at, piece in pieces(t, k):
                held = self.find.get(piece, None)
                if held is None:
                    self.find.add_word(piece, held := [])
                held.append((n, at + len(piece)))
        if self.items:
            self.find.make_automaton()

    def search(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, start, end) of the best match of each item in a normalised text."""
        if not self.items or not text:
            return []
        around: dict[int, list[tuple[int, int]]] = {}
        for end, held in self.find.iter(text):
            for n, upto in held:
                t, _, k, _, _ = self.items[n]
                lo = max(0, end + 1 - upto - k)
                hi = min(len(text), end + 1 - upto + len(t) + k)
                spans = around.setdefault(n, [])
                # hits come by their end, so windows of one item that overlap are next to each other
                if spans and lo <= spans[-1][1]:
                    spans[-1] = (min(lo, spans[-1][0]), max(hi, spans[-1][1]))
                else:
                    spans.append((lo, hi))
        out = []
        for n, spans in around.items():
            t, ids, k, forward, backward = self.items[n]
            if len(t) < SHORT:
                out += [(i, *found) for found in self.whole(n, text, spans) for i in ids]
                continue
            best = None
            for lo, hi in spans:
                d, e = best_end(forward, len(t), text[lo:hi])
                if d <= k and (best is None or d < best[0]):
                    best = (d, lo, lo + e)
                    if d == 0:
                        break
            if best:
                d, lo, e = best
                _, back = best_end(backward, len(t), text[lo:e][::-1], anchored=True)
                out += [(i, d, e - back, e) for i in ids]
        return sorted(out)

    def whole(self, n: int, text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """(distance, start, end) of the best match of a short item that begins and ends between words, if there is one."""
        t, _, k, forward, backward = self.items[n]
        found = []
        for lo, hi in spans:
            for _, e in ends_within(forward, len(t), text[lo:hi], k):
                if border(text, lo + e):
                    starts = ends_within(backward, len(t), text[lo : lo + e][::-1], k, anchored=True)
                    found += [(d, lo + e - back, lo + e) for d, back in starts if border(text, lo + e - back)]
        return [min(found)] if found else []


def blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int, str]]]:
    """The items, a block at a time; the driver holds one partition and one block of them."""
    held, size = [], 0
    for row in benchmark.select(F.col(f"`{item_id}`"), F.col(f"`{text}`")).toLocalIterator():
        if row[1] is None:
            continue
        held.append((row[0], row[1]))
        size += len(row[1])
        if size >= BLOCK_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _pass(docs: DataFrame, text: str, block: list[tuple[int, str]], error_rate: float, schema: T.StructType | str, shape: Callable) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = None
        for batch in batches:
            matcher = matcher or Matcher(shared.value, error_rate)
            found = [matcher.search(normal(t.as_py())) for t in batch.column(text)]
            yield shape(batch, found)

    return docs.mapInArrow(run, schema)


def matches(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", error_rate: float = ERROR_RATE) -> DataFrame:
    """key, item_id, distance, start, end: the best match of each item in each document that has one."""
    source = docs.select(F.col(f"`{key}`").alias("__key"), F.col(f"`{text}`").alias("__text"))
    schema = T.StructType([T.StructField("__key", docs.schema[key].dataType), *T.StructType.fromDDL(MATCHES)])

    def shape(batch: pa.RecordBatch, found: list[list[tuple]]) -> pa.RecordBatch:
        rows = [i for i, x in enumerate(found) for _ in x]
        flat = [x for xs in found for x in xs]
        cols = [pa.array([x[j] for x in flat], k) for j, k in enumerate((pa.int64(), pa.int32(), pa.int32(), pa.int32()))]
        return pa.RecordBatch.from_arrays([batch.column("__key").take(pa.array(rows, pa.int64())), *cols], names=["__key", "item_id", "distance", "start", "end"])

    out = None
    for block in blocks(benchmark, item_id, item_text):
        part = _pass(source, "__text", block, error_rate, schema, shape)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = docs.sparkSession.createDataFrame([], schema)
    return out.withColumnRenamed("__key", key)


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", error_rate: float = ERROR_RATE) -> DataFrame:
    """The documents in which no item matches, with all their columns."""
    def shape(batch: pa.RecordBatch, found: list[list[tuple]]) -> pa.RecordBatch:
        return batch.filter(pa.array([not x for x in found], pa.bool_()))

    for block in blocks(benchmark, item_id, item_text):
        docs = _pass(docs, text, block, error_rate, docs.schema, shape)
    return docs
