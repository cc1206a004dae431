"""How quality filters interact: what each removes, repeats or alone would catch, for every order of applying them.

A first pass over the texts gives a few flags and a digest for each document; what
equals an earlier text is found by the digests. The flags of a batch of documents
then become an index of packed bitmaps, 64 documents to a word: one for each
filter, one for each label, and for each part a run of words that is its own, as
the documents of a batch are laid out by part. For every set of filters the
survivors are the documents AND-NOT the set's bitmaps, and popcounts of them, by
part and label, are all that leaves the task. Summed over all tasks these 32 counts
of a part answer for all orders: an order's step removes what survives the
filters before it and not those up to it.

Defined cases: a null text is an empty one, and equals one; a null source is the
empty string. A null doc_id is no smaller and no larger than another, so such a row
neither repeats a text nor is repeated, and has no label. Rows that repeat a doc_id are documents of
their own, and all have its label; of several labels of one doc_id the greatest
counts. Texts may be of any length; one at a time is hashed. An empty table has no
parts, so no rows. Columns that are not named are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import materialize, release
from tessera.llm.words import chunks, text_buffer, words_of

#: A: too few words, B: too few different ones, C: too many capitals, D: odd characters, E: the text of a smaller doc_id.
FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITALS_PERCENT = 2
ODD = b"#$%&*|"
_E, _GOOD, _TOXIC = 16, 32, 64
#: Parts whose counts a task holds before it sends them on.
HELD_PARTS = 4096

_ODD = np.isin(np.arange(256), np.frombuffer(ODD, np.uint8))
_CAPITAL = np.isin(np.arange(256), np.arange(ord("A"), ord("Z") + 1))
_BEGINS = np.arange(256) & 0xC0 != 0x80


def _per_text(mask: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """How many bytes of each text are set in the mask."""
    total = np.concatenate([[0], np.cumsum(mask)])
    return total[cuts[1:]] - total[cuts[:-1]]


def flags_of(column: pa.Array) -> tuple[np.ndarray, list[bytes]]:
    """For each text the filters A to D that it fails, as bits, and its digest."""
    data, offsets = text_buffer(column)
    out = np.zeros(len(offsets) - 1, np.uint8)
    for lo, hi in chunks(offsets):
        cuts = offsets[lo : hi + 1] - offsets[lo]
        piece = data[offsets[lo] : offsets[hi]]
        found = words_of(piece, cuts, lower=False)
        n = np.diff(found.first)
        distinct = np.array([len(np.unique(found.hash[a:b])) for a, b in zip(found.first[:-1], found.first[1:], strict=True)], np.int64)
        capitals, points, odd = (_per_text(m[piece], cuts) for m in (_CAPITAL, _BEGINS, _ODD))
        fails = (n < MIN_WORDS, 100 * distinct < MIN_DISTINCT_PERCENT * n, 100 * capitals > MAX_CAPITALS_PERCENT * points, odd > 0)
        out[lo:hi] = sum(f.astype(np.uint8) << i for i, f in enumerate(fails))
    whole = memoryview(data)
    return out, [hashlib.blake2b(whole[a:b], digest_size=16).digest() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def document_flags(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """part, doc_id, flags (bits of A to D) and the 128-bit digest of the text, h1 and h2."""
    rows = docs.select(F.coalesce(F.col(f"`{source}`"), F.lit("")).alias("part"), F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags, digests = flags_of(batch.column("text"))
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("doc_id"), pa.array(flags.astype(np.int16)), pa.array(halves[:, 0]), pa.array(halves[:, 1])], names=["part", "doc_id", "flags", "h1", "h2"])

    return rows.mapInArrow(run, "part string, doc_id long, flags short, h1 long, h2 long")


def subset_counts(codes: np.ndarray, parts: int, flags: np.ndarray) -> np.ndarray:
    """Survivors of each set of filters, [part, set, (all, good, toxic)], by AND-NOT and popcount of packed bitmaps."""
    sizes = np.bincount(codes, minlength=parts)
    widths = -(-sizes // 64)
    starts = np.concatenate([[0], np.cumsum(widths)])
    order = np.argsort(codes, kind="stable")
    place = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(64 * starts[:-1], sizes)
    laid = np.zeros(64 * starts[-1], np.uint8)
    laid[place] = flags[order] | 0x80
    bitmap = lambda bit: np.packbits(laid & bit != 0, bitorder="little").view(np.uint64)
    fails = [bitmap(1 << i) for i in range(len(FILTERS))]
    wanted = (bitmap(0x80), bitmap(_GOOD), bitmap(_TOXIC))
    gone = np.zeros((1 << len(FILTERS), len(wanted[0])), np.uint64)
    out = np.zeros((parts, len(gone), len(wanted)), np.int64)
    for s in range(len(gone)):
        if s:
            low = (s & -s).bit_length() - 1
            gone[s] = gone[s & (s - 1)] | fails[low]
        for j, w in enumerate(wanted):
            out[:, s, j] = np.add.reduceat(np.bitwise_count(w & ~gone[s]).astype(np.int64), starts[:-1])
    return out


def part_counts(flagged: DataFrame) -> DataFrame:
    """part and sets, an array of the (n, good, toxic) that survive each set of filters, for (part, flags) with the bits of E and of labels."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def out() -> pa.RecordBatch:
            names, counts = list(held), np.concatenate(list(held.values()))
            held.clear()
            sets = 1 << len(FILTERS)
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(names, object), sets), pa.string()), pa.array(np.tile(np.arange(sets, dtype=np.int32), len(names))), *[pa.array(counts[:, j]) for j in range(3)]], names=["part", "set", "n", "good", "toxic"])

        for batch in batches:
            coded = batch.column("part").dictionary_encode()
            names = coded.dictionary.to_pylist()
            if not names:
                continue
            counts = subset_counts(coded.indices.to_numpy(), len(names), batch.column("flags").to_numpy().astype(np.uint8))
            for name, c in zip(names, counts, strict=True):
                held[name] = held[name] + c if name in held else c
            if len(held) > HELD_PARTS:
                yield out()
        if held:
            yield out()

    each = flagged.mapInArrow(run, "part string, set int, n long, good long, toxic long").groupBy("part", "set").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
    return each.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("set", "n", "good", "toxic"))).alias("sets"))


def _lost(sets: str, before: Column, after: Column, what: str) -> Column:
    return F.get(sets, before)[what] - F.get(sets, after)[what]


def _shapley(i: int) -> Column:
    """What a filter removes, summed over all orders: each set before it stands for the orders that begin with that set."""
    bit, n = 1 << i, len(FILTERS)
    terms = [_lost("sets", F.lit(s), F.lit(s | bit), "n") * (factorial(s.bit_count()) * factorial(n - 1 - s.bit_count())) for s in range(1 << n) if not s & bit]
    return sum(terms[1:], terms[0])


def order_report(counts: DataFrame) -> DataFrame:
    """A row for each part, order and step, from the counts of part_counts()."""
    spark = counts.sparkSession
    bit = {c: 1 << i for i, c in enumerate(FILTERS)}
    steps = [("".join(o), k + 1, sum(bit[c] for c in o[:k]), FILTERS.index(o[k])) for o in permutations(FILTERS) for k in range(len(o))]
    every = F.broadcast(spark.createDataFrame(steps, "filter_order string, step int, before int, filter int"))  # 600 rows, always
    own = counts.withColumn("shapleys", F.array(*[_shapley(i) for i in range(len(FILTERS))]))
    own = own.select("part", "sets", "shapleys", F.explode(F.sequence(F.lit(0), F.lit((1 << len(FILTERS)) - 1))).alias("before")).join(every, "before")
    own = own.withColumn("bit", F.element_at(F.array(*[F.lit(b) for b in bit.values()]), F.col("filter") + 1))
    before, after, whole = F.col("before"), F.col("before") + F.col("bit"), F.lit((1 << len(FILTERS)) - 1)
    removed = _lost("sets", before, after, "n")
    return own.select(
        "part", "filter_order", "step",
        F.get("sets", after)["n"].alias("kept"),
        removed.alias("removed"),
        (_lost("sets", F.lit(0), F.col("bit"), "n") - removed).alias("redundant"),
        _lost("sets", whole - F.col("bit"), whole, "n").alias("unique_fails"),
        _lost("sets", before, after, "good").alias("good_lost"),
        _lost("sets", before, after, "toxic").alias("toxic_lost"),
        F.get("shapleys", F.col("filter")).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    """part, filter_order, step and the counts of that step, a row for every part, order of the five filters, and step.

    Joins are by the digest and by doc_id, with what texts occur more than once and
    what ids have a label written first: a key with very many documents is then a
    skewed key of one side only, which adaptive execution splits.
    """
    flags = materialize(document_flags(docs, doc_id, text, source), "audit-flags")
    repeated = flags.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("last > first").drop("last")
    repeated = materialize(repeated, "audit-repeated")
    marked = labels.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), (F.when(F.col(f"`{quality}`") == 1, _GOOD).otherwise(0)).alias("good"), F.when(F.col(f"`{toxic}`") == 1, _TOXIC).otherwise(0).alias("toxic"))
    marked = materialize(marked.filter("doc_id is not null and good + toxic > 0").groupBy("doc_id").agg((F.max("good") + F.max("toxic")).alias("label")), "audit-labels")
    found = flags.join(repeated, ["h1", "h2"], "left").join(marked, "doc_id", "left")
    bits = F.col("flags") + F.when(F.col("doc_id") > F.col("first"), _E).otherwise(0) + F.coalesce("label", F.lit(0))
    counts = materialize(part_counts(found.select("part", bits.cast("short").alias("flags"))), "audit-counts")
    release(flags, repeated, marked)
    return order_report(counts)
