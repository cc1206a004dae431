"""Ranked lexical search by inverted treaps.

Items are a query set, taken in blocks of bounded size. One pass over the texts
writes, for each document, the terms it shares with the block and their counts, and
for each task how many documents have each of those terms; sums of these give the
weights. A second pass builds the index, a shard of documents at a time: for every
term a treap over its documents, a search tree by doc_id and a heap by impact (what
the term adds to the document's score). All treaps of an item are walked together. A
step holds, for a range of documents, the top of each treap's subtree in that
range; the sum of these impacts bounds every score in the range, and the range
is left where that cannot enter the item's best. Else the document of the greatest
impact is scored, and the treaps are split at it into the ranges on either side.
The ranges of all items of a shard are walked at once, level by level, in numpy.

The best of an item so far go from shard to shard of a task, so later shards are cut
earlier. Each task gives up to k rows an item, which are ranked first in salted
groups, then whole.

Defined cases: a null text has no terms, and a document without terms is in no
result and not counted; a null item has none either. Rows that repeat a doc_id are
documents of their own, as are rows that repeat an item_id; a null doc_id (and the
greatest long, which stands for it) comes last among equal scores. Texts and items may be of any length:
one text at a time is cut, and a block or a shard has one item or document at least.
Empty tables give an empty result. Columns that are not named are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.decontaminate import blocks
from tessera.llm.shared import materialize, release
from tessera.llm.words import NOT_ALNUM, chunks, text_buffer, words_of

BEST = 20
#: Postings of a shard, and those that a walk's items may touch together.
SHARD_POSTINGS = 1 << 20
#: Groups that the rows of one item are dealt to before they meet.
SALT = 32
_N, _L = -1, -2
_NO_ID = np.iinfo(np.int64).max


class Items(NamedTuple):
    """A block of items: the hashes of their terms, sorted, and for each item the terms (places in hashes) and how often they come."""

    ids: list
    hashes: np.ndarray
    first: np.ndarray
    term: np.ndarray
    times: np.ndarray


def _terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of all texts, and where each text's begin."""
    data, offsets = text_buffer(texts)
    found = words_of(data, offsets, gaps=NOT_ALNUM)
    return found.hash, found.first


def items_of(block: list[tuple]) -> Items:
    hashes, first = _terms(pa.array([t for _, t in block], pa.string()))
    known, place = np.unique(hashes, return_inverse=True)
    own = np.repeat(np.arange(len(block)), np.diff(first))
    pairs, times = np.unique(own * max(len(known), 1) + place, return_counts=True)
    item, term = np.divmod(pairs, max(len(known), 1))
    return Items([i for i, _ in block], known, np.searchsorted(item, np.arange(len(block) + 1)), term, times)


# -- postings ------------------------------------------------------------------------
def _postings(docs: DataFrame, hashes: np.ndarray) -> DataFrame:
    """id, n, terms, counts of each document, and as rows without terms the sums of the task: documents of each term, and N and L under ids of their own."""
    shared = docs.sparkSession.sparkContext.broadcast(hashes)
    names = ["id", "n", "terms", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        df, total, some = np.zeros(len(known), np.int64), 0, 0
        packed = lambda values, cuts: pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((4 * cuts).astype(np.int32)), pa.py_buffer(values.astype(np.int32))])
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for lo, hi in chunks(offsets):
                found = words_of(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], gaps=NOT_ALNUM)
                n = np.diff(found.first)
                total, some = total + int(n.sum()), some + int(np.count_nonzero(n))
                if not len(known):
                    continue
                place = np.minimum(np.searchsorted(known, found.hash), len(known) - 1)
                hit = known[place] == found.hash
                keys, counts = np.unique(np.repeat(np.arange(hi - lo), n)[hit] * len(known) + place[hit], return_counts=True)
                doc, term = np.divmod(keys, len(known))
                df += np.bincount(term, minlength=len(known))
                cuts = np.searchsorted(doc, np.arange(hi - lo + 1))
                out = pa.RecordBatch.from_arrays([batch.column("id").slice(lo, hi - lo), pa.array(n), packed(term, cuts), packed(counts, cuts)], names=names)
                yield out.filter(pa.array(np.diff(cuts) > 0))
        sums = np.flatnonzero(df)
        ids, n = np.concatenate([sums, [_N, _L]]), np.concatenate([df[sums], [some, total]])
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n), pa.nulls(len(ids), pa.binary()), pa.nulls(len(ids), pa.binary())], names=names)

    return docs.mapInArrow(run, "id long, n long, terms binary, counts binary")


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


# -- treaps --------------------------------------------------------------------------
class Treaps(NamedTuple):
    """Treaps of all terms of a shard in one set of arrays, ordered by (term, document); root[t] is the top of term t's, -1 where it has none."""

    docs: int
    key: np.ndarray
    doc: np.ndarray
    impact: np.ndarray
    left: np.ndarray
    right: np.ndarray
    root: np.ndarray


def treaps(term: np.ndarray, doc: np.ndarray, impact: np.ndarray, terms: int, docs: int) -> Treaps:
    """Treaps from postings sorted by (term, document); of equal impacts the smaller document is above.

    A node hangs below the lesser of the nearest greater impacts on its two sides,
    which all nodes find together by following those of the nodes they pass.
    """
    n = len(term)
    first = np.searchsorted(term, np.arange(terms + 1))
    begin, end = first[term], first[term + 1]
    before, after = np.arange(n) - 1, np.arange(n) + 1
    at = np.arange(n)
    while len(at := at[(before[at] >= begin[at]) & (impact[before[at]] < impact[at])]):
        before[at] = before[before[at]]
    at = np.arange(n)
    while len(at := at[(after[at] < end[at]) & (impact[np.minimum(after[at], n - 1)] <= impact[at])]):
        after[at] = after[after[at]]
    has_before, has_after = before >= begin, after < end
    hangs_left = has_after & (~has_before | (impact[np.minimum(after, n - 1)] <= impact[np.maximum(before, 0)]))
    hangs_right = has_before & ~hangs_left
    left, right, root = np.full(n, -1), np.full(n, -1), np.full(terms, -1)
    left[after[hangs_left]] = np.flatnonzero(hangs_left)
    right[before[hangs_right]] = np.flatnonzero(hangs_right)
    tops = np.flatnonzero(~has_before & ~has_after)
    root[term[tops]] = tops
    return Treaps(docs, term * docs + doc, doc, impact, left, right, root)


class Best:
    """The best (score, doc_id) of each item, equal scores by doc_id."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.item, self.score, self.doc = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.zeros(items, np.int64)  # the score that the next one must reach

    def offer(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        enters = (score > 0) & (score >= self.least[item])
        if not enters.any():
            return
        item, score, doc = (np.concatenate([a, b[enters]]) for a, b in ((self.item, item), (self.score, score), (self.doc, doc)))
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        self.item, self.score, self.doc = (x[rank < self.k] for x in (item, score, doc))
        last = rank == self.k - 1
        self.least[item[last]] = score[last]


def walk(index: Treaps, ids: np.ndarray, items: Items, chosen: np.ndarray, best: Best) -> int:
    """Offer best all documents of a shard that can enter the chosen items' best; the number of documents that were scored.

    Cursors are (state, term): a state is an item and a range of documents, a cursor
    the top of the term's treap in that range. Those of a state are next to each other.
    """
    pair = np.concatenate([np.arange(items.first[i], items.first[i + 1]) for i in chosen]) if len(chosen) else np.zeros(0, np.int64)
    owner = np.repeat(chosen, items.first[chosen + 1] - items.first[chosen])
    term, times, node = items.term[pair], items.times[pair], index.root[items.term[pair]]
    state, scored = owner, 0
    begin, end = np.zeros(len(owner), np.int64), np.full(len(owner), index.docs)
    last = max(len(index.key) - 1, 0)
    while True:
        held = node >= 0
        state, term, times, node = state[held], term[held], times[held], node[held]
        owner, begin, end = owner[held], begin[held], end[held]
        if not len(node):
            return scored
        starts = np.flatnonzero(np.concatenate([[True], state[1:] != state[:-1]]))
        sizes = np.diff(np.append(starts, len(state)))
        gain = times * index.impact[node]
        item = owner[starts]
        bound = np.add.reduceat(gain, starts)
        open_ = bound >= np.maximum(best.least[item], 1)
        # the document to split at: that of the greatest gain
        top = np.maximum.reduceat(gain, starts)
        place = np.where(gain == np.repeat(top, sizes), np.arange(len(gain)), len(gain))
        pivot = index.doc[node[np.minimum.reduceat(place, starts)]]
        mine = np.repeat(open_, sizes)
        if not mine.any():
            return scored
        pivot_of = np.repeat(pivot, sizes)[mine]
        state = np.repeat(np.arange(len(starts)), sizes)[mine]
        term, times, node, owner, begin, end = (x[mine] for x in (term, times, node, owner, begin, end))
        key = term * index.docs + pivot_of
        found = np.minimum(np.searchsorted(index.key, key), last)
        got = np.where(index.key[found] == key, times * index.impact[found], 0)
        kept = sizes[open_]
        begins = np.cumsum(kept) - kept
        best.offer(item[open_], np.add.reduceat(got, begins), ids[pivot[open_]])
        scored += len(begins)
        twice = lambda x: np.concatenate([x, x])
        node, begin, end = twice(node), np.concatenate([begin, pivot_of + 1]), np.concatenate([pivot_of, end])
        # down each treap to the first node in the range
        at = np.arange(len(node))
        while len(at):
            doc = index.doc[node[at]]
            low, high = doc < begin[at], doc >= end[at]
            out = low | high
            at = at[out]
            node[at] = np.where(low[out], index.right[node[at]], index.left[node[at]])
            at = at[node[at] >= 0]
        both = np.argsort(np.concatenate([2 * state, 2 * state + 1]), kind="stable")
        state = np.concatenate([2 * state, 2 * state + 1])[both]
        term, times, owner = (twice(x)[both] for x in (term, times, owner))
        node, begin, end = node[both], begin[both], end[both]


def _shards(batches: Iterator[pa.RecordBatch], postings: int) -> Iterator[pa.Table]:
    """Rows together of up to so many postings, or of one document."""
    held, size = [], 0
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column("terms")).to_numpy() // 4)
        lo = 0
        while lo < batch.num_rows:
            before = int(ends[lo - 1]) if lo else 0
            hi = max(int(np.searchsorted(ends, before + postings - size, "right")), lo + (not held))
            if hi > lo:
                held.append(batch.slice(lo, hi - lo))
                size += int(ends[hi - 1]) - before
            if hi < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            lo = hi
    if held:
        yield pa.Table.from_batches(held)


def shard_index(rows: pa.Table, weight: np.ndarray, n_docs: int, n_terms: int) -> tuple[Treaps, np.ndarray]:
    """The treaps of a shard's documents, and their ids in order."""
    ids = rows.column("id").fill_null(_NO_ID).to_numpy()
    order = np.argsort(ids, kind="stable")
    n = rows.column("n").to_numpy()
    flat = lambda c: np.frombuffer(b"".join(rows.column(c).to_pylist()), np.int32).astype(np.int64)
    sizes = pc.binary_length(rows.column("terms")).to_numpy() // 4
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    doc, term, tf = np.repeat(place, sizes), flat("terms"), flat("counts")
    m = np.repeat(100 - 25 + (25 * n * n_docs) // n_terms, sizes)
    impact = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
    by = np.lexsort((doc, term))
    by = by[impact[by] > 0]
    return treaps(term[by], doc[by], impact[by], len(weight), len(ids)), ids[order]


def _search(table: DataFrame, items: Items, weight: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """item, doc_id, score: the best of each task."""
    shared = table.sparkSession.sparkContext.broadcast((items, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight = shared.value
        best = Best(len(items.ids), k)
        for rows in _shards(batches, SHARD_POSTINGS):
            index, ids = shard_index(rows, weight, n_docs, n_terms)
            touched = np.bincount(index.key // max(index.docs, 1), minlength=len(weight))[items.term]
            upto = np.concatenate([[0], np.cumsum(touched)])[items.first]
            group = upto[1:] // SHARD_POSTINGS
            for chosen in np.split(np.arange(len(items.ids)), np.flatnonzero(np.diff(group)) + 1):
                walk(index, ids, items, chosen, best)
        missing = best.doc == _NO_ID
        yield pa.RecordBatch.from_arrays([pa.array(best.item), pa.array(best.doc, mask=missing), pa.array(best.score)], names=["item", "doc_id", "score"])

    return table.mapInArrow(run, "item long, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", k: int = BEST) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item with a score above 0, equal scores by doc_id."""
    spark = docs.sparkSession
    source = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    kind = items.schema[item_id].dataType
    out = None
    for block in blocks(items, item_id, item_text):
        asked = items_of(block)
        rows = materialize(_postings(source, asked.hashes), "search-postings")
        sums = dict(rows.filter("terms is null").groupBy("id").agg(F.sum("n")).collect())  # at most one row for each term of the block
        n_docs, n_terms = sums.get(_N, 0) or 0, sums.get(_L, 0) or 0
        weight = weights(np.array([sums.get(t, 0) for t in range(len(asked.hashes))], np.int64), n_docs)
        near = materialize(_search(rows.filter("terms is not null"), asked, weight, n_docs, max(n_terms, 1), k), "search-best")
        release(rows)
        order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        first = near.withColumn("__salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALT)))
        first = first.withColumn("rank", F.row_number().over(Window.partitionBy("item", "__salt").orderBy(*order))).filter(F.col("rank") <= k)
        last = first.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)
        ids = spark.createDataFrame(list(enumerate(asked.ids)), f"item long, item_id {kind.simpleString()}")
        part = last.join(F.broadcast(ids), "item").select(F.col("item_id").alias(item_id), "rank", "doc_id", "score")  # one row for each item of a block
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], f"`{item_id}` {kind.simpleString()}, rank int, doc_id long, score long")
