"""Passages that repeat across documents, by sparse suffix arrays.

Of a document's suffixes, as sequences of lower-cased words, only those are
retained that start at a minimiser: a place whose run of SEED words has the
least hash among the runs of some window. Two documents that share a passage of
``least`` words retain suffixes at the same places of it, so the passage is found
among suffixes that begin with the same seed. Suffixes are sorted by their seed,
in buckets by its hash, and neighbours with one seed from different texts are
matches. A match is extended left and right: every passage of exactly ``least``
words that holds a matched seed is taken, these are sorted by their hash, and
neighbours of different texts repeat. Overlapping passages of a document are one
span, which is thus as long as the repetition.

A seed or passage that a task meets in many texts is settled there; only its
first and last text go on to be sorted, so what all documents share costs a
bucket two rows for each batch and not one for each document.

Documents of one word sequence are a class, of which the first document is
sorted; if a class has more documents, all of its words repeat. Hashes have 64
bits.

Defined cases: a null or empty text, or one of fewer words than ``least``, has no
spans; repetition within one document alone does not count; documents without an
id take part as copies of their class only; repeated ids are rows of their own, and
a passage that different texts under one id share is reported for both; empty tables give no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import words as W
from tessera.llm.shared import materialize

LEAST, SEED = 50, 20
#: Rows that are sorted together, and in how many texts of a task's batch a hash is settled there.
BATCH_ROWS, LOCAL = 1 << 20, 6
_ROW = np.dtype([("hash", "<u8"), ("doc", "<i8"), ("cls", "<i8"), ("at", "<i4"), ("later", "?")])


def sliding(x: np.ndarray, width: int, pick) -> np.ndarray:  # noqa: ANN001
    """pick (np.minimum or np.maximum) over each run of ``width`` entries."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = pick(x[: len(x) - step], x[step:])
        done += step
    return x


def minimisers(seeds: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the least hash of some window of ``width`` places; ties are all taken."""
    if len(seeds) < width:
        return np.zeros(0, np.int64)
    low = sliding(seeds, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    return np.flatnonzero(sliding(np.concatenate([edge, low, edge]), width, np.maximum) == seeds)


def _sequences(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, word hashes) of each text."""
    data, offsets = W.text_buffer(column)
    for lo, hi in W.chunks(offsets):
        w = W.words_of(data, offsets[lo : hi + 1])
        for i in range(hi - lo):
            yield lo + i, w.hash[w.first[i] : w.first[i + 1]]


def _rows(hashes: np.ndarray, doc: int, cls: int, at: np.ndarray | int) -> np.ndarray:
    row = np.zeros(len(hashes), _ROW)
    row["hash"], row["doc"], row["cls"], row["at"] = hashes, doc, cls, at
    return row


def _other(rows: np.ndarray, i: np.ndarray | slice, j: np.ndarray | slice) -> np.ndarray:
    """Whether rows i and rows j are of different texts."""
    return (rows["cls"][i] != rows["cls"][j]) | (rows["doc"][i] != rows["doc"][j])


def _sorted(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows by hash, doc and class, where each run of one hash begins, and the run of each row."""
    rows = rows[np.lexsort((rows["cls"], rows["doc"], rows["hash"]))]
    begins = np.ones(len(rows), bool)
    begins[1:] = rows["hash"][1:] != rows["hash"][:-1]
    return rows, np.flatnonzero(begins), np.cumsum(begins) - 1


def deal(held: list[np.ndarray], buckets: int, own: int) -> Iterator[tuple[int, bytes]]:
    """(bucket, rows) of rows yet to be sorted, and (own, rows) of those that are settled here."""
    rows = np.concatenate(held) if held else np.zeros(0, _ROW)
    if not len(rows):
        return
    rows, begins, run = _sorted(rows)
    ends = np.append(begins[1:], len(rows)) - 1
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (run[1:] != run[:-1]) | _other(rows, slice(1, None), slice(None, -1))
    texts = np.bincount(run[fresh], minlength=len(begins))
    busy = texts[run] >= LOCAL
    # the first text's rows and one of the last's go on, the others are settled: an earlier text has them
    inner = busy & _other(rows, slice(None), begins[run])
    settled = rows[inner]
    settled["later"] = True
    if len(settled):
        yield own, settled.tobytes()
    onward = ~inner
    onward[ends[texts >= LOCAL]] = True
    rows = rows[onward]
    to = (W.mix(rows["hash"]) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    rows, to = rows[order], to[order]
    cuts = np.flatnonzero(np.diff(to)) + 1
    for b, part in zip(to[np.concatenate([[0], cuts])], np.split(rows, cuts), strict=True):
        yield int(b), part.tobytes()


def repeating(table: pa.Table) -> np.ndarray:
    """Of a bucket, the rows whose hash a neighbour of another text has; later: a smaller text has it."""
    rows = np.concatenate([np.frombuffer(x.as_py(), _ROW) for x in table.column("rows")])
    if table.column("bucket")[0].as_py() < 0:
        return rows
    rows, begins, run = _sorted(rows)
    ends = np.append(begins[1:], len(rows)) - 1
    several = _other(rows, begins, ends)[run]
    rows["later"] |= _other(rows, slice(None), begins[run])
    return rows[several]


def _dealt(source: DataFrame, rows_of, rows: int) -> DataFrame:  # noqa: ANN001
    """bucket, rows of the table whose batches rows_of turns into rows of _ROW."""
    buckets = max(source.sparkSession.sparkContext.defaultParallelism, int(rows // BATCH_ROWS) + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        own = -1 - TaskContext.get().partitionId()

        def out() -> pa.RecordBatch:
            got = list(deal(held, buckets, own))
            return pa.RecordBatch.from_arrays([pa.array([b for b, _ in got], pa.int64()), pa.array([x for _, x in got], pa.binary())], names=["bucket", "rows"])

        for batch in batches:
            for row in rows_of(batch):
                held.append(row)
                size += len(row)
                if size >= BATCH_ROWS:
                    yield out()
                    held, size = [], 0
        yield out()

    return source.mapInArrow(run, "bucket long, rows binary")


def seeds_of(docs: DataFrame, least: int = LEAST, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, cls and the seeds at the minimisers of the first document of each class in its task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            ids = batch.column("doc_id")
            n, cls, seeds = [], [], []
            for i, h in _sequences(batch.column("text")):
                n.append(len(h))
                if len(h) < least:
                    cls.append(None)
                    seeds.append(None)
                    continue
                c = int(W.whole_hash(h).view(np.int64)[0])
                cls.append(c)
                if c in seen or not ids[i].is_valid:
                    seeds.append(None)
                    continue
                seen.add(c)
                grams = W.gram_hashes(h, seed)
                seeds.append(np.unique(grams[minimisers(grams, least - seed + 1)]).tobytes())
            if len(seen) > 1_000_000:
                seen.clear()
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(cls, pa.int64()), pa.array(seeds, pa.binary())], names=["doc_id", "n_words", "cls", "seeds"])

    return materialize(docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, cls long, seeds binary"), "suffix-seeds")


def matched_seeds(sets: DataFrame) -> DataFrame:
    """cls and the packed seeds that a text of another class has."""
    rows = sets.agg(F.sum(F.octet_length("seeds") / 8)).first()[0] or 0

    def rows_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for c, s in zip(batch.column("cls").to_pylist(), batch.column("seeds"), strict=True):
            yield _rows(np.frombuffer(s.as_py(), np.uint64), 0, c, 0)

    def meet(table: pa.Table) -> pa.Table:
        return _by_class(repeating(table), "hash", np.uint64, "cls", "seeds")

    dealt = _dealt(sets.filter("seeds is not null").select("cls", "seeds"), rows_of, rows)
    return materialize(dealt.groupBy("bucket").applyInArrow(meet, "cls long, seeds binary"), "suffix-matches")


def _by_class(rows: np.ndarray, field: str, kind, key: str, name: str, extra: bool = False) -> pa.Table:  # noqa: ANN001
    """A row for each class with its packed values."""
    rows = rows[np.argsort(rows["cls"], kind="stable")]
    cuts = np.flatnonzero(np.diff(rows["cls"])) + 1
    parts = np.split(rows, cuts) if len(rows) else []
    docs = [int(p["cls"][0]) for p in parts]
    values = [np.ascontiguousarray(p[field]).astype(kind).tobytes() for p in parts]
    cols = {key: pa.array(docs, pa.int64()), name: pa.array(values, pa.binary())}
    if extra:
        cols["later"] = pa.array([np.ascontiguousarray(p["later"]).tobytes() for p in parts], pa.binary())
    return pa.table(cols)


def spans_of(starts: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Unions of the passages of ``least`` words that begin at sorted starts."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > least) + 1
    return [(int(p[0]), int(p[-1]) + least) for p in np.split(starts, cut)]


def repeated_passages(docs: DataFrame, sets: DataFrame, least: int = LEAST, seed: int = SEED) -> DataFrame:
    """cls, spans and later: the repeated words of a class's text, and those that an earlier text has (of one id, the one of the lesser class)."""
    found = matched_seeds(sets)
    classes = sets.filter("cls is not null and doc_id is not null").groupBy("cls").agg(F.min("doc_id").alias("first_id"))
    wanted = found.groupBy("cls").agg(F.collect_list("seeds").alias("seeds")).join(classes, "cls")
    texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id") == F.col("first_id")).select("first_id", "cls", "text", "seeds")

    def passages(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        own, cls = batch.column("first_id").to_pylist(), batch.column("cls").to_pylist()
        for i, h in _sequences(batch.column("text")):
            if len(h) < least or int(W.whole_hash(h).view(np.int64)[0]) != cls[i]:
                continue  # another text of the same id
            seeds = np.unique(np.concatenate([np.frombuffer(x, np.uint64) for x in batch.column("seeds")[i].as_py()]))
            grams = W.gram_hashes(h, seed)
            at = np.flatnonzero(np.isin(grams, seeds))
            # a passage may begin up to least - seed words before a seed that it holds
            ahead = np.zeros(len(grams) + 1, np.int64)
            np.add.at(ahead, np.maximum(at - (least - seed), 0), 1)
            np.add.at(ahead, at + 1, -1)
            starts = np.flatnonzero(np.cumsum(ahead)[: len(h) - least + 1] > 0)
            yield _rows(W.gram_hashes(h, least)[starts], own[i], cls[i], starts)

    words = sets.agg(F.sum("n_words")).first()[0] or 0
    dealt = _dealt(texts, passages, words // 8)

    def meet(table: pa.Table) -> pa.Table:
        return _by_class(repeating(table), "at", np.int32, "cls", "starts", extra=True)

    pieces = dealt.groupBy("bucket").applyInArrow(meet, "cls long, starts binary, later binary")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            every, later = [], []
            for s, t in zip(batch.column("starts"), batch.column("later"), strict=True):
                starts = np.concatenate([np.frombuffer(x, np.int32) for x in s.as_py()])
                flags = np.concatenate([np.frombuffer(x, bool) for x in t.as_py()])
                tell = lambda x: [{"start": a, "end": b} for a, b in spans_of(np.unique(x), least)]
                every.append(tell(starts))
                later.append(tell(starts[flags]))
            yield pa.RecordBatch.from_arrays([batch.column("cls"), pa.array(every, kind), pa.array(later, kind)], names=["cls", "spans", "later"])

    joined = pieces.groupBy("cls").agg(F.collect_list("starts").alias("starts"), F.collect_list("later").alias("later"))
    return joined.mapInArrow(merge, "cls long, spans array<struct<start:int,end:int>>, later array<struct<start:int,end:int>>")


def document_spans(docs: DataFrame, least: int = LEAST, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, cls, spans and later of every document; later words are repeated from an earlier document."""
    sets = seeds_of(docs, least, seed)
    spans = materialize(repeated_passages(docs, sets, least, seed), "suffix-spans")
    classes = sets.filter("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    known = classes.join(spans, "cls", "left")
    all_words = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end")))
    none = F.expr("cast(array() as array<struct<start:int,end:int>>)")
    copied = F.coalesce(F.col("copies") > 1, F.lit(False))
    is_first = F.col("doc_id").eqNullSafe(F.col("first_id"))
    joined = sets.drop("seeds").join(known, "cls", "left")
    return joined.select(
        "doc_id", "n_words", "cls",
        F.when(copied, all_words).otherwise(F.coalesce("spans", none)).alias("spans"),
        F.when(copied & ~is_first, all_words).otherwise(F.coalesce("later", none)).alias("later"),
    )


def document_repeats(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, n_repeated_words, n_later_words and spans (start:end, in words) of every document."""
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    shown = F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["start"], x["end"])), ",")
    return document_spans(docs, least).select("doc_id", "n_words", total("spans").alias("n_repeated_words"), total("later").alias("n_later_words"), shown.alias("spans"))
