"""Toxicity as an ordered grade, by cumulative-link regression on sparse text features.

The chance that a document's grade is at most j is the logistic function of
threshold j less a score; the score is one sum of word weights for all
thresholds. The expected severity is the sum over j of the chance to be above j.

Labels say toxic or not. Grades of toxic documents come from the labels' own
words: words are marked that stand out in documents labelled toxic, and the
toxic documents fall into as many equal parts as there are grades above 0 by how
many of their words are marked. The regression then learns the grades from the
presence of the words that tell the labels apart most.

Candidate words are chosen one after the other: the word that tells the labels
apart most, then the one that does so among the documents it is not in, and so
on. So a word that a few copies of one toxic document share has no place once
that document is explained.

It is fitted on at most FIT_ROWS labelled documents, those with the least hash
of their id; fitting is the only step that is bounded, and every document is
scored from its whole text. Words are lower-cased in A-Z, without the signs
around them.

Defined cases: a null or empty text has no words, so the model's severity for an
empty document; labels that are null or conflict count as toxic if any says so;
with labels of one kind only, or none, or where no word of LEAST_DOCS documents tells
them apart by three quarters of the greatest possible z score or by LEAST_Z, there is no
model and every severity is 0; of candidates that tell as much, the one of the smaller
hash is taken; repeated documents are rows of their own; a text of any length is scored
whole; an empty table of documents gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import words as W
from tessera.llm.shared import materialize

GRADES = 4
FIT_ROWS = 20_000
#: The z score of a candidate word among the fitted rows, the documents and the z score that a chosen word needs, and the part of the greatest possible z score that is enough.
CANDIDATE_Z, LEAST_DOCS, LEAST_Z, OF_GREATEST = 3.0, 5, 6.0, 0.75
RIDGE, STEPS, RATE = 1e-6, 1500, 0.05
_EDGE = np.zeros(256, dtype=bool)
_EDGE[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = True


def trimmed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, without ASCII signs on either side, and where each text's begin."""
    if len(data):
        data = np.where(_EDGE[data], np.uint8(0x20), data)
    w = W.words_of(data, offsets)
    return w.hash, w.first


def _counted(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, distinct word hashes, their counts) of each text."""
    data, offsets = W.text_buffer(batch.column(column))
    for lo, hi in W.chunks(offsets):
        hashes, first = trimmed_words(data, offsets[lo : hi + 1])
        for i in range(hi - lo):
            u, n = np.unique(hashes[first[i] : first[i + 1]], return_counts=True)
            yield lo + i, u, n


def sample(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """toxic, hashes and counts of the labelled documents that the model is fitted on."""
    marks = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text")  # at most ``rows`` pairs of numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_counted(batch, "text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic").cast(pa.int32()), pa.array([u.tobytes() for _, u, _ in found], pa.binary()), pa.array([n.astype(np.int32).tobytes() for _, _, n in found], pa.binary())], names=["doc_id", "toxic", "hashes", "counts"])

    return materialize(joined.mapInArrow(run, "doc_id long, toxic int, hashes binary, counts binary"), "toxicity-sample")


def needed(documents: int) -> tuple[float, float]:
    """The z scores of a candidate and of a chosen word. A word of all toxic and no other documents has the root of their number, so few documents ask for less."""
    most = OF_GREATEST * documents**0.5
    return min(CANDIDATE_Z, most / 2), min(LEAST_Z, most)


def features(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words that stand out in toxic documents, sorted, and their z scores; at most as many as a sample of FIT_ROWS documents has words of LEAST_DOCS."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [np.frombuffer(h.as_py(), np.uint64) for h in batch.column("hashes")]
            toxic = np.array(batch.column("toxic").to_pylist(), np.int64) > 0
            for kind in (True, False):
                some = [g for g, t in zip(got, toxic, strict=True) if t == kind]
                if some:
                    u, n = np.unique(np.concatenate(some), return_counts=True)
                    many = np.full(len(u), len(some) * 0, np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n if kind else many, pa.int64()), pa.array(many if kind else n, pa.int64())], names=["hash", "bad", "good"])

    totals = {bool(r["toxic"]): r["n"] for r in rows.groupBy((F.col("toxic") > 0).alias("toxic")).agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = totals.get(True, 0), totals.get(False, 0)
    if not bad or not good:
        return np.zeros(0, np.uint64), np.zeros(0)
    counts = rows.mapInArrow(run, "hash long, bad long, good long").groupBy("hash").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    rate = (F.col("bad") + F.col("good")) / F.lit(float(bad + good))
    z = (F.col("bad") / F.lit(float(bad)) - F.col("good") / F.lit(float(good))) / F.sqrt(F.greatest(rate * (1 - rate), F.lit(1e-12)) * F.lit(1 / bad + 1 / good))
    top = counts.filter(F.col("bad") + F.col("good") >= LEAST_DOCS).withColumn("z", z).filter(F.col("z") >= needed(bad + good)[0]).collect()
    hashes = np.array([r["hash"] for r in top], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], np.array([r["z"] for r in top])[order]


def places_in(sorted_hashes: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each hash stands in a sorted array, and whether it does."""
    if not len(sorted_hashes):
        return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
    at = np.minimum(np.searchsorted(sorted_hashes, hashes), len(sorted_hashes) - 1)
    return at, sorted_hashes[at] == hashes


def grades(toxic: np.ndarray, density: np.ndarray, levels: int = GRADES) -> np.ndarray:
    """0 where not toxic, else 1 up to levels - 1 by the rank of the density among toxic rows."""
    out = np.zeros(len(toxic), np.int64)
    bad = np.flatnonzero(toxic)
    if len(bad):
        rank = np.searchsorted(np.sort(density[bad]), density[bad], "left") / len(bad)
        out[bad] = 1 + np.minimum(levels - 2, (rank * (levels - 1)).astype(np.int64))
    return out


def select(rows: list[np.ndarray], toxic: np.ndarray, n_features: int) -> np.ndarray:
    """Candidates in the order in which each tells toxic from other documents best, among documents without those before it."""
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    left = np.ones(len(rows), bool)
    enough = needed(len(rows))[1]
    chosen: list[int] = []
    while True:
        bad, good = int((left & toxic).sum()), int((left & ~toxic).sum())
        if not bad or not good:
            break
        open_ = left[owner]
        a = np.bincount(flat[open_ & toxic[owner]], minlength=n_features)
        b = np.bincount(flat[open_ & ~toxic[owner]], minlength=n_features)
        rate = (a + b) / (bad + good)
        z = (a / bad - b / good) / np.sqrt(np.maximum(rate * (1 - rate), 1e-12) * (1 / bad + 1 / good))
        z[a + b < LEAST_DOCS] = 0
        best = int(np.argmax(z))
        if z[best] < enough:
            break
        chosen.append(best)
        left[owner[flat == best]] = False
    return np.array(sorted(chosen), np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(rows: list[np.ndarray], y: np.ndarray, n_features: int, levels: int = GRADES) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the features and the ordered thresholds, by gradient steps on the penalised likelihood.

    rows hold the features present in each document. The first threshold is free
    and the others add positive steps to it, so their order cannot break.
    """
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    share = np.array([(y <= j).mean() for j in range(levels - 1)]).clip(1e-3, 1 - 1e-3)
    theta = np.log(share / (1 - share))
    free = np.concatenate([theta[:1], np.log(np.maximum(np.diff(theta), 1e-2))])
    w = np.zeros(n_features)
    state = [np.zeros(n_features + levels - 1), np.zeros(n_features + levels - 1)]
    for step in range(1, STEPS + 1):
        theta = free[0] + np.concatenate([[0.0], np.cumsum(np.exp(free[1:]))])
        score = np.bincount(owner, w[flat], len(rows))
        upper = np.where(y < levels - 1, _sigmoid(theta[np.minimum(y, levels - 2)] - score), 1.0)
        lower = np.where(y > 0, _sigmoid(theta[np.maximum(y - 1, 0)] - score), 0.0)
        chance = np.maximum(upper - lower, 1e-12)
        du, dl = upper * (1 - upper) / chance, lower * (1 - lower) / chance
        g_score = (du - dl) / len(rows)
        g_theta = np.bincount(np.minimum(y, levels - 2), -du * (y < levels - 1), levels - 1) + np.bincount(np.maximum(y - 1, 0), dl * (y > 0), levels - 1)
        g_theta = g_theta / len(rows)
        g_free = np.concatenate([[g_theta.sum()], np.exp(free[1:]) * np.cumsum(g_theta[::-1])[::-1][1:]])
        g = np.concatenate([np.bincount(flat, g_score[owner], n_features) + RIDGE * w, g_free])
        state[0] = 0.9 * state[0] + 0.1 * g
        state[1] = 0.999 * state[1] + 0.001 * g * g
        move = RATE * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.999**step)) + 1e-8)
        w -= move[:n_features]
        free -= move[n_features:]
    return w, free[0] + np.concatenate([[0.0], np.cumsum(np.exp(free[1:]))])


def train(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature hashes, their weights, and the thresholds (none where the labels are of one kind)."""
    taken = sample(docs, labels, rows)
    nothing = np.zeros(0, np.uint64), np.zeros(0), np.zeros(0)
    hashes, _ = features(taken)
    if not len(hashes):
        return nothing
    shared = docs.sparkSession.sparkContext.broadcast(hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            present, often, total = [], [], []
            for h, n in zip(batch.column("hashes"), batch.column("counts"), strict=True):
                u, c = np.frombuffer(h.as_py(), np.uint64), np.frombuffer(n.as_py(), np.int32)
                at, hit = places_in(shared.value, u)
                order = np.argsort(at[hit])
                present.append(at[hit][order])
                often.append(c[hit][order].astype(np.int64))
                total.append(int(c.sum()))
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(present, lists), pa.array(often, lists), pa.array(total, pa.int64())], names=["doc_id", "toxic", "present", "often", "total"])

    # at most ``rows`` short lists reach the driver
    got = taken.mapInArrow(run, "doc_id long, toxic int, present array<long>, often array<long>, total long").orderBy("doc_id", "total").collect()
    toxic = np.array([r["toxic"] > 0 for r in got])
    present = [np.array(r["present"], np.int64) for r in got]
    chosen = select(present, toxic, len(hashes))
    if not len(chosen):
        return nothing
    place = np.full(len(hashes), -1, np.int64)
    place[chosen] = np.arange(len(chosen))
    density = np.array([sum(n for f, n in zip(r["present"], r["often"], strict=True) if place[f] >= 0) / max(1, r["total"]) for r in got])
    kept = [place[p][place[p] >= 0] for p in present]
    w, theta = fit(kept, grades(toxic, density), len(chosen))
    return hashes[chosen], w, theta


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, severity, grade and toxic of every document; the grade is how many thresholds it is more likely above than not."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, w, theta = shared.value
        for batch in batches:
            data, offsets = W.text_buffer(batch.column("text"))
            total = np.zeros(batch.num_rows)
            for lo, hi in W.chunks(offsets):
                got, first = trimmed_words(data, offsets[lo : hi + 1])
                at, hit = places_in(hashes, got)
                owner = np.searchsorted(first, np.flatnonzero(hit), "right") - 1
                both = np.unique(owner * max(1, len(hashes)) + at[hit])
                if len(both):
                    total[lo:hi] += np.bincount(both // len(hashes), w[both % len(hashes)], hi - lo)
            above = _sigmoid(total[:, None] - theta[None, :])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.round(above.sum(axis=1), 6)), pa.array((above >= 0.5).sum(axis=1).astype(np.int32)), pa.array((above >= 0.5).any(axis=1))], names=["doc_id", "severity", "grade", "toxic"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, severity double, grade int, toxic boolean")


def document_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on the labelled documents, then score all."""
    return score(docs, train(docs, labels))
