"""The filter audit, the ranked search and SimHash components against plain-Python versions, on odd and on generated documents."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_operators import SCHEMA, made_docs, sentence

from tessera.llm import filter_audit, search, simhash

DOCS = [*made_docs(), *[(800 + i, f"Copied ONE {i % 2}", None, ["", None, "s0"][i % 3], 0) for i in range(6)], (None, "Copied ONE 0", "en", "s1", 0), (4, "repeated id", "en", "s1", 0), (4, "repeated id", "en", "s1", 0), (900, "many $ words " * 90, "en", "rare", 0)]
CLASH = ("part", "flags", "h1", "set", "fp", "first", "root", "key", "id", "terms", "rank", "score", "node")


def clashing(df):
    """With columns whose names the operators use themselves."""
    return df.withColumns({c: F.lit("x") for c in CLASH})


@pytest.fixture(scope="module")
def frame(spark):
    return clashing(spark.createDataFrame(DOCS, SCHEMA)).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# -- filter audit ------------------------------------------------------------------
LABELS = [*[(i, i % 2, i % 3 % 2) for i in range(0, 60, 2)], (4, 1, None), (4, 0, 1), (None, 1, 1), (5000, 1, 1), (801, None, 1)]


def audited(df) -> dict:
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")) for r in df.collect()}


@pytest.mark.parametrize("parts", [1, 5])
def test_audit(spark, frame, parts):
    labels = clashing(spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int"))
    got = audited(filter_audit.audit(frame.repartition(parts), labels))
    want = brute.audit(DOCS, LABELS)
    assert got == want and len(got) == 600 * len({x[3] or "" for x in DOCS})
    assert sum(v[1] for (p, o, s), v in want.items() if o == "EDCBA" and s == 1) >= 15  # copies


def test_audit_of_nothing(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(empty, labels).count() == 0
    one = spark.createDataFrame([(None, None, None, None, None)], SCHEMA)
    assert audited(filter_audit.audit(one, labels)) == brute.audit([(None, None, None, None)], [])


def test_audit_sends_counts_on(spark, monkeypatch):
    """Many parts in a task: their counts leave it in several batches."""
    monkeypatch.setattr(filter_audit, "HELD_PARTS", 3)
    flags = spark.range(5000).select((F.col("id") % 700).cast("string").alias("part"), (F.col("id") % 128).cast("short").alias("flags")).repartition(3)
    got = {r["part"]: r["sets"] for r in filter_audit.part_counts(flags).collect()}
    rows = [(str(i % 700), i % 128) for i in range(5000)]
    for part in ("0", "13", "699"):
        mine = [f for p, f in rows if p == part]
        for x in got[part]:
            left = [f for f in mine if not f & x["set"] & 31]
            assert (x["n"], x["good"], x["toxic"]) == (len(left), sum(f & 32 > 0 for f in left), sum(f & 64 > 0 for f in left))


# -- ranked search -------------------------------------------------------------------
def items_for(seed: int) -> list[tuple]:
    r = random.Random(seed)
    some = [(i, sentence(r, r.randrange(1, 40))) for i in range(15)]
    return [*some, (20, None), (21, ""), (22, "nothing-like_this zzz"), (23, "the THE the"), (24, "ünï omega"), (25, " ".join(sentence(r, 60) for _ in range(20)))]


def found(df) -> set:
    rows = df.collect()
    out = {(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("shard", [1, 200, 1 << 20])
def test_ranked_search(spark, frame, monkeypatch, shard):
    monkeypatch.setattr(search, "SHARD_POSTINGS", shard)
    items = items_for(shard)
    got = found(search.ranked(frame, clashing(spark.createDataFrame(items, "item_id long, text string"))))
    assert got == brute.ranked(DOCS, items) and len({x[0] for x in got}) >= 17


def test_ranked_search_in_blocks(spark, frame, monkeypatch):
    from tessera.llm import decontaminate

    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 300)
    items = items_for(3)
    assert found(search.ranked(frame, spark.createDataFrame(items, "item_id long, text string"))) == brute.ranked(DOCS, items)


def test_ranked_search_of_nothing(spark, frame, empty):
    items = spark.createDataFrame([(1, "alpha"), (2, None)], "item_id long, text string")
    assert search.ranked(empty, items).count() == 0 and search.ranked(frame, items.limit(0)).count() == 0
    assert search.ranked(frame.limit(0), items.filter("item_id = 2")).count() == 0


def test_ranked_search_of_repeated_items_and_one_long_text(spark):
    docs = [(1, "alpha beta " * 300_000), (2, "beta"), (None, "beta"), (3, "beta")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = search.ranked(df, spark.createDataFrame([(7, "beta alpha"), (7, "beta alpha")], "item_id long, text string"), k=3).collect()
    want = sorted((r, d, s) for _, r, d, s in brute.ranked(docs, [(7, "beta alpha")], 3))
    assert sorted((r["rank"], r["doc_id"], r["score"]) for r in rows) == sorted(want * 2)


def test_walk_leaves_what_cannot_enter():
    """A treap's ranges are cut once the best are known: few of many documents are scored, and the best are those of a full scan."""
    r = np.random.default_rng(5)
    docs, terms = 20_000, 6
    held = np.unique(r.integers(0, docs * terms, 60_000))
    term, doc = np.divmod(held, docs)
    impact = (r.pareto(1.5, len(held)) * 1000).astype(np.int64) + 1
    index = search.treaps(term, doc, impact, terms, docs)
    for t in range(terms):  # in order by document, and no child above its parent
        own = np.flatnonzero(term == t)
        assert index.root[t] in own and impact[index.root[t]] == impact[own].max()
    for child in (index.left, index.right):
        has = np.flatnonzero(child >= 0)
        assert (impact[child[has]] <= impact[has]).all() and (term[child[has]] == term[has]).all()
    assert (doc[index.left[index.left >= 0]] < doc[np.flatnonzero(index.left >= 0)]).all() and (doc[index.right[index.right >= 0]] > doc[np.flatnonzero(index.right >= 0)]).all()
    items = search.Items([1, 2], np.zeros(terms, np.uint64), np.array([0, 4, 6]), np.array([0, 1, 2, 3, 4, 5]), np.array([1, 2, 1, 1, 1, 3]))
    best = search.Best(2, 20)
    scored = search.walk(index, np.arange(docs), items, np.arange(2), best)
    assert scored < docs
    for i, weights in ((0, {0: 1, 1: 2, 2: 1, 3: 1}), (1, {4: 1, 5: 3})):
        total = np.zeros(docs, np.int64)
        for t, w in weights.items():
            np.add.at(total, doc[term == t], w * impact[term == t])
        want = sorted(zip(-total, range(docs), strict=True))[:20]
        mine = best.item == i
        assert list(zip((-best.score[mine]).tolist(), best.doc[mine].tolist(), strict=True)) == [(int(a), b) for a, b in want]


# -- SimHash ---------------------------------------------------------------------------
def compared(df) -> list:
    return sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in df.collect()), key=str)


def test_simhash_components(frame, empty):
    got = compared(simhash.document_components(frame))
    assert got == sorted(brute.simhash_components(DOCS), key=str) and sum(a != c for a, _, c in got) >= 10
    assert simhash.document_components(empty).count() == 0


def test_simhash_of_missing_ids_and_one_long_text(spark):
    docs = [(None, None), (None, " "), (3, "x y"), (None, "lone words here and there"), (9, sentence(random.Random(2), 200_000))]
    assert compared(simhash.document_components(spark.createDataFrame(docs, "doc_id long, text string"))) == sorted(brute.simhash_components(docs), key=str)


def ball(r: random.Random, n: int, most: int) -> set[int]:
    """Fingerprints around a few centres, and some far from all."""
    centres = [r.getrandbits(64) for _ in range(4)]
    out = {0, 1, (1 << 64) - 1}
    while len(out) < n:
        fp = r.choice(centres)
        for _ in range(r.randrange(most)):
            fp ^= 1 << r.randrange(64)
        out.add(fp if r.random() < 0.9 else r.getrandbits(64))
    return out


@pytest.mark.parametrize(("tree", "pieces", "most"), [(2048, 4, 9), (8, 4, 9), (8, 4, 14), (16, 5, 14), (8, 6, 9)])
def test_trees_find_all_links(spark, tree, pieces, most):
    """Small trees make shards of most groups, so links run between trees too."""
    fps = sorted(ball(random.Random(most + tree), 500, most))
    df = spark.createDataFrame([(fp - (1 << 64) if fp >> 63 else fp,) for fp in fps], "fp long")
    stars = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in simhash.fingerprint_components(df, tree=tree, pieces=pieces).collect()}
    want = brute.components([(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if (a ^ b).bit_count() <= 3], fps)
    groups = lambda top: {frozenset(x for x in fps if top.get(x, x) == t) for t in {top.get(x, x) for x in fps}}
    assert groups(stars) == groups(want) and len(set(want.values())) > 3
