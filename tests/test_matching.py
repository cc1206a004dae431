"""Bounded matching against the matching of all pairs, and word vectors as a table."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tessera.functions import similarity as S
from tessera.operators import matching as M
from tessera.plans import pipelines as C


def names(seed, n, words=60):
    r = random.Random(seed)
    known = ["".join(r.choice("abcde") for _ in range(r.randrange(1, 7))) for _ in range(words)]
    return [" ".join(r.choice(known) for _ in range(r.randrange(1, 6))) for _ in range(n)]


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "n string")


@pytest.fixture(scope="module")
def sides(spark):
    whole = names(5, 450)
    return frame(spark, [*whole[:150], "", None, "a  b", "a a b"]), frame(spark, [*whole[150:], "b a", "a\tb", None])


@pytest.mark.parametrize("hot", [10_000, 7])
def test_bounds_hold_and_lose_nothing(sides, hot):
    left, right = sides
    met, pairs = M.candidates(left, right, "n", "n", hot).cache(), M.token_pairs(left, right, "n", "n")
    assert sorted(map(tuple, met.select("l", "r").collect())) == sorted(map(tuple, pairs.collect()))
    least, most = M.score_bounds()
    scores = met.select("l", "r", least.alias("least"), most.alias("most"), S.weighted_ratio_udf("l", "r").alias("w"))
    assert scores.filter("w > most + 1e-6 or w < least - 1e-6").count() == 0
    got, want = (sorted(map(tuple, df.collect())) for df in (M.best_bounded(met), M.best_weighted(pairs)))
    assert got == want and len(got) > 100


def test_few_pairs_are_scored(spark):
    """Names of a common word: every pair is met, and the best is scored with few others."""
    r = random.Random(8)
    stems = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(200)]
    left, right = frame(spark, [f"{s} mining" for s in stems]), frame(spark, [f"{s[:-1]}x mining" for s in stems])
    met = M.candidates(left, right, "n", "n", 50)
    scored = M.scored_pairs(met)
    assert met.count() == 40_000 and scored.count() < 4_000
    assert {x["l"]: x["r"] for x in M.best_bounded(met).collect()} == {f"{s} mining": f"{s[:-1]}x mining" for s in stems}


def test_word_vectors_from_a_table(spark):
    vectors = spark.createDataFrame([("gold", [1.0, 0.0]), ("silver", [0.6, 0.8]), ("void", [0.0, 0.0]), ("mine", [0.0, 2.0])], "word string, vector array<float>")
    pairs = spark.createDataFrame([("gold", "silver"), ("gold mine", "silver"), ("gold gold mine", "mine unknown"), ("void", "gold"), ("unknown", "gold"), ("", "gold"), (None, "gold")], "l string, r string")
    got = {(x["l"], x["r"]): x["vector_similarity"] for x in M.with_vector_similarity(pairs, vectors).collect()}
    want = {("gold", "silver"): 0.6, ("gold mine", "silver"): (0.5 * 0.6 + 1.0 * 0.8) / 1.25**0.5, ("gold gold mine", "mine unknown"): 0.5**0.5, ("void", "gold"): 0, ("unknown", "gold"): 0, ("", "gold"): 0, (None, "gold"): 0}
    assert got.keys() == want.keys() and all(abs(got[k] - v) < 1e-6 for k, v in want.items())


def test_match_takes_a_table_of_vectors(spark):
    left, right = spark.createDataFrame([("acme gold mining",)], "norm string"), spark.createDataFrame([("acme gold minin",)], "norm string")
    vectors = spark.createDataFrame([("acme", [1.0, 1.0]), ("gold", [1.0, 0.5])], "word string, vector array<double>")
    row = M.match(left, right, vector=vectors, vector_gate=(90.0, 101.0)).first()
    assert abs(row["vector_similarity"] - 1) < 1e-9 and row["status"] == "confident_score_match" and "__near" not in row.asDict()
    assert M.match(left, right, vector=vectors, vector_gate=(99.0, 101.0)).select(F.col("vector_similarity")).first()[0] == 0


def variants(seed, n):
    """Names of two rare words and frequent ones, and the same with a letter changed, words moved, spaces gone or an "au" more."""
    r = random.Random(seed)
    word = lambda k: "".join(r.choice("abcdefgh") for _ in range(k))
    out = []
    for _ in range(n):
        base = " ".join([word(r.randrange(1, 14)), word(r.randrange(1, 14)), *r.sample(["gold", "mining", "au", "of"], r.randrange(3))])
        at = r.randrange(len(base))
        changed = [base, base[:at] + base[at + 1 :], base[:at] + "x" + base[at:], base[:at] + "y" + base[at + 1 :], base + " au", base.replace(" ", "", 1), " ".join(sorted(base.split())), base + " gold", f"{base} {word(3)}"]
        out += [" ".join(v.split()) for v in r.sample(changed, 4)]
    return out


@pytest.mark.parametrize("gate", [(95.0, 100.0), (90.0, 101.0)])
def test_confident_is_match_of_high_confidence(spark, gate):
    whole = variants(3, 400)
    random.Random(4).shuffle(whole)
    extra = ["n1 m1 au", "ab c au", "ab cd", "", None]
    left, right = frame(spark, [*whole[:700], *extra]), frame(spark, [*whole[700:], "n1 m1", "n2 m1 au", "abc au", "a bcd ab cd", None])
    got = M.confident(left, right, "n", "n", vector_gate=gate)
    want = M.match(left, right, "n", "n", vector_gate=gate).filter(F.col("status").isin(*S.HIGH_CONFIDENCE))
    assert got.columns == want.columns
    rows = sorted(map(tuple, want.collect()))
    assert sorted(map(tuple, got.collect())) == rows
    assert {r[-1] for r in rows} == set(S.HIGH_CONFIDENCE) and {r[2] < M.CLOSE for r in rows} == {True, False}


def test_confident_makes_no_pairs_of_a_frequent_word(spark, monkeypatch):
    """3,000 names on either side share a word: of nine million pairs, one or two a name are scored."""
    seen = []
    best = M._best_scored
    monkeypatch.setattr(M, "_best_scored", lambda scored, threshold: seen.append(scored.count()) or best(scored, threshold))
    monkeypatch.setattr(M, "candidates", lambda *_: pytest.fail("all pairs of a word were asked for"))
    left = frame(spark, [f"left{i:05d} west{i:05d} au" for i in range(3000)])
    right = frame(spark, [f"left{i:05d} west{i:05d}" if i < 100 else f"right{i:05d} east{i:05d} au" for i in range(3000)])
    assert M.confident(left, right, "n", "n").count() == 100 and sum(seen) < 6000


def test_cascade_makes_no_pairs_of_a_frequent_word(spark, monkeypatch):
    monkeypatch.setattr(M, "candidates", lambda *_: pytest.fail("all pairs of a word were asked for"))
    projects = spark.createDataFrame([(f"west{i:05d} rock{i:05d} Australia",) for i in range(300)], "COMPANIES string")
    master = spark.createDataFrame([(f"west{i:05d} rock{i:05d}" if i < 50 else f"east{i:05d} sand{i:05d} Australia", i, "market" if i % 2 else "statements") for i in range(300)], "name string, ord int, Source string")
    got = C.cascaded_matches(projects, master).filter("matched_name is not null").collect()
    assert {(x["name"], x["matched_source"], x["matched_name"]) for x in got} == {(f"west{i:05d} rock{i:05d} Australia", "market" if i % 2 else "statements", f"west{i:05d} rock{i:05d}") for i in range(50)}


def test_owners_make_no_pairs_of_a_frequent_word(spark, monkeypatch):
    monkeypatch.setattr(M, "candidates", lambda *_: pytest.fail("all pairs of a word were asked for"))
    projects = spark.createDataFrame([(str(i), f"west{i:05d} rock{i:05d} Australia") for i in range(300)], "ENO string, COMPANIES string")
    master = spark.createDataFrame([(f"comp_{i}", f"west{i:05d} rock{i:05d}" if i < 50 else f"east{i:05d} sand{i:05d} Australia", None) for i in range(300)], "companyID string, name string, synonyms string")
    got = C.project_owners(projects, projects.select("ENO", F.concat(F.lit("p"), "ENO").alias("projectID")), master).collect()
    assert {tuple(x) for x in got} == {(f"comp_{i}", f"p{i}") for i in range(50)}
