"""Golden cases of names, texts and scores."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import similarity as S
from tessera.functions import text as X


def values(spark, column, rows, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, s {kind}")
    return [r[0] for r in df.repartition(3).select("i", column(F.col("s")).alias("v")).orderBy("i").select("v").collect()]


def test_normalize_name(spark):
    names = ["BHP Group Ltd", "Gujarat NRE Coke Pty. Ltd.", "Rio & Tinto Minerals Australia", "A&B Resources Ltd/Australia", "Group Holdings Ltd", None, "Acme S.A.C.", "  Steels   Co  "]
    got = values(spark, X.normalize_name, names)
    assert got == ["bhp", "gujarat nre coke", "rio and tinto mineral au", "aandb resource", "", "", "acme", "steel"]
    assert values(spark, X.normalize_name, got) == got


def test_split_primary_secondary(spark):
    got = values(spark, X.split_primary_secondary, ["Au, Cu (Ag, Pb)", "Au (Ag, Cu), Zn (Pb)", "Au （Ag）", "", None, " , Au,,"])
    assert [tuple(r) for r in got] == [("Au, Cu", "Ag, Pb"), ("Au", "Ag, Cu), Zn (Pb"), ("Au", "Ag"), ("", ""), ("", ""), ("Au", "")]


def test_parse_pairs(spark):
    keys = ("environment", "group", "type")
    got = values(spark, lambda c: X.parse_pairs(c, keys), ["Environment: Magmatic, Group: Mafic, Type: Layered", "type: a, TYPE: b:c, x", "", None])
    assert [tuple(r) for r in got] == [("Magmatic", "Mafic", "Layered"), ("", "", "b:c"), ("", "", ""), ("", "", "")]


def test_numbers_and_nulls(spark):
    assert values(spark, X.shorthand_number, ["1.5M", "2k", "--", "", None, " 3B ", "12", "K"]) == [1500000.0, 2000.0, None, None, None, 3e9, 12.0, None]
    assert values(spark, X.null_tokens, ["0", "--", "  ", "", "00", None, "x"]) == [None, None, None, None, "00", None, "x"]
    assert values(spark, X.id_number, ["comp_12", "x", None]) == [12, None, None]


def test_title_case_and_variants(spark):
    assert values(spark, X.title_case, ["O'NEIL BHP-BILLITON 3M (AUST.)", "élan ÜBER", None]) == ["O'Neil Bhp-Billiton 3M (Aust.)", "Élan Über", None]
    got = values(spark, X.name_variants, ["ACME CORP LTD", "x", "Limited Ltd"])
    assert got == [["ACME CORP LTD", "ACME CORP LIMITED", "ACME CORPORATION LTD"], ["X"], ["LIMITED LTD", "LIMITED LIMITED", "LTD LTD"]]


def test_lists(spark):
    df = spark.createDataFrame([(["A", "b"], ["B", "c", "c"])], "a array<string>, b array<string>")
    assert df.select(X.merge_names("a", "b")).first()[0] == ["A", "b", "c", "c"]
    assert [tuple(x) for x in df.select(X.zip_shorter("a", "b")).first()[0]] == [("A", "B"), ("b", "c")]
    assert values(spark, X.status_kind, ["Mining ", "other", None]) == ["Mine Projects", "other", None]
    assert values(spark, X.state_code, [" Queensland", "Elsewhere", None]) == ["QLD", "Elsewhere", None]
    assert values(spark, lambda c: X.point_text(c, F.lit("2")), ["1.5", "", None]) == ["point({longitude: 1.5, latitude: 2})", "", ""]
    assert values(spark, X.clean_breaks, ["a\r\nb", None]) == ["ab", None]


def test_flags(spark):
    df = spark.createDataFrame([("gold road", "goldroad"), ("acme au", "acme"), ("acme", "acme au")], "a string, b string")
    assert [tuple(r) for r in df.select(S.same_without_spaces("a", "b"), S.same_without_au("a", "b")).collect()] == [(1, 0), (0, 1), (0, 0)]
    score = lambda *v: spark.range(1).select(S.match_status(*[F.lit(x) for x in v])).first()[0]
    assert score(95.0, 90.0, 0.5, 0.5, 0, 0) == "confident_score_match"
    assert score(95.0, 90.0, 0.5, 0.4, 0, 0) == "identified_candidates"
    assert score(10.0, 10.0, 0.0, 0.0, 0, 1) == "au_removed_match"
    assert score(10.0, 10.0, 0.0, 0.0, 1, 1) == "no_space_exact_match"


def plain_lcs(a: str, b: str) -> int:
    row = [0] * (len(b) + 1)
    for c in a:
        new = [0]
        for j, d in enumerate(b):
            new.append(row[j] + 1 if c == d else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.text("ab c", max_size=30), st.text("ab c", max_size=30))
def test_scores_are_sound(a, b):
    assert S.lcs_length(a, b) == plain_lcs(a, b)
    for f in (S.indel_ratio, S.weighted_ratio, S.token_set_ratio, S.token_sort_ratio, S.partial_ratio):
        assert 0 <= f(a, b) <= 100 + 1e-9
        assert f(a, b) == pytest.approx(f(b, a))
    if a and b:
        assert (S.weighted_ratio(a, b) == 100) == (a == b)


def test_known_scores():
    assert S.indel_ratio("this is a test", "this is a test!") == pytest.approx(96.551724, abs=1e-5)
    assert S.partial_ratio("this is a test", "this is a test!") == 100
    assert S.token_sort_ratio("fuzzy wuzzy was a bear", "wuzzy fuzzy was a bear") == 100
    assert S.token_set_ratio("fuzzy was a bear", "fuzzy fuzzy was a bear") == 100
    assert S.weighted_ratio("x au", "x gold au") == pytest.approx(85.5)
    assert S.weighted_ratio("acme gold", "acme gold au") == 95


def test_cosines(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    assert [round(r[0], 6) for r in df.select(S.cosine("a", "b")).collect()] == [0.707107, 0.0]
    near = spark.createDataFrame([("gold road", "gold road"), ("gold road", "zinc")], "a string, b string").select(S.ngram_cosine("a", "b")).collect()
    assert near[0][0] == 1.0 and near[1][0] < 0.2


def test_suffix_pattern_strips_like_a_loop():
    import re

    from tessera.functions.vocabulary import LEGAL_SUFFIXES

    endings = sorted({tuple(re.findall("[a-z0-9]+", s.lower())) for s in LEGAL_SUFFIXES}, key=lambda t: (-len(t), -sum(map(len, t))))
    r = random.Random(1)
    vocabulary = [w for e in endings for w in e] + ["gold", "mine"]
    for _ in range(3000):
        words = [r.choice(vocabulary) for _ in range(r.randrange(7))]
        left = list(words)
        while hit := next((e for e in endings if len(e) <= len(left) and tuple(left[-len(e) :]) == e), None):
            left = left[: -len(hit)]
        assert re.sub(X.suffix_pattern(), "", " ".join(words)) == " ".join(left)
