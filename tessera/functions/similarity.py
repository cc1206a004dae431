"""Similarity of names. Scores that need the longest common subsequence run in Arrow-batched UDFs; the rest are native."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import _col, normalize_name


# -- plain Python, one pair at a time -------------------------------------
def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    if not a or not b:
        return 0
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & where.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def indel_ratio(a: str, b: str) -> float:
    """100 times the share of both strings that is in a longest common subsequence."""
    total = len(a) + len(b)
    return 100.0 if not total else 200.0 * lcs_length(a, b) / total


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter string with a window of the longer one that is no longer than it."""
    a, b = sorted((a, b), key=len)
    if not a:
        return 100.0 if not b else 0.0
    best = 0.0
    for end in range(1, len(b) + len(a)):
        window = b[max(0, end - len(a)) : end]
        if window:
            best = max(best, indel_ratio(a, window))
            if best == 100.0:
                break
    if len(a) == len(b):
        for end in range(1, len(a) + len(b)):
            if window := a[max(0, end - len(b)) : end]:
                best = max(best, indel_ratio(b, window))
    return best


def token_sort_ratio(a: str, b: str) -> float:
    return indel_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def _token_sets(a: str, b: str) -> tuple[str, str, str]:
    x, y = set(a.split()), set(b.split())
    return tuple(" ".join(sorted(s)) for s in (x & y, x - y, y - x))  # type: ignore[return-value]


def token_set_ratio(a: str, b: str) -> float:
    if not a.split() or not b.split():
        return 0.0
    both, left, right = _token_sets(a, b)
    if both and (not left or not right):
        return 100.0
    gap = 1 if both else 0
    n, m = (len(both) + gap + len(x) for x in (left, right))
    apart = len(left) + len(right) - 2 * lcs_length(left, right)
    best = 100.0 * (1 - apart / (n + m)) if n + m else 0.0
    if both:
        for size, extra in ((n, left), (m, right)):
            best = max(best, 100.0 * (1 - (gap + len(extra)) / (len(both) + size)))
    return best


def partial_token_ratio(a: str, b: str) -> float:
    both, left, right = _token_sets(a, b)
    if both:
        return 100.0
    return max(partial_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split()))), partial_ratio(left, right))


def weighted_ratio(a: str, b: str) -> float:
    """The best of whole, token-wise and partial ratios, weighted by how far the lengths differ."""
    if not a or not b:
        return 0.0
    stretch = max(len(a), len(b)) / min(len(a), len(b))
    whole = indel_ratio(a, b)
    if stretch < 1.5:
        return max(whole, 0.95 * max(token_sort_ratio(a, b), token_set_ratio(a, b)))
    part = 0.9 if stretch <= 8 else 0.6
    return max(whole, part * partial_ratio(a, b), 0.95 * part * partial_token_ratio(a, b))


# -- columns -----------------------------------------------------------------
@F.pandas_udf(T.DoubleType())
def indel_ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else indel_ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def weighted_ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else weighted_ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def word_set(text: Column | str) -> Column:
    return F.array_distinct(F.array_remove(F.split(_col(text), r"\s+"), ""))


def word_jaccard(a: Column | str, b: Column | str) -> Column:
    x, y = word_set(a), word_set(b)
    union = F.size(F.array_union(x, y))
    return F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect(x, y)) / union)


def same_without_spaces(a: Column | str, b: Column | str) -> Column:
    bare = lambda c: F.replace(_col(c), F.lit(" "), F.lit(""))
    return (bare(a) == bare(b)).cast("int")


def same_without_au(a: Column | str, b: Column | str) -> Column:
    """Whether the left name, normalised, ends in " au" and is the right one without it."""
    x, y = normalize_name(a), normalize_name(b)
    return F.when(x.endswith(" au"), (x.substr(F.lit(1), F.length(x) - 3) == y).cast("int")).otherwise(0)


def ngram_cosine(a: Column | str, b: Column | str, n: int = 3) -> Column:
    """Cosine of the sets of character n-grams; a stand-in for word vectors that needs no model."""
    def grams(c: Column | str) -> Column:
        s = F.concat(F.lit(" "), _col(c), F.lit(" "))
        return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(s) - (n - 1), F.lit(1))), lambda i: s.substr(i, F.lit(n))))

    x, y = grams(a), grams(b)
    return F.size(F.array_intersect(x, y)) / F.sqrt(F.size(x).cast("double") * F.size(y))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine of two arrays of numbers; 0 where either has no length."""
    x, y = _col(a), _col(b)
    dot = lambda p, q: F.aggregate(F.zip_with(p, q, lambda u, v: u.cast("double") * v.cast("double")), F.lit(0.0), lambda s, z: s + z)
    norm = F.sqrt(dot(x, x)) * F.sqrt(dot(y, y))
    return F.when(norm == 0, 0.0).otherwise(dot(x, y) / norm)


def match_status(w: Column, ratio: Column, jaccard: Column, vector: Column, no_space: Column, no_au: Column) -> Column:
    """The first rule that holds."""
    return (
        F.when(no_space == 1, "no_space_exact_match")
        .when(no_au == 1, "au_removed_match")
        .when((w >= 95) & (ratio >= 90) & (jaccard >= 0.5) & (vector >= 0.5), "confident_score_match")
        .otherwise("identified_candidates")
    )


HIGH_CONFIDENCE = ("no_space_exact_match", "au_removed_match", "confident_score_match")


def folded_status(status: Column, found: Column) -> Column:
    return F.when(~found, "no_candidate_found").when(status.isin(*HIGH_CONFIDENCE), status).otherwise("low_confidence")
