"""Fuzzy matching of names: token blocking, the best candidate, its status, cascades, and merging by matches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import similarity as S
from tessera.functions.text import normalize_name
from tessera.operators.order import dense_ids, keep_first
from tessera.operators.relational import append_unmatched
from tessera.operators.stages import settled, written

THRESHOLD = 80.0
#: Names whose lengths differ by more cannot reach the threshold.
MAX_STRETCH = 8.0


def token_index(df: DataFrame, name: str) -> DataFrame:
    """token, name: an inverted index over the words of names."""
    return df.select(F.explode(F.array_distinct(F.array_remove(F.split(F.col(name), r"\s+"), ""))).alias("token"), F.col(name).alias("name")).distinct()


def token_pairs(left: DataFrame, right: DataFrame, left_name: str, right_name: str) -> DataFrame:
    """Distinct pairs (l, r) of names that share a word; adaptive execution splits the join of frequent words."""
    a = token_index(left, left_name).select("token", F.col("name").alias("l"))
    b = token_index(right, right_name).select("token", F.col("name").alias("r"))
    return a.join(b, "token").select("l", "r").distinct()


def best_by(pairs: DataFrame, left: str, order: Sequence[Column]) -> DataFrame:
    """The first pair of each left name in the order."""
    rank = F.row_number().over(Window.partitionBy(left).orderBy(*order))
    return pairs.withColumn("__rank", rank).filter("__rank = 1").drop("__rank")


def best_jaccard(pairs: DataFrame, least: float = 0.0) -> DataFrame:
    """l, r, jaccard: the right name of the greatest word Jaccard; ties go to the smaller name."""
    scored = pairs.withColumn("jaccard", S.word_jaccard("l", "r")).filter(F.col("jaccard") > least)
    return best_by(scored, "l", [F.col("jaccard").desc(), F.col("r").asc()])


#: Buckets that letters are counted in, and rows of one word on the right beyond which its join is salted.
LETTERS = 32
HOT_WORD = 10_000


def _described(df: DataFrame, name: str) -> DataFrame:
    """name and d: distinct names with their distinct words, sorted, and the lengths and letter counts that bound scores."""
    c = F.col("name")
    words = F.array_remove(F.split(c, r"\s+"), "")
    bare = F.regexp_replace(c, r"\s+", "")
    seen = F.transform(F.split(bare, ""), lambda x: F.ascii(x) % LETTERS)
    # bound as a lambda's argument, the letters are taken apart once and not once for each bucket
    counts = F.transform(F.array(seen), lambda s: F.transform(F.sequence(F.lit(0), F.lit(LETTERS - 1)), lambda i: F.size(F.filter(s, lambda x: x == i)).cast("short")))[0]
    return df.select(F.col(name).alias("name")).filter("name <> ''").distinct().select(
        "name", F.struct(F.array_sort(F.array_distinct(words)).alias("words"), F.size(words).alias("k"), F.length(c).alias("n"), F.length(bare).alias("bare"), counts.alias("letters")).alias("d"))


def score_bounds(a: str = "a", b: str = "b") -> tuple[Column, Column]:
    """(least, most) that the weighted ratio of two described names with a word in common can be, without comparing them letter by letter.

    A common subsequence is no longer than the letters that both have, counted with
    repeats; lengths and the words in common are known exactly.
    """
    of = lambda side, what: F.col(f"{side}.{what}")
    chars = lambda words: F.aggregate(words, F.lit(0), lambda s, w: s + F.length(w))
    shared = F.aggregate(F.zip_with(of(a, "letters"), of(b, "letters"), lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    spaces = F.least(of(a, "n") - of(a, "bare"), of(b, "n") - of(b, "bare"))
    share = lambda common, total: F.least(F.lit(100.0), 200.0 * common / F.greatest(total, F.lit(1)))
    whole = share(shared + spaces, of(a, "n") + of(b, "n"))
    by_words = share(shared + F.least(of(a, "k"), of(b, "k")) - 1, of(a, "bare") + of(a, "k") + of(b, "bare") + of(b, "k") - 2)
    both = F.array_intersect(of(a, "words"), of(b, "words"))
    both_chars, both_n = chars(both), F.size(both)
    rest = {s: (chars(of(s, "words")) - both_chars, F.greatest(F.size(of(s, "words")) - both_n - 1, F.lit(0))) for s in (a, b)}
    left, right = (c + gaps for c, gaps in rest.values())
    head = both_chars + both_n - 1
    common = F.least(left, right, F.greatest(shared - both_chars, F.lit(0)) + F.least(rest[a][1], rest[b][1]))
    covered = (left == 0) | (right == 0)
    known = F.greatest(*[100.0 * (1 - (1 + x) / (head + head + 1 + x)) for x in (left, right)])
    total = head + 1 + left + head + 1 + right
    set_most = F.when(covered, 100.0).otherwise(F.greatest(known, 100.0 * (1 - (left + right - 2 * common) / total)))
    stretch = F.greatest(of(a, "n"), of(b, "n")) / F.least(of(a, "n"), of(b, "n"))
    part = F.when(stretch <= 8, 0.9).otherwise(0.6)
    window = share(shared + spaces, F.least(of(a, "n"), of(b, "n")) + shared + spaces)
    near = stretch < 1.5
    most = F.when(near, F.greatest(whole, 0.95 * F.greatest(by_words, set_most))).otherwise(F.greatest(whole, part * window, 95.0 * part))
    least = F.when(near, 0.95 * F.when(covered, 100.0).otherwise(known)).otherwise(95.0 * part)
    return least, most


def candidates(left: DataFrame, right: DataFrame, left_name: str, right_name: str, hot_word: int = HOT_WORD) -> DataFrame:
    """l, r, a, b: each pair of names that share a word, once, with what describes them.

    A pair comes up at the first of its common words only, so pairs need not be made
    distinct. The names of a word that very many names on the right have are dealt to
    salted parts, and those on the left to all of that word's parts.
    """
    words = lambda df, name, x, d: df.select(F.col("name").alias(x), F.col("d").alias(d), F.explode("d.words").alias("word"))
    x = words(_described(left, left_name), left_name, "l", "a")
    y = words(_described(right, right_name), right_name, "r", "b")
    hot = written(token_index(right, right_name).withColumnRenamed("token", "word").groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot_word).select("word", F.ceil(F.col("n") / hot_word).cast("int").alias("parts")), "hot-words")
    keys = ["word"]
    if not hot.isEmpty():
        parts = F.coalesce("parts", F.lit(1))
        y = y.join(hot, "word", "left").withColumn("part", F.pmod(F.xxhash64("r"), parts).cast("int")).drop("parts")
        x = x.join(hot, "word", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
        keys.append("part")
    met = x.join(y, keys)
    return met.filter(F.element_at(F.array_intersect("a.words", "b.words"), 1) == F.col("word")).select("l", "r", "a", "b")


def scored_pairs(met: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """l, r, w_ratio of those pairs of candidates() that can be the best of their left name.

    Of each name, the pair with the greatest bound is scored first. Others follow
    only where their bound reaches that score, and the greatest score that any pair is known to have.
    """
    longer, shorter = F.greatest("a.n", "b.n"), F.least("a.n", "b.n")
    least, most = score_bounds()
    slack = 1e-6  # bounds are sums in another order
    bounded = met.filter((shorter > 0) & (longer <= MAX_STRETCH * shorter)).select("l", "r", least.alias("least"), (most + slack).alias("most")).filter(F.col("most") >= threshold)
    bounded = written(bounded, "bounded")
    heads = bounded.groupBy("l").agg(F.max("least").alias("floor"), F.max_by("r", F.struct("most", "least", "r")).alias("r"))
    heads = written(heads.withColumn("w_ratio", S.weighted_ratio_udf("l", "r")), "heads")
    floors = heads.select("l", F.col("r").alias("__head"), F.greatest(F.col("floor") - slack, "w_ratio", F.lit(threshold)).alias("floor"))
    rest = bounded.join(floors, "l").filter("r <> __head and most >= floor").select("l", "r")
    return heads.select("l", "r", "w_ratio").unionByName(rest.withColumn("w_ratio", S.weighted_ratio_udf("l", "r")))


def best_bounded(met: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """l, r, w_ratio, levenshtein_ratio of the best of candidates(), as best_weighted gives it."""
    return _best_scored(scored_pairs(met, threshold), threshold)


def _best_scored(scored: DataFrame, threshold: float) -> DataFrame:
    good = scored.filter(F.col("w_ratio") >= threshold)
    # only candidates with the best first score need the second
    tied = good.withColumn("__top", F.max("w_ratio").over(Window.partitionBy("l"))).filter("w_ratio = __top").drop("__top")
    return best_by(tied.withColumn("levenshtein_ratio", S.indel_ratio_udf("l", "r")), "l", [F.col("levenshtein_ratio").desc(), F.col("r").asc()])


def best_weighted(pairs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """l, r, w_ratio, levenshtein_ratio of the best candidate, every pair of like length scored."""
    longer, shorter = F.greatest(F.length("l"), F.length("r")), F.least(F.length("l"), F.length("r"))
    near = pairs.filter((shorter > 0) & (longer <= MAX_STRETCH * shorter))
    return _best_scored(near.withColumn("w_ratio", S.weighted_ratio_udf("l", "r")), threshold)


def name_vectors(names: DataFrame, name: str, vectors: DataFrame, word: str = "word", vector: str = "vector") -> DataFrame:
    """name, vector: the mean of the vectors of each name's words, repeats included; words that the table lacks count as zero vectors.

    vectors is a table of a model's words, of any size: it is joined, not loaded.
    """
    words = F.posexplode(F.array_remove(F.split(F.col("name"), r"\s+"), ""))
    each = names.select(F.col(name).alias("name")).distinct().select("name", words.alias("i", "word"))
    found = each.join(vectors.select(F.col(word).alias("word"), F.col(vector).cast("array<double>").alias("v")), "word", "left")
    held = found.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.when(F.col("v").isNotNull(), F.struct("i", "v")))).alias("vs"))
    plus = lambda s, x: F.when(F.size(s) == 0, x["v"]).otherwise(F.zip_with(s, x["v"], lambda p, q: p + q))
    total = F.aggregate("vs", F.expr("cast(array() as array<double>)"), plus)
    return held.select("name", F.transform(total, lambda x: x / F.col("n")).alias("vector"))


def with_vector_similarity(pairs: DataFrame, vectors: DataFrame, alias: str = "vector_similarity") -> DataFrame:
    """pairs of l and r with the cosine of their mean word vectors; 0 where a name has no vector or one of no length."""
    both = written(name_vectors(pairs.select(F.explode(F.array("l", "r")).alias("name")), "name", vectors), "vectors")
    x, y = (both.select(F.col("name").alias(side), F.col("vector").alias(f"__{side}")) for side in ("l", "r"))
    known = (F.size("__l") > 0) & (F.size("__r") > 0)
    joined = pairs.join(x, "l", "left").join(y, "r", "left")
    return joined.withColumn(alias, F.coalesce(F.when(known, S.cosine("__l", "__r")), F.lit(0.0))).drop("__l", "__r")


def match(
    left: DataFrame, right: DataFrame, left_name: str = "norm", right_name: str = "norm",
    vector: Callable[[str, str], Column] | DataFrame | None = S.ngram_cosine, vector_gate: tuple[float, float] = (95.0, 100.0),
) -> DataFrame:
    """l, r, six scores and the folded status for every distinct left name; scores are null where there is no candidate.

    vector scores a pair of names, or is a table of (word, vector), and takes part where vector_gate[0] <= w_ratio <
    vector_gate[1]; None leaves it 0, so that no match is confident by scores.
    """
    names = left.select(F.col(left_name).alias("l")).distinct()
    best = _judged(best_bounded(candidates(left, right, left_name, right_name)), vector, vector_gate)
    out = names.join(best, "l", "left")
    return out.withColumn("status", S.folded_status(F.col("status"), F.col("r").isNotNull()))


def _judged(best: DataFrame, vector: Callable[[str, str], Column] | DataFrame | None, vector_gate: tuple[float, float]) -> DataFrame:
    """l, r, w_ratio and levenshtein_ratio of best pairs with the other four scores and the rule that holds."""
    gate = (F.col("w_ratio") >= vector_gate[0]) & (F.col("w_ratio") < vector_gate[1])
    if isinstance(vector, DataFrame):
        best = written(best, "best")
        close = with_vector_similarity(best.filter(gate).select("l", "r"), vector, "__near")
        best = best.join(close, ["l", "r"], "left")
    best = best.withColumns({
        "jaccard_similarity": S.word_jaccard("l", "r"),
        "vector_similarity": F.coalesce("__near", F.lit(0.0)) if isinstance(vector, DataFrame) else F.when(gate, vector("l", "r")).otherwise(0.0) if vector else F.lit(0.0),
        "no_space_exact_match": S.same_without_spaces("l", "r"),
        "au_removed_match": S.same_without_au("l", "r"),
    })
    best = best.drop("__near")
    return best.withColumn("status", S.match_status(F.col("w_ratio"), F.col("levenshtein_ratio"), F.col("jaccard_similarity"), F.col("vector_similarity"), F.col("no_space_exact_match"), F.col("au_removed_match")))


#: The weighted ratio from which confident() finds all pairs by their form: below it only names that are equal but for spaces or an "au" can be confident.
CLOSE = 95.0


def _worded(df: DataFrame, name: str, alias: str, words: str) -> DataFrame:
    c = F.col(name)
    return df.select(c.alias(alias), S.word_set(c).alias(words)).filter(F.size(words) > 0).distinct()


def _contained(x: DataFrame, y: DataFrame) -> DataFrame:
    """l, r where all words of one name are among those of the other, and lengths differ by less than a half.

    They meet at the word of the smaller set that fewest names on the right have.
    """
    counts = y.select(F.explode("b").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))

    def rarest(df: DataFrame, name: str, words: str) -> DataFrame:
        each = df.select(name, words, F.explode(words).alias("word")).join(counts, "word")
        # a name with a word that no name on the right has is in none of them
        return each.groupBy(name, words).agg(F.min_by("word", F.struct("n", "word")).alias("word"), F.count(F.lit(1)).alias("known")).filter(F.col("known") == F.size(words)).drop("known")

    longer, shorter = F.greatest(F.length("l"), F.length("r")), F.least(F.length("l"), F.length("r"))
    near = 2 * longer < 3 * shorter
    inner = rarest(x, "l", "a").join(y.select("r", "b", F.explode("b").alias("word")), "word").filter(near & (F.size(F.array_except("a", "b")) == 0))
    outer = rarest(y, "r", "b").join(x.select("l", "a", F.explode("a").alias("word")), "word").filter(near & (F.size(F.array_except("b", "a")) == 0))
    return inner.select("l", "r").unionByName(outer.select("l", "r"))


def _alike(x: DataFrame, y: DataFrame) -> DataFrame:
    """l, r of different names with a word in common, among them all whose whole ratio reaches CLOSE.

    Names of n and m letters then differ by at most (n + m) / 20 letters put in or taken out, and by
    2 * m / 19 whatever n is. The right name is cut into one part more than that, one of which
    stands unchanged in the left one, moved by no more letters than differ.
    """
    m, n = F.col("m"), F.length("l")
    parts = (F.floor(2 * m / 19) + 1).cast("int")
    start = lambda j: F.floor(j * m / F.col("k")).cast("int")
    length = (start(F.col("j") + 1) - start(F.col("j"))).alias("length")
    each = lambda df: df.withColumn("k", parts).filter("k > 1").withColumn("j", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    right = each(y.withColumn("m", F.length("r"))).withColumns({"at": start(F.col("j")), "length": length})
    right = right.select("m", "j", F.col("r").substr(F.col("at") + 1, F.col("length")).alias("part"), "r", "b")

    sized = x.withColumn("n", n).withColumn("m", F.explode(F.sequence(F.ceil(19 * n / 21).cast("int"), F.floor(21 * n / 19).cast("int"))))
    apart = F.abs(F.col("n") - m)
    # as many letters differ as the lengths do, or more by an even number
    spare = F.floor((F.floor((F.col("n") + m) / 20) - apart) / 2).cast("int")
    left = each(sized.withColumn("spare", spare).filter((F.col("spare") >= 0) & ((apart > 0) | (F.col("spare") > 0))))
    moves = F.sequence(F.least(F.lit(0), F.col("n") - m) - F.col("spare"), F.greatest(F.lit(0), F.col("n") - m) + F.col("spare"))
    left = left.withColumns({"at": start(F.col("j")), "length": length}).withColumn("at", F.explode(F.transform(moves, lambda d: F.col("at") + d)))
    left = left.filter((F.col("at") >= 0) & (F.col("at") + F.col("length") <= F.col("n")))
    left = left.select("m", "j", F.col("l").substr(F.col("at") + 1, F.col("length")).alias("part"), "l", "a")
    return left.join(right, ["m", "j", "part"]).filter((F.col("l") != F.col("r")) & F.arrays_overlap("a", "b")).select("l", "r")


def confident(
    left: DataFrame, right: DataFrame, left_name: str = "norm", right_name: str = "norm",
    vector: Callable[[str, str], Column] | DataFrame | None = S.ngram_cosine, vector_gate: tuple[float, float] = (95.0, 100.0),
) -> DataFrame:
    """The rows of match() of high confidence, without the pairs that have no more in common than a frequent word.

    Names are normalised ones. An equal name is the best there is. Other pairs whose
    weighted ratio reaches CLOSE have one name's words within the other's, or few letters that differ; both are
    found by joins on rare keys, and the best of them is the best of all. A name without such a
    pair can only be confident where it equals one on the right but for spaces or an
    "au"; those few are held against all their candidates.
    """
    x, y = _worded(left, left_name, "l", "a"), _worded(right, right_name, "r", "b")
    exact = x.join(y.select(F.col("r").alias("l")), "l").select("l", F.col("l").alias("r"), F.lit(100.0).alias("w_ratio"), F.lit(100.0).alias("levenshtein_ratio"))
    exact = written(exact, "exact")
    others = written(x.join(exact.select("l"), "l", "left_anti"), "others")
    pairs = written(_contained(others, y).unionByName(_alike(others, y)).distinct(), "close")
    close = written(_best_scored(pairs.withColumn("w_ratio", S.weighted_ratio_udf("l", "r")), CLOSE), "close-best")
    best = _judged(exact.unionByName(close.select("l", "r", "w_ratio", "levenshtein_ratio")), vector, vector_gate)

    rest = others.join(close.select("l"), "l", "left_anti").select("l", "a")
    bare = lambda name: F.replace(F.col(name), F.lit(" "), F.lit(""))
    less_au = lambda c: F.when(c.endswith(" au"), c.substr(F.lit(1), F.length(c) - 3))
    spaced = rest.withColumn("key", bare("l")).join(y.select(bare("r").alias("key")), "key", "left_semi")
    with_au = rest.withColumn("key", less_au(normalize_name("l"))).join(y.select(normalize_name("r").alias("key")), "key", "left_semi")
    plain = rest.withColumn("key", less_au(F.col("l"))).join(y.select(F.col("r").alias("key")), "key", "left_semi")
    odd = spaced.unionByName(with_au).select("l", "a").distinct().join(plain.select("l", F.lit(True).alias("plain")), "l", "left")
    odd = written(odd, "odd")
    if not odd.isEmpty():
        # a ratio of 90, which a name has with itself less an "au", takes a like length or a part of the other name
        longer, shorter = F.greatest(F.length("l"), F.length("r")), F.least(F.length("l"), F.length("r"))
        like = (2 * longer < 3 * shorter) | F.contains(F.col("l"), F.col("r")) | F.contains(F.col("r"), F.col("l"))
        met = odd.withColumn("word", F.explode("a")).join(y.select("r", F.explode("b").alias("word")), "word").filter(F.col("plain").isNull() | like)
        best = best.unionByName(match(odd, written(met.select("r").distinct(), "odd-right"), "l", "r", vector, vector_gate))
    return best.filter(F.col("status").isin(*S.HIGH_CONFIDENCE))


def cascade(left: DataFrame, name: str, sources: Sequence[tuple[str, DataFrame, str]], find: Callable[[DataFrame, DataFrame, str, str], DataFrame]) -> DataFrame:
    """Matches in the first source that has a good one; what one source settles is not held against the next.

    find(left, right, left_name, right_name) gives (l, r, ...) for names with a good match.
    """
    rest, out = left.select(F.col(name)).distinct(), None
    for label, right, right_name in sources:
        got = settled(lambda: find(rest, right, name, right_name).withColumn("matched_source", F.lit(label)), "cascade")  # noqa: B023
        out = got if out is None else out.unionByName(got, allowMissingColumns=True)
        rest = written(rest.join(got.select(F.col("l").alias(name)), name, "left_anti"), "cascade")
    return out.unionByName(rest.select(F.col(name).alias("l")), allowMissingColumns=True)


def prepared(df: DataFrame, name: str, order: str) -> DataFrame:
    """df with norm, of each normalised name the first row; names that vanish are dropped."""
    named = df.withColumn("norm", normalize_name(name)).filter("norm <> ''")
    return keep_first(named, ["norm"], [order])


def enrich_append(left: DataFrame, right: DataFrame, name: str, order: str, take: Sequence[str], tag: str) -> DataFrame:
    """One stage of building a master table.

    Right rows matched with high confidence give their ``take`` columns to the left
    rows they match; right rows that no left row matched are appended and tagged. Each
    step is written to the shared folder, so that stages on stages stay small plans.
    """
    a, b = written(prepared(left, name, order), "left"), written(prepared(right, name, order), "right")
    good = settled(lambda: confident(a, b).select(F.col("l").alias("norm"), F.col("r").alias("__r")), "matches")
    found = good.join(b.select(F.col("norm").alias("__r"), *take), "__r")
    mine = a.drop(*[c for c in take if c in a.columns]).join(found.drop("__r"), "norm", "left")
    extra = b.join(good.select(F.col("__r").alias("norm")).distinct(), "norm", "left_anti")
    return written(append_unmatched(mine, extra, "norm", "Source", tag), "merged")


def with_company_ids(df: DataFrame, order: Sequence[str]) -> DataFrame:
    return dense_ids(df, order, "comp_", "companyID")
