"""Quality rules whose thresholds adapt to each language and source, with DataFrame functions only.

Every document is measured in one pass. Fixed rules (too few words, too many
repeated ones) fail a document outright. The other limits come from the corpus:
a mergeable KLL quantile sketch of each measure for each language and source,
built by partial aggregation, gives quartiles, and a document fails that lies
further than ``reach`` interquartile ranges outside them. A measure's floor
stands for the range where the quartiles lie closer, so that a group of equal
values does not reject what barely differs. A group of under ``least`` documents
uses the merged sketches of its language, or, failing that, of all documents.
Measures are joined with the limits of their group and filtered.

Contract of the limits. Up to SKETCH_K documents in a group the quartiles are the
exact ones. Beyond, a sketch is randomised and depends on the order in which parts
are merged: a quartile's rank is off by RANK_ERROR of the group at most (with a
chance of over 99 %), so runs may differ for documents whose measure lies at a
limit, and for no others; a test holds sketches of 100,000 values to it.

Measures are written to the shared folder first: texts are read once, and the
sketch and the verdict see the same rows.

Defined cases: a null text has no words, so it fails; null languages and sources
form groups of their own; repeated documents are rows of their own; an empty
table gives an empty result; other columns are kept by ``passing`` and ignored
by ``measured``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import materialize

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SPACE = r"[ \t-\r]+"
#: Entries that a sketch keeps for sure; up to that many documents quartiles are exact.
SKETCH_K = 800
RANK_ERROR = 0.01
REACH = 3.0
LEAST = 20
#: Measure and the least interquartile range that its limits assume.
MEASURES = {"symbols": 0.1, "dup_lines": 0.1, "repeats": 0.05, "word_length": 2.0}


def _counts(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The kept columns with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    names = [F.col(f"`{c}`") for c in keep]
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    base = docs.select(
        *names,
        F.array_remove(F.split(whole, SPACE), "").alias("__words"),
        (F.length(whole) - F.length(F.regexp_replace(whole, r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^ \t-\r]")).alias("__lines"),
    )
    base = base.select(
        *names,
        "n_symbols",
        "__words",
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.transform("__words", lambda w: F.xxhash64(w)).alias("__hashes"),
    )
    hashed = F.transform(F.sequence(F.lit(0), F.size("__hashes") - WINDOW), lambda i: F.xxhash64(*[F.get("__hashes", i + j) for j in range(WINDOW)]))
    kept = [*names, "n_words", "word_chars", "n_symbols", "n_dup_lines"]
    no_longs, no_structs = F.expr("cast(array() as array<bigint>)"), F.expr("cast(array() as array<struct<h:bigint,i:int>>)")
    base = base.select(*kept, F.when(F.size("__hashes") >= WINDOW, hashed).otherwise(no_longs).alias("__windows"))
    twice = F.size(F.array_distinct("__windows")) < F.size("__windows")
    paired = F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    base = base.select(*kept, F.when(twice, paired).otherwise(no_structs).alias("__sorted"))
    same = lambda x, i: x["h"].eqNullSafe(F.get("__sorted", i - 1)["h"]) | x["h"].eqNullSafe(F.get("__sorted", i + 1)["h"])
    places = F.sort_array(F.transform(F.filter("__sorted", same), lambda x: x["i"]))
    base = base.select(*kept, places.alias("__places"))
    # windows overlap: each adds the words up to the next one's first, at most its own
    gaps = F.transform("__places", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("__places", i + 1) - p, F.lit(WINDOW))))
    return base.select(*kept, F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_repeat_words"))


def _per_word() -> dict[str, Column]:
    words = F.when(F.col("n_words") > 0, F.col("n_words"))
    return {"symbols": F.col("n_symbols") / words, "dup_lines": F.col("n_dup_lines") / words, "repeats": F.col("n_repeat_words") / words, "word_length": F.col("word_chars") / words}


def sketches(measured: DataFrame) -> DataFrame:
    """lang, source, n and a KLL sketch of each measure; sketches of groups can be merged further."""
    return measured.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"), *[F.kll_sketch_agg_double(v, F.lit(SKETCH_K)).alias(m) for m, v in _per_word().items()])


def limits(groups: DataFrame, least: int = LEAST, reach: float = REACH) -> DataFrame:
    """lang, source and the array of (low, high) of each measure, from the group's sketch or a merged one."""
    def quartiles(of: str) -> Column:
        return F.struct(F.kll_sketch_get_quantile_double(of, F.lit(0.25)).alias("q1"), F.kll_sketch_get_quantile_double(of, F.lit(0.75)).alias("q3"))

    sizes = {m: F.kll_sketch_get_n_double(m) for m in MEASURES}
    ready = lambda df: [F.when(sizes[m] > 0, quartiles(m)).alias(m) for m in MEASURES]  # noqa: E731, ARG005
    merged = lambda keys: groups.groupBy(*keys).agg(F.sum("n").alias("n"), *[F.kll_merge_agg_double(m, F.lit(SKETCH_K)).alias(m) for m in MEASURES])
    own = groups.select("lang", "source", "n", F.struct(*ready(groups)).alias("own"))
    by_lang = merged(["lang"])
    by_lang = by_lang.select(F.col("lang").alias("__lang"), F.col("n").alias("__n"), F.struct(*ready(by_lang)).alias("of_lang"))
    whole = merged([])
    all_docs = whole.select(*ready(whole)).first()  # one row: the limits for documents of a rare language

    def fixed(m: str) -> Column:
        q = all_docs[m]
        return F.struct(*[F.lit(None if q is None else q[k]).cast("double").alias(k) for k in ("q1", "q3")]).alias(m)

    joined = own.join(by_lang, F.col("lang").eqNullSafe(F.col("__lang")), "left").withColumn("of_all", F.struct(*map(fixed, MEASURES)))
    chosen = F.when(F.col("n") >= least, F.col("own")).when(F.col("__n") >= least, F.col("of_lang")).otherwise(F.col("of_all"))
    joined = joined.select("lang", "source", chosen.alias("__q"))
    bounds = []
    for m, floor in MEASURES.items():
        spread = F.greatest(F.col(f"__q.{m}.q3") - F.col(f"__q.{m}.q1"), F.lit(floor)) * reach
        bounds += [(F.col(f"__q.{m}.q1") - spread).alias(f"{m}_low"), (F.col(f"__q.{m}.q3") + spread).alias(f"{m}_high")]
    return joined.select("lang", "source", *bounds)


def _judged(docs: DataFrame, keys: list[str], text: str, lang: str, source: str) -> DataFrame:
    """__key0, __key1, ... for the key columns, with the measures, failed and passed."""
    kept = [F.col(f"`{c}`").alias(f"__key{i}") for i, c in enumerate(keys)]
    renamed = docs.select(*kept, F.col(f"`{text}`").alias("__text"), F.col(f"`{lang}`").alias("lang"), F.col(f"`{source}`").alias("source"))
    own = [f"__key{i}" for i in range(len(keys))]
    measured = materialize(_counts(renamed, "__text", [*own, "lang", "source"]), "quality-measures")
    bounds = materialize(limits(materialize(sketches(measured), "quality-sketches")), "quality-limits").withColumnsRenamed({"lang": "__lang", "source": "__source"})
    joined = measured.join(bounds, F.col("lang").eqNullSafe(F.col("__lang")) & F.col("source").eqNullSafe(F.col("__source")), "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    inside = F.lit(True)
    for m, value in _per_word().items():
        inside &= F.coalesce((value >= F.col(f"{m}_low")) & (value <= F.col(f"{m}_high")), F.lit(True))
    return joined.withColumn("failed", failed).withColumn("passed", ~F.col("failed") & inside)


def verdicts(docs: DataFrame, keys: list[str], text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The key columns with n_words, the four base counts, base_failed and kept, a row for each document."""
    named = [F.col(f"__key{i}").alias(c) for i, c in enumerate(keys)]
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return _judged(docs, keys, text, lang, source).select(*named, *counts, F.col("failed").alias("base_failed"), F.col("passed").alias("kept"))


def passing(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The documents that the rules keep, with all their columns.

    Whole rows are measured and carried, so neither repeated nor missing ids matter.
    """
    return _judged(docs, docs.columns, text, lang, source).filter("passed").select(*[F.col(f"__key{i}").alias(c) for i, c in enumerate(docs.columns)])
