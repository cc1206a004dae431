"""Which texts contain which terms, by an inverted index of character runs instead of a comparison of all pairs.

A term of three characters or more is looked up by its rarest trigram: the texts that
have it are its candidates, and each is verified. A shorter term is a run of its own
length, so the index of such runs, made only where there are such terms, gives its texts at
once. Case does not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.stages import written

GRAM = 3


def runs(text: Column, n: int) -> Column:
    """The distinct runs of n characters of a text."""
    places = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - (n - 1))).otherwise(F.expr("cast(array() as array<int>)"))
    return F.array_distinct(F.transform(places, lambda i: text.substr(i, F.lit(n))))


def containing(texts: DataFrame, text: str, terms: DataFrame, term: str = "term") -> DataFrame:
    """term, text: the distinct texts that contain each distinct term in any case; the empty term is in all texts, a null one in none.

    No side is broadcast by this function; adaptive execution may, after it has seen
    its size. A gram of very many texts is a skewed key of the index, which is only asked for where a
    term has no rarer one.
    """
    wanted = written(terms.select(F.col(term).alias("term")).filter("term is not null").distinct().withColumn("low", F.lower("term")), "terms")
    whole = texts.select(F.col(f"`{text}`").alias("text")).filter("text is not null").distinct()
    sizes = sorted(r[0] for r in wanted.select(F.least(F.length("low"), F.lit(GRAM))).distinct().collect())  # four values at most
    low = whole.withColumn("low", F.lower("text"))
    out = None
    for n in sizes:
        if n == 0:
            part = whole.select(F.lit("").alias("term"), "text")
        else:
            mine = wanted.filter(F.length("low") >= GRAM if n == GRAM else F.length("low") == n)
            asked = mine.select("term", "low", F.explode(runs(F.col("low"), n)).alias("gram"))
            index = low.select("text", F.col("low").alias("low_text"), F.explode(runs(F.col("low"), n)).alias("gram")).join(asked.select("gram").distinct(), "gram", "left_semi")
            if n == GRAM:
                index = written(index, "gram-index")
                often = index.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
                # a term with a gram that no text has is in no text
                asked = asked.join(often, "gram", "left").groupBy("term", "low").agg(F.min_by("gram", F.coalesce("n", F.lit(0))).alias("gram"))
            part = index.join(asked, "gram").filter(F.col("low_text").contains(F.col("low"))).select("term", "text")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else whole.select(F.col("text").alias("term"), "text").limit(0)
