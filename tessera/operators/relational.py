"""Projections, filters, joins, aggregates and set operations that the pipelines share."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# -- projections ---------------------------------------------------------------
def fixed_columns(df: DataFrame, columns: Sequence[str], default: str = "") -> DataFrame:
    """Exactly these columns, as strings; what is missing or null gets the default."""
    have = set(df.columns)
    return df.select(*[(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(default)) if c in have else F.lit(default)).alias(c) for c in columns])


def ensure_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """These columns in this order, null where df has none."""
    have = set(df.columns)
    return df.select(*[F.col(f"`{c}`") if c in have else F.lit(None).cast("string").alias(c) for c in columns])


def rename_if_count(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """New names by position, only if there are as many."""
    return df.toDF(*names) if len(names) == len(df.columns) else df


def upper_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def move_column(df: DataFrame, column: str, to: str, drop_target: bool = False) -> DataFrame:
    """The column put where ``to`` stands."""
    rest = [c for c in df.columns if c != column]
    at = rest.index(to)
    rest.insert(at, column)
    return df.select(*[f"`{c}`" for c in rest if not (drop_target and c == to)])


def fill_from(column: str, other: str, blank: bool = False) -> Column:
    """The column, or the other one where it is null (or blank)."""
    c = F.col(column)
    empty = c.isNull() | (F.trim(c.cast("string")) == "") if blank else c.isNull()
    return F.when(empty, F.col(other)).otherwise(c)


# -- filters --------------------------------------------------------------------
def without_unlisted(df: DataFrame, country: str, home: str, values: Sequence[str]) -> DataFrame:
    """Drops rows of another country (or none) all of whose values are null."""
    none = F.lit(True)
    for v in values:
        none = none & F.col(v).isNull()
    return df.filter(~(~F.col(country).eqNullSafe(home) & none))


def non_blank(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull() & (F.col(column) != ""))


def differing(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows whose two columns differ, null counting as a value, and whose first is known."""
    return df.filter(~F.col(a).eqNullSafe(F.col(b)) & F.col(a).isNotNull())


# -- joins ----------------------------------------------------------------------
def enrich(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join that takes only the columns of the right that the left lacks."""
    return left.join(right.drop(*[c for c in right.columns if c in left.columns and c != key]), key, "left")


def append_unmatched(left: DataFrame, right: DataFrame, key: str, tag: str, value: str) -> DataFrame:
    """left, and the rows of right whose key it lacks, tagged."""
    extra = right.join(left.select(key).distinct(), key, "left_anti").withColumn(tag, F.lit(value))
    return left.unionByName(extra, allowMissingColumns=True)


def finest_level(levels: Sequence[str | Column]) -> Column:
    """The first level, finest first, that is not blank."""
    cols = [F.col(c) if isinstance(c, str) else c for c in levels]
    return F.coalesce(*[F.when(F.trim(c.cast("string")) != "", F.trim(c.cast("string"))) for c in cols])


def first_hit(variants: DataFrame, lookup: DataFrame, key: str, variant: str, priority: str, value: str) -> DataFrame:
    """key -> value of the first variant, by priority, that the lookup holds."""
    return variants.join(lookup, variant).groupBy(key).agg(F.min_by(value, priority).alias(value))


# -- aggregates -------------------------------------------------------------------
def sorted_concat(column: str | Column, sep: str = ", ") -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.array_join(F.array_sort(F.collect_set(c.cast("string"))), sep)


def ordered_list(value: str, order: str) -> Column:
    """Values in order, repeats kept."""
    return F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))), lambda x: x["v"])


def pivot_concat(df: DataFrame, key: str, kind: str, value: str, kinds: Sequence[str], sep: str = ",") -> DataFrame:
    """For each key a column of each kind with its distinct values, sorted; kinds match in lower case without blanks around."""
    tidy = df.withColumn("__kind", F.lower(F.trim(F.col(kind).cast("string"))))
    return tidy.filter(F.col("__kind").isin(*kinds)).groupBy(key).agg(*[F.nullif(sorted_concat(F.when(F.col("__kind") == k, F.col(value)), sep), F.lit("")).alias(k) for k in kinds])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def weighted_jaccard(roles: DataFrame, entity: str, item: str, role: str, weights: Mapping[str, float], other: float, pairs: DataFrame) -> DataFrame:
    """a, b, similarity: the sum of lesser over the sum of greater item weights; an item's weight is its best role's.

    pairs has the columns a and b. Only items of entities in pairs are joined.
    """
    weight = F.coalesce(F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(v))])[F.col(role)], F.lit(other))
    best = roles.groupBy(F.col(entity).alias("e"), F.col(item).alias("i")).agg(F.max(weight).alias("w"))
    sides = pairs.distinct().select("a", "b", F.explode(F.array(F.struct(F.lit(0).alias("s"), F.col("a").alias("e")), F.struct(F.lit(1).alias("s"), F.col("b").alias("e")))).alias("x")).select("a", "b", "x.s", "x.e")
    met = sides.join(best, "e").groupBy("a", "b", "i").agg(F.coalesce(F.max(F.when(F.col("s") == 0, F.col("w"))), F.lit(0.0)).alias("x"), F.coalesce(F.max(F.when(F.col("s") == 1, F.col("w"))), F.lit(0.0)).alias("y"))
    return met.groupBy("a", "b").agg((F.sum(F.least("x", "y")) / F.sum(F.greatest("x", "y"))).alias("similarity"))
