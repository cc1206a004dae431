"""What depends on row order, made explicit: keep-first, last-wins, dense ids, source precedence, tiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.stages import written


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in the given order. The rank limit is pushed below the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__kept_first", rank).filter("__kept_first = 1").drop("__kept_first")


def last_wins(df: DataFrame, keys: Sequence[str], value: str, order: str, alias: str) -> DataFrame:
    """key -> value of its last row, as a dictionary that is filled in order would have it."""
    return df.groupBy(*keys).agg(F.max_by(value, order).alias(alias))


def first_wins(df: DataFrame, keys: Sequence[str], value: str, order: str, alias: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min_by(value, order).alias(alias))


def dense_ids(df: DataFrame, order: Sequence[str | Column], prefix: str = "", alias: str = "id", range_partitions: int | None = None) -> DataFrame:
    """prefix1, prefix2, ... by the order, without a single-partition window.

    Rows are range-partitioned by the order, each partition is counted, and its
    rows are numbered from the sum of the counts before it. The order must be total.
    The dealt rows are written to the shared folder, so that counts and numbers see
    one dealing, whatever executors are lost between.
    """
    spark = df.sparkSession
    parts = range_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("__key", F.struct(*[c if isinstance(c, Column) else F.col(f"`{c}`") for c in order]))
    dealt = keyed.repartitionByRange(parts, "__key").withColumn("__part", F.spark_partition_id())
    dealt = written(dealt, "ids")
    counts = dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    # one row for each partition: their number is fixed, so this window stays small
    before = counts.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    numbered = dealt.withColumn("__row", F.row_number().over(Window.partitionBy("__part").orderBy("__key")))
    out = numbered.join(F.broadcast(before), "__part").withColumn("__id", F.col("__before") + F.col("__row"))
    named = F.concat(F.lit(prefix), F.col("__id").cast("string")) if prefix else F.col("__id")
    return out.withColumn(alias, named).drop("__key", "__part", "__before", "__row", "__id")


def union_keep_first(sources: Sequence[DataFrame], key: str, order: str) -> DataFrame:
    """Rows of all sources, of each key the first by (source, order); blank keys go."""
    tagged = [s.withColumn("__source", F.lit(i)) for i, s in enumerate(sources)]
    whole = tagged[0]
    for s in tagged[1:]:
        whole = whole.unionByName(s, allowMissingColumns=True)
    return keep_first(whole.filter(F.col(key).isNotNull() & (F.col(key).cast("string") != "")), [key], ["__source", order]).drop("__source")


def union_first_source(sources: Sequence[DataFrame], key: str) -> DataFrame:
    """Of each key all rows of the first source that has it; repeats within that source stay."""
    whole = None
    for i, s in enumerate(sources):
        s = s.withColumn("__source", F.lit(i))
        whole = s if whole is None else whole.unionByName(s, allowMissingColumns=True)
    first = F.min("__source").over(Window.partitionBy(key))
    return whole.withColumn("__first", first).filter("__source = __first").drop("__source", "__first")


def tiered_order(value: str, fallback: str, rank: Column, order: str) -> list[Column]:
    """Rows with a value first, by rank and falling value; the rest by rank and falling fallback; then the order."""
    has = F.col(value).isNotNull() & (F.col(value) != 0)
    return [F.when(has, 0).otherwise(1).asc(), rank.asc_nulls_last(), F.when(has, F.col(value)).otherwise(F.col(fallback)).desc_nulls_last(), F.col(order).asc()]


def list_rank(value: str | Column, names: Sequence[str]) -> Column:
    """Place of a value in a list; null for others."""
    c = F.col(value) if isinstance(value, str) else value
    return F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(i))])[c]
