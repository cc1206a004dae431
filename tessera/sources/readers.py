"""Readers: GeoJSON, CSV, positional TSV, shapefiles, lookup tables. All read through Spark, so any store works."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessera.sources.lines import numbered_lines, quoted_records
from tessera.sources.shapefiles import shapefile

__all__ = ["PROPERTIES", "csv_folders", "csv_or_none", "csv_strings", "exists", "geojson_points", "lookup_pairs", "register_tsv", "search_terms", "shapefile"]

PROPERTIES = (
    "ENO", "DEPOSIT_NAME", "SYNONYMS", "STATE", "LONG_GDA94", "LAT_GDA94", "ACCURACY_M", "OPERATING_STATUS", "COMMODITY_CODES", "COMMODITY_NAMES",
    "COMPANIES", "COMPANY_WEBSITES", "PROVINCES", "GEOLOGIC_AGE", "DEPOSIT_MODEL",
)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path, or a file of that pattern, is there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(target)
    return found is not None and len(found) > 0


def geojson_points(spark: SparkSession, path: str, properties: Sequence[str] = PROPERTIES, by_line: bool = False) -> DataFrame:
    """A row for each feature: its properties as strings, longitude and latitude, and ord, its place.

    A document is read by one task. With by_line, each feature has a line of its own,
    as writers of large files lay them out (a comma may follow it; lines that are no
    feature are left out), and a file is read by many tasks; ord then counts lines, over all files of the path.
    """
    fields = ", ".join(f"`{p}`: string" for p in properties)
    feature = f"struct<type: string, properties: struct<{fields}>, geometry: struct<coordinates: array<double>>>"
    if by_line:
        lines = numbered_lines(spark, path)
        each = lines.select("ord", F.from_json(F.regexp_replace("value", r"^\ufeff|,\s*$", ""), feature).alias("f")).filter("f.type = 'Feature'")
    else:
        raw = spark.read.text(path, wholetext=True).select(F.from_json(F.regexp_replace("value", "^\ufeff", ""), f"features array<{feature}>").alias("j"))
        each = raw.select(F.posexplode("j.features").alias("ord", "f"))
    at = lambda i: F.get(F.col("f.geometry.coordinates"), F.lit(i))
    return each.select(*[F.col(f"f.properties.{p}").alias(p) for p in properties], at(0).alias("longitude"), at(1).alias("latitude"), "ord")


def csv_strings(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A CSV file with a header, all columns as strings, blanks as null, a byte-order mark left out; only the named columns if given."""
    df = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', inferSchema=False)
    df = df.toDF(*[c.lstrip("﻿") for c in df.columns])
    return df.select(*[f"`{c}`" for c in columns]) if columns else df


def csv_or_none(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame | None:
    """As csv_strings; None where there is no such file."""
    return csv_strings(spark, path, columns) if exists(spark, path) else None


def csv_folders(spark: SparkSession, folders: Sequence[str], needed: str) -> DataFrame | None:
    """CSV files of folders, by the sorted names within each, with file_rank and file_row; files without the needed column are left out.

    One scan gives the headers of all files, and one more reads the files of each
    header that occurs: the plan grows with different headers, not with files. A file's rank
    comes from a table of paths, and file_row orders the rows of a file. A header is one line.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    places = []
    for folder in folders:
        target = jvm.org.apache.hadoop.fs.Path(folder)
        places.append(_place(target.getFileSystem(conf).makeQualified(target).toUri().toString()))
    patterns = [f"{f}/*.csv" for f in folders if exists(spark, f"{f}/*.csv")]
    if not patterns:
        return None
    lines = spark.read.text(patterns).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row"))
    heads = lines.filter("start = 0").groupBy("file").agg(F.min_by("value", "row").alias("head")).collect()
    order = sorted((places.index(_place(r["file"]).rpartition("/")[0]), r["file"], r["head"]) for r in heads)  # a row for each file
    by_head: dict[tuple[str, ...], list[tuple[str, int]]] = {}
    for rank, (_, file, head) in enumerate(order):
        names = tuple(next(csv.reader([head.lstrip("\ufeff")])))
        if needed in names:
            by_head.setdefault(names, []).append((file, rank))
    ranks = spark.createDataFrame([x for files in by_head.values() for x in files], "__file string, file_rank int") if by_head else None
    out = None
    for names, files in by_head.items():
        schema = StructType([StructField(n, StringType()) for n in names])
        df = spark.read.schema(schema).csv([unquote(f) for f, _ in files], header=True, multiLine=True, quote='"', escape='"')
        df = df.select("*", F.col("_metadata.file_path").alias("__file"), F.monotonically_increasing_id().alias("file_row"))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return None if out is None else out.join(F.broadcast(ranks), "__file").drop("__file")  # as long as the list of files that the driver holds


def _place(uri: str) -> str:
    """A path's scheme, host and place in one spelling."""
    parts = urlsplit(uri)
    return f"{parts.scheme}://{parts.netloc}{parts.path.rstrip('/')}"


def register_tsv(spark: SparkSession, path: str) -> DataFrame:
    """ord, name, acn, previous and n_columns of a ragged tab-separated register without a header, fields of which may be quoted.

    ord is the number of a record's first line. Records of one column are left out.
    """
    cells = quoted_records(spark, path).filter(F.size("cells") >= 2)
    plain = lambda i: F.trim(F.coalesce(F.get("cells", F.lit(i)), F.lit("")))
    return cells.select("ord", plain(0).alias("name"), plain(1).alias("acn"), plain(13).alias("previous"), F.size("cells").alias("n_columns"))


def lookup_pairs(df: DataFrame, a: str, b: str, order: str) -> tuple[DataFrame, DataFrame]:
    """(symbol -> name, name -> symbol) of a two-column table: the shorter text is the symbol; the last row of a key wins."""
    x, y = F.trim(F.col(a)), F.trim(F.col(b))
    pairs = df.filter((F.coalesce(x, F.lit("")) != "") & (F.coalesce(y, F.lit("")) != "")).select(
        F.when(F.length(x) <= F.length(y), x).otherwise(y).alias("symbol"), F.when(F.length(x) <= F.length(y), y).otherwise(x).alias("name"), F.col(order).alias("o")
    )
    last = lambda k, v: pairs.groupBy(k).agg(F.max_by(v, "o").alias(v))
    return last("symbol", "name"), last("name", "symbol")


def search_terms(spark: SparkSession, folder: str) -> DataFrame:
    """term and file: the first column of every CSV file of a folder, which has no header."""
    df = spark.read.csv(f"{folder}/*.csv", header=False)
    return df.select(F.trim(F.col(df.columns[0])).alias("term"), F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file")).filter("term <> ''")
