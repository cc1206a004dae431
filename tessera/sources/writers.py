"""Writers: CSV exports with or without a byte-order mark, graph load files, JSON reports. Parquet is the native store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, bom: bool = False) -> None:
    """A folder of CSV files with headers; nulls are blank. With bom, the first column's name begins with the mark, as a file that has one reads."""
    flat = df.select(*[F.array_join(c, ", ").alias(c) if t.startswith("array") else F.col(f"`{c}`") for c, t in df.dtypes])
    if bom and flat.columns:
        flat = flat.withColumnRenamed(flat.columns[0], "﻿" + flat.columns[0])
    flat.write.mode("overwrite").csv(path, header=True, quote='"', escape='"', nullValue="", emptyValue="")


def write_nodes(nodes: DataFrame, path: str, id_col: str, types: dict[str, str]) -> None:
    """Nodes with typed headers: name:ID for the id, name:type for the others."""
    write_csv(nodes.select(F.col(id_col).alias(f"{id_col}:ID"), *[F.col(c).alias(f"{c}:{t}") for c, t in types.items()]), path)


def write_edges(edges: DataFrame, path: str, kind: str, props: Sequence[str] = ()) -> None:
    """Edges with :START_ID, :END_ID, :TYPE and typed properties; an empty table gives a header only."""
    write_csv(edges.select(F.col("src").alias(":START_ID"), F.col("dst").alias(":END_ID"), F.lit(kind).alias(":TYPE"), *[F.col(p).alias(f"{p}:string") for p in props]), path)


def write_former_names(found: DataFrame, path: str) -> None:
    """ID, ACN and MatchedNames, a comma list, of the companies found in a register (companyID, ACN, names)."""
    write_csv(found.select(F.col("companyID").alias("ID"), "ACN", F.array_join("names", ",").alias("MatchedNames")), path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path, ignoreNullFields=False)
