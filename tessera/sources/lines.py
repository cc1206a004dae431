"""Lines of text files with their place, and delimited records whose quoted fields may hold delimiters and line breaks.

A large file is read in blocks. A first pass counts each block's lines and finds in which state,
inside or outside of quotes, the block ends for either state it may begin in: a few numbers a block,
from which follow the number of its first line and the state it begins in. The second pass then reads all blocks at once.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BLOCK = "file string, start long"


def _scan(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines with the file and block they come from, in the order of the block."""
    return spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def ends_quoted(line: str, quoted: bool, delimiter: str) -> bool:
    """Whether a line that begins inside or outside of a quoted field ends inside of one.

    A field is quoted if it begins with a quote; a doubled quote inside stands for one; other quotes are text.
    """
    if '"' not in line:
        return quoted
    at, n = 0, len(line)
    begins = not quoted
    while at < n:
        if quoted:
            close = line.find('"', at)
            if close < 0:
                return True
            if line[close + 1 : close + 2] == '"':
                at = close + 2
                continue
            quoted, begins, at = False, False, close + 1
        elif begins and line[at] == '"':
            quoted, at = True, at + 1
        else:
            cut = line.find(delimiter, at)
            if cut < 0:
                return False
            begins, at = True, cut + len(delimiter)
    return quoted


class Block(NamedTuple):
    """Of a block: the number of its first line, whether it begins in quotes, and, if so, the number of the line where that record began."""

    first: int
    quoted: bool
    owner: int


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


_COUNTS = pa.schema([("file", pa.string()), ("start", pa.int64()), ("n", pa.int64()), *[(f"{what}{i}", kind) for i in (0, 1) for what, kind in (("ends", pa.bool_()), ("last", pa.int64()))]])


def _blocks(spark: SparkSession, paths: str | list[str], delimiter: str | None) -> dict[tuple[str, int], Block]:
    """All blocks of the files, in the order of their names and places; the driver holds a row for each block."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], list] = {}
        for batch in batches:
            for line, *key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                # lines, then, for a block that begins outside and inside of quotes, the state and the last line that begins a record
                x = held.setdefault(tuple(key), [0, False, -1, True, -1])
                if delimiter is not None:
                    for i in (1, 3):
                        if not x[i]:
                            x[i + 1] = x[0]
                        x[i] = ends_quoted(line, x[i], delimiter)
                x[0] += 1
        yield _arrow([(*k, *x) for k, x in held.items()], _COUNTS)

    rows = _scan(spark, paths).mapInArrow(count, f"{_BLOCK}, n long, ends0 boolean, last0 long, ends1 boolean, last1 long").orderBy("file", "start").collect()
    out: dict[tuple[str, int], Block] = {}
    line, quoted, owner, file = 0, False, 0, None
    for r in rows:
        if r["file"] != file:
            file, quoted = r["file"], False
        out[r["file"], r["start"]] = Block(line, quoted, owner)
        ends, last = (r["ends1"], r["last1"]) if quoted else (r["ends0"], r["last0"])
        if last >= 0:
            owner = line + last
        quoted = ends
        line += r["n"]
    return out


def numbered_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """ord, value: the lines of text files, numbered in the order of the files' names and of their places."""
    known = spark.sparkContext.broadcast({k: b.first for k, b in _blocks(spark, paths, None).items()})

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: dict[tuple[str, int], int] = {}
        for batch in batches:
            out = []
            for key in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                out.append(at.setdefault(key, known.value[key]))
                at[key] += 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64()), batch.column(0)], names=["ord", "value"])

    return _scan(spark, paths).mapInArrow(number, "ord long, value string")


_PIECES = pa.schema([("ord", pa.int64()), ("piece", pa.int64()), ("text", pa.string()), ("cells", pa.list_(pa.string()))])


def _cells(text: str, delimiter: str) -> list[str]:
    csv.field_size_limit(1 << 31)
    return next(csv.reader(text.splitlines(keepends=True) if "\n" in text else [text], delimiter=delimiter), [])


def quoted_records(spark: SparkSession, paths: str | list[str], delimiter: str = "\t") -> DataFrame:
    """ord, cells: the records of delimited files without a header, each with as many cells as it has; ord is the number of its first line.

    A record goes on over lines while it is in quotes; its line breaks are read as line
    feeds. One that goes on into other blocks is put together from their pieces, of which a
    block has two at most. Quotes that never close take the rest of their file, as one record.
    """
    known = spark.sparkContext.broadcast(_blocks(spark, paths, delimiter))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: tuple[str, int] | None = None
        at, quoted, owner, piece, held = 0, False, 0, 0, []
        for batch in batches:
            out: list[tuple] = []
            for line, *now in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if tuple(now) != key:
                    if held:
                        out.append((owner, piece, "\n".join(held), None))
                    key, held = tuple(now), []
                    at, quoted, owner = known.value[key]
                    foreign = quoted
                if not held:
                    piece = at
                    if not quoted:
                        owner, foreign = at, False
                held.append(line)
                quoted = ends_quoted(line, quoted, delimiter)
                at += 1
                if not quoted:
                    text = "\n".join(held)
                    out.append((owner, piece, text, None) if foreign else (owner, piece, None, _cells(text, delimiter)))
                    held = []
            yield _arrow(out, _PIECES)
        if held:
            yield _arrow([(owner, piece, "\n".join(held), None)], _PIECES)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [_cells("\n".join(p["text"] for p in pieces), delimiter) for pieces in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cells, pa.list_(pa.string()))], names=["ord", "cells"])

    each = _scan(spark, paths).mapInArrow(cut, "ord long, piece long, text string, cells array<string>")
    torn = each.filter("text is not null").groupBy("ord").agg(F.array_sort(F.collect_list(F.struct("piece", "text"))).alias("pieces")).mapInArrow(join, "ord long, cells array<string>")
    return each.filter("text is null").select("ord", "cells").unionByName(torn)
