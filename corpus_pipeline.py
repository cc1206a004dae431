"""From raw documents to token ids: five stages, each of one operator, each written as Parquet and read again.

Defined cases: null and empty texts have too few words, so the first stage drops
them; documents without an id pass all stages by their texts alone; of rows that
repeat id and text, one is left after the third stage; an empty table gives an
empty result with the same columns; further columns of the input go on to the last
stage, whatever their names; a text of any length is one row throughout; of lines and
near copies that tie, the one of the smaller id stays. The tables that a stage has used are
deleted when the next one of its thread begins, unless that one's input still reads them.
"""

from __future__ import annotations

import re
import threading
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import bpe, decontaminate, jaccard, line_dedup, quality
from tessera.llm.queries import table, tokenizer
from tessera.llm.shared import materialize, recorded, release, release_paths

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


class _Left(threading.local):
    """Tables that the stages of this thread have left for results yet to be written, by session."""

    def __init__(self) -> None:
        self.paths: dict[int, list[str]] = {}


_LEFT = _Left()


def _read_by(docs: DataFrame, paths: list[str]) -> list[str]:
    """Those of the paths that a table's plan still reads."""
    plain = lambda path: re.sub("^file:/+", "/", path)
    files = [plain(f) for f in docs.inputFiles()] if paths else []
    return [p for p in paths if any(f.startswith(plain(p)) for f in files)]


def _stage(f: Stage) -> Stage:
    """A stage that first deletes what the stages before it have left, but for what its own input still reads: stages may be chained without a write between."""
    @wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        before = _LEFT.paths.pop(id(spark), [])
        kept = _read_by(docs, before)
        release_paths([p for p in before if p not in kept])
        with recorded() as made:
            out = f(spark, docs, sf_dir)
        _LEFT.paths[id(spark)] = kept + made
        return out

    return run_stage


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.passing(docs)


@_stage
def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat earlier ones."""
    return line_dedup.deduplicated(docs)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.keep_one(docs)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


@_stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document left, with digests of the ids and of their decoding."""
    spec = bpe.read_spec(tokenizer("word_bpe_49k.json"))
    return bpe.digest(docs.select("doc_id", "text"), spec, packed="ids").select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_deduplication),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", tokens),
]

#: Merges, edit distances and components are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{i + 1}")
            release(before)
    return docs
