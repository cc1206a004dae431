"""One query for each operator of this subpackage, over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import bpe, decontaminate, filter_audit, jaccard, line_dedup, quality, search, secrets, simhash, suffix_dedup, token_counts, toxicity, warc
from tessera.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES", "table", "tokenizer"]


def tokenizer(name: str) -> str:
    """The place of a public vocabulary file; TESSERA_TOKENIZERS names their folder where the package of files is not installed."""
    folder = os.environ.get("TESSERA_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.documents_round_trip(spark, table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op2_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.document_components(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.document_secrets(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.document_counts(table(spark, sf_dir, "documents"), bpe.read_spec(tokenizer("byte_bpe_50k.json")))


def op5_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.pages_round_trip(table(spark, sf_dir, "pages")).drop("url")


def op6_benchmark_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(table(spark, sf_dir, "documents"), ["doc_id"])


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.document_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.document_lines(table(spark, sf_dir, "documents"))


def op10_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.document_repeats(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.document_components(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe_round_trip": op1_bpe_round_trip,
    "op2_jaccard_components": op2_jaccard_components,
    "op3_secret_scan": op3_secret_scan,
    "op4_token_counts": op4_token_counts,
    "op5_warc_round_trip": op5_warc_round_trip,
    "op6_benchmark_matches": op6_benchmark_matches,
    "op7_quality_rules": op7_quality_rules,
    "op8_toxicity": op8_toxicity,
    "op9_line_dedup": op9_line_dedup,
    "op10_suffix_repeats": op10_suffix_repeats,
    "op11_filter_audit": op11_filter_audit,
    "op12_ranked_search": op12_ranked_search,
    "op13_simhash_components": op13_simhash_components,
}
