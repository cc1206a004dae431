"""Matches of streamed names, micro-batch by micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tessera.functions.text import normalize_name
from tessera.operators.matching import match, prepared


def match_stream(names: DataFrame, known: DataFrame, path: str, checkpoint: str, name: str = "name", order: str = "ord") -> StreamingQuery:
    """Append the matches of a stream's names to Parquet below path; a batch that runs again replaces its own folder.

    known is matched as it is when a batch begins.
    """
    right = prepared(known, name, order)

    def one(batch: DataFrame, number: int) -> None:
        left = batch.select(normalize_name(name).alias("norm")).filter("norm <> ''").distinct()
        match(left, right).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return names.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
