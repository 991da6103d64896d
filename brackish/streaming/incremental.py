"""Incremental forms: counts are additive, so models and tables grow by micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import sequence as S


def append_word_counts(refs: DataFrame, table: str, checkpoint: str, k: int = 8) -> StreamingQuery:
    """Each micro-batch's (batch, word, lineage, m), written under its number, so that a repeated batch replaces itself; a model is their sum."""

    def put(batch: DataFrame, number: int) -> None:
        words = batch.select("lineage", F.explode(S.words(F.col("seq"), k)).alias("word")).groupBy("word", "lineage").agg(F.count("*").alias("m"))
        words.write.mode("overwrite").parquet(f"{table}/batch={number}")

    return refs.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def step_durations(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """Start and end events of a step (ts, step, kind) -> windowed counts and spans, with a watermark for late ones."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", "1 hour"), "step").agg(F.min(F.when(F.col("kind") == "start", F.col("ts"))).alias("started"), F.max(F.when(F.col("kind") == "end", F.col("ts"))).alias("ended"))
