"""From raw documents to a training mix: each stage reads what the one before it kept.

Nulls, empty texts, repeated rows and clashing or dotted column names are treated as each stage's operator says; an empty table stays empty through all stages.
All stages but the last return the columns of documents; the last adds mix_copy."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from brackish.llm import decontam, line_dedup, mixing, simhash, toxicity
from brackish.llm.common import scratch, settle


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once for each copy, numbered by mix_copy."""
    settle(spark)
    return mixing.mix(docs)


STAGES = [
    ("toxicity", toxicity.stage),
    ("line_dedup", line_dedup.stage),
    ("simhash_near_dedup", simhash.stage),
    ("decontamination", decontam.stage),
    ("mixing", mix),
]

#: The toxicity model and the SimHash components are beyond SQL; tests/llm checks line dedup, near dedup, decontamination and mixing by brute force, toxicity on labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = f"{scratch(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{root}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
