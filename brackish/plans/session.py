"""Session helpers."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession) -> str:
    """The shared folder the cluster names; a local one only where none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = tempfile.mkdtemp(prefix="brackish-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def written(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Cuts lineage by a Parquet table in the shared folder, in folders by the columns `by`."""
    path = f"{scratch(df.sparkSession).rstrip('/')}/brackish-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle(spark: SparkSession) -> None:
    """Lets the driver drop finished queries, so that Spark's cleaner removes their shuffle files now."""
    gc.collect()
    spark._jvm.java.lang.System.gc()
