"""Numbers in order lose no row, however a plan's ranges are merged."""

import pytest
from pyspark.sql import functions as F

from brackish.operators import counts


@pytest.mark.parametrize("lexical", [False, True])
def test_numbers_of_rows_in_several_ranges(spark, lexical):
    small = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    was = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        seq = F.when(F.col("id") != 77, F.concat(F.sha2(F.col("id").cast("string"), 256), F.repeat(F.lit("x"), (F.col("id") % 97).cast("int"))))
        reads = spark.range(1, 12001, numPartitions=8).select(F.col("id").alias("seq_id"), seq.alias("seq"))
        got = counts.unique_sequences(reads, lexical=lexical).toPandas()
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    got = got.sort_values("seq" if lexical else "first_id", na_position="last")
    assert len(got) == 12000 and got.columns.tolist() == ["seq", "first_id", "n_reads", "unique_id"]
    assert got["unique_id"].tolist() == [f"unique_{i}" if lexical else f"uniq_{i:05d}" for i in range(1, 12001)]
