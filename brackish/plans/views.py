"""The test tables as canonical views, and the same views in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ALPHABET, DNA = "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def reads(spark: SparkSession, d: str) -> DataFrame:
    """Whole texts as sequences."""
    seq = F.translate(F.regexp_replace(F.lower("text"), "[^a-z]", ""), ALPHABET, DNA)
    return table(spark, d, "documents").select(F.col("doc_id").alias("seq_id"), F.col("source").alias("sample"), seq.alias("seq"))


def pieces(spark: SparkSession, d: str, size: int = 250) -> DataFrame:
    """Whole texts in pieces of `size` letters, the last one shorter; for operators that take reads of one length."""
    r = reads(spark, d).where(F.length("seq") > 0)
    at = r.select("sample", "seq_id", "seq", F.explode(F.sequence(F.lit(0), F.floor((F.length("seq") - 1) / size).cast("int"))).alias("i"))
    return at.select((F.col("seq_id") * 1_000_000 + F.col("i")).alias("seq_id"), "sample", F.substring("seq", F.col("i") * size + 1, F.lit(size)).alias("seq"))


def refs(spark: SparkSession, d: str) -> DataFrame:
    docs, labels = table(spark, d, "documents").select("doc_id", "lang", "source"), table(spark, d, "labels")
    lin = F.concat(F.lit("Root;"), F.col("lang"), F.lit(";"), F.col("source"), F.lit(";q"), F.col("quality").cast("string"))
    tax = docs.join(labels, "doc_id").select(F.col("doc_id").alias("seq_id"), lin.alias("lineage"))
    return reads(spark, d).join(tax, "seq_id")


def counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("feature_id"), F.concat(F.lit("S"), (F.col("l_suppkey") % 12).cast("string")).alias("sample")).agg(F.sum("l_quantity").cast("long").alias("count"))


def taxonomy(spark: SparkSession, d: str) -> DataFrame:
    full = F.split(F.concat_ws(";", F.lit("Bacteria"), "p_type", "p_brand", F.concat(F.lit("size"), F.col("p_size").cast("string")), "p_name"), ";")
    return table(spark, d, "part").select(F.col("p_partkey").alias("feature_id"), F.slice(full, F.lit(1), (1 + F.col("p_partkey") % 5).cast("int")).alias("lineage"))


def membership(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(F.col("p_partkey").alias("member_id"), (F.col("p_partkey") - F.col("p_partkey") % 10).alias("centroid_id"))


def metadata(spark: SparkSession, d: str) -> DataFrame:
    return counts(spark, d).select("sample").distinct().withColumn("site", F.when(F.substring("sample", 2, 9).cast("int") % 2 == 0, "nose").otherwise("pharynx"))


READS = f"reads AS (SELECT doc_id AS seq_id, source AS sample, translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), '{ALPHABET}', '{DNA}') AS seq FROM documents)"
PIECES = READS + ", pieces AS (SELECT seq_id * 1000000 + i AS seq_id, substr(seq, i * 250 + 1, 250) AS seq FROM (SELECT seq_id, seq, unnest(range(0, (length(seq) + 249) // 250)) AS i FROM reads))"
REFS = READS + ", refs AS (SELECT r.seq_id, r.sample, r.seq, concat('Root;', d.lang, ';', d.source, ';q', l.quality) AS lineage FROM reads r JOIN documents d ON d.doc_id = r.seq_id JOIN labels l ON l.doc_id = r.seq_id)"
COUNTS = "counts AS (SELECT l_partkey AS feature_id, concat('S', l_suppkey % 12) AS sample, CAST(sum(l_quantity) AS BIGINT) AS count FROM lineitem GROUP BY ALL)"
TAX = "tax AS (SELECT p_partkey AS feature_id, list_slice(['Bacteria', p_type, p_brand, concat('size', p_size), p_name], 1, 1 + p_partkey % 5) AS lineage FROM part)"
