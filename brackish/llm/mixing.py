"""Mixing sources to target weights by systematic sampling.

Every document of a source expects the same number of copies, target / source_size.  Documents are
laid out by size within their source, the expected copies are prefix-summed along that order, one random
offset per source is added, and a document is emitted once for each integer boundary that its
interval crosses.  The layout by size makes the sample an implicitly stratified one, so the words taken lie
near the target even though whole documents are taken.

The prefix sum needs no task that sees a whole source: a document's position is its rank within a
(source, size bin, salt) cell plus the number of documents in earlier cells, and those counts come
from a small aggregate (at most 256 salts a bin, some hundreds of bins a source).

Edge cases: a null text has size 0; a null source is a source of its own, ordered last; a source without
words has target 0 and takes nothing; rows equal in source, size and id are interchangeable; an empty table gives
an empty result.  Input columns other than the named ones are ignored by `plan` and kept by `mix`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import column, n_words, table, written

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"


def _hex_fraction(digits):
    return F.conv(digits, 16, 10).cast("double") / F.lit(4294967296.0)


def targets(sources: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(src, source_size) -> + target.  Weighted shares of all words; a target stops at max_epochs times
    its source and the excess is shared again by weight.  Solved in closed form: in order of cap / weight the
    capped sources are a prefix, and the level of the others follows from prefix sums.  One row a source."""
    by_src = Window.orderBy("src")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(by_src) - 1) % len(weights) + 1).cast("int"))
    every = Window.partitionBy()
    order = Window.orderBy("ratio", "src")
    lvl = (F.col("total") - F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("double")) / F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    return (
        sources.withColumn("w", w)
        .withColumn("cap", F.col("source_size") * max_epochs)
        .withColumn("total", F.sum("source_size").over(every).cast("double"))
        .withColumn("ratio", F.col("cap").cast("double") / F.col("w"))
        .withColumn("here", lvl)
        .withColumn("level", F.min(F.when(F.col("here") <= F.col("ratio"), F.struct("ratio", "src", "here"))).over(every)["here"])
        .select("src", "source_size", F.least(F.col("cap").cast("double"), F.coalesce(F.col("level"), F.lit(0.0)) * F.col("w")).alias("target"))
    )


def plan(docs: DataFrame, *, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS, max_epochs=MAX_EPOCHS, seed=SEED, carry: list[str] = ()) -> DataFrame:
    """One row a document: id, size, source_size, target, copies, taken, and the carried columns as a struct `row`."""
    size = n_words(column(text_col))
    bits = F.length(F.bin("size"))
    rows = (
        docs.select(
            column(id_col).alias("doc_id"),
            F.coalesce(F.concat(F.lit("0"), column(source_col).cast("string")), F.lit("1")).alias("src"),
            size.alias("size"),
            *([F.struct(*[column(c) for c in carry]).alias("row")] if carry else []),
        )
        .withColumn("h", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
        .withColumn("bin", (bits * 16 + F.expr("shiftright(size * 8, length(bin(size)) - 1)")).cast("int"))
        .withColumn("salt", F.substring("h", 1, 2))
    )
    cells = written(rows.groupBy("src", "bin", "salt").agg(F.count("*").alias("n"), F.sum("size").alias("words")), "mix-cells")
    bins = cells.groupBy("src", "bin").agg(F.sum("n").alias("bin_n"), F.sum("words").alias("words"))
    sources = bins.groupBy("src").agg(F.sum("words").alias("source_size"))
    before = (Window.unboundedPreceding, -1)
    bins = bins.select("src", "bin", F.coalesce(F.sum("bin_n").over(Window.partitionBy("src").orderBy("bin").rowsBetween(*before)), F.lit(0)).alias("bin_base"))
    cells = cells.select("src", "bin", "salt", F.coalesce(F.sum("n").over(Window.partitionBy("src", "bin").orderBy("salt").rowsBetween(*before)), F.lit(0)).alias("salt_base"))
    goal = targets(sources, weights, max_epochs).withColumn("u", _hex_fraction(F.substring(F.md5(F.concat(F.lit(seed), F.col("src")).cast("binary")), 1, 8)))
    cells = cells.join(bins, ["src", "bin"]).join(goal, "src")
    at = Window.partitionBy("src", "bin", "salt").orderBy("size", "h", "doc_id", *(["tie"] if carry else []))
    if carry:
        rows = rows.withColumn("tie", F.xxhash64("row"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    ranked = rows.withColumn("rank_in", F.row_number().over(at)).join(cells, ["src", "bin", "salt"]).withColumn("rank", F.col("rank_in") + F.col("bin_base") + F.col("salt_base")).withColumn("rate", rate)
    copies = (F.floor(F.col("u") + F.col("rate") * F.col("rank")) - F.floor(F.col("u") + F.col("rate") * (F.col("rank") - 1))).cast("long")
    return ranked.withColumn("copies", copies).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", *(["row"] if carry else []))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every document's row once for each copy, with `mix_copy` counting from 1 (it replaces an input column of that name in any case)."""
    names = [c for c in docs.columns if c.lower() != "mix_copy"]
    out = plan(docs.select(*[column(c) for c in names]), carry=names, **options)
    return out.where("copies > 0").select(*[F.col("row")[c].alias(c) for c in names], F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("mix_copy"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def sql(docs: str = "documents") -> str:
    """DuckDB: the same rows as `query` over the named relation."""
    return rf"""
    WITH r AS (SELECT doc_id, coalesce('0' || source, '1') AS src, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '')) AS h FROM {docs}),
    b AS (SELECT *, length(bin(size)) * 16 + ((size * 8) >> (length(bin(size)) - 1)::INT) AS sbin, substr(h, 1, 2) AS salt FROM r),
    s AS (SELECT src, sum(size)::BIGINT AS source_size FROM b GROUP BY src),
    w AS (SELECT src, source_size, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY src) - 1) % 3 + 1)::INT] AS w, source_size * 3 AS cap, (sum(source_size) OVER ())::DOUBLE AS total FROM s),
    l AS (SELECT *, cap::DOUBLE / w AS ratio, (total - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / w, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE) / sum(w) OVER (ORDER BY cap::DOUBLE / w, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS here FROM w),
    v AS (SELECT coalesce(first(here ORDER BY ratio, src), 0.0) AS level FROM l WHERE here <= ratio),
    t AS (SELECT src, source_size, least(cap::DOUBLE, level * w) AS target, ('0x' || substr(md5('{SEED}' || src), 1, 8))::BIGINT::DOUBLE / 4294967296.0 AS u FROM l, v),
    k AS (SELECT b.*, row_number() OVER (PARTITION BY src ORDER BY sbin, salt, size, h, doc_id) AS rank FROM b),
    c AS (SELECT doc_id, size, t.source_size, target, u, rank, CASE WHEN t.source_size > 0 THEN target / t.source_size ELSE 0.0 END AS rate FROM k JOIN t USING (src))
    SELECT doc_id, size, source_size, target, ((floor(u + rate * rank) - floor(u + rate * (rank - 1)))::BIGINT * size)::BIGINT AS taken, (floor(u + rate * rank) - floor(u + rate * (rank - 1)))::BIGINT AS copies FROM c"""
