"""Relational operators over long count tables (feature_id, sample, count) and sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lineage as L
from ..functions import sequence as S
from ..plans.session import written


def numbered(df: DataFrame, order: list[Column], name: str, fmt: str | None = None) -> DataFrame:
    """Sequential numbers from 1 in a total order (null last), without one task for all rows: ranges are sorted apart and each adds
    the rows before it.  The sorted rows are written once, as a second run of the plan may cut its ranges elsewhere."""
    order = [c.asc_nulls_last() for c in order]
    sorted_ = written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id()), "numbered")
    ranged = sorted_.withColumn("_p", F.shiftright("_m", 33)).withColumn("_i", F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)) + 1)
    before = ranged.groupBy("_p").agg(F.count("*").alias("_n"))
    before = before.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    number = F.col("_i") + F.col("_b")
    return ranged.join(F.broadcast(before), "_p").withColumn(name, F.format_string(fmt, number) if fmt else number).drop("_p", "_m", "_i", "_b")


def unique_sequences(reads: DataFrame, *, lexical: bool = False) -> DataFrame:
    """Distinct sequences with their id, uniq_00001 in first-seen order or unique_1 in alphabetic order."""
    seqs = reads.groupBy("seq").agg(F.min("seq_id").alias("first_id"), F.count("*").alias("n_reads"))
    return numbered(seqs, [F.col("seq")] if lexical else [F.col("first_id")], "unique_id", "unique_%d" if lexical else "uniq_%05d")


def dereplicate(reads: DataFrame) -> DataFrame:
    """Reads of each distinct sequence in each sample."""
    return reads.groupBy("seq", "sample").agg(F.count("*").alias("count"))


def qc(reads: DataFrame, **limits) -> DataFrame:
    return reads.where(S.passes_qc(F.col("seq"), **limits))


def keep_features(counts: DataFrame, ids: DataFrame) -> DataFrame:
    return counts.join(ids.select("feature_id"), "feature_id", "left_semi")


def drop_features(counts: DataFrame, ids: DataFrame) -> DataFrame:
    return counts.join(ids.select("feature_id"), "feature_id", "left_anti")


def to_centroids(counts: DataFrame, membership: DataFrame) -> DataFrame:
    """Counts of members summed by centroid and sample; features without a cluster are left out."""
    return counts.join(membership, counts.feature_id == membership.member_id).groupBy("centroid_id", "sample").agg(F.sum("count").alias("count"))


def by_rank(counts: DataFrame, taxonomy: DataFrame, rank: str = "Phylum") -> DataFrame:
    return counts.join(taxonomy, "feature_id").groupBy(L.at_rank(F.col("lineage"), rank).alias("taxon"), "sample").agg(F.sum("count").alias("count"))


def relative(table: DataFrame, value: str = "count") -> DataFrame:
    """Adds pct, 0 where the sample is empty."""
    total = F.sum(value).over(Window.partitionBy("sample"))
    return table.withColumn("pct", F.when(total > 0, 100.0 * F.col(value) / total).otherwise(F.lit(0.0)))


def wide(table: DataFrame, key: str, samples: list[str] | None = None) -> DataFrame:
    return table.groupBy(key).pivot("sample", samples).agg(F.sum("count")).na.fill(0)


def long(table: DataFrame, key: str) -> DataFrame:
    names = [F.col(f"`{c}`") for c in table.columns if c != key]
    return table.unpivot([F.col(f"`{key}`")], names, "sample", "count").where("count > 0")


def richness(counts: DataFrame) -> DataFrame:
    return counts.groupBy("sample").agg(F.count_distinct(F.when(F.col("count") > 0, F.col("feature_id"))).alias("richness"))


def top_features(counts: DataFrame, n: int = 10) -> DataFrame:
    """The n largest features of every sample with their rank."""
    order = Window.partitionBy("sample").orderBy(F.desc("count"), "feature_id")
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def top_taxa(rel: DataFrame, n: int = 10, least: float = 0.0) -> DataFrame:
    """Taxa by mean share over samples, those missing in a sample counting 0."""
    samples = rel.agg(F.count_distinct("sample").alias("k"))
    mean = rel.groupBy("taxon").agg(F.sum("pct").alias("s")).crossJoin(F.broadcast(samples)).select("taxon", (F.col("s") / F.col("k")).alias("mean_pct"))
    return mean.where(F.col("mean_pct") > least).orderBy(F.desc("mean_pct"), "taxon").limit(n)


def with_other(rel: DataFrame, top: DataFrame, other: str = "Otros") -> DataFrame:
    """Shares by sample of the top taxa and of all others together."""
    marked = rel.join(F.broadcast(top.select("taxon", F.lit(True).alias("_top"))), "taxon", "left")
    return marked.groupBy("sample", F.when(F.col("_top"), F.col("taxon")).otherwise(F.lit(other)).alias("taxon")).agg(F.sum("pct").alias("pct"))


def assigned(counts: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Every feature's seven rank columns, Unclassified where unknown."""
    ranks = [L.at_rank(F.coalesce("lineage", F.array().cast("array<string>")), r).alias(r) for r in L.RANKS]
    return counts.join(taxonomy, "feature_id", "left").select("feature_id", "sample", "count", *ranks)


def summary(seqs: DataFrame) -> DataFrame:
    """Minimum, quartiles and 2.5 % tails (linear), maximum and mean of length, ambiguous bases and longest run."""
    measures = {"nbases": F.length(S.clean(F.col("seq"))), "ambigs": S.ambiguous_any(S.clean(F.col("seq"))), "polymer": S.homopolymer(F.col("seq"))}
    rows = seqs.select(F.explode(F.array(*[F.struct(F.lit(n).alias("measure"), m.cast("double").alias("v")) for n, m in measures.items()])).alias("m")).select("m.*")
    q = F.percentile("v", [0.025, 0.25, 0.5, 0.75, 0.975])
    return rows.groupBy("measure").agg(F.min("v").alias("minimum"), *[q[i].alias(n) for i, n in enumerate(["p2_5", "p25", "median", "p75", "p97_5"])], F.max("v").alias("maximum"), F.round(F.avg("v"), 2).alias("mean"), F.count("*").alias("n"))


#: The terms that make a genus name ambiguous.
AMBIGUOUS = r"uncultured|unclassified|unidentified|incertae[ _]sedis|environmental|metagenome|unknown"


def genus_class(genus: Column) -> Column:
    """Unclassified without a name, Ambiguous/propagated by its terms in any case, else Classified.  A rank prefix (g__) and a confidence in brackets are no part of the name."""
    g = F.trim(F.regexp_replace(F.regexp_replace(F.trim(F.coalesce(genus, F.lit(""))), r"\(\d+\)$", ""), "^[a-z]__", ""))
    return F.when(g == "", "Unclassified").when(g.rlike("(?i)" + AMBIGUOUS), "Ambiguous/propagated").otherwise("Classified")


def genus_resolution(counts: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Share of reads and of features by class of the genus name, with distinct genera."""
    per = counts.groupBy("feature_id").agg(F.sum("count").alias("reads")).join(taxonomy, "feature_id", "left").withColumn("genus", F.try_element_at("lineage", F.lit(6)))
    out = per.groupBy(genus_class(F.col("genus")).alias("class")).agg(F.sum("reads").alias("reads"), F.count("*").alias("features"), F.count_distinct("genus").alias("genera"))
    every = Window.partitionBy()
    return out.withColumn("pct_reads", 100.0 * F.col("reads") / F.sum("reads").over(every)).withColumn("pct_features", 100.0 * F.col("features") / F.sum("features").over(every))


def remove_lineages(counts: DataFrame, taxonomy: DataFrame, taxon_filter: str) -> DataFrame:
    """Counts of features whose lineage text holds none of the tokens; features without one are "unknown;"."""
    bad = taxonomy.where(L.removed_by(F.array_join("lineage", ";"), taxon_filter)).select("feature_id")
    return drop_features(counts.where("feature_id is not null"), bad)
