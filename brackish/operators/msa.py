"""Column operators over aligned sequences (seq_id, aln of equal length)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def columns(alignment: DataFrame) -> DataFrame:
    """Per column: rows, gap share, A/C/G/T share, ambiguous share."""
    c = alignment.select(F.posexplode(F.split("aln", "")).alias("pos", "base")).where("base <> ''").withColumn("base", F.upper("base"))
    gap, acgt = F.col("base").isin("-", "."), F.col("base").isin("A", "C", "G", "T")
    return c.groupBy("pos").agg(F.count("*").alias("n"), F.avg(gap.cast("double")).alias("gap_share"), F.avg(acgt.cast("double")).alias("acgt_share"), F.avg((~gap & ~acgt).cast("double")).alias("ambiguous_share"))


def keep_columns(alignment: DataFrame, keep: DataFrame) -> DataFrame:
    """Alignment with the positions of `keep` only.  The positions are as many as an alignment has columns, and go along as one row."""
    kept = F.broadcast(keep.agg(F.sort_array(F.collect_list("pos")).alias("_keep")))
    cut = F.array_join(F.transform("_keep", lambda i: F.substring(F.col("aln"), i + 1, F.lit(1))), "")
    return alignment.crossJoin(kept).withColumn("aln", cut).drop("_keep")


def positional_filter(alignment: DataFrame, start: int = 0, end: int | None = None, least_info: float = 0.02, most_ambiguous: float = 0.5) -> DataFrame:
    """Window [start, end); drops gap-only columns, those with little A/C/G/T and ambiguous ones; then gap-only rows.
    The alignment comes back unchanged if nothing would be left."""
    c = columns(alignment).where((F.col("pos") >= start) & (F.col("pos") < (end if end is not None else 1 << 30)))
    keep = c.where((F.col("gap_share") < 1) & (F.col("acgt_share") >= least_info) & (F.col("ambiguous_share") <= most_ambiguous)).select("pos")
    out = keep_columns(alignment, keep).where(F.length(F.regexp_replace("aln", "[-.]", "")) > 0)
    return alignment if out.isEmpty() else out


def trump_filter(alignment: DataFrame, trump: str = ".") -> DataFrame:
    """Drops columns in which every row is the trump character."""
    c = alignment.select(F.posexplode(F.split("aln", "")).alias("pos", "base")).where("base <> ''").groupBy("pos").agg(F.bool_and(F.col("base") == trump).alias("all"))
    return keep_columns(alignment, c.where("not all").select("pos"))


def diagnose(alignment: DataFrame, gap_threshold: float = 0.5) -> DataFrame:
    """Mean ungapped length, and first, last and width of the columns below the gap threshold, with the region it suggests."""
    core = columns(alignment).where(F.col("gap_share") < gap_threshold).agg(F.min("pos").alias("core_start"), F.max("pos").alias("core_end"))
    mean = alignment.agg(F.avg(F.length(F.regexp_replace("aln", "[-.]", ""))).alias("mean_ungapped"))
    m = F.col("mean_ungapped")
    region = F.when(m < 300, "short").when(m < 450, "V4").when(m < 650, "V3-V4").otherwise("long")
    return mean.crossJoin(core).select("mean_ungapped", "core_start", "core_end", (F.col("core_end") - F.col("core_start") + 1).alias("core_width"), region.alias("region"))
