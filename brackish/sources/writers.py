"""Writers of sequence, taxonomy and count files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lineage as L


def fasta_text(seq_id: Column, seq: Column, width: int = 80) -> Column:
    return F.concat(F.lit(">"), seq_id.cast("string"), F.lit("\n"), F.regexp_replace(F.regexp_replace(seq, f"(.{{{width}}})", "$1\n"), r"\n$", ""))


def fasta(seqs: DataFrame, path: str) -> None:
    seqs.select(fasta_text(F.col("seq_id"), F.col("seq"))).write.text(path)


def taxonomy(assigned: DataFrame, path: str, confidence: bool = False) -> None:
    text = L.confidence_text(F.col("assignment")) if confidence else F.concat(F.array_join("lineage", ";"), F.lit(";"))
    assigned.select("feature_id", text.alias("t")).write.csv(path, sep="\t")


def shared(counts: DataFrame, path: str, label: str = "0.03") -> None:
    w = counts.groupBy("sample").pivot("feature_id").agg(F.sum("count")).na.fill(0)
    names = [c for c in w.columns if c != "sample"]
    w.select(F.lit(label).alias("label"), F.col("sample").alias("Group"), F.lit(len(names)).alias("numOtus"), *[F.col(f"`{c}`") for c in names]).write.csv(path, sep="\t", header=True)


#: Rank letters of classifier headers (fixed values).
LETTERS = ["k", "p", "c", "o", "f", "g", "s"]


def sintax_header(names: Column, sep: str = ",", confidence: bool = False) -> Column:
    """k:A,p:B,... of an array of names, quotes gone and spaces as _."""
    mark = F.array(*[F.lit(x) for x in LETTERS])
    tagged = F.zip_with(F.slice(mark, F.lit(1), F.least(F.size(names), F.lit(7))), F.slice(names, 1, 7), lambda p, n: F.concat(p, F.lit(":"), F.replace(F.replace(n, F.lit('"'), F.lit("")), F.lit(" "), F.lit("_")), F.lit(":1.00" if confidence else "")))
    return F.array_join(tagged, sep)


def phyloseq(counts: DataFrame, taxonomy_: DataFrame, out: str) -> None:
    """otu, tax (six ranks) and sample tables."""
    counts.groupBy("feature_id").pivot("sample").agg(F.sum("count")).na.fill(0).write.csv(f"{out}/otu", header=True)
    taxonomy_.select("feature_id", *[L.at_rank(F.col("lineage"), r).alias(r) for r in L.RANKS[:6]]).write.csv(f"{out}/tax", header=True)
    counts.select("sample").distinct().withColumn("Group", F.col("sample")).write.csv(f"{out}/samples", header=True)
