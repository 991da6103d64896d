"""Aggregates, selections and set operators over long tables: taxa by tool, summaries of contigs, samples, splits, caps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lineage as L
from ..functions import sequence as S


def collapse(rel: DataFrame, taxonomy: DataFrame, rank: str, drop_unassigned: bool = False) -> DataFrame:
    """Shares by sample and taxon; features without a name at the rank are Unassigned, or left out."""
    name = F.try_element_at("lineage", F.lit(L.RANKS.index(rank) + 1))
    out = rel.join(taxonomy, "feature_id", "left").select("sample", "pct", F.coalesce(name, F.lit("Unassigned")).alias("taxon"))
    if drop_unassigned:
        out = out.where("taxon <> 'Unassigned'")
    return out.groupBy("taxon", "sample").agg(F.sum("pct").alias("pct"))


def contig_summary(seqs: DataFrame, counts: DataFrame | None = None, strip_gaps: bool = False) -> DataFrame:
    """Minimum, median (rounded half to even) and mean (two places) of start, end, bases, ambiguous bases, longest run and reads
    of contigs, with their number and that of all reads.  A contig without counts is one read.  An empty table gives no rows."""
    seq = F.regexp_replace("seq", "[-.]", "") if strip_gaps else F.col("seq")
    rows = seqs.select("seq_id", seq.alias("seq")).where("seq is not null")
    if counts is None:
        rows = rows.withColumn("reads", F.lit(1).cast("long"))
    else:
        per = counts.groupBy(F.col("feature_id").alias("seq_id")).agg(F.sum("count").alias("reads"))
        rows = rows.join(per, "seq_id", "left").withColumn("reads", F.coalesce("reads", F.lit(1)))
    n = F.length("seq")
    parts = {"start": F.lit(1), "end": n, "nbases": n, "ambigs": S.ambiguous_any(F.upper("seq")), "polymer": S.homopolymer(F.upper("seq")), "numseqs": F.col("reads")}
    v = rows.select(F.explode(F.array(*[F.struct(F.lit(k).alias("measure"), c.cast("long").alias("v")) for k, c in parts.items()])).alias("m")).select("m.*")
    # The median is found in the (value, number) table: values repeat, so one task holds distinct values only.
    per_value = v.groupBy("measure", "v").agg(F.count("*").alias("n"))
    w = Window.partitionBy("measure").orderBy("v")
    upto = per_value.withColumn("upto", F.sum("n").over(w)).withColumn("total", F.sum("n").over(Window.partitionBy("measure")))
    at = lambda k: F.min(F.when(F.col("upto") >= k, F.col("v")))
    mid = (at(F.floor((F.col("total") + 1) / 2)) + at(F.floor(F.col("total") / 2) + 1)) / 2
    return upto.groupBy("measure").agg(F.min("v").alias("minimum"), F.bround(mid).cast("long").alias("median"), F.round(F.sum(F.col("v") * F.col("n")) / F.sum("n"), 2).alias("mean"), F.sum("n").alias("contigs"))


#: The parts of a name, case and all, that make it ambiguous in the older resolution.
AMBIGUOUS_PARTS = ["unclassified", "Unclassified", "uncultured", "Uncultured", "Incertae Sedis", "incertae sedis", "metagenome", "ambiguous", "unknown", "Unknown"]


def genus_label(genus: Column) -> Column:
    """unclassified without a name, ambiguous if it holds any of AMBIGUOUS_PARTS, else classified."""
    odd = F.lit(False)
    for part in AMBIGUOUS_PARTS:
        odd = odd | F.contains(genus, F.lit(part))
    return F.when(F.trim(F.coalesce(genus, F.lit(""))) == "", "unclassified").when(odd, "ambiguous").otherwise("classified")


def label_resolution(counts: DataFrame, taxonomy: DataFrame, depth: int = 6) -> DataFrame:
    """Share of features and of reads by label; all three labels, with 0 where none."""
    per = counts.groupBy("feature_id").agg(F.sum("count").alias("reads")).join(taxonomy, "feature_id", "left")
    got = per.groupBy(genus_label(F.try_element_at("lineage", F.lit(depth))).alias("label")).agg(F.count("*").alias("features"), F.sum("reads").alias("reads"))
    every = counts.sparkSession.createDataFrame([("classified",), ("ambiguous",), ("unclassified",)], "label string")
    all_rows = every.join(got, "label", "left").na.fill(0, ["features", "reads"])
    w = Window.partitionBy()
    return all_rows.select("label", "features", "reads", (100.0 * F.col("features") / F.sum("features").over(w)).alias("pct_features"), (100.0 * F.col("reads") / F.sum("reads").over(w)).alias("pct_reads"))


ABOVE, NONE, FORCED = "Classified (above genus)", "Unclassifiable", "Forced genus"


def genus_bucket(names: Column, style: str = "plain") -> Column:
    """The genus, or what there is in its place.

    plain: uncultured and unclassified names are above genus.  confidence: a name that only carries its parent on (_unclassified) is a
    forced genus.  prefixed: the genus is the name after g__, at any depth; names without anything after their prefix do not count."""
    if style == "prefixed":
        real = F.filter(names, lambda x: F.trim(F.regexp_replace(x, "^[a-z]__", "")) != "")
        g = F.trim(F.regexp_replace(F.get(F.filter(names, lambda x: x.startswith("g__")), F.lit(0)), "^g__", ""))
        return F.when(F.size(real) <= 1, NONE).when(F.coalesce(g, F.lit("")) != "", g).otherwise(ABOVE)
    if style == "confidence":
        names = F.transform(names, lambda x: F.regexp_replace(x, r"\([0-9]+\)", ""))
    names = F.filter(F.transform(names, lambda x: F.trim(x)), lambda x: x != "")
    g, n = F.try_element_at(names, F.lit(6)), F.size(names)
    if style == "confidence":
        named = F.when(g.rlike("(?i)_unclassified$"), FORCED).when(~g.rlike("(?i)^unclassified$"), g).otherwise(ABOVE)
    elif style == "plain":
        named = F.when(~g.rlike("(?i)unclassified|uncultured"), g).otherwise(ABOVE)
    else:
        raise ValueError(f"no style {style!r}; there are plain, confidence, prefixed")
    return F.when(n <= 1, NONE).when(n < 6, ABOVE).otherwise(named)


def recoded(table: DataFrame, names: DataFrame, column: str = "taxon") -> DataFrame:
    """Old names replaced by new ones (old, new); others stay.  `names` is a nomenclature, bounded by its ranks, not by the data."""
    one = names.groupBy(F.col("old").alias(column)).agg(F.min("new").alias("_new"))
    return table.join(one, column, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")


def composition(shares: DataFrame, n: int = 8) -> DataFrame:
    """(tool, sample, taxon, share) -> mean share by tool of the n taxa that are largest in any tool, of Unclassified and of all others (0 at least).
    A taxon that is missing in a sample counts 0 there."""
    samples = shares.groupBy("tool").agg(F.count_distinct("sample").alias("k"))
    mean = shares.groupBy("tool", "taxon").agg(F.sum("share").alias("s")).join(samples, "tool").select("tool", "taxon", (F.col("s") / F.col("k")).alias("mean"))
    top = mean.where("taxon <> 'Unclassified'").groupBy("taxon").agg(F.max("mean").alias("m")).orderBy(F.desc("m"), "taxon").limit(n).select("taxon")
    rows = samples.select("tool").crossJoin(F.broadcast(top.union(top.sparkSession.createDataFrame([("Unclassified",)], "taxon string"))))  # n + 1 rows
    named = rows.join(mean, ["tool", "taxon"], "left").select("tool", "taxon", F.coalesce("mean", F.lit(0.0)).alias("mean"))
    other = named.groupBy("tool").agg(F.greatest(1 - F.sum("mean"), F.lit(0.0)).alias("mean")).select("tool", F.lit("Other").alias("taxon"), "mean")
    return named.union(other)


def metric_summary(alpha: DataFrame, metrics: list[str], by: str = "pipeline") -> DataFrame:
    """Median, mean, minimum and maximum of every measure by group."""
    long = alpha.unpivot([by], metrics, "metric", "v").where("v is not null")
    return long.groupBy(by, "metric").agg(F.percentile("v", F.lit(0.5)).alias("median"), F.avg("v").alias("mean"), F.min("v").alias("minimum"), F.max("v").alias("maximum"))


def top_ids(counts: DataFrame, n: int = 10) -> DataFrame:
    """Features that are among the n largest of any sample."""
    order = Window.partitionBy("sample").orderBy(F.desc("count"), "feature_id")
    return counts.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= n).select("feature_id").distinct()


def ranked_text(counts: DataFrame) -> DataFrame:
    """Lines (sample, line, text): "# sample", then its features from the largest on (ties by id)."""
    order = Window.partitionBy("sample").orderBy(F.desc("count"), "feature_id")
    body = counts.select("sample", F.row_number().over(order).alias("line"), F.col("feature_id").cast("string").alias("text"))
    return body.union(counts.select("sample").distinct().select("sample", F.lit(0), F.concat(F.lit("# "), "sample")))


def most_common(votes: DataFrame, key: str, choice: str, place: str) -> DataFrame:
    """The commonest choice of every key; of equal ones that which came first by `place`."""
    per = votes.groupBy(key, choice).agg(F.count("*").alias("n"), F.min(place).alias("first"))
    return per.groupBy(key).agg(F.max_by(F.struct(choice, "n"), F.struct("n", -F.col("first"))).alias("m")).select(key, f"m.{choice}", "m.n")


def first_n(seqs: DataFrame, n: int | None) -> DataFrame:
    """The first n sequences in file order (`ord`), or all; a top-k, not a sort of the whole."""
    return seqs if n is None else seqs.orderBy("ord", "seq_id").limit(n)


def sample_n(seqs: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """n rows without replacement, the same whatever the partitions: the least by a seeded hash of their id."""
    return seqs.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col("seq_id").cast("string"))), "seq_id").limit(n)


def held_out(seq_id: Column, parts: int = 10, seed: int = 42) -> Column:
    """True for one in `parts` ids by a seeded hash: a split that needs no shuffle and never changes with the partitions."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), seq_id.cast("string"))), 1, 8), 16, 10).cast("long") % parts == 0


def without_empty(counts: DataFrame, least_depth: int = 1) -> DataFrame:
    """Counts above 0 of samples with at least `least_depth` reads."""
    return counts.where("count > 0").withColumn("_n", F.sum("count").over(Window.partitionBy("sample"))).where(F.col("_n") >= least_depth).drop("_n")


def with_genus(assigned: DataFrame, genus: str = "Genus") -> DataFrame:
    return assigned.where(F.col(genus).isNotNull() & (F.trim(genus) != "") & (F.col(genus) != L.NONE))


def shared_samples(*tables: DataFrame) -> list[DataFrame]:
    """The tables with only those samples that all of them have."""
    common = tables[0].select("sample")
    for t in tables[1:]:
        common = common.intersect(t.select("sample"))
    common = common.distinct()
    return [t.join(common, "sample", "left_semi") for t in tables]


def training_join(seqs: DataFrame, taxonomy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sequences with their lineage, and one row (matched, without_taxonomy, without_sequence)."""
    both = seqs.select("seq_id", F.lit(1).alias("s")).join(taxonomy.select("seq_id", F.lit(1).alias("t")).distinct(), "seq_id", "full_outer")
    counters = both.agg(F.count_if(F.col("s").isNotNull() & F.col("t").isNotNull()).alias("matched"), F.count_if(F.col("t").isNull()).alias("without_taxonomy"), F.count_if(F.col("s").isNull()).alias("without_sequence"))
    return seqs.join(taxonomy, "seq_id"), counters


def complete(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """left with right's columns; an error names keys that right does not have."""
    missing = [str(r[0]) for r in left.join(right, key, "left_anti").select(key).distinct().limit(5).collect()]
    if missing:
        raise ValueError(f"no row for {key} {', '.join(missing)}")
    return left.join(right, key, "left")


def renamed(table: DataFrame, names: DataFrame, column: str) -> DataFrame:
    """Ids replaced by (old, new), the first new one by name of each; rows without one go."""
    one = names.groupBy(F.col("old").alias(column)).agg(F.min("new").alias("_new"))
    return table.join(one, column).withColumn(column, F.col("_new")).drop("_new")


def capped(refs: DataFrame, per_genus: int | None, per_phylum: int | None, order: str = "ord") -> DataFrame:
    """In file order, rows whose genus and then whose phylum is not full yet; a row that finds its phylum full leaves its genus as it was.

    Until a phylum is full it takes all its genera's first rows, and then no more: so two ranks give what one pass would.  Needs columns genus, phylum;
    a genus name in two phyla counts in each apart."""
    out = refs
    for cap, key in ((per_genus, ["phylum", "genus"]), (per_phylum, ["phylum"])):
        if cap is not None:
            out = out.withColumn("_r", F.row_number().over(Window.partitionBy(*key).orderBy(order))).where(F.col("_r") <= cap).drop("_r")
    return out


def stacked(*tables: DataFrame) -> DataFrame:
    """Rows of all tables by column name; columns that a table lacks are null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def transposed(counts: DataFrame, features: list | None = None) -> DataFrame:
    """One row a sample, one column a feature; long tables need none of this, so it is for the edges."""
    return counts.groupBy("sample").pivot("feature_id", features).agg(F.sum("count")).na.fill(0)


def newest(jobs: DataFrame, at: str, n: int) -> DataFrame:
    return jobs.orderBy(F.desc(at), F.desc(jobs.columns[0])).limit(n)
