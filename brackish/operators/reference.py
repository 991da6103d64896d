"""Building reference sets: headers, quality limits, dereplication with consensus lineages, indexes by k-mer and by minimizer."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lineage as L
from ..functions import sequence as S
from . import windows as W

#: Least lengths by domain, most ambiguous bases, longest run, least length of all.
LEAST_BY_DOMAIN = {"Archaea": 900, "Bacteria": 1200, "Eukaryota": 1400}
MOST_AMBIGUOUS, LONGEST_RUN, LEAST = 5, 8, 50


def id_and_lineage(header: Column) -> Column:
    """">AB1.1.1510 Bacteria;..." -> struct(seq_id with _ for dots, lineage); nulls without a blank."""
    h = F.trim(F.regexp_replace(header, "^>+", ""))
    parts = F.split(h, " ", 2)
    ok = F.size(parts) == 2
    return F.struct(F.when(ok, F.translate(F.trim(parts[0]), ".", "_")).alias("seq_id"), F.when(ok, F.trim(F.get(parts, F.lit(1)))).alias("lineage"))


def piped_id(header: Column) -> Column:
    """">HOMD:tax_1 | name | gene" or ">id name" -> the id."""
    h = F.trim(F.regexp_replace(header, "^>+", ""))
    return F.split(F.trim(F.split(h, r"\|")[0]), r"\s+")[0]


def rooted(lineage: Column) -> Column:
    """Without (confidence) and trailing ;, beginning with Root."""
    x = F.regexp_replace(lineage, r"\(\d+\)", "")
    return F.rtrim(F.when(x.startswith("Root"), x).otherwise(F.concat(F.lit("Root;"), F.ltrim(x, F.lit(";")))), F.lit(";"))


def judged(refs: DataFrame, domains: dict[str, int] = LEAST_BY_DOMAIN) -> DataFrame:
    """refs (seq_id, seq, lineage string) with clean DNA in seq and why each goes (`reason`, null if it stays), the first that holds."""
    seq = F.translate(F.upper(F.translate("seq", "-.", "")), "U", "T")
    rows = refs.withColumn("seq", seq).withColumn("domain", F.trim(F.split("lineage", ";")[0]))
    least = F.lit(LEAST)
    for name, n in domains.items():
        least = F.when(F.col("domain") == name, F.lit(n)).otherwise(least)
    reason = (
        F.when(F.col("lineage").isNull(), "header").when(~F.coalesce(F.col("domain").isin(*domains), F.lit(False)), "domain").when(F.coalesce(F.length("seq"), F.lit(0)) < LEAST, "short")
        .when(F.length("seq") < least, "length").when(S.ambiguous_any(F.col("seq")) > MOST_AMBIGUOUS, "ambiguous").when(F.col("seq").rlike("|".join(f"{x}{{{LONGEST_RUN + 1},}}" for x in "ACGT")), "homopolymer")
    )
    return rows.withColumn("reason", reason)


def reasons(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def consensus(refs: DataFrame, majority: float = 0.9, depth: int = 6) -> DataFrame:
    """refs (seq_id, seq, lineage array, ord): one row a distinct sequence with its first id and the lineage that `majority` of its
    copies have, else what all share; `conflict` tells that they differ.  Equal lineages are counted before they meet, so copies cost nothing."""
    per = refs.withColumn("lineage", F.slice("lineage", 1, depth)).groupBy("seq", "lineage").agg(F.count("*").alias("n"), F.min(F.struct("ord", "seq_id")).alias("first"))
    out = per.groupBy("seq").agg(
        F.min("first").alias("first"), F.sum("n").alias("copies"), F.max("n").alias("most"), F.count("*").alias("kinds"),
        F.max_by("lineage", F.struct("n", -F.col("first.ord"))).alias("common"), L.lca(F.col("lineage")).alias("shared"),
    )
    return out.select("first.seq_id", "seq", F.when(F.col("most") / F.col("copies") >= majority, F.col("common")).otherwise(F.col("shared")).alias("lineage"), "copies", (F.col("kinds") > 1).alias("conflict"))


def trim_to_span(seqs: DataFrame, spans: DataFrame) -> DataFrame:
    """seqs cut to their hits' least start and greatest end (1-based); those without a hit or with an odd span go."""
    span = spans.groupBy("query_id").agg(F.min("start").alias("_a"), F.max("end").alias("_b")).where("_a >= 1 and _b >= _a")
    return seqs.join(span, seqs.seq_id == span.query_id).withColumn("seq", S.trim(F.col("seq"), F.col("_a"), F.col("_b"))).drop("query_id", "_a", "_b")


def share_index(postings: DataFrame, most_taxa: int = 1000) -> DataFrame:
    """(kmer, lineage, weight): each taxon's share of a k-mer's occurrences; k-mers in more than most_taxa taxa go."""
    w = Window.partitionBy("kmer")
    rows = postings.withColumn("_df", F.count("*").over(w)).withColumn("_t", F.sum("n").over(w)).where(F.col("_df") <= most_taxa)
    return rows.select("kmer", "lineage", (F.col("n") / F.col("_t")).alias("weight"))


def minimizer_index(postings: DataFrame, k: int = 8, m: int = 4) -> DataFrame:
    """(minimizer, lineage): the first m letters in order of every k-mer that a taxon has."""
    return postings.select(F.get(S.minimizers(F.col("kmer"), k, m), F.lit(0)).alias("minimizer"), "lineage").where("minimizer is not null").distinct()


def lca_index(refs: DataFrame, k: int, m: int = 0) -> DataFrame:
    """(kmer, lca): shared beginning of the lineages with a k-letter string, or with `m` with a minimizer.  Tasks merge lineages before the shuffle."""
    own = W.shared_names(refs.select("seq", F.array_join(L.parts(F.col("lineage")), ";").alias("lineage")), k, m)
    return own.groupBy("kmer").agg(L.lca(L.parts(F.col("names"))).alias("lca"))


def minimizer_lca_classify(queries: DataFrame, lcas: DataFrame, k: int = 8, m: int = 4) -> DataFrame:
    """minimizer_classify from lca_index's table, which every task holds, or else by its join."""
    own = W.sent_names(lcas, "kmer", "lca", m)
    if own is None:
        return minimizer_classify(queries, lcas.select(F.col("kmer").alias("minimizer"), F.array_join("lca", ";").alias("lineage")), k, m)
    shared = queries.sparkSession.sparkContext.broadcast(own)

    def run(s):
        table, ids, names = shared.value
        got = [names[i] for i in np.unique(ids[W.found(table, *W.minimizer_codes(s, k, m))])]
        out = got[0] if got else ()
        for x in got[1:]:
            out = W.shared_beginning(out, x)
        return (";".join(out) or L.NONE,)

    return W.each(queries, {"lineage": "string"}, run)


def minimizer_classify(queries: DataFrame, index: DataFrame, k: int = 8, m: int = 4) -> DataFrame:
    """(seq_id, lineage): what all taxa share that have any of a query's minimizers; Unclassified without a hit or a shared name.

    A minimizer's taxa are brought to their shared beginning once, so a query joins one row a minimizer."""
    shared = index.groupBy("minimizer").agg(L.lca(L.parts(F.col("lineage"))).alias("names"))
    q = queries.select("seq_id", F.explode(F.array_distinct(S.minimizers(F.col("seq"), k, m))).alias("minimizer"))
    got = q.join(shared, "minimizer").groupBy("seq_id").agg(L.lca(F.col("names")).alias("names"))
    return queries.select("seq_id").join(got, "seq_id", "left").select("seq_id", F.when(F.size("names") > 0, F.array_join("names", ";")).otherwise(F.lit(L.NONE)).alias("lineage"))


def lca_classify(queries: DataFrame, lcas: DataFrame, k: int = 15, ratio: float = 0.85, deepest: int = 6) -> DataFrame:
    """(seq_id, lineage) from a table (kmer, lca) alone: every k-mer votes for all beginnings of its shared lineage; from the best of level 2 (or 1) on,
    the best of the next level is taken while it has more than `ratio` of the votes of the one before.  Level n has n names below the root; ties go to the first in order.
    The table is held by every task, or else joined."""
    own = W.sent_names(lcas.where(F.size("lca") > 0), "kmer", "lca", k)
    if own is None:
        return lca_join(queries, lcas, k, ratio, deepest)
    levels = []
    for n in range(2, deepest + 2):
        every = sorted({x[:n] for x in own[2] if len(x) >= n}, key=";".join)
        at = {x: i for i, x in enumerate(every)}
        levels.append((np.array([at.get(x[:n], len(every)) if len(x) >= n else len(every) for x in own[2]], np.int64), [";".join(x) for x in every]))
    shared = queries.sparkSession.sparkContext.broadcast((own[0], own[1], levels))

    def run(s):
        table, ids, levels = shared.value
        x, rest = W.codes(s, k)
        votes = np.bincount(ids[W.found(table, x, [w for w in rest if "N" not in w])], minlength=1)
        ladder = []
        for at, names in levels:
            v = np.bincount(at[: len(votes)], votes[: len(at)], len(names) + 1)[: len(names)] if names else np.zeros(0)
            if len(v) and v.max() > 0:
                ladder.append((v.max(), names[int(v.argmax())]))
        if not ladder:
            return (L.NONE,)
        v, pick = ladder[min(1, len(ladder) - 1)]
        for more, name in ladder[2:]:
            if more / (v + 1e-9) <= ratio:
                break
            v, pick = more, name
        return (pick,)

    return W.each(queries, {"lineage": "string"}, run)


def lca_join(queries: DataFrame, lcas: DataFrame, k: int, ratio: float, deepest: int) -> DataFrame:
    """lca_classify for a table of any size."""
    q = queries.select("seq_id", F.explode(S.kmers_without_n(F.col("seq"), k)).alias("kmer")).groupBy("seq_id", "kmer").agg(F.count("*").alias("n"))
    votes = q.join(lcas.where(F.size("lca") > 0), "kmer").groupBy("seq_id", "lca").agg(F.sum("n").alias("n"))
    levels = votes.select("seq_id", "n", F.posexplode(L.prefixes(F.col("lca"), deepest + 1)).alias("level", "prefix")).where("level >= 1").groupBy("seq_id", "level", "prefix").agg(F.sum("n").alias("v"))
    w = Window.partitionBy("seq_id", "level").orderBy(F.desc("v"), "prefix")
    best = levels.withColumn("_r", F.row_number().over(w)).where("_r = 1")
    ladder = best.groupBy("seq_id").agg(F.sort_array(F.collect_list(F.struct("level", "v", "prefix"))).alias("at"))  # at most `deepest` rows a query
    start = F.when(F.size("at") > 1, F.col("at")[1]).otherwise(F.col("at")[0])
    none = F.struct(start["level"].alias("level"), start["v"].alias("v"), start["prefix"].alias("prefix"), F.lit(True).alias("on"))
    step = lambda acc, x: F.when(acc["on"] & (x["v"] / (acc["v"] + 1e-9) > ratio), F.struct(x["level"].alias("level"), x["v"].alias("v"), x["prefix"].alias("prefix"), F.lit(True).alias("on"))).otherwise(F.struct(acc["level"].alias("level"), acc["v"].alias("v"), acc["prefix"].alias("prefix"), F.lit(False).alias("on")))
    picked = F.aggregate(F.slice("at", 3, deepest), none, step)["prefix"]
    return queries.select("seq_id").join(ladder.select("seq_id", picked.alias("lineage")), "seq_id", "left").select("seq_id", F.coalesce("lineage", F.lit(L.NONE)).alias("lineage"))


#: The lineage of a species without one of its own.
UNKNOWN = "unknown_domain;unknown_phylum;unknown_class;unknown_order;unknown_family;"


def species_lineage(species: Column, share: Column, lineage: Column, least: float = 0.5) -> Column:
    """A species call's lineage; unclassified; if unknown, ambiguous or short of votes, made up from Genus_species if it has none."""
    weak = species.isin("UNKNOWN", "AMBIGUOUS") | (F.lit(least > 0) & (share < least))
    made = F.concat(F.lit(UNKNOWN), F.split(species, "_", 2)[0], F.lit(";"), species, F.lit(";"))
    return F.when(weak, "unclassified;").when(F.coalesce(lineage, F.lit("")) != "", lineage).otherwise(made)
