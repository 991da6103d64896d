"""How well classifiers do: hold-out tables, kinds of error, agreement of two of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def starts(a: Column, b: Column) -> Column:
    """b begins with a."""
    return F.slice(b, F.lit(1), F.greatest(F.size(a), F.lit(1))) == a


def outcome(got: Column, truth: Column, genus: int = 6) -> Column:
    """unclassified, genus_ok, genus_wrong, above_ok or above_wrong; got, truth: arrays of names."""
    n = F.coalesce(F.size(F.filter(got, lambda x: x != "")), F.lit(0))
    deep = F.when(F.slice(got, 1, genus) == F.slice(truth, 1, genus), "genus_ok").otherwise("genus_wrong")
    return F.when(n <= 0, "unclassified").when(n >= genus, deep).when(starts(got, truth), "above_ok").otherwise("above_wrong")


def hold_out(calls: DataFrame, settings: list[str], genus: int = 6) -> DataFrame:
    """calls (settings..., got, truth, known): shares of the outcomes of known genera, and of novel ones that got a genus, by setting."""
    rows = calls.withColumn("_o", outcome(F.col("got"), F.col("truth"), genus))
    is_ = lambda known, *kinds: F.count_if((F.col("known") if known else ~F.col("known")) & F.col("_o").isin(*kinds))
    share = lambda n, of: F.when(of > 0, 100.0 * n / of).otherwise(F.lit(0.0))
    known, novel = F.count_if("known"), F.count_if(~F.col("known"))
    return rows.groupBy(*settings).agg(
        known.alias("n_known"), share(is_(True, "genus_ok"), known).alias("genus_ok_pct"), share(is_(True, "genus_wrong"), known).alias("genus_wrong_pct"),
        share(is_(True, "above_ok", "above_wrong"), known).alias("above_genus_pct"), share(is_(True, "unclassified"), known).alias("unclassified_pct"),
        novel.alias("n_novel"), share(is_(False, "genus_wrong"), novel).alias("novel_false_genus_pct"),
    )


def error_kinds(calls: DataFrame, ambiguous: str = r"(?i)uncultured|unclassified|unidentified|incertae[ _]sedis|metagenome|unknown", genus: int = 6) -> DataFrame:
    """Wrong genera by whether the truth itself is an ambiguous name."""
    wrong = calls.where(outcome(F.col("got"), F.col("truth"), genus) == "genus_wrong")
    return wrong.groupBy(F.when(F.try_element_at("truth", F.lit(genus)).rlike(ambiguous), "ambiguous truth").otherwise("real error").alias("kind")).agg(F.count("*").alias("n"))


def called(assignment: Column, least: int, most: int = 6) -> Column:
    """Names of (taxon, conf) down to the first one below `least` or without a name of its own."""
    pairs = F.slice(assignment, 1, most)
    bad = F.array_position(F.transform(pairs, lambda t: (t["conf"] < least) | t["taxon"].endswith("_unclassified") | (t["taxon"] == "unknown")), True)
    return F.transform(F.when(bad > 0, F.slice(pairs, F.lit(1), (bad - 1).cast("int"))).otherwise(pairs), lambda t: t["taxon"])


def concordance(a: DataFrame, b: DataFrame, least: tuple[int, ...] = (60, 70, 80, 90), genus: int = 6) -> DataFrame:
    """(seq_id, assignment) of two classifiers -> by confidence: shares of sequences called alike, on one branch, otherwise, and both to one genus; `raw_pct` without any confidence."""
    both = a.select("seq_id", F.col("assignment").alias("x")).join(b.select("seq_id", F.col("assignment").alias("y")), "seq_id")
    names = lambda c: F.transform(F.slice(c, 1, genus), lambda t: t["taxon"])
    rows = both.select("x", "y", (names("x") == names("y")).alias("raw"), F.explode(F.array(*[F.lit(v) for v in least])).alias("least"))
    cut = rows.select("least", "raw", *[F.coalesce(*[F.when(F.col("least") == v, called(F.col(c), v, genus)) for v in least]).alias(c) for c in "xy"])
    m = F.least(F.size("x"), F.size("y"))
    # An array of no names begins any other.
    branch = (m == 0) | (F.slice("x", F.lit(1), F.greatest(m, F.lit(1))) == F.slice("y", F.lit(1), F.greatest(m, F.lit(1))))
    pct = lambda c: 100.0 * F.count_if(c) / F.count("*")
    same = F.col("x") == F.col("y")
    return cut.groupBy("least").agg(F.count("*").alias("n"), pct("raw").alias("raw_pct"), pct(same).alias("same_pct"), pct(~same & branch).alias("branch_pct"), pct(~same & ~branch).alias("different_pct"), pct(same & (F.size("x") == genus)).alias("genus_pct"))


def confidence_gap(a: DataFrame, b: DataFrame, genus: int = 6) -> DataFrame:
    """Median and 5 and 95 % points (by place in order) of the difference in confidence where both name one genus."""
    both = a.select("seq_id", F.try_element_at("assignment", F.lit(genus)).alias("x")).join(b.select("seq_id", F.try_element_at("assignment", F.lit(genus)).alias("y")), "seq_id")
    d = both.where("x.taxon = y.taxon").groupBy((F.col("x.conf") - F.col("y.conf")).alias("d")).agg(F.count("*").alias("n"))  # at most 201 differences
    rows = d.agg(F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct("d", "n"))).alias("all"))
    # The value at place k (from 0) is the first whose running number exceeds k.
    at = lambda k: F.aggregate("all", F.struct(F.lit(0).cast("long").alias("s"), F.lit(None).cast("int").alias("v")), lambda acc, x: F.struct((acc["s"] + x["n"]).alias("s"), F.when(acc["v"].isNull() & (acc["s"] + x["n"] > k), x["d"]).otherwise(acc["v"]).alias("v")))["v"]
    n = F.col("n")
    return rows.where("n > 0").select("n", at(F.floor(n / 2)).alias("median"), at(F.floor(n / 20)).alias("p5"), at(F.floor(n * 19 / 20)).alias("p95"))
