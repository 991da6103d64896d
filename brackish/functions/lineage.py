"""Column functions over lineages, "A;B;C" strings and arrays of names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Ranks in order (fixed values).
RANKS = ["Kingdom", "Phylum", "Class", "Order", "Family", "Genus", "Species"]
NONE = "Unclassified"


def parts(lineage: Column) -> Column:
    """Names without empty ones and quotes."""
    return F.filter(F.transform(F.split(F.replace(lineage, F.lit('"'), F.lit("")), ";"), lambda x: F.trim(x)), lambda x: x != "")


def at_rank(names: Column, rank: str = "Phylum") -> Column:
    """The name at a rank; an unknown rank means Phylum, a missing name Unclassified."""
    i = RANKS.index(rank) if rank in RANKS else 1
    return F.coalesce(F.try_element_at(names, F.lit(i + 1)), F.lit(NONE))


def depth(names: Column) -> Column:
    return F.size(F.filter(names, lambda x: x != ""))


def prefixes(names: Column, most: int = 6) -> Column:
    """A, A;B, A;B;C, ... down to level `most`."""
    n = F.least(F.size(names), F.lit(most))
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(names, F.lit(1), i), ";"))).otherwise(F.array().cast("array<string>"))


def common(a: Column, b: Column) -> Column:
    """Shared beginning of two arrays."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    off = F.array_position(same, False)
    return F.when(off > 0, F.slice(a, F.lit(1), (off - 1).cast("int"))).otherwise(F.slice(a, F.lit(1), F.least(F.size(a), F.size(b))))


def lca(lineages: Column) -> Column:
    """Aggregate: the shared beginning of all arrays of a group.  Equal lineages are merged before it."""
    every = F.collect_set(lineages)
    return F.coalesce(F.aggregate(F.slice(every, 2, 1 << 30), F.element_at(every, 1), common), F.array().cast("array<string>"))


def removed_by(lineage: Column, taxon_filter: str) -> Column:
    """True if any "-"-separated token is anywhere in the lineage (case counts); a null lineage is "unknown;"."""
    lin = F.coalesce(lineage, F.lit("unknown;"))
    out = F.lit(False)
    for token in filter(None, taxon_filter.split("-")):
        out = out | F.contains(lin, F.lit(token))
    return out


def seven_ranks(names: Column) -> Column:
    """Seven names; missing ones are the parent's with _incertae_sedis, its other characters than letters and digits as _."""
    pad = lambda acc, _: F.when(F.size(acc) < 7, F.concat(acc, F.array(F.concat(F.regexp_replace(F.element_at(acc, -1), "[^A-Za-z0-9]", "_"), F.lit("_incertae_sedis"))))).otherwise(acc)
    return F.slice(F.aggregate(F.sequence(F.lit(1), F.lit(7)), names, pad), 1, 7)


def with_confidence(text: Column) -> Column:
    """"Name(conf);..." -> array of (taxon, conf)."""
    p = F.lit(r"([^;]+?)\((\d+)\);")
    return F.zip_with(F.regexp_extract_all(text, p, F.lit(1)), F.regexp_extract_all(text, p, F.lit(2)), lambda t, c: F.struct(t.alias("taxon"), c.cast("int").alias("conf")))


def confidence_text(pairs: Column) -> Column:
    return F.when(F.size(pairs) > 0, F.array_join(F.transform(pairs, lambda t: F.concat(t["taxon"], F.lit("("), t["conf"].cast("string"), F.lit(");"))), "")).otherwise(F.lit("unknown(0);"))


def cut_at_confidence(pairs: Column, least: int = 80, most: int = 6) -> Column:
    """Names down to the first one below `least`, at most `most`."""
    bad = F.array_position(F.transform(F.slice(pairs, 1, most), lambda t: t["conf"] < least), True)
    n = F.when(bad > 0, bad - 1).otherwise(F.least(F.size(pairs), F.lit(most))).cast("int")
    return F.transform(F.slice(pairs, F.lit(1), n), lambda t: t["taxon"])


def sintax(text: Column) -> Column:
    """"d:A,p:B" or "k__A;p__B" -> names without prefixes and blanks."""
    return F.filter(F.transform(F.split(F.regexp_replace(text, r"\(\d+(\.\d+)?\)", ""), "[,;]"), lambda x: F.trim(F.regexp_replace(x, "^ *([a-z]:|[a-z]__)", ""))), lambda x: x != "")
