"""Near-duplicate lines by an exact set-similarity join, in DataFrame functions only.

A line is the set of its lower-cased words.  A line goes if an earlier line (by document id, then place) has a Jaccard similarity of at least
`similarity` with it; whether that earlier line goes itself does not matter, so the result needs no order of work.

Lines of the same set are grouped first (by two 64-bit hashes of the ordered set), with their first place; all others of a group go.  The words
of a set are ordered from rare to common by a table of 2 ** 20 counts over the whole corpus, whatever its size (words of one hash bucket share
a count), then by hash.  Of two sets that reach the similarity, let n and m >= n be their sizes; they share at least s / (1 + s) * (n + m)
words.  So the first shared word is among the first m - ceil(s * m) + 1 words of the longer one, and among as many of the shorter one as that bound
leaves for the least m in question.  Sizes fall into bands a factor 1 / s wide: a set is indexed for longer partners in its own band and in the next,
and looks for shorter ones in its own, so that sets too different in size never meet.  Pairs must also have enough words left behind the
shared one and parity masks that differ little.  Those that pass are verified word by word, on the text of the two lines.

Large groups of near copies do not become all their pairs: where at least `HUB_LEAST` sets share one of the commoner words of their prefixes, each is
verified against the earliest of them first.  A set that is known to go needs no earlier partner any more, so the join that follows returns only pairs whose later set is
undecided.  Every set's fate is still exact, whatever `HUB_LEAST`; what the operator answers is which lines go, each with one or more earlier lines that
it matches, and not the number of all links, which grows with the square of such a group.

Numbers alone move until pairs are verified.  The text of a line moves only if a bitmap of 2 ** 25 places (4 MB, whatever the input) says that a pair may need
it.  Words whose bucket counts one occurrence are not indexed.  Joins are equi-joins, whose hot keys the skew join splits.

Edge cases: lines without a word are kept and match nothing; a null text is kept; rows equal in id and text are one document and lose the same
lines; a null id counts as the last; texts keep their other lines and line breaks; extra columns are kept; an empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import GAP, HAS_WORD, NULL_ID, bitmap, column, forget, marked, place_of, row_key, settle, table, written

SIMILARITY = 0.8
BUCKETS = 1 << 20
CHUNK = 1 << 10
#: Groups of at least so many sets with a word in common are first compared with their earliest one alone.  It decides on work, not on results.
HUB_WORDS, HUB_LEAST = 12, 32
#: Keys of the two joins on words are dealt into so many parts, one after the other, so that the shuffle files of one part are on disk at once.
PARTS = 3


def split(text: Column) -> Column:
    """Lower-cased words and maybe empty strings.  A single space is split without a regular expression."""
    odd = F.lit(False)
    for c in "\t\x0b\x0c\r":
        odd = odd | F.contains(text, F.lit(c))
    return F.when(odd, F.split(F.lower(text), GAP)).otherwise(F.split(F.lower(text), " "))


def words(line: Column) -> Column:
    """Distinct lower-cased words."""
    return F.array_distinct(F.array_remove(split(line), ""))


def lines_of(docs: DataFrame) -> DataFrame:
    """k_id, k_th, pos, line of every line; repeated rows twice."""
    return docs.select(*row_key(F.col("doc_id"), F.col("text")), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))


def bucket(hashed: Column) -> Column:
    return hashed.bitwiseAND(F.lit(BUCKETS - 1))


def rarity(docs: DataFrame) -> DataFrame:
    """One row with a byte for every hash bucket: three times the binary logarithm of its words' count.  A byte of 0 says that at most one word fell there.

    Eight bytes are put together as bits of a number, and the numbers' hexadecimal digits in order."""
    lines = docs.select(F.explode(F.split("text", "\n", -1)).alias("line"))
    counts = lines.select(F.explode(split(F.col("line"))).alias("w")).where("w <> ''").groupBy(bucket(F.xxhash64("w")).alias("b")).agg(F.count("*").alias("n"))
    level = F.least(F.floor(3 * F.log2("n")), F.lit(94)).cast("long")
    eight = counts.select(F.shiftright("b", 3).alias("c"), F.call_function("shiftleft", level, ((7 - F.col("b").bitwiseAND(F.lit(7))) * 8).cast("int")).alias("v"))
    every = eight.union(docs.sparkSession.range(BUCKETS // 8).select("id", F.lit(0).cast("long"))).groupBy("c").agg(F.bit_or("v").alias("v"))
    joined = lambda at, s: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(at.alias("at"), s.alias("s")))), lambda x: x["s"]), "")
    chunks = every.groupBy(F.expr(f"c div {CHUNK}").alias("d")).agg(joined(F.col("c"), F.lpad(F.hex("v"), 16, "0")).alias("s"))
    return written(chunks.agg(F.unhex(joined(F.col("d"), F.col("s"))).alias("scale")), "line-rarity")


class Sizes:
    """What the similarity s says about the sizes of partners."""

    def __init__(self, s: float):
        self.s = s

    def need(self, total: Column) -> Column:
        """Words that two sets of this total size must share."""
        return F.ceil(total * F.lit(self.s / (1 + self.s)) - 1e-9).cast("int")

    def longest(self, n: Column) -> Column:
        """Length of the prefix that meets any partner no longer."""
        return n - F.ceil(n * F.lit(self.s) - 1e-9).cast("int") + 1

    def against(self, n: Column, m: Column) -> Column:
        """Length of the prefix that meets any partner of m words or more."""
        return F.greatest(n - self.need(n + m) + 1, F.lit(0))

    def band(self, n: Column) -> Column:
        return (F.floor(F.log(n) / -math.log(self.s)) if self.s < 1 else n).cast("int")

    def beyond(self, n: Column) -> Column:
        """No partner in the next band is smaller; a little too small does no harm."""
        return F.greatest(n, F.ceil(F.pow(F.lit(1 / self.s), self.band(n) + 1) - 1e-6).cast("int") if self.s < 1 else n + 1)

    def may(self, n: Column, m: Column, p: Column, q: Column) -> Column:
        """Sizes n <= m and parity masks that a matching pair can have.  A word in one set only flips one bit of the mask, so masks differ in no more bits than the sets in words."""
        return (n >= m * F.lit(self.s) - 1e-9) & (F.bit_count(p.bitwiseXOR(q)) <= n + m - 2 * self.need(n + m))


def word_sets(docs: DataFrame, sizes: Sizes) -> DataFrame:
    """One row a distinct word set: g, its first place, n words, parity mask p, t the words of its longest prefix from rare to common."""
    counts = rarity(docs)
    scale = F.lit(counts.first()["scale"])  # BUCKETS bytes
    forget(counts)
    # Rare words have the smallest numbers: 7 bits of commonness, then 56 of hash.
    level = lambda h: F.ascii(F.substring(scale, bucket(h).cast("int") + 1, F.lit(1)).cast("string"))
    number = lambda h: F.shiftleft(level(h).cast("long"), 56).bitwiseOR(F.shiftrightunsigned(h, 8))
    hashes = F.array_remove(F.array_distinct(F.transform(split(F.col("line")), lambda w: F.xxhash64(w))), F.xxhash64(F.lit("")))
    place = F.struct(F.when(F.col("k_id") == NULL_ID, F.lit(2**63 - 1)).otherwise(F.col("k_id")).alias("o"), "k_th", "pos", "k_id")
    sets = lines_of(docs).where(F.col("line").rlike(HAS_WORD)).select(place.alias("first"), F.sort_array(F.transform(hashes, number)).alias("t"))
    flip = F.aggregate("t", F.lit(0).cast("long"), lambda acc, x: acc.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(F.lit(63)).cast("int"))))
    n = F.size("t")
    sets = sets.select("first", F.xxhash64("t").alias("s1"), F.xxhash64(F.lit(1), "t").alias("s2"), n.alias("n"), flip.alias("p"), F.slice("t", F.lit(1), sizes.longest(n)).alias("t"))
    sets = sets.groupBy("s1", "s2").agg(F.min("first").alias("first"), F.any_value("n").alias("n"), F.any_value("p").alias("p"), F.any_value("t").alias("t"))
    return written(sets.select(F.monotonically_increasing_id().alias("g"), "first", "n", "p", "t"), "line-sets")


def known(w: Column) -> Column:
    return F.shiftrightunsigned(w, 56) > 0


def part(rows: DataFrame, i: int) -> DataFrame:
    """The rows of the i-th part of all keys."""
    return rows.where(F.pmod("key", F.lit(PARTS)) == i)


def verified(candidates: Callable[[int], DataFrame], sets: DataFrame, docs: DataFrame, sizes: Sizes, name: str) -> DataFrame:
    """Links (g of the later set, later, earlier) of the candidate pairs (g_a, g_b) of every part, as places."""
    parts = []
    for i in range(PARTS):
        parts.append(written(candidates(i).distinct(), f"{name}-pairs"))
        settle(docs.sparkSession)
    pairs = reduce(DataFrame.union, parts).distinct()
    end = lambda x: sets.select(F.col("g").alias(f"g_{x}"), F.col("first").alias(f"first_{x}"))
    placed = pairs.join(end("a"), "g_a").join(end("b"), "g_b")
    late = F.col("first_a") > F.col("first_b")
    either = lambda when, x, y: F.when(when, F.col(x)).otherwise(F.col(y))
    placed = written(placed.select(either(late, "g_a", "g_b").alias("g"), either(late, "first_a", "first_b").alias("later"), either(late, "first_b", "first_a").alias("earlier")), f"{name}-placed")
    keys = ["k_id", "k_th", "pos"]
    ends = placed.select(F.explode(F.array("later", "earlier")).alias("x")).select(place_of(*[f"x.{k}" for k in keys]).alias("h"))
    bits = bitmap(ends, f"{name}-wanted")
    wanted = marked(lines_of(docs), bits, *keys)
    lines = wanted.groupBy(*keys).agg(F.first("line").alias("line"))
    text = lambda x: lines.select(*[F.col(k).alias(f"{x}_{k}") for k in keys], F.col("line").alias(f"{x}_line"))
    same = lambda x: [F.col(f"{x}.{k}") == F.col(f"{x[0]}_{k}") for k in keys]
    both = placed.join(text("e"), same("earlier")).select("g", "later", "earlier", "e_line").join(text("l"), same("later"))
    # The word sets of a pair are bound by a generator, so that they are made once.
    enough = lambda x: F.size(F.array_intersect(x["e"], x["l"])) >= sizes.need(F.size(x["e"]) + F.size(x["l"]))
    links = both.select("g", "later", "earlier", F.explode(F.transform(F.array(F.struct(words(F.col("e_line")).alias("e"), words(F.col("l_line")).alias("l"))), enough)).alias("ok")).where("ok").drop("ok")
    links = written(links, f"{name}-links")
    forget(*parts, placed, bits)
    settle(docs.sparkSession)
    return links


def heads_of(sets: DataFrame, sizes: Sizes) -> DataFrame:
    """key, g, n, p, o: the commoner words of every set's prefix, made once for all parts."""
    words_of = F.slice(F.reverse(F.filter("t", known)), F.lit(1), F.lit(HUB_WORDS))
    heads = sets.select("g", "n", "p", F.col("first.o").alias("o"), sizes.band(F.col("n")).alias("band"), F.explode(words_of).alias("w"))
    return written(heads.select(F.xxhash64("w", "band").alias("key"), "g", "n", "p", "o"), "line-heads")


def by_hub(heads: DataFrame, sizes: Sizes, i: int) -> DataFrame:
    """Candidate pairs (g_a, g_b) of each set with the earliest one of the large groups that share a commoner word of its prefix, in the i-th part."""
    heads = part(heads, i)
    hubs = heads.groupBy("key").agg(F.count("*").alias("many"), *[F.min_by(c, "o").alias(f"hub_{c}") for c in ("g", "n", "p")]).where(F.col("many") >= HUB_LEAST).drop("many")
    tried = heads.join(hubs, "key").where("g <> hub_g")
    return tried.where(sizes.may(F.least("n", "hub_n"), F.greatest("n", "hub_n"), F.col("p"), F.col("hub_p"))).select(F.col("hub_g").alias("g_a"), F.col("g").alias("g_b"))


def by_prefix(sets: DataFrame, sizes: Sizes, i: int) -> DataFrame:
    """Candidate pairs (g_a, g_b) of the i-th part, each once or more; sets: with `open`, and only pairs whose later set may be an open one.

    One index serves both sides: a row has whether its word is in the prefix for longer partners (low) and for shorter ones (high)."""
    n, band = F.col("n"), sizes.band(F.col("n"))
    index = sets.select("g", "n", "p", F.col("first.o").alias("o"), "open", F.posexplode("t").alias("at", "w")).where(known(F.col("w")))
    step = F.explode(F.when(F.col("at") < sizes.against(n, sizes.beyond(n)), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    index = index.select("*", step.alias("step"))
    flags = F.when(F.col("open"), 1).otherwise(0) + F.when((F.col("step") == 1) | (F.col("at") < sizes.against(n, n)), 2).otherwise(0) + F.when(F.col("step") == 0, 4).otherwise(0)
    index = part(index.select(F.xxhash64("w", band + F.col("step")).alias("key"), "g", "o", "p", "n", "at", flags.alias("is")), i)
    a, b = (index.select("key", *[F.col(c).alias(f"{c}_{x}") for c in ("g", "o", "p", "n", "at", "is")]) for x in "ab")
    # Both flags in one term: a filter on one side alone would be pushed down, and the sides could no longer share one exchange.
    has = lambda x, bit: F.col(f"is_{x}").bitwiseAND(F.lit(bit))
    c = F.col
    left = F.least(c("n_a") - c("at_a"), c("n_b") - c("at_b"))
    return a.join(b, "key").where(
        (has("a", 2) + has("b", 4) == 6)
        & ((c("n_a") < c("n_b")) | (c("n_a") == c("n_b")) & (c("g_a") < c("g_b")))
        & ((has("a", 1) == 1) & (c("o_a") >= c("o_b")) | (has("b", 1) == 1) & (c("o_b") >= c("o_a")))
        & sizes.may(c("n_a"), c("n_b"), c("p_a"), c("p_b")) & (left >= sizes.need(c("n_a") + c("n_b")))
    ).select("g_a", "g_b")


def matched(docs: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """The distinct word sets (g, first, ...) and links (g, later, earlier): at least one for every set whose first line matches an earlier line."""
    sizes = Sizes(similarity)
    sets = word_sets(docs, sizes)
    settle(docs.sparkSession)
    heads = heads_of(sets, sizes)
    early = verified(lambda i: by_hub(heads, sizes, i), sets, docs, sizes, "line-hub")
    forget(heads)
    gone = early.select("g").distinct().withColumn("gone", F.lit(True))
    rest = written(sets.join(gone, "g", "left").withColumn("open", F.col("gone").isNull()).drop("gone"), "line-sets")
    forget(sets)
    settle(docs.sparkSession)
    return rest, verified(lambda i: by_prefix(rest, sizes, i), rest, docs, sizes, "line").union(early)


def kept(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """k_id, k_th, and `stay`: the places of the lines with words that stay, as (number of 64 lines, bits)."""
    sets, links = matched(docs, similarity)
    stay = sets.select("g", "first.k_id", "first.k_th", "first.pos").join(links.select("g"), "g", "left_anti")
    bits = stay.groupBy("k_id", "k_th", F.shiftright("pos", 6).alias("c")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("pos").bitwiseAND(F.lit(63)))).alias("b"))
    return bits.groupBy("k_id", "k_th").agg(F.collect_list(F.struct("c", "b")).alias("stay"))


def picked(stay: Column, last: Column, then) -> Column:
    """then(stays), where stays tells of a line number up to `last` whether it is in `stay`.  The bits of every 64 lines are laid out once."""
    none = F.array().cast("array<struct<c:int,b:long>>")
    bits = F.transform(F.sequence(F.lit(0), F.shiftright(last, 6)), lambda c: F.coalesce(F.get(F.filter(F.coalesce(stay, none), lambda x: x["c"] == c), 0)["b"], F.lit(0).cast("long")))
    one = lambda b: lambda i: F.call_function("shiftrightunsigned", F.get(b, F.shiftright(i, 6)), i.bitwiseAND(F.lit(63))).bitwiseAND(F.lit(1)) == 1
    return F.get(F.transform(F.array(bits), lambda b: then(one(b))), 0)


def dedup(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """docs with the later matches cut out of `text`; every row stays."""
    stay = written(kept(docs, similarity), "lines-kept")
    rows = docs.select(F.struct(*[column(c) for c in docs.columns]).alias("row"), *row_key(F.col("doc_id"), F.col("text"))).join(stay, ["k_id", "k_th"], "left")
    lines = F.split(F.col("row.text"), "\n", -1)
    left = F.get(F.transform(F.array(lines), lambda ls: picked(F.col("stay"), F.size(ls), lambda stays: F.filter(ls, lambda x, i: stays(i) | ~x.rlike(HAS_WORD)))), 0)
    text = F.when(F.col("row.text").isNotNull(), F.array_join(left, "\n")).alias("text")
    return rows.select(*[text if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with_words = F.filter(F.transform(F.split("text", "\n", -1), lambda x, i: F.when(x.rlike(HAS_WORD), i).otherwise(-1)), lambda i: i >= 0)
    rows = docs.select("doc_id", F.coalesce(with_words, F.array().cast("array<int>")).alias("at"), *row_key(F.col("doc_id"), F.col("text")))
    rows = rows.join(kept(docs), ["k_id", "k_th"], "left")
    gone = picked(F.col("stay"), F.greatest(F.array_max("at"), F.lit(0)), lambda stays: F.filter("at", lambda i: ~stays(i)))
    return rows.select("doc_id", F.size("at").cast("long").alias("n_lines"), gone.alias("gone")).select("doc_id", "n_lines", F.size("gone").cast("long").alias("n_removed"), F.array_join(F.transform("gone", lambda x: x.cast("string")), ",").alias("removed_lines"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    settle(spark)
    return dedup(docs)
