"""Multi-party perspective rotation of dialogues, in DataFrame functions only.

For every participant of a dialogue the dialogue is rendered with that speaker as assistant and the others as users with
their names; system turns stay system turns and are nobody's perspective.  `mask` holds the character spans
[start, end) of the text to train on: the bodies and end marks of that speaker's turns.

A dialogue comes in parts of `turns` turn numbers, so that no task holds an unbounded dialogue: parts in order of
(part, sub), joined, are the whole dialogue, and spans count from the start of their part.  A part with a turn number that
more than `turns` rows of the dialogue share is cut into pieces of `turns` rows by position (sub = 0, 1, ...), in the same order of turn, role and text.

Edge cases: a null text is empty; a null role is "unknown"; a null turn comes last, in a part of its own; equal turns are ordered by role and text,
and repeated rows are repeated turns; rows without a conversation id are dialogues of one row's content each; a dialogue of system turns only has no participant
and gives no row.  Marks inside texts and names are escaped, so that a text cannot forge a turn.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

TURNS = 64
LAST = 2**62
#: Crowded parts that may be sent to the executors whole.
CROWDED = 1_000
CONTEXT = ("system",)


def escaped(text: Column) -> Column:
    """Turns "<|" into "<\\|"; "<\\" into "<\\\\" first, so that it can be undone."""
    return F.replace(F.replace(text, F.lit("<\\"), F.lit("<\\\\")), F.lit("<|"), F.lit("<\\|"))


def pieces(rows: DataFrame, turns: int) -> DataFrame:
    """Rows of crowded parts with sub: their position in the part's order, divided by `turns`.  Equal rows are counted first; the others are dealt
    out by ranges of the order, and a row's position is what lies in the ranges before and, in its own range, before it."""
    order = ["at", "role", "body"]
    equal = rows.groupBy("key", "part", *order).agg(F.count("*").alias("n"), F.first("conv_id").alias("conv_id"))
    equal = written(equal.repartitionByRange("key", "part", *order).withColumn("range", F.spark_partition_id()), "turns")
    before = (Window.unboundedPreceding, -1)
    ranges = equal.groupBy("key", "part", "range").agg(F.sum("n").alias("m"))
    base = F.coalesce(F.sum("m").over(Window.partitionBy("key", "part").orderBy("range").rowsBetween(*before)), F.lit(0))
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("key", "part", "range").orderBy(*order).rowsBetween(*before)), F.lit(0))
    placed = equal.withColumn("inside", inside).join(ranges.select("key", "part", "range", base.alias("base")), ["key", "part", "range"]).withColumn("start", F.col("base") + F.col("inside"))
    at = placed.withColumn("sub", F.explode(F.sequence(F.floor(F.col("start") / turns), F.floor((F.col("start") + F.col("n") - 1) / turns))))
    copies = F.least(F.col("start") + F.col("n"), (F.col("sub") + 1) * turns) - F.greatest(F.col("start"), F.col("sub") * turns)
    return at.withColumn("_c", F.explode(F.array_repeat(F.lit(1), copies.cast("int")))).select("key", "part", F.col("sub").cast("long").alias("sub"), "conv_id", *order)


def render(turns_df: DataFrame, *, turns: int = TURNS, context: tuple[str, ...] = CONTEXT) -> DataFrame:
    """conv_id, perspective, part, sub, n_turns, text, mask array<struct<start,end>>."""
    rows = turns_df.select(
        F.col("conv_id"),
        F.coalesce(F.col("turn").cast("long"), F.lit(LAST)).alias("at"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("body"),
    ).withColumn("key", F.when(F.col("conv_id").isNull(), F.concat(F.lit("?"), F.xxhash64("at", "role", "body").cast("string"))).otherwise(F.concat(F.lit("="), F.col("conv_id").cast("string"))))
    rows = rows.withColumn("part", F.floor(F.col("at") / turns).cast("long"))
    full = written(rows.groupBy("key", "part", "at").agg(F.count("*").alias("n")).where(F.col("n") > turns).select("key", "part").distinct(), "crowded")
    shown = ["key", "part", "sub", "conv_id", "at", "role", "body"]
    if full.isEmpty():
        placed = rows.withColumn("sub", F.lit(0).cast("long")).select(*shown)
    else:
        marked = rows.join(F.broadcast(full.withColumn("crowded", F.lit(True))) if full.count() <= CROWDED else full.withColumn("crowded", F.lit(True)), ["key", "part"], "left")
        placed = marked.where("crowded is null").withColumn("sub", F.lit(0).cast("long")).select(*shown).union(pieces(marked.where("crowded"), turns).select(*shown))
    parts = placed.groupBy("key", "part", "sub").agg(F.first("conv_id").alias("conv_id"), F.sort_array(F.collect_list(F.struct("at", "role", "body"))).alias("t"))
    speakers = rows.where(~F.col("role").isin(*context)).select("key", F.col("role").alias("perspective")).distinct()
    name = lambda r: escaped(F.regexp_replace(r, r"\s+", " "))

    def segment(t: Column) -> Column:
        own = t["role"] == F.col("perspective")
        head = F.concat(
            F.lit("<|im_start|>"),
            F.when(own, F.lit("assistant")).when(t["role"].isin(*context), name(t["role"])).otherwise(F.concat(F.lit("user name="), name(t["role"]))),
            F.lit("\n"),
        )
        tail = F.concat(escaped(t["body"]), F.lit("<|im_end|>"))
        return F.struct(F.concat(head, tail, F.lit("\n")).alias("s"), F.length(head).alias("head"), (F.length(head) + F.length(tail)).alias("end"), own.alias("own"))

    spans = F.aggregate(
        "seg",
        F.struct(F.lit(0).alias("pos"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
        lambda acc, s: F.struct(
            (acc["pos"] + s["end"] + 1).cast("int").alias("pos"),
            F.when(s["own"], F.concat(acc["spans"], F.array(F.struct((acc["pos"] + s["head"]).cast("int").alias("start"), (acc["pos"] + s["end"]).cast("int").alias("end"))))).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return (
        parts.join(speakers, "key")
        .withColumn("seg", F.transform("t", segment))
        .select("conv_id", "perspective", "part", "sub", F.size("t").cast("long").alias("n_turns"), F.array_join(F.transform("seg", lambda s: s["s"]), "").alias("text"), spans.alias("mask"))
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.array_join(F.transform("mask", lambda m: F.concat_ws("-", m["start"].cast("string"), m["end"].cast("string"))), ",")
    return render(table(spark, sf_dir, "conversations")).withColumn("mask", spans)


def sql() -> str:
    """DuckDB, for tables without conversation ids missing or turn numbers that more than 64 rows share."""
    esc = lambda x: rf"replace(replace({x}, '<\', '<\\'), '<|', '<\|')"
    return rf"""
    WITH r AS (SELECT conv_id, coalesce(turn, {LAST}) AS tn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS body FROM conversations WHERE conv_id IS NOT NULL),
    s AS (SELECT DISTINCT conv_id, role AS perspective FROM r WHERE role <> 'system'),
    g AS (SELECT conv_id, perspective, (tn >> 6) AS part, tn, role, body, role = perspective AS own,
          '<|im_start|>' || CASE WHEN role = perspective THEN 'assistant' WHEN role = 'system' THEN 'system' ELSE 'user name=' || {esc("regexp_replace(role, '[ \t\n\x0B\f\r]+', ' ', 'g')")} END || chr(10) AS head,
          {esc("body")} || '<|im_end|>' AS tail FROM r JOIN s USING (conv_id)),
    o AS (SELECT *, coalesce(sum(length(head) + length(tail) + 1) OVER (PARTITION BY conv_id, perspective, part ORDER BY tn, role, body ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos FROM g)
    SELECT conv_id, perspective, part::BIGINT AS part, 0::BIGINT AS sub, count(*) AS n_turns, string_agg(head || tail || chr(10), '' ORDER BY tn, role, body) AS text,
           coalesce(string_agg((pos + length(head))::VARCHAR || '-' || (pos + length(head) + length(tail))::VARCHAR, ',' ORDER BY pos) FILTER (WHERE own), '') AS mask
    FROM o GROUP BY conv_id, perspective, part"""
