"""Connected components of a graph given as edges, by alternating large-star and small-star rounds.

Every round is two aggregations with a join each, cut off by a written table, so that lost executors cost one round
at most.  The minimum of a node's neighbours is an aggregate with map-side combining; joins on a hub node are left to the skew
join.  Nothing but two checksums a round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """edges: (u, v).  Links u's neighbours (the larger ones, or the smaller ones and u) to the least of them."""
    ends = edges.where("u > v") if small else edges.union(edges.select("v", "u"))
    least = ends.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    to = ends.join(least, "u")
    near = to.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v") if small else to.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    more = least.select("u", F.col("m").alias("v")).where("u > v") if small else None
    return (near.union(more) if small else near.union(least.select("u", F.col("m").alias("v")).where("u > v"))).distinct()


def stars(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """edges: (u long, v long), any order.  -> (u, root) for every node that is not its component's least."""
    edges = written(edges.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = lambda d: tuple(d.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    seen = mark(edges)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        edges = written(_star(written(_star(edges, False), "large-star"), True), "small-star")
        now = mark(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select("u", F.col("v").alias("root"))
