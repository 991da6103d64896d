"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are compared in tiles with numpy exclusive-or and bit counts.  A tile holds fingerprints whose
four 16-bit words have the same four population counts; two tiles are compared only if these counts differ by no
more than the radius in sum, since every differing bit changes one count by one.  So no link is lost and most tile
pairs are skipped.  Full cells are split into tiles of about `tile` rows by hash, and all their pairs compared.  Equal fingerprints are
one node; of the links that a tile pair finds, a spanning forest goes on, which keeps the components.

The work is quadratic in distinct fingerprints with a small factor (about 1/80 of all pairs at four words).

The pipeline's stage (`keep_similar`) finds texts whose sets of 5-word shingles are alike by 0.8: the same tiled comparison over wider fingerprints and a wider
radius, with tiles by bands of set sizes as well; each tile pair hands on a spanning forest of its candidates, nearest first, and every link is verified on the
whole shingle sets, so nothing is removed for a fingerprint alone.

Edge cases: a null or wordless text has fingerprint zero, linked like any other; a text of fewer words than a shingle has its
whole word sequence as one; a null id never is a component's id unless all its ids are null; repeated rows stay
separate rows.  Extra columns are ignored, and kept by `keep_one`.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import NULL_ID, bitmap, column, forget, marked, place_of, row_key, settle, table, written
from .components import stars

SHINGLE = 3
RADIUS = 3
TILE = 2_048
WORDS = 4
SEED = 42
MIX = np.uint64(0x9E3779B97F4A7C15)
#: The pipeline's stage: 5-word shingles, similarity 0.8, fingerprints of 256 bits.  At that similarity two of them differ in 39 bits on average, with a deviation of
#: 6, and in 10 with 3 in the first word; unlike texts differ in 128 and 32.  The radius leaves 3.7 deviations; links are verified on the shingles.
WIDE_SHINGLE, WIDE_BITS, WIDE_FIRST = 5, 256, 20
SIMILARITY = 0.8
LAYERS = (-1, 8, 16, 24, 32, 40, 50, 60)


def fingerprint(text: str | None, k: int = SHINGLE) -> int:
    """Unsigned 64 bits: a bit is 1 if over half of the shingles' hashes have it."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z, and the six ASCII white-space characters
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= k:
        return digest(joined, SEED)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    hashes = [digest(joined[a : b - 1], SEED) for a, b in zip([0, *ends], ends[k - 1 :], strict=False)]
    n, bits = len(hashes), np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], "<u8")
        bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * bits > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, carry: list, k: int = SHINGLE) -> DataFrame:
    """The carried long columns and fp (the fingerprint's bits as a long)."""
    rows = docs.select(*carry, F.col("text").cast("string").alias("text"))
    names = rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, k) for t in b.column(len(names)).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fp)], [*names, "fp"])

    return rows.mapInArrow(run, ", ".join([*(f"{n} long" for n in names), "fp long"]))


def forest(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For edges (i, j) over n nodes: each node that is not the least of its component, and that least one."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    at = np.flatnonzero(label != np.arange(n))
    return at, label[at]


def compare(a: np.ndarray, b: np.ndarray, same: bool, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between two tiles (or within one), as a spanning forest."""
    i, j = np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= radius)
    if same:
        i, j = i[i < j], j[i < j]
        u, v = forest(i, j, len(a)) if len(i) else (i, j)
        return a[u], a[v]
    if not len(i):
        return a[i], b[j]
    both = np.concatenate([a, b])
    u, v = forest(i, j + len(a), len(both))
    return both[u], both[v]


def links(nodes: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """nodes: distinct fp.  -> edges (u, v) whose components are those of all pairs within the radius."""
    width = 64 // WORDS
    count = lambda w: F.bit_count(F.shiftrightunsigned("fp", w * width).bitwiseAND(F.lit((1 << width) - 1)))
    cells = nodes.select("fp", *[count(w).alias(f"p{w}") for w in range(WORDS)])
    key = [f"p{w}" for w in range(WORDS)]
    # At most 17 ** 4 rows of five numbers, whatever the input.
    sizes = written(cells.groupBy(*key).agg(F.ceil(F.count("*") / tile).cast("long").alias("parts")), "cells")
    tiles = written(
        cells.join(F.broadcast(sizes), key)
        .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")))
        .groupBy(*key, "part").agg(F.collect_list("fp").alias("fps")),
        "tiles",
    )
    steps = [s for s in itertools.product(range(-radius, radius + 1), repeat=WORDS) if sum(map(abs, s)) <= radius and s >= (0,) * WORDS]
    near = F.explode(F.array(*[F.struct(*[(F.col(k) + d).cast("int").alias(k) for k, d in zip(key, s, strict=True)], F.lit(any(s)).alias("other")) for s in steps]))
    left = tiles.select(F.col("part").alias("part_a"), F.col("fps").alias("a"), near.alias("to")).select("part_a", "a", "to.*")
    # Only cells that exist are met; a tile's partners within its own cell have a part no smaller.
    pairs = left.join(tiles.select(*key, F.col("part").alias("part_b"), F.col("fps").alias("b")), key).where("other or part_b >= part_a").select("a", "b", (F.col("other") | (F.col("part_b") > F.col("part_a"))).alias("other"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs = [], []
            a, b, other = batch.column(0), batch.column(1), batch.column(2).to_pylist()
            av, bv = (c.flatten().to_numpy(zero_copy_only=False).view(np.uint64) for c in (a, b))
            ao, bo = (np.concatenate([[0], np.cumsum(c.value_lengths().to_numpy(zero_copy_only=False))]) for c in (a, b))
            for r, differ in enumerate(other):
                u, v = compare(av[ao[r] : ao[r + 1]], bv[bo[r] : bo[r + 1]], not differ, radius)
                if len(u):
                    us.append(u)
                    vs.append(v)
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (us, vs)], ["u", "v"])

    return pairs.mapInArrow(run, "u long, v long")


def components(fps: DataFrame, radius: int = RADIUS, tile: int = TILE, best: str = "doc_id") -> DataFrame:
    """fps: (fp, best).  -> fp, component: the least `best` of all rows whose fingerprints are reachable."""
    nodes = written(fps.groupBy("fp").agg(F.min(best).alias("least")), "nodes")
    roots = stars(links(nodes.select("fp"), radius, tile))
    rooted = nodes.join(roots.select(F.col("u").alias("fp"), "root"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = written(rooted, "rooted")
    tops = written(rooted.groupBy("root").agg(F.min("least").alias("component")), "tops")
    return written(rooted.join(tops, "root").select("fp", "component"), "components")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    fps = written(fingerprints(table(spark, sf_dir, "documents"), [F.col("doc_id").cast("long").alias("doc_id")]), "fps")
    return fps.join(components(fps), "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


def wide_fingerprint(text: str | None, k: int = WIDE_SHINGLE) -> tuple[int, bytes]:
    """(number of distinct k-word shingles, WIDE_BITS bits as bytes): the SimHash of the set, each bit from a mixed copy of the shingles' hashes."""
    hashes = np.array(sorted(shingle_hashes(text, k)), np.uint64)
    bits = np.zeros(WIDE_BITS, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)]
        words = mixed(part[:, None] + np.arange(WIDE_BITS // 64, dtype=np.uint64) * MIX)
        bits += np.unpackbits(words.view(np.uint8).reshape(-1, WIDE_BITS // 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return len(hashes), np.packbits(2 * bits > len(hashes), bitorder="little").tobytes()


def shingle_hashes(text: str | None, k: int) -> set[int]:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return set()
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= k:
        return {digest(joined, SEED)}
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    return {digest(joined[a : b - 1], SEED) for a, b in zip([0, *ends], ends[k - 1 :], strict=False)}


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def layered(i: np.ndarray, j: np.ndarray, apart: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the edges (i, j) over n nodes that prefers near ones: by LAYERS of distance, only edges between parts that nearer ones leave apart."""
    label, us, vs = np.arange(n), [], []
    for low, high in zip(LAYERS, LAYERS[1:], strict=False):
        at = np.flatnonzero((apart > low) & (apart <= high))
        a, b = label[i[at]], label[j[at]]
        at, a, b = at[a != b], a[a != b], b[a != b]
        while len(at):
            # Each part takes one edge to the least part beside it, with its own two ends.
            lo, hi = np.minimum(a, b), np.maximum(a, b)
            order = np.lexsort((apart[at], lo, hi))
            pick = order[np.unique(hi[order], return_index=True)[1]]
            us.append(i[at[pick]])
            vs.append(j[at[pick]])
            u, v = forest(lo[pick], hi[pick], n)
            to = np.arange(n)
            to[u] = v
            label = to[label]
            a, b = label[i[at]], label[j[at]]
            at, a, b = at[a != b], a[a != b], b[a != b]
    return (np.concatenate(us), np.concatenate(vs)) if us else (i[:0], j[:0])


def near(a: np.ndarray, b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, distance) of the rows of two tiles of wide fingerprints within the wide radius; the first word decides on most."""
    i, j = np.nonzero(np.bitwise_count(a[:, None, 0] ^ b[None, :, 0]) <= WIDE_FIRST)
    if same:
        i, j = i[i < j], j[i < j]
    apart = np.bitwise_count(a[i] ^ b[j]).sum(1, dtype=np.int64)
    ok = apart <= LAYERS[-1]
    return i[ok], j[ok], apart[ok]


def candidates(nodes: DataFrame, thin: bool, tile: int = TILE) -> DataFrame:
    """nodes: node, label, n, fp (wide).  -> pairs (u, v) of different labels: all candidates, or a near-first spanning forest of each tile pair's.

    Texts of n and m shingles reach the similarity only if their sizes lie within it, so tiles are made by bands of sizes and meet their own band and the
    next; and by the population count of the first word, which differs by no more than the radius."""
    pop = F.bit_count(F.conv(F.hex(F.substring("fp", 1, 8)), 16, -10).cast("long"))
    band = F.when(F.col("n") > 0, F.floor(F.log(F.greatest("n", F.lit(1))) / -math.log(SIMILARITY))).otherwise(-2).cast("int")
    cells = nodes.select("node", "label", "fp", band.alias("band"), pop.alias("pop"))
    # A row for each band of sizes and population count: some thousands, whatever the input.
    sizes = written(cells.groupBy("band", "pop").agg(F.ceil(F.count("*") / tile).cast("long").alias("parts")), "wide-cells")
    tiles = cells.join(F.broadcast(sizes), ["band", "pop"]).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
    tiles = written(tiles.groupBy("band", "pop", "part").agg(F.collect_list(F.struct("node", "label", "fp")).alias("x")).select("band", "pop", "part", F.col("x.node").alias("nodes"), F.col("x.label").alias("labels"), F.col("x.fp").alias("fps")), "wide-tiles")
    there = sizes.select(F.col("band").alias("band_b"), F.col("pop").alias("pop_b"))
    meets = sizes.select("band", "pop").join(F.broadcast(there), (F.col("band_b") >= F.col("band")) & (F.col("band_b") <= F.col("band") + 1) & (F.abs(F.col("pop_b") - F.col("pop")) <= WIDE_FIRST) & ((F.col("band_b") > F.col("band")) | (F.col("pop_b") >= F.col("pop"))))
    left = tiles.select("band", "pop", F.col("part").alias("part_a"), F.col("nodes").alias("a"), F.col("fps").alias("fa"), F.col("labels").alias("la")).join(F.broadcast(meets), ["band", "pop"])
    own = (F.col("band") == F.col("band_b")) & (F.col("pop") == F.col("pop_b"))
    right = tiles.select(F.col("band").alias("band_b"), F.col("pop").alias("pop_b"), F.col("part").alias("part_b"), F.col("nodes").alias("b"), F.col("fps").alias("fb"), F.col("labels").alias("lb"))
    pairs = left.join(right, ["band_b", "pop_b"]).where(~own | (F.col("part_b") >= F.col("part_a"))).select("a", "fa", "la", "b", "fb", "lb", (own & (F.col("part_a") == F.col("part_b"))).alias("same"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs = [], []
            for r in range(batch.num_rows):
                a, la, b, lb = (batch.column(c)[r].values.to_numpy(zero_copy_only=False) for c in (0, 2, 3, 5))
                fa, fb = (np.frombuffer(b"".join(batch.column(c)[r].values.to_pylist()), "<u8").reshape(-1, WIDE_BITS // 64) for c in (1, 4))
                i, j, apart = near(fa, fb, batch.column(6)[r].as_py())
                ok = la[i] != lb[j]
                i, j, apart = i[ok], j[ok], apart[ok]
                if thin and len(i):
                    both, at = np.unique(np.concatenate([a, b]), return_inverse=True)
                    u, v = layered(at[i], at[j + len(a)], apart, len(both))
                    us.append(both[u])
                    vs.append(both[v])
                else:
                    us.append(a[i])
                    vs.append(b[j])
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in (us, vs)], ["u", "v"])

    return pairs.mapInArrow(run, "u long, v long")


def similar(docs: DataFrame) -> DataFrame:
    """Links (u, v) between the nodes (hashes of word sequences) of texts whose sets of 5-word shingles have a Jaccard similarity of SIMILARITY or more."""
    texts = docs.select(F.col("text").cast("string").alias("text"))

    def wide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [(node_of(t), *wide_fingerprint(t)) for t in b.column(0).to_pylist()]
            node, n, fp = zip(*got, strict=True) if got else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(n, pa.int64()), pa.array(fp, pa.binary())], ["node", "n", "fp"])

    nodes = written(texts.mapInArrow(wide, "node long, n long, fp binary").groupBy("node").agg(F.first("n").alias("n"), F.first("fp").alias("fp")), "wide-nodes")
    first = verified(written(candidates(nodes.withColumn("label", F.col("node")), True).distinct(), "wide-forest"), texts)
    # A forest's link that fails may stand for one that holds, so what the links of the forest leave apart is compared once more, pair by pair.
    roots = stars(first)
    settle(docs.sparkSession)
    labelled = written(nodes.join(roots.select(F.col("u").alias("node"), "root"), "node", "left").select("node", F.coalesce("root", "node").alias("label"), "n", "fp"), "wide-labelled")
    return first.union(verified(written(candidates(labelled, False).distinct(), "wide-pairs"), texts))


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (u, v) of nodes whose shingle sets reach the similarity."""
    bits = bitmap(pairs.select(F.explode(F.array("u", "v")).alias("node")).select(place_of("node").alias("h")), "wide-wanted")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([node_of(t) for t in b.column(0).to_pylist()], pa.int64()), b.column(0)], ["node", "text"])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [np.array(sorted(shingle_hashes(t, WIDE_SHINGLE)), np.uint64).tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.binary())], ["node", "s"])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                p, q = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(both >= SIMILARITY * (len(p) + len(q) - both) - 1e-9)
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    held = marked(texts.mapInArrow(keyed, "node long, text string"), bits, "node").groupBy("node").agg(F.first("text").alias("text"))
    held = written(held.mapInArrow(sets, "node long, s binary"), "wide-sets")
    side = lambda x: held.select(F.col("node").alias(x), F.col("s").alias(f"s_{x}"))
    links = written(pairs.join(side("u"), "u").join(side("v"), "v").select("u", "v", "s_u", "s_v").mapInArrow(judge, "u long, v long"), "wide-links")
    forget(held, bits, pairs)
    settle(texts.sparkSession)
    return links


def node_of(text: str | None) -> int:
    """A signed hash of the lower-cased word sequence."""
    h = xxhash.xxh3_64_intdigest(b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split()))
    return h - (1 << 64) if h >> 63 else h


def keep_one(docs: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """docs with one row of each component: that of the smallest id (null ids last), of its texts the one with the smallest
    hash, and of rows equal in both any one."""
    k_id, k_th = row_key(F.col("doc_id"), F.col("text"))
    fps = written(fingerprints(docs, [k_id, k_th]), "fps")
    # A null id's key is the least long; turned round so that it comes last.
    rank = F.struct(F.when(F.col("k_id") == -(2**63) + 1, F.lit(2**63 - 1)).otherwise(F.col("k_id")).alias("i"), F.col("k_th").alias("t"), F.col("k_id").alias("k"))
    best = components(fps.withColumn("best", rank), radius, tile, "best")
    keep = written(best.select("component").distinct().select(F.col("component.k").alias("k_id"), F.col("component.t").alias("k_th")), "keep")
    one = F.row_number().over(Window.partitionBy("k_id", "k_th").orderBy("k_id"))
    rows = docs.select(F.struct(*[column(c) for c in docs.columns]).alias("row"), k_id, k_th)
    return rows.join(keep, ["k_id", "k_th"], "left_semi").withColumn("one", one).where("one = 1").select(*[F.col("row")[c].alias(c) for c in docs.columns])


def keep_similar(docs: DataFrame) -> DataFrame:
    """docs with one row of each group of near duplicates (5-word shingles, Jaccard similarity of 0.8 or more, chained): which one, as `keep_one`."""
    roots = stars(similar(docs))
    k_id, k_th = row_key(F.col("doc_id"), F.col("text"))

    def node(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([node_of(t) for t in b.column(2).to_pylist()], pa.int64())], ["k_id", "k_th", "node"])

    rows = written(docs.select(k_id, k_th, F.col("text").cast("string").alias("text")).mapInArrow(node, "k_id long, k_th long, node long"), "wide-rows")
    rank = F.struct(F.when(F.col("k_id") == NULL_ID, F.lit(2**63 - 1)).otherwise(F.col("k_id")).alias("i"), F.col("k_th").alias("t"), F.col("k_id").alias("k"))
    best = rows.groupBy("node").agg(F.min(rank).alias("best")).join(roots.select(F.col("u").alias("node"), "root"), "node", "left")
    best = best.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("best").alias("best"))
    keep = written(best.select(F.col("best.k").alias("k_id"), F.col("best.t").alias("k_th")), "wide-keep")
    one = F.row_number().over(Window.partitionBy("k_id", "k_th").orderBy("k_id"))
    held = docs.select(F.struct(*[column(c) for c in docs.columns]).alias("row"), k_id, k_th)
    return held.join(keep, ["k_id", "k_th"], "left_semi").withColumn("one", one).where("one = 1").select(*[F.col("row")[c].alias(c) for c in docs.columns])


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    settle(spark)
    return keep_similar(docs)
