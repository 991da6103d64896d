"""Repeated long spans by De Bruijn compaction.

A span of `window` words is repeated if its word sequence starts at two places or more.  Instead of counting
every window, the texts become paths in a sparse De Bruijn graph: the k-word strings that are the least of
some window (by hash) are its nodes, and the text from one to the next is an edge.  Equal windows hold equal nodes at equal
places, so a window whose least k-word string is unique cannot be repeated.

Node and edge occurrences are counted.  Where a node, the edge after it and the next node have the same count of two or more, every
occurrence goes on alike: the path does not branch there.  Maximal runs of such edges are compacted into one path, and
every window inside a path is repeated, at all its occurrences.  Only windows that cross a path's end
are left; a window crosses an end at one occurrence if and only if it does at all, so these are verified among
themselves, by 128-bit hashes of their words taken at their source coordinates.

Counting is by aggregates with map-side combining; the counts of two and more are written and joined back, where the skew
join splits hot keys.  One document is read whole in one task, nothing else is collected.

Edge cases: a null or wordless text has no words and keeps the empty string; texts shorter than a window lose nothing; repeated rows
are different places, so their texts are removed if they have a window; rows may share an id.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import row_key, table, written

WINDOW = 35
K = 12
MIX = np.uint64(0x9E3779B97F4A7C15)


def split(text: str | None) -> list[bytes]:
    """Words: bytes split at the six ASCII white-space characters."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least of every w neighbours, by doubling."""
    have, m = 1, x
    while have * 2 <= w:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    return np.minimum(m[: len(m) - (w - have)], m[w - have :]) if have < w else m


def sliding_max(x: np.ndarray, w: int) -> np.ndarray:
    return ~sliding_min(~x, w)


def spread(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def word_hashes(words: list[bytes], memo: dict[bytes, int]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    out = []
    for w in words:
        h = memo.get(w)
        if h is None:
            if len(memo) > 400_000:
                memo.clear()
            h = memo[w] = digest(w)
        out.append(h)
    return np.array(out, np.uint64)


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every k neighbours."""
    n = len(h) - k + 1
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * MIX + h[j : j + n]
    return spread(out)


class Path:
    """A text's nodes: the positions `at` of its least k-word strings, their hashes, and the edges' hashes.

    Hashes of edges come from 64-bit prefix hashes of the words, so a text's nodes and edges cost a few array operations."""

    def __init__(self, words: list[bytes], window: int, k: int, memo: dict[bytes, int]):
        self.n, self.window, self.k = len(words), window, k
        self.spans = window - k + 1
        if self.n < window:
            self.at = np.zeros(0, np.int64)
            return
        h = word_hashes(words, memo)
        self.codes = rolling(h, k)
        self.least = sliding_min(self.codes, self.spans)  # of every window
        pad = np.zeros(self.spans - 1, np.uint64)
        top = sliding_max(np.concatenate([pad, self.least, pad]), self.spans)  # the largest least value of the windows over a position
        self.at = np.flatnonzero(top == self.codes)
        self.nodes = self.codes[self.at]
        # The words from one node's start to the next one's end are told by all k-word strings between; chain their hashes.
        acc = np.concatenate([np.zeros(1, np.uint64), np.cumsum(spread(self.codes) * (np.arange(len(self.codes), dtype=np.uint64) * np.uint64(2) + np.uint64(1)), dtype=np.uint64)])
        base = np.concatenate([np.zeros(1, np.uint64), np.cumsum(spread(self.codes), dtype=np.uint64)])
        a, b = self.at[:-1], self.at[1:]
        one = base[b + 1] - base[a]
        two = (acc[b + 1] - acc[a]) - one * (a.astype(np.uint64) * np.uint64(2))  # positions counted from the edge's start
        self.edges = spread(spread(two) ^ (one * MIX) ^ (b - a).astype(np.uint64) ^ np.uint64(0x5851F42D4C957F2D))

    def keys(self) -> np.ndarray:
        """Node and edge hashes in turn; an edge's slot is twice its first node's number plus 1."""
        out = np.zeros(max(0, 2 * len(self.at) - 1), np.uint64)
        if len(out):
            out[0::2], out[1::2] = self.nodes, self.edges
        return out

    def judge(self, slots: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """slots with a count of two or more -> (windows inside paths, windows left to verify), as starts."""
        none = np.zeros(0, np.int64)
        if not len(self.at) or not len(slots):
            return none, none
        many = np.zeros(2 * len(self.at), np.int64)
        many[slots] = counts
        node, edge = many[0::2], many[1::2][:-1]
        linked = (node[:-1] >= 2) & (node[:-1] == edge) & (edge == node[1:])
        run = np.concatenate([[0], np.cumsum(~linked)])  # the path of every node
        first = np.searchsorted(run, run)
        last = np.searchsorted(run, run, side="right") - 1
        starts = np.arange(len(self.least))
        # A window's node: the first of its nodes that has the window's least hash.
        i = np.searchsorted(self.at, starts)
        own = self.codes[self.at[i]] == self.least
        while not own.all():
            i = np.where(own, i, i + 1)
            own = self.codes[self.at[i]] == self.least
        can = node[i] >= 2
        inside = can & (starts >= self.at[first[i]]) & (starts + self.window <= self.at[last[i]] + self.k)
        return np.flatnonzero(inside), np.flatnonzero(can & ~inside)


def covered(starts: np.ndarray, n: int, window: int) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    edge[starts] += 1
    edge[starts + window] -= 1
    return np.cumsum(edge[:n]) > 0


def _numbers(column: pa.Array) -> list[np.ndarray]:
    return [np.zeros(0, np.int64) if x is None else np.array(x, np.int64) for x in column.to_pylist()]


def repeats(docs: DataFrame, *, window: int = WINDOW, k: int = K, carry: list | None = None) -> DataFrame:
    """Every row's carried columns, with n_words, n_removed, kept (the words left, joined by one space)."""
    keyed = docs.select(*row_key(F.col("doc_id"), F.col("text")), F.col("text").cast("string").alias("text"))

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[bytes, int] = {}
        for b in batches:
            got = [Path(split(t), window, k, memo).keys().view(np.int64) if t else np.zeros(0, np.int64) for t in b.column(2).to_pylist()]
            n = np.array([len(g) for g in got])
            if not n.sum():
                continue
            row = np.repeat(np.arange(len(n)), n)
            slot = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)), pa.array(slot.astype(np.int32)), pa.array(np.concatenate(got))], ["k_id", "k_th", "slot", "key"])

    kind = "k_id long, k_th long, slot int, key long"
    found = keyed.mapInArrow(nodes, kind)
    many = written(found.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "nodes")
    repeated = written(found.join(many, "key").groupBy("k_id", "k_th").agg(F.sort_array(F.collect_set(F.struct("slot", "n"))).alias("m")).select("k_id", "k_th", F.col("m.slot").alias("slots"), F.col("m.n").alias("counts")), "paths")

    def crossing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[bytes, int] = {}
        digest = xxhash.xxh3_128_digest
        for b in batches:
            ids, ths = b.column(0).to_pylist(), b.column(1).to_pylist()
            out: tuple[list, list, list, list] = ([], [], [], [])
            for i, th, text, slots, counts in zip(ids, ths, b.column(2).to_pylist(), _numbers(b.column(3)), _numbers(b.column(4)), strict=True):
                words = split(text)
                left = Path(words, window, k, memo).judge(slots, counts)[1]
                if not len(left):
                    continue
                joined = b" ".join(words)
                ends = np.cumsum(np.fromiter((len(w) + 1 for w in words), np.int64, len(words)))
                begins = ends - np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
                hashes = [digest(joined[x:y]) for x, y in zip(begins[left].tolist(), (ends[left + window - 1] - 1).tolist(), strict=True)]
                both = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
                out[0].append(np.full(len(left), i))
                out[1].append(np.full(len(left), th))
                out[2].append(left)
                out[3].append(both)
            if out[0]:
                both = np.concatenate(out[3])
                cols = [np.concatenate(out[0]), np.concatenate(out[1]), np.concatenate(out[2]).astype(np.int32), both[:, 0].copy(), both[:, 1].copy()]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["k_id", "k_th", "start", "h1", "h2"])

    texts = keyed.join(repeated, ["k_id", "k_th"])
    left = written(texts.select("k_id", "k_th", "text", "slots", "counts").mapInArrow(crossing, "k_id long, k_th long, start int, h1 long, h2 long"), "crossing")
    twice = written(left.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2"), "twice")
    verified = left.join(twice, ["h1", "h2"]).groupBy("k_id", "k_th").agg(F.collect_set("start").alias("starts"))
    known = repeated.join(verified, ["k_id", "k_th"], "left")
    carried = carry or [F.col("doc_id")]
    rows = docs.select(F.struct(*carried).alias("row"), *row_key(F.col("doc_id"), F.col("text")), F.col("text").cast("string").alias("text")).join(known, ["k_id", "k_th"], "left")
    return rows.select("row", "text", "slots", "counts", "starts")


def removed(text: str | None, slots, counts, starts, memo: dict[bytes, int], window: int = WINDOW, k: int = K) -> tuple[list[bytes], np.ndarray]:
    """The words of a text, and for each whether it goes."""
    words = split(text)
    if not len(slots):
        return words, np.zeros(len(words), bool)
    inside = Path(words, window, k, memo).judge(slots, counts)[0]
    return words, covered(np.concatenate([inside, starts]).astype(np.int64), len(words), window)


def strip(docs: DataFrame, *, window: int = WINDOW, k: int = K) -> DataFrame:
    """docs' rows as a struct `row`, with n_words, n_removed, kept (the words left, joined by one space)."""
    return _apply(repeats(docs, window=window, k=k, carry=[F.col(f"`{c}`") for c in docs.columns]), window, k, False)


def _apply(rows: DataFrame, window: int, k: int, digest: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[bytes, int] = {}
        for b in batches:
            n, gone, kept = [], [], []
            for text, slots, counts, starts in zip(b.column(1).to_pylist(), _numbers(b.column(2)), _numbers(b.column(3)), _numbers(b.column(4)), strict=True):
                words, out = removed(text, slots, counts, starts, memo, window, k)
                n.append(len(words))
                gone.append(int(out.sum()))
                left = b" ".join([w for w, x in zip(words, out.tolist(), strict=True) if not x] if gone[-1] else words)
                kept.append(hashlib.sha256(left).hexdigest() if digest else left.decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], ["row", "n_words", "n_removed", "kept"])

    inner = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {inner}, n_words long, n_removed long, kept string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _apply(repeats(table(spark, sf_dir, "documents").select("doc_id", "text")), WINDOW, K, True)
    return out.select("row.doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))
