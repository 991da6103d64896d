"""Benchmark decontamination by q-gram lemma filtering.

An item of m characters that occurs in a text with at most k edits shares at least m + 1 - q - k * q of its character
q-grams with it, on diagonals (text place less item place) that lie within k of each other.  Shared q-grams are counted in diagonal
bands of width 2w that overlap by w > k, so one band holds them all.  Bands that reach the bound are
verified by a banded alignment of the item against the text under the band.

Items and texts are compared in lower case with every run of other characters than letters and digits as one space.  The
documents are read once and never shuffled; the items go to the executors in blocks of at most `block_chars` characters, one pass over
the documents a block, so their size is bounded whatever the benchmark's.

Edge cases: null and empty texts and items match nothing; an item too short for the bound at its edit budget must occur
unchanged; one of fewer than q characters is not evidence of a leak and is left out; repeated rows and items each report; a null id is
reported as null.  Extra columns are kept by `clean`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, settle, table

Q = 12
EDIT_RATE = 0.05
BLOCK_CHARS = 4_000_000
#: Characters of texts that are searched together.
CHUNK = 1_000_000
MIX = np.uint64(0x9E3779B97F4A7C15)


def plain(text: str | None) -> str:
    text = (text or "").lower()
    for c in set(text):
        if not c.isalnum():
            text = text.replace(c, " ")
    return " ".join(text.split())


def codes(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("utf-32-le", "surrogatepass"), "<u4")


def grams(c: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of every q neighbours, put together from those of 1, 2, 4, ... neighbours."""
    n = len(c) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    part, size, factor = c.astype(np.uint64), 1, MIX
    out, have = None, 0
    with np.errstate(over="ignore"):
        while True:
            if q & size:
                out = part[:n].copy() if out is None else out * factor + part[have : have + n]
                have += size
            if have == q:
                return out * np.uint64(0xD6E8FEB86659FD93)
            part = part[:-size] * factor + part[size:]
            size, factor = 2 * size, factor * factor


class Index:
    """The q-grams of a block of items, sorted, with a bit table before the search."""

    def __init__(self, items: list[tuple[int, str]], q: int = Q, rate: float = EDIT_RATE):
        self.q = q
        self.items = [(i, c) for i, c in ((i, codes(plain(t))) for i, t in items) if len(c) >= q]
        m = np.array([len(c) for _, c in self.items], np.int64)
        k = (m * rate).astype(np.int64)
        k[m + 1 - q - k * q <= 0] = 0
        self.m, self.k = m, k
        self.need = m + 1 - q - k * q
        self.band = np.maximum(32, 2 ** np.ceil(np.log2(k + 2)).astype(np.int64)) if len(m) else m
        every = [grams(c, q) for _, c in self.items]
        code = np.concatenate(every) if every else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(every)), [len(g) for g in every])
        at = np.concatenate([np.arange(len(g)) for g in every]) if every else np.zeros(0, np.int64)
        order = np.argsort(code, kind="stable")
        self.code, self.item, self.at = code[order], item[order], at[order]
        self.bits = np.zeros(1 << 22, bool)
        self.bits[(self.code >> np.uint64(42)).astype(np.int64)] = True

    def search(self, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
        """(text number, item number, edits, start, end) of the best place of every item in every plain text."""
        if not len(self.code) or not texts:
            return []
        text = codes("\x00".join(texts))
        begin = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        g = grams(text, self.q)
        hit = np.flatnonzero(self.bits[(g >> np.uint64(42)).astype(np.int64)])
        low = np.searchsorted(self.code, g[hit])
        n = np.searchsorted(self.code, g[hit], side="right") - low
        hit, low, n = hit[n > 0], low[n > 0], n[n > 0]
        if not len(hit):
            return []
        post = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        item = self.item[post]
        diagonal = np.repeat(hit, n) - self.at[post]
        band = diagonal // self.band[item]
        # Alignments on one diagonal without an edit need no table.
        unchanged = [(i, s) for i, s in zip(item[self.at[post] == 0].tolist(), diagonal[self.at[post] == 0].tolist(), strict=True) if np.array_equal(text[s : s + int(self.m[i])], self.items[i][1])]
        changed: set[tuple[int, int]] = set()
        # Band b covers the diagonals from b * w to (b + 2) * w; each is in two bands.
        key = np.concatenate([item, item]) * np.int64(1 << 40) + np.concatenate([band, band - 1]) + (1 << 30)
        key, count = np.unique(key, return_counts=True)
        item, band = key >> 40, (key & ((1 << 40) - 1)) - (1 << 30)
        some = count >= self.need[item]
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for i, s in unchanged:
            t = int(np.searchsorted(begin, s, side="right")) - 1
            got = (0, s - int(begin[t]), s - int(begin[t]) + int(self.m[i]))
            best[t, i] = min(got, best.get((t, i), got))
        for i, b in zip(item[some].tolist(), band[some].tolist(), strict=True):
            w = int(self.band[i])
            t = int(np.searchsorted(begin, max(b * w, 0), side="right")) - 1
            if (t, i) in best and (t, i) not in changed and b * w + 2 * w < begin[t + 1]:
                continue  # no place can beat an unchanged one
            changed.add((t, i))
            found = align(self.items[i][1], text, b * w, 2 * w, int(self.k[i]))
            if found is None:
                continue
            edits, start, end = found
            t = int(np.searchsorted(begin, start, side="right")) - 1
            got = (edits, start - int(begin[t]), end - int(begin[t]))
            if end <= begin[t + 1] - 1 and got < best.get((t, i), (1 << 30,)):
                best[t, i] = got
        return [(t, i, *v) for (t, i), v in sorted(best.items())]


def align(item: np.ndarray, text: np.ndarray, diagonal: int, width: int, k: int) -> tuple[int, int, int] | None:
    """The least edits of the whole item against text on the diagonals [diagonal - k, diagonal + width + k), with the place, or None if over k.

    Row i, column d: item[:i] against text that ends at i + d; texts outside and the separators never match."""
    low, cols = diagonal - k, width + 2 * k + 1
    first = max(low, 0)
    over = np.zeros(cols + len(item), np.uint32)
    part = text[first : max(first, low + len(over))]
    over[first - low : first - low + len(part)] = part
    d = np.arange(cols)
    cost = np.zeros(cols, np.int64)
    start = d.copy()
    big = 1 << 20
    for i in range(len(item)):
        match = cost + (over[i : i + cols] != item[i])
        skip = np.concatenate([cost[1:], [big]]) + 1
        up = skip < match
        new = np.where(up, skip, match)
        origin = np.where(up, np.concatenate([start[1:], [0]]), start)
        # Extra characters of the text: the cheapest column to the left plus the distance.
        slack = new - d
        least = np.minimum.accumulate(slack)
        source = np.maximum.accumulate(np.where(slack == least, d, 0))
        cost, start = least + d, origin[source]
        if cost.min() > k:
            return None
    end = int(cost.argmin())
    return int(cost[end]), low + int(start[end]), low + end + len(item)


def blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about block_chars characters."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null and text <> ''")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-size // block_chars)
    for b in range(n):
        yield [(r[0], r[1]) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).orderBy("item_id", "text").collect()]


def matches(texts: list[str | None], index: Index) -> Iterator[tuple[int, int, int, int, int]]:
    """As Index.search, over texts as they come, in chunks of bounded size."""
    done, some, size = 0, [], 0
    for n, t in enumerate(texts):
        some.append(plain(t))
        size += len(some[-1])
        if size > CHUNK or n == len(texts) - 1:
            for found in index.search(some):
                yield (done + found[0], *found[1:])
            done, some, size = n + 1, [], 0


def leaks(docs: DataFrame, benchmark: DataFrame, *, q: int = Q, rate: float = EDIT_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, edits, start, end (in the plain text) of every item that a document holds."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    names = ["doc_id", "item_id", "edits", "start", "end"]
    schema = ", ".join(f"{n} long" for n in names)
    out = docs.sparkSession.createDataFrame([], schema)
    for items in blocks(benchmark, block_chars):

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            index = Index(items, q, rate)
            for b in batches:
                got = list(matches(b.column(1).to_pylist(), index))
                if got:
                    ids = [index.items[g[1]][0] for g in got]
                    cols = [b.column(0).take(pa.array([g[0] for g in got])), pa.array(ids, pa.int64()), *(pa.array([g[c] for g in got], pa.int64()) for c in (2, 3, 4))]
                    yield pa.RecordBatch.from_arrays(cols, names)

        out = out.union(rows.mapInArrow(run, schema))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, *, q: int = Q, rate: float = EDIT_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """docs without the rows that hold an item."""
    out = docs.select(F.struct(*[column(c) for c in docs.columns]).alias("row"), F.col("text").cast("string").alias("text"), F.lit(True).alias("clean"))
    schema = out.schema
    for items in blocks(benchmark, block_chars):

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            index = Index(items, q, rate)
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                keep[[g[0] for g in matches(b.column(1).to_pylist(), index)]] = False
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(keep)], ["row", "text", "clean"])

        out = out.mapInArrow(run, schema).where("clean")
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).withColumn("contaminated", F.lit(True))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    settle(spark)
    return clean(docs, table(spark, sf_dir, "benchmark"))
