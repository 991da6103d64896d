"""Words of line dedup are ordered by their counts over all lines, and the commoner words of prefixes are made once for all parts."""

import collections
import math

from pyspark.sql import functions as F

from brackish.llm import line_dedup as L

TEXTS = ["the cat\nthe  dog", "The\tcat sat\n\n", "the the the bird sat on a wall of stone", None, ""]


def test_prefixes_go_from_rare_to_common(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    lines = [x.lower().split() for t in TEXTS if t for x in t.split("\n") if x.split()]
    hashes = {r.w: r.h for r in spark.createDataFrame([(w,) for x in lines for w in x], "w string").distinct().select("w", F.xxhash64("w").alias("h")).collect()}
    counts = collections.Counter(hashes[w] & (L.BUCKETS - 1) for x in lines for w in x)
    number = lambda w: math.floor(3 * math.log2(counts[hashes[w] & (L.BUCKETS - 1)])) << 56 | (hashes[w] & (1 << 64) - 1) >> 8
    want = sorted(sorted(map(number, set(x)))[: len(set(x)) - math.ceil(0.8 * len(set(x)) - 1e-9) + 1] for x in lines)
    assert sorted(r.t for r in L.word_sets(docs, L.Sizes(0.8)).collect()) == want


def test_the_commoner_words_are_made_once(spark, monkeypatch):
    made, written = [], L.written
    monkeypatch.setattr(L, "written", lambda df, name: (made.append(name), written(df, name))[1])
    docs = spark.createDataFrame([(i, f"a b c d e f g h i j{i % 3}\nother words {i}") for i in range(8)], "doc_id long, text string")
    L.kept(docs).collect()
    assert made.count("line-heads") == 1 and made.count("line-hub-pairs") == L.PARTS
