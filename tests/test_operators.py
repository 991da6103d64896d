import gzip
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brackish.functions import lineage as L
from brackish.functions import sequence as S
from brackish.operators import classify, ecology, search
from brackish.sources import readers, writers

random.seed(3)
dna = lambda n: "".join(random.choices("ACGT", k=n))


def test_merge_finds_the_overlap_and_better_bases_win():
    t = dna(200)
    a, b = t[:130], search.reverse_complement(t[80:])
    assert search.merge_pair(a, "I" * 130, b, "I" * 120) == t
    worse = a[:-1] + ("A" if a[-1] != "A" else "C")
    assert search.merge_pair(worse, "I" * 129 + "#", b, "I" * 120) == t
    assert search.merge_pair(dna(100), "I" * 100, dna(100), "I" * 100) is None


def test_linked_primers():
    f, r, body = "CCTACGGGNGGCWGCAG", "GACTACHVGGGTATCTAATCC", dna(120)
    read = "CCTACGGGAGGCAGCAG" + body + "GGATTAGATACCCTGGTAGTC"
    assert search.trim_linked("GG" + read + "TT", f, r) == body
    assert search.trim_linked(read.replace("TAGATACC", "TAGAACC"), f, r) == body  # one deletion is within 10 %
    assert search.trim_linked(body, f, r) is None


def test_infix_distance_equals_the_plain_table():
    for _ in range(30):
        q, t = dna(random.randint(1, 12)), dna(random.randint(0, 20))
        d = [0] * (len(t) + 1)
        for i, x in enumerate(q, 1):
            n = [i]
            for j, y in enumerate(t, 1):
                n.append(min(d[j - 1] + (x != y), d[j] + 1, n[-1] + 1))
            d = n
        e, s, end = search.infix_distance(q, t)
        assert e == min(d) and 0 <= s <= end <= len(t)


def test_chimera_of_two_parents():
    a, b = dna(200), dna(200)
    assert search.is_chimera(a[:100] + b[100:], [a, b])
    assert not search.is_chimera(a, [a, b])


def test_clusters_are_greedy_by_length(spark):
    a = dna(200)
    near = a[:100] + ("A" if a[100] != "A" else "C") + a[101:190]
    df = spark.createDataFrame([("x1", a), ("x2", near), ("x3", dna(180))], "seq_id string, seq string")
    got = dict(search.cluster(df).select("member_id", "centroid_id").collect())
    assert got == {"x1": "x1", "x2": "x1", "x3": "x3"}


def test_lineage_functions(spark):
    df = spark.createDataFrame([("A;B 2;C;", ["A", "B"], ["A", "X"])], "t string, a array<string>, b array<string>")
    r = df.select(L.parts(F.col("t")), L.common(F.col("a"), F.col("b")), L.seven_ranks(F.col("a")), L.at_rank(F.col("a"), "Genus"), L.cut_at_confidence(L.with_confidence(F.lit("A(100);B(90);C(70);D(99);")))).first()
    assert r[0] == ["A", "B 2", "C"] and r[1] == ["A"] and r[3] == "Unclassified" and r[4] == ["A", "B"]
    assert len(r[2]) == 7 and r[2][2] == "B_incertae_sedis" and r[2][3] == "B_incertae_sedis_incertae_sedis"


def test_empty_and_null_sequences(spark):
    df = spark.createDataFrame([("",), (None,), ("ACGTN",)], "s string")
    r = df.select(S.homopolymer(F.col("s")).alias("h"), F.size(S.kmers(F.col("s"), 3)).alias("k")).collect()
    assert [x.h for x in r] == [0, 0, 1] and [x.k for x in r] == [0, 0, 3]


def test_readers_round_trip(spark, tmp_path):
    seqs = {"a": dna(200), "b": dna(79), "c": dna(80)}
    df = spark.createDataFrame(list(seqs.items()), "seq_id string, seq string")
    writers.fasta(df, str(tmp_path / "x"))
    assert {r.seq_id: r.seq for r in readers.fasta(spark, str(tmp_path / "x")).collect()} == seqs
    (tmp_path / "q_R1_001.fastq.gz").write_bytes(gzip.compress(b"@r1 x\nACGT\n+\nIIII\n@r2\nAC\n+\nII\n"))
    assert [tuple(r) for r in readers.fastq(spark, str(tmp_path / "q_R1_001.fastq.gz")).select("read_id", "seq", "qual").collect()] == [("r1", "ACGT", "IIII"), ("r2", "AC", "II")]
    (tmp_path / "t.tsv").write_text("id\tS1\tS2\nf1\t3\t0\nf2\tx\t4.0\n")
    assert sorted(map(tuple, readers.count_table(spark, str(tmp_path / "t.tsv")).collect())) == [("f1", "S1", 3), ("f2", "S2", 4)]
    files = spark.createDataFrame([("/d/a_R1_001.fastq.gz",), ("/d/a_R2_001.fastq.gz",), ("/d/b_R1_001.fq",)], "path string")
    assert [r.sample for r in readers.manifest(files).collect()] == ["a"]


def test_bootstrap_is_seeded_by_the_sequence(spark):
    refs = spark.createDataFrame([(str(i), dna(300), f"B;p{i % 2};g{i}") for i in range(6)], "seq_id string, seq string, lineage string")
    model = classify.wang_train(refs)
    q = refs.select("seq_id", "seq")
    a = {r[0]: r[1] for r in classify.truncated(classify.wang_classify(q, *model)).collect()}
    b = {r[0]: r[1] for r in classify.truncated(classify.wang_classify(q.repartition(3), *model)).collect()}
    assert a == b and a["3"] == "B;p1;g3;"
    with pytest.raises(ValueError):
        classify.classifier("pro-engine")


def test_statistics():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 1, (8, 3)), rng.normal(4, 1, (8, 3))])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    p = ecology.permanova(d, [0] * 8 + [1] * 8, 199)
    assert p["p"] < 0.02 and 0 < p["R2"] < 1
    y, share = ecology.pcoa(d, 3)
    assert np.allclose(np.sqrt(((y[:, None] - y[None]) ** 2).sum(-1)), d) and abs(share.sum() - 1) < 1e-9
    assert ecology.mantel(d, d, 99)["r"] > 0.999 and ecology.procrustes(y[:, :2], 3 * y[:, :2] + 1, 99)["correlation"] > 0.999
    assert ecology.holm([0.01, 0.04, 0.03]) == [0.03, 0.06, 0.06]
    assert ecology.wilcoxon(np.arange(10.0), np.arange(10.0)) == 1.0
