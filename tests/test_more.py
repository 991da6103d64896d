"""Operators that SQL on the test tables does not reach: brute force and small cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brackish.operators import classify, ecology, evaluate, reference, search, tables


def dna(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def edited(rng, s, n):
    s = list(s)
    for p in rng.sample(range(len(s)), n):
        s[p] = rng.choice([x for x in "ACGT" if x != s[p]])
    return "".join(s)


def test_precluster_meets_every_near_pair(spark):
    rng = random.Random(3)
    rows, i = [], 0
    for n in (1, 2, 3, 5, 9, 40, 60, 95, 96, 200):
        base = dna(rng, n + 20)
        for m in (n, n, n + 1, n + 20):
            rows.append((i, edited(rng, base[:m], min(rng.randint(0, 3), m))))
            i += 1
    rows += [(i, ""), (i + 1, rows[5][1])]
    far = lambda a, b: sum(x != y for x, y in zip(a, b, strict=False))
    order, centroid, want = sorted(rows, key=lambda r: (-len(r[1]), r[0])), [], {}
    for k, s in order:
        hit = next((c for c, t in centroid if s and t and far(s, t) <= 2), None)
        want[k] = k if hit is None else hit
        if hit is None:
            centroid.append((k, s))
    got = {r.member_id: r.centroid_id for r in search.precluster(spark.createDataFrame(rows, "seq_id long, seq string")).collect()}
    assert got == want


def test_min_size_clusters_and_otus(spark):
    rng = random.Random(5)
    a, b = dna(rng, 200), dna(rng, 200)
    rows = [(1, a, 9), (2, b, 5), (3, edited(rng, a, 3), 1), (4, dna(rng, 200), 1), (5, edited(rng, b, 2), 2)]
    members, figures = search.cluster_min_size(spark.createDataFrame(rows, "seq_id long, seq string, size long"))
    assert {r.member_id: r.centroid_id for r in members.collect()} == {1: 1, 2: 2, 5: 2, 3: 1}
    assert figures.first().asDict() == {"min_size": 2, "uniques_clustered": 3, "reads_clustered": 16, "uniques_below": 2, "uniques_mapped": 1, "reads_mapped": 1, "reads_discarded": 1}
    asvs = spark.createDataFrame([r[:2] for r in rows], "seq_id long, seq string")
    counts = spark.createDataFrame([(1, "s", 4), (3, "s", 2), (2, "t", 1)], "feature_id long, sample string, count long")
    _, table = search.otus(asvs, counts)
    assert {(r.centroid_id, r["sample"], r["count"]) for r in table.collect()} == {(1, "s", 6), (2, "t", 1)}
    with pytest.raises(ValueError, match="77"):
        search.otus(asvs, counts.union(spark.createDataFrame([(77, "s", 1)], counts.schema)))


def test_sintax(spark):
    rng = random.Random(7)
    a, b = dna(rng, 300), dna(rng, 300)
    refs = spark.createDataFrame([(1, a, "K;P;A"), (2, b, "K;P;B"), (3, dna(rng, 300), "K;Q;C")], "seq_id long, seq string, lineage string")
    turned = a[::-1].translate(str.maketrans("ACGT", "TGCA"))
    queries = spark.createDataFrame([(1, a), (2, turned), (3, b[:150]), (4, ""), (5, a[:150] + b[:150])], "seq_id long, seq string")
    words = classify.sintax_train(refs)
    got = {r.seq_id: [(x.taxon, x.conf) for x in r.assignment] for r in classify.sintax_classify(queries, words).collect()}
    assert got[1] == got[2] == [("K", 100), ("P", 100), ("A", 100)] and got[3][2] == ("B", 100) and got[4] == []
    assert got[5][1] == ("P", 100) and got[5][2][1] < 80
    again = {r.seq_id: [(x.taxon, x.conf) for x in r.assignment] for r in classify.sintax_classify(queries.repartition(3), words.repartition(5)).collect()}
    assert again == got


def test_hierarchical_models(spark):
    rng = random.Random(9)
    parts = {(p, g): dna(rng, 400) for p, g in (("P", "a"), ("P", "b"), ("Q", "c"), ("R", None))}
    refs = spark.createDataFrame([(i, s, p, g) for i, ((p, g), s) in enumerate(parts.items())], "seq_id long, seq string, phylum string, genus string")
    queries = spark.createDataFrame([(i, edited(rng, s, 5)) for i, s in enumerate(parts.values())], "seq_id long, seq string")
    got = [(r.phylum, r.genus) for r in classify.hierarchical(queries, refs).orderBy("seq_id").collect()]
    assert got == [("P", "a"), ("P", "b"), ("Q", "c"), ("R", "genus__unclassified")]


@pytest.mark.parametrize("shares,want", [((60, 20, 20), "K;P"), ((30, 25, 23, 22), "K;P"), ((24, 20, 19, 19, 18), None)])
def test_kraken_branches(spark, shares, want):
    """The winning phylum itself from 25 % on; below that what the strongest taxa share."""
    rng = random.Random(11)
    q, index, names = "", [], "PQRST"
    for n, p in zip(shares, names, strict=False):
        s = dna(rng, n + 14)
        q += s + "N"
        index += [(s[i : i + 15], f"K;{p};c{i % 9};o;f;g", 1.0) for i in range(n)]
    table = spark.createDataFrame(index, "kmer string, lineage string, weight double")
    got = classify.kraken_classify(spark.createDataFrame([(1, q)], "seq_id long, seq string"), table).first().lineage
    assert got == (want or "Unclassified")


def test_reference_reasons(spark):
    ok = "ACGU" * 300
    rows = [(1, ok, "Bacteria;x"), (2, ok, None), (3, ok, "Other;x"), (4, "ACGT", "Bacteria;x"), (5, "ACGT" * 200, "Bacteria;x"), (6, ok + "NNNNNN", "Bacteria;x"), (7, ok + "A" * 9, "Bacteria;x"), (8, None, "Bacteria;x"), (9, "--.." + ok, "Archaea;x")]
    got = {r.seq_id: r.reason for r in reference.judged(spark.createDataFrame(rows, "seq_id long, seq string, lineage string")).collect()}
    assert got == {1: None, 2: "header", 3: "domain", 4: "short", 5: "length", 6: "ambiguous", 7: "homopolymer", 8: "short", 9: None}


def test_genus_buckets(spark):
    rows = [("plain", ["K"], tables.NONE), ("plain", ["K", "p"], tables.ABOVE), ("plain", list("Kpcof") + ["G"], "G"), ("plain", list("Kpcof") + ["uncultured x"], tables.ABOVE)]
    rows += [("confidence", [f"{x}(99)" for x in "Kpcof"] + ["G(80)"], "G"), ("confidence", list("Kpcof") + ["f_unclassified(80)"], tables.FORCED)]
    rows += [("prefixed", ["d__K", "p__"], tables.NONE), ("prefixed", ["d__K", "p__P", "g__G"], "G"), ("prefixed", ["d__K", "p__P", "g__"], tables.ABOVE)]
    for style, names, want in rows:
        assert spark.range(1).select(tables.genus_bucket(F.array(*[F.lit(x) for x in names]), style)).first()[0] == want


def test_joins_that_check(spark):
    a, b = spark.createDataFrame([("x",), ("y",)], "sample string"), spark.createDataFrame([("x", 1)], "sample string, v int")
    with pytest.raises(ValueError, match="y"):
        tables.complete(a, b, "sample")
    assert tables.complete(a.where("sample = 'x'"), b, "sample").collect()[0].v == 1
    counts = spark.createDataFrame([(1, "x", 2), (2, "y", 3)], "feature_id long, sample string, count long")
    assert {tuple(r) for r in tables.transposed(counts).collect()} == {("x", 2, 0), ("y", 0, 3)}


def test_capped_is_one_pass_in_order(spark):
    rng = random.Random(13)
    rows = [(i, p := rng.choice("PQ"), p + rng.choice("abc")) for i in range(60)]
    genus, phylum, want = {}, {}, []
    for i, p, g in rows:
        if genus.get(g, 0) >= 4 or phylum.get(p, 0) >= 9:
            continue
        genus[g], phylum[p] = genus.get(g, 0) + 1, phylum.get(p, 0) + 1
        want.append(i)
    got = tables.capped(spark.createDataFrame(rows, "ord long, phylum string, genus string"), 4, 9)
    assert sorted(r.ord for r in got.collect()) == want


def test_confidence_gap(spark):
    rng = random.Random(17)
    rows = [(i, "G", rng.randint(0, 100), rng.choice("GH"), rng.randint(0, 100)) for i in range(77)]
    side = lambda t, c: spark.createDataFrame([(r[0], [(r[t], r[c])]) for r in rows], "seq_id long, assignment array<struct<taxon:string,conf:int>>")
    d = sorted(r[2] - r[4] for r in rows if r[3] == "G")
    assert tuple(evaluate.confidence_gap(side(1, 2), side(3, 4), genus=1).first()) == (len(d), d[len(d) // 2], d[len(d) // 20], d[len(d) * 19 // 20])


def test_ordination():
    rng = np.random.default_rng(19)
    x = np.vstack([rng.normal(size=(8, 2)), rng.normal(size=(8, 2)) + 6])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    site, half = ["a"] * 8 + ["b"] * 8, [i % 2 for i in range(16)]
    one = ecology.marginal_permanova(d, {"site": site}, 199)["site"]
    assert one["F"] == pytest.approx(ecology.permanova(d, site, 9)["F"]) and one["p"] < 0.05
    two = ecology.marginal_permanova(d, {"site": site, "half": half}, 199, blocks=half)
    assert two["site"]["p"] < 0.05 and np.isnan(two["half"]["p"])
    assert ecology.dispersion_test(d, site, 199)["p"] > 0.01
    coords, stress, kind = ecology.nmds(d, tries=3)
    assert stress < 0.02 and kind == "good" and coords.shape == (16, 2)
    assert ecology.isotonic(np.array([1.0, 3, 2, 2, 5])).tolist() == pytest.approx([1, 7 / 3, 7 / 3, 7 / 3, 5])


def test_rarefaction_does_not_follow_partitions(spark):
    rows = [(i, s, i % 5 + 1) for i in range(40) for s in ("x", "y")]
    counts = spark.createDataFrame(rows, "feature_id long, sample string, count long")
    t = lambda c: sorted(map(tuple, ecology.rarefaction_table(c, [10, 10_000], 3).collect()), key=str)
    assert t(counts) == t(counts.repartition(7)) and all((r[3] is None) == (r[1] == 10_000) for r in t(counts))
    exact = {r["sample"]: r.expected for r in ecology.expected_richness(counts, [30]).collect()}
    for r in ecology.rarefied_means(counts, 30, 400).collect():
        assert r.replicates == 400 and r.richness == pytest.approx(exact[r["sample"]], abs=0.4)
