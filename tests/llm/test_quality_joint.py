"""Joint cutoffs of the quality rules, against a plain recount."""

from pyspark.sql import functions as F

from brackish.llm import quality


def test_a_few_hundred_labels_activate_rules_in_every_stratum(spark):
    rows, labels = [], []
    for g in range(70):
        for i in range(760 if g < 2 else 3):
            words = ["word%d" % ((g * 7 + i * 13 + j * j) % 997) for j in range(20)]
            bad = i % 38 == 0
            rows.append((len(rows), " ".join(words) + (" ####" * 20 if bad else ""), f"l{g}"))
            labels.append((len(labels), int(not bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = quality.judge(docs, spark.createDataFrame(labels, "doc_id long, quality int")).toPandas().set_index("doc_id")
    assert len(got) == len(rows)
    large = [i for i, r in enumerate(rows) if r[2] in ("l0", "l1")]
    assert quality.least_labels(70) <= 740 < quality.least_labels(70) + 60
    for i in large:
        if not labels[i][1]:
            assert not got.loc[i, "kept"]
    small = got.loc[[i for i in range(len(rows)) if i not in set(large)]]
    assert (small["kept"] == ~small["base_failed"]).all()
    for g in ("l0", "l1"):
        good = got.loc[[i for i in large if rows[i][2] == g and labels[i][1]]]
        good = good[~good["base_failed"]]
        assert quality.upper_bound(int((~good["kept"]).sum()), len(good), quality.DELTA / 70) <= quality.ALPHA


def test_first_step_is_where_a_rule_first_rejects(spark):
    rows = [(i, n, c, s, d, r) for i, (n, c, s, d, r) in enumerate([(10, 50, 0, 0, 0), (10, 500, 31, 1, 2), (10, 9, 4, 0, 1), (100, 444, 17, 3, 19)])]
    df = spark.createDataFrame(rows, "i long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long")
    score, step = quality.scores(), quality.first_steps()
    for r in df.select(F.struct(*[x.alias(k) for k, x in score.items()]).alias("s"), F.struct(*[x.alias(k) for k, x in step.items()]).alias("t")).collect():
        for rule, cutoffs in quality.RULES.items():
            over = [quality.STEPS.index((i, rule)) for i, c in enumerate(cutoffs) if r.s[rule] > c]
            assert r.t[rule] == min(over, default=len(quality.STEPS))
