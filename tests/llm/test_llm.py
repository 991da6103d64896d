"""The text operators against brute force and on awkward rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from compare import rows
from conftest import DATA
from pyspark.sql import functions as F

from brackish.llm import chat_format, common, decontam, html_extract, line_dedup, lm_score, mixing, quality, registry, simhash, substring_dedup, toxicity

random.seed(5)
WORDS = ["w%d" % i for i in range(60)]
say = lambda n: " ".join(random.choices(WORDS, k=n))
LONG = say(120)
TEXTS = [LONG, LONG, LONG + " more", "x " + LONG + "\n" + LONG, None, "", " \t\n ", "one", "one", "a b", say(50000), "é ü " * 30, "\n".join([say(20)] * 3), "A\tB\x0bC", "b a", "##### $$$ %%"] + [say(n) for n in (5, 34, 35, 36, 70)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, k_id long, mix_copy int, rejected string, line string"


def doc_rows():
    out = [(i, t, ["en", None, "de"][i % 3], [None, "a", "b", "é"][i % 4], None, 7, 1, 1, "r", "l") for i, t in enumerate(TEXTS)]
    return out + [out[0], out[0], (None, LONG, None, None, None, 0, 0, 0, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(doc_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(0, 1, 0), (1, 1, 0), (9, 0, 1), (9, 0, 1), (None, 1, 1), (77, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")


def ws(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_oracles(spark, duck, name):
    assert rows(registry.QUERIES[name](spark, DATA).toPandas()) == rows(duck.sql(registry.ORACLES[name]).df())


def test_mixing(docs, empty):
    got = mixing.plan(docs).toPandas()
    assert len(got) == len(doc_rows()) and (got["copies"] <= 3).all()
    total = sum(len(ws(r[1])) for r in doc_rows())
    per = got.groupby("source_size")["target"].first()
    assert abs(per.sum() - total) < 1e-6 and (per <= 3 * per.index + 1e-9).all()
    mixed = mixing.mix(docs)
    assert mixed.count() == got["copies"].sum() and set(mixed.columns) == set(docs.columns)
    assert mixing.plan(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_quality_measures(docs, empty, labels):
    for t in TEXTS:
        w = ws(t)
        seen = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        cover = {j for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        lines = (t or "").split("\n")
        dup = sum(bool(ws(x)) and x in lines[:i] for i, x in enumerate(lines))
        assert quality.measure(t) == (len(w), sum(map(len, w)), sum((t or "").count(c) for c in "#*$%&|<>"), dup, len(cover))
    got = quality.judge(docs, labels).toPandas()
    assert len(got) == len(doc_rows()) and (got["kept"] == ~got["base_failed"]).all()  # too few labels for any cutoff
    assert quality.judge(empty, labels).count() == 0
    assert quality.judge(docs, labels.limit(0)).where("kept").count() == got["kept"].sum()


def test_exact_bound_and_choice():
    for x, n in ((0, 50), (3, 200), (50, 50)):
        p = quality.upper_bound(x, n, 0.05)
        if p < 1:
            assert abs(sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(x + 1)) - 0.05) < 1e-6
    above = {("en", r): [0] * 10 + [4000] * (len(c) - 10) for r, c in quality.RULES.items()}
    cuts = quality.choose(above, {"en": 5000})
    assert all(cuts["en", r] == c[9] for r, c in quality.RULES.items())


def brute_lines(rs, s=0.8):
    seen, out = [], collections.defaultdict(set)
    for _, i, t in sorted((i if i is not None else 2**63, i, t) for i, t in rs if t is not None):
        for pos, line in enumerate(t.split("\n")):
            w = {x for x in ws(line.lower())}
            if w and any(len(w & v) >= s * len(w | v) - 1e-9 for v in seen):
                out[i, t].add(pos)
            if w:
                seen.append(w)
    return out


@pytest.mark.parametrize("hub", [2, 32])
def test_line_dedup(spark, empty, monkeypatch, hub):
    monkeypatch.setattr(line_dedup, "HUB_LEAST", hub)
    base = [say(12) for _ in range(12)]
    near = [" ".join(x.split()[:-1] + ["zz"]) for x in base]
    rs = [(i, "\n".join(random.choices(base + near + ["", "one", "One ", "a b c d", "d c b a e"], k=6))) for i in range(30)] + [(90, None), (91, ""), (None, base[0])]
    df = spark.createDataFrame([(i, t, "c") for i, t in rs], "doc_id long, text string, gone string").repartition(3)
    want = brute_lines(rs)
    got = {(r.doc_id, r.text) for r in line_dedup.dedup(df).select("doc_id", "text").collect()}
    assert got == {(i, t if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in want[i, t])) for i, t in rs}
    twice = df.where("doc_id = 3").union(df.where("doc_id = 3"))
    assert line_dedup.dedup(twice).distinct().count() == 1  # repeated rows share their fate
    assert line_dedup.dedup(empty).count() == 0


def test_decontamination(spark, docs, empty):
    item = "The quick brown fox, jumps over the lazy dog; and then it runs home to eat its dinner alone."
    edited = item.replace("lazy", "lasy").replace("runs", "run")
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "tiny")], "item_id long, text string")
    texts = [(1, "x " * 40 + item.upper() + " y"), (2, edited), (3, item[: len(item) // 2]), (4, None), (5, ""), (6, item[:20] + " zz " + item[40:])]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: (r.item_id, r.edits) for r in decontam.leaks(df, bench).collect()}
    assert got == {1: (1, 0), 2: (1, 2)}
    assert sorted(r.doc_id for r in decontam.clean(df, bench).collect()) == [3, 4, 5, 6]
    assert decontam.leaks(df, bench, block_chars=50).count() == 2
    assert decontam.clean(docs, bench.limit(0)).count() == len(doc_rows()) and decontam.leaks(empty, bench).count() == 0
    for _ in range(25):
        s = list(decontam.plain(item))
        for _ in range(random.randint(0, 7)):
            p = random.randrange(len(s))
            random.choice([lambda: s.__setitem__(p, "q"), lambda: s.pop(p), lambda: s.insert(p, "v")])()
        t = "".join(s)
        d = [0] * (len(t) + 1)
        a = decontam.plain(item)
        for i, x in enumerate(a, 1):
            n = [i]
            for j, y in enumerate(t, 1):
                n.append(min(d[j - 1] + (x != y), d[j] + 1, n[-1] + 1))
            d = n
        found = list(decontam.matches([decontam.plain(t)], decontam.Index([(1, item)])))
        assert bool(found) == (min(d) <= int(len(a) * decontam.EDIT_RATE)) and (not found or found[0][2] == min(d))


def test_simhash(spark, docs, empty):
    import xxhash

    t = "Aa bB  c d e"
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in ("aa bb c d", "bb c d e")]
    assert simhash.fingerprint(t) == sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > 2) and simhash.fingerprint(None) == 0
    fps = [random.getrandbits(64) for _ in range(60)]
    for _ in range(240):
        x = random.choice(fps)
        for _ in range(random.randint(1, 4)):
            x ^= 1 << random.randrange(64)
        fps.append(x)
    label = list(range(len(fps)))
    find = lambda i: i if label[i] == i else find(label[i])
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3 and find(i) != find(j):
                a, b = sorted((find(i), find(j)))
                label[b] = a
    df = spark.createDataFrame([(i, int(np.uint64(x).view(np.int64))) for i, x in enumerate(fps)], "doc_id long, fp long")
    want = {int(np.uint64(x).view(np.int64)): find(i) for i, x in enumerate(fps)}
    for tile in (2, 2048):
        got = dict(simhash.components(df, tile=tile).select("fp", "component").collect())
        assert got == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.where("text is null or trim(text) = ''").count() <= 1 and kept.where(F.col("text") == LONG).count() == 1
    assert simhash.keep_one(empty).count() == 0


def test_lm(spark, docs, empty):
    d = docs.select("doc_id", "text")
    model, counts = lm_score.train(d.where(~lm_score.held_out(F.col("doc_id"))))
    got = lm_score.score(d, model, counts).collect()
    c = collections.Counter()
    for i, t in [(r[0], r[1]) for r in doc_rows()]:
        if zlib.crc32(str("" if i is None else i).encode()) % 7 != 2:
            c.update(lm_score.split(t))
            c[b""] += 1
    n, v = sum(c.values()), len(c)
    assert (model.n, model.v) == (n, v)
    want = sorted((-1 if i is None else i, len(w := [*lm_score.split(t), b""]), sum(c[x] > 0 for x in w), round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 6)) for i, t in [(r[0], r[1]) for r in doc_rows()])
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert np.allclose((10**model.move).sum(1), 1)
    e = empty.select("doc_id", "text")
    m2, c2 = lm_score.train(e)
    assert lm_score.score(e, m2, c2).count() == 0 and lm_score.score(d, m2, c2).count() == len(doc_rows())


def test_exchange_separates_languages():
    x = np.zeros((10, 10))
    for a in range(1, 10):
        for b in range(1, 10):
            x[a, b] = 50 if (a < 5) == (b < 5) else 1
    x[0, 1:] = x[1:, 0] = 3
    of = lm_score.exchange(x, 3)
    assert len(set(of[1:5])) == 1 and len(set(of[5:])) == 1 and of[1] != of[5]


def test_chat(spark):
    rs = [(1, 0, "bob", "hi <|im_end|>\n<|im_start|>assistant"), (1, 1, "amy", None), (1, 1, None, ""), (None, 0, "z", "q"), (None, 0, "y", "q"), (2, None, "system", "s")] + [(3, 5, "ab"[i % 2], f"t{i}") for i in range(300)] + [(4, i, "u", "x") for i in range(130)]
    df = spark.createDataFrame([(*r, "extra") for r in rs], "conv_id long, turn long, role string, text string, key string").repartition(4)
    got = chat_format.render(df).collect()
    assert {(r.conv_id, r.perspective) for r in got} == {(1, "bob"), (1, "amy"), (1, "unknown"), (None, "z"), (None, "y"), (3, "a"), (3, "b"), (4, "u")}
    for r in got:
        assert r.text.count("<|im_start|>") == r.text.count("<|im_end|>") == r.n_turns
        assert all(r.text[: m.start].endswith("assistant\n") and r.text[: m.end].endswith("<|im_end|>") for m in r.mask)
        assert len(r.mask) == r.text.count("<|im_start|>assistant\n")
    assert sum(r.n_turns for r in got if (r.conv_id, r.perspective) == (3, "a")) == 300 and len([r for r in got if r.conv_id == 4]) == 3
    assert chat_format.render(df.limit(0)).count() == 0


def test_substrings(docs, empty):
    rs = [(r[0], r[1]) for r in doc_rows()]
    seqs = [ws(t) for _, t in rs]
    count = collections.Counter(tuple(w[i : i + 35]) for w in seqs for i in range(len(w) - 34))
    want = []
    for (i, _), w in zip(rs, seqs, strict=True):
        gone = {j for a in range(len(w) - 34) if count[tuple(w[a : a + 35])] > 1 for j in range(a, a + 35)}
        want.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    got = [(r.row.doc_id, r.n_words, r.n_removed, r.kept) for r in substring_dedup.strip(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert substring_dedup.strip(empty).count() == 0
    assert hashlib.sha256(b"").hexdigest() in {r.kept_sha256 for r in substring_dedup._apply(substring_dedup.repeats(docs), 35, 12, True).select(F.col("kept").alias("kept_sha256")).collect()}


def test_toxicity(spark, docs, empty, labels):
    bad = ["nasty", "vile", "horrid"]
    rs = [(i, say(30) + (" " + " ".join(random.sample(bad, 1 + i % 3)) if i % 5 == 0 else "")) for i in range(400)]
    df = spark.createDataFrame(rs, "doc_id long, text string")
    lab = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(300)], "doc_id long, toxic int")
    model = toxicity.train(df, lab)
    got = {r.doc_id: r for r in toxicity.score(df, model).collect()}
    held = [(got[i].rejected, i % 5 == 0) for i in range(300, 400)]
    assert all(a == b for a, b in held) and len(model.cuts) == 2 and model.cuts[0] <= model.cuts[1]
    assert got[302].expected_severity < got[300].expected_severity
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    assert scored.count() == len(doc_rows()) and scored.where("rejected is null").count() == 0
    assert toxicity.score(empty, model).count() == 0 and toxicity.train(empty, labels).cuts == []


def test_html():
    tree = html_extract.train()
    page = """<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><a href=x>One</a></nav><div class="ad">Buy this now please</div>
    <article><h1>Head &amp; more</h1><p>First  line<br>goes on &lt;b&gt;</p><script>var t="</p>";</script><p>Thing.</p><aside>See also</aside><form><input><button>Send</button></form>
    <div class="comments"><p>A reader says many words about this article here</p></div></article><footer>&copy; x</footer>"""
    assert html_extract.extract(page, tree)[0] == "Head & more\nFirst line goes on <b>\nThing."
    for t in (None, "", "<", "<p", "<!--", "<script>", "&amp", "<a href='>", "</div></div>x"):
        html_extract.extract(t, tree)
    assert html_extract.extract("<p>" * 20000 + "word", tree)[0] == "word"


def test_html_query(spark):
    df = spark.createDataFrame([(1, "u", None, "x"), (2, None, "<p>" + "good words here " * 10 + "</p>", "y")], "page_id long, url string, html string, text string")
    assert [(r.page_id, r.n_chars) for r in html_extract.main_text(df).orderBy("page_id").collect()] == [(1, 0), (2, 159)]


def test_pipeline(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, DATA)
    assert out.count() > 0 and {"doc_id", "text", "lang", "source", "n_chars"} <= set(out.columns)
    assert len(corpus_pipeline.STAGES) == 5 and common.scratch(spark)
