"""The pipeline's near-duplicate stage against brute force over 5-word shingles."""

import random

from brackish.llm import simhash

SCHEMA = "doc_id long, text string, `a.b` string, Text2 string"


def shingles(t, k=5):
    w = (t or "").lower().split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def alike(a, b):
    x, y = shingles(a), shingles(b)
    return x == y or bool(x | y) and len(x & y) >= 0.8 * len(x | y)


def brute(rows):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if alike(rows[i][1], rows[j][1]):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    best = {}
    for i in order:
        best.setdefault(group[i], rows[i][0])
    return sorted(best.values(), key=str)


def test_stage_by_brute_force(spark):
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = [(1, None), (2, ""), (3, "\n "), (4, "One two"), (5, "one  TWO"), (None, "a null id stands last in its group"), (7, "a null id stands last in its group")]
    for n in (60, 300, 2500):
        base = [r.choice(vocabulary) for _ in range(n)]
        for copies in range(12):
            words = list(base)
            for _ in range(copies * n // 250):
                words[r.randrange(n)] = r.choice(vocabulary)
            rows.append((100 * n + copies, " ".join(words)))
        rows += [(100 * n + 50 + i, " ".join(r.choice(vocabulary) for _ in range(n))) for i in range(10)]
    rows.append((100 * 60, rows[7][1]))
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    out = simhash.keep_similar(df)
    assert out.columns == df.columns
    assert sorted((x[0] for x in out.select("doc_id").collect()), key=str) == brute(rows)
    assert simhash.keep_similar(df.limit(0)).count() == 0
