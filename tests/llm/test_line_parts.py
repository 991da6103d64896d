"""The joins on words of line dedup go by parts of their keys, and the lines that go do not depend on how many."""

import random

from brackish.llm import line_dedup

rnd = random.Random(11)
WORDS = [f"w{i}" for i in range(60)]


def test_parts_hold_a_share_of_the_keys_and_lose_no_line(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HUB_LEAST", 4)
    base = [rnd.sample(WORDS, rnd.randint(1, 25)) for _ in range(40)]
    near = [b[: max(1, len(b) - rnd.randint(0, 3))] + rnd.sample(WORDS, rnd.randint(0, 2)) for b in base for _ in range(3)]
    lines = [" ".join(x) for x in base + near]
    docs = spark.createDataFrame([(i, "\n".join(lines[i * 4 : i * 4 + 4])) for i in range(40)], "doc_id long, text string")
    sets = [set(x) for x in base + near]
    gone = {i for i in range(len(sets)) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}
    want = {i: [x for k, x in enumerate(lines[i * 4 : i * 4 + 4]) if i * 4 + k not in gone] for i in range(40)}
    shares = []
    part = line_dedup.part
    monkeypatch.setattr(line_dedup, "part", lambda rows, i: (shares.append((part(rows, i).count(), rows.count())), part(rows, i))[1])
    for n in (1, 3):
        monkeypatch.setattr(line_dedup, "PARTS", n)
        shares.clear()
        got = {r.doc_id: r.text for r in line_dedup.dedup(docs).collect()}
        assert {i: [x for x in t.split("\n") if x] for i, t in got.items()} == want
        assert len(shares) == 2 * n and (n == 1 or all(0 < a < 0.6 * b for a, b in shares))
