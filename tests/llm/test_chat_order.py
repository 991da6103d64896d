"""Dialogues with crowded turns keep their order."""

import random

from brackish.llm import chat_format


def test_joined_parts_are_the_dialogue_in_its_order(spark):
    rnd = random.Random(4)
    rs = [(1, t, rnd.choice("ab"), f"t{rnd.randrange(10**6)}") for t in range(70)]
    rs += [(1, 5, rnd.choice("ab"), f"m{rnd.randrange(10**6)}") for _ in range(200)] + [(1, 9, "a", "same")] * 150
    rs += [(2, t, "a", f"x{t}") for t in range(3)] + [(3, None, "a", f"n{i}") for i in range(90)] + [(None, 1, "a", "lone")] * 70
    rnd.shuffle(rs)
    got = chat_format.render(spark.createDataFrame(rs, "conv_id long, turn long, role string, text string").repartition(3)).collect()
    for conv in (1, 2, 3, None):
        want = sorted((t if t is not None else 2**62, r, x) for c, t, r, x in rs if c == conv)
        for who in {r for _, r, _ in want}:
            mine = sorted((r.part, r.sub, r.text, r.n_turns) for r in got if (r.conv_id, r.perspective) == (conv, who))
            text = "".join(f"<|im_start|>{'assistant' if r == who else 'user name=' + r}\n{x}<|im_end|>\n" for _, r, x in want)
            assert "".join(m[2] for m in mine) == text and len({m[:2] for m in mine}) == len(mine)
    crowded = [r.n_turns for r in got if r.conv_id == 1 and r.part == 0]
    assert max(crowded) <= chat_format.TURNS
