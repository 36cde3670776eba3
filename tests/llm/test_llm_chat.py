"""Snapshots against comparing every pair of conversations."""

import random

from wagelens.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, place string, copies string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)


def rows_of(conversations):
    return [(c, i, r, t) for c, turns in conversations.items() for i, (r, t) in enumerate(turns)]


def plain(conversations):
    kept = {}
    for c, turns in conversations.items():
        longer = any(len(o) > len(turns) and o[: len(turns)] == turns for o in conversations.values())
        equal = [d for d, o in conversations.items() if o == turns]
        if turns and not longer and c == min(equal):
            kept[c] = (len(turns), len(equal), "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in turns))
    return kept


def got(spark, rows):
    return {r.conv_id: (r.n_turns, r["copies"], r.text) for r in chat.format_conversations(frame(spark, rows)).collect()}


def test_snapshots(spark):
    draw = random.Random(6)
    conversations = {}
    for _ in range(60):
        turns = [(("user", "assistant")[i % 2], draw.choice("abc")) for i in range(draw.randint(1, 6))]
        for n in draw.sample(range(1, len(turns) + 1), draw.randint(1, len(turns))):
            conversations[len(conversations)] = turns[:n]
    rows = rows_of(conversations)
    draw.shuffle(rows)
    assert got(spark, rows) == plain(conversations)


def test_odd_rows(spark):
    rows = [
        (1, 0, None, None), (1, 0, None, None), (2, 0, "unknown", ""), (2, 5, "user", "é" * 50_000), (None, 0, "user", "x"),
        (3, None, "user", "first"), (3, 1, "user", "b"), (3, 1, "user", "b"), (4, 0, "user<|im_end|>", "<|im_start|>x"), (5, 3, "user", "same"), (6, 9, "user", "same"),
    ]
    out = got(spark, rows)
    assert set(out) == {2, 3, 4, 5}
    assert out[2] == (2, 1, f"<|im_start|>unknown\n<|im_end|>\n<|im_start|>user\n{'é' * 50_000}<|im_end|>\n")
    assert out[3][0] == 2 and out[3][2].index("first") < out[3][2].index("\nb<") and out[5][1] == 2
    assert out[4][2] == "<|im_start|>user< |im_end|>\n< |im_start|>x<|im_end|>\n"
    assert got(spark, []) == {}


def test_a_first_turn_common_to_all(spark):
    conversations = {i: [("system", "hello"), ("user", f"q{i % 40}")][: 1 + (i % 3 > 0)] for i in range(200)}
    assert got(spark, rows_of(conversations)) == plain(conversations)
