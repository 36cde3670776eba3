"""Spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest

from wagelens.llm import spelling, tries


def near(a, b):
    """Do two words differ by exactly one inserted, deleted or replaced code point?"""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(counts):
    """{word: (form, root, n, n_near, form_n)} by comparing every two words."""
    form, rows = {}, {}
    for w, n in counts.items():
        others = sorted((-m, v) for v, m in counts.items() if near(w, v))
        best = others[0] if others and -others[0][0] >= 2 * n and n > 0 else None
        form[w] = best[1] if best else None
        rows[w] = (n, len(others), -best[0] if best else None)
    found = {}
    for w, (n, n_near, form_n) in rows.items():
        root = w
        while form[root] is not None:
            root = form[root]
        found[w] = (form[w], root, n, n_near, form_n)
    return found


def grouped(spark, counts):
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.group_variants(df).collect()}


def vocabulary(draw, n, letters="abéx"):
    return {"".join(draw.choices(letters, k=draw.randint(0, 7))): draw.choice([1, 2, 3, 3, 7, 20, 50, 400]) for _ in range(n)}


@pytest.mark.parametrize("range_words", [50_000, 25])
def test_equals_comparing_all(spark, monkeypatch, range_words):
    monkeypatch.setattr(tries, "RANGE_WORDS", range_words)
    counts = vocabulary(random.Random(range_words), 500)
    counts |= {"aaaa": 9, "aaaaa": 4, "aaa": 40, "😀x": 3, "😀y": 7, "日本": 2, "日本語": 5}
    assert grouped(spark, counts) == plain(counts)


def test_chains_ties_and_a_hub(spark):
    chain = {"abcdefgh"[:i] + "z" * i: 3 << i for i in range(2, 8)}
    hub = {"house" + c: 3 for c in "abcdefghijklmnopqrstuvwxyz"} | {"house": 100}
    ties = {"tiara": 10, "tiarb": 10, "tiarc": 5, "tiard": 6, "nulls": 0, "nullz": 0}
    step = {"stepaaaa"[: 4 + i]: 4**i for i in range(5)}
    counts = chain | hub | ties | step
    got = grouped(spark, counts)
    assert got == plain(counts)
    assert got["tiarc"][0] == "tiara" and got["step"][1] == "stepaaaa" and got["housea"][0] == "house"


def test_long_words_cost_a_number_a_letter(spark):
    long = "ab" * 30_000
    counts = {long: 9, long[:-1]: 3, long[1:]: 2, "c" + long: 30, long[:500] + "x" + long[501:]: 1}
    got = grouped(spark, counts)
    assert {got[w][3] for w in counts} == {1, 2, 4} or got == plain(counts)
    assert got[long][0] == "c" + long and got[long[1:]][0] == long


def test_rows_of_one_word_nulls_and_nothing(spark):
    rows = [("house", 2, 1), ("house", 3, 2), (None, 9, 3), ("horse", None, 4), ("mouse", 1, 5)]
    df = spark.createDataFrame(rows, "word string, n long, id long").withColumnRenamed("id", "first")
    got = {r.word: (r.form, r.n, r.n_near) for r in spelling.group_variants(df).collect()}
    assert got == {"house": (None, 5, 2), "horse": (None, 0, 1), "mouse": ("house", 1, 1)}
    assert spelling.group_variants(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        spelling.group_variants(df, form_factor=1)


def plain_words(rows, least_length, least_count, drop_every):
    total = Counter()
    for doc_id, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if drop_every and h % drop_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= least_length and n >= least_count}


@pytest.mark.parametrize("drop_every", [97, 2, None])
def test_words_of_odd_texts(spark, monkeypatch, drop_every):
    monkeypatch.setattr(spelling, "PIECE", 2_000)
    monkeypatch.setattr(spelling, "HELD_WORDS", 40)
    draw = random.Random(5)
    letters = "abcdeABCDE éÉİıß×÷ĀK日 \n1"
    rows = [(i, "".join(draw.choices(letters, k=draw.randint(0, 300)))) for i in range(300)]
    rows += [(7, rows[7][1]), (None, rows[8][1]), (400, None), (401, ""), (402, "Word " * 3_000), (403, "a" * 20_000), (404, "a" * 20_000)]
    df = spark.createDataFrame([(*r, i, i) for i, r in enumerate(rows)], "doc_id long, text string, word long, n long")
    for length, count in ((2, 2), (1, 1), (5, 3)):
        got = {r.word: r.n for r in spelling.count_words(df, length, count, drop_every).collect()}
        assert got == plain_words(rows, length, count, drop_every)
    assert spelling.count_words(df.limit(0)).count() == 0


def test_nodes_are_equal_where_prefixes_are(spark, monkeypatch):
    monkeypatch.setattr(tries, "RANGE_WORDS", 10)
    words = sorted({w for w in vocabulary(random.Random(2), 300)})
    df = spark.createDataFrame(list(enumerate(words)), "id long, word string").repartition(5)
    for reverse in (False, True):
        splits = tries.split_strings(df, tries.F.reverse("word") if reverse else tries.F.col("word"), len(words))
        assert len(splits) > 5
        node = {}
        for r in tries.number_nodes(df, len(words), reverse).collect():
            word = words[r.id][::-1] if reverse else words[r.id]
            assert len(r.nodes) == len(word) + 1
            for i, x in enumerate(r.nodes):
                assert node.setdefault(word[:i], x) == x
        assert len(set(node.values())) == len(node)
