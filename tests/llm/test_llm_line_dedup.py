"""Deleted runs against a plain search through the documents in order."""

import random

import pytest
from pyspark.sql import functions as F

from wagelens.llm import line_dedup

SCHEMA = "doc_id long, text string, runs string, lo int, words string, lines string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, "clash", "clash") for r in rows], SCHEMA)


def plain(rows, hashes, least):
    """(doc_id, text) to (deleted spans of lines, text left)."""
    docs = {}
    for (d, t), h in zip(rows, hashes):
        if t is not None:
            lines = t.split("\n")
            docs[(d is not None, d or 0, h)] = (lines, [(i, x.strip(" \t\x0b\x0c\r"), len(x.split())) for i, x in enumerate(lines) if x.split()])
    first, windows = {}, {}
    for key in sorted(docs):
        for s, _ in enumerate(docs[key][1]):
            words, e = 0, s
            while words < least and e < len(docs[key][1]):
                words += docs[key][1][e][2]
                e += 1
            if words >= least:
                content = tuple(x[1] for x in docs[key][1][s:e])
                first.setdefault(content, (key, s))
                windows.setdefault(key, []).append((s, e, content))
    out = {}
    for key, (lines, own) in docs.items():
        gone, runs = set(), []
        for s, e, content in sorted(windows.get(key, []), key=lambda w: (first[w[2]][0], w[0] - first[w[2]][1], w[0])):
            src, at = first[content]
            if (src, at) == (key, s):
                continue
            if runs and runs[-1][:2] == [src, s - at] and s <= runs[-1][3]:
                runs[-1][3] = max(e, runs[-1][3])
            else:
                runs.append([src, s - at, s, e])
        for src, shift, s, e in runs:
            other, lo, hi = docs[src][1], s, e
            if src == key and lo < hi - shift:
                lo = hi - shift
            else:
                while hi - e < least and hi < len(own) and hi - shift < len(other) and own[hi][1] == other[hi - shift][1]:
                    hi += 1
                while s - lo < least and lo > 0 and lo - shift > 0 and own[lo - 1][1] == other[lo - 1 - shift][1]:
                    lo -= 1
                if src == key:
                    lo = max(lo, hi - shift)
            if lo < hi:
                gone.update(range(own[lo][0], own[hi - 1][0] + 1))
        out[key] = (len(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


def check(spark, rows, least):
    docs = frame(spark, rows)
    hashes = [r.h for r in spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "i int, t string").orderBy("i").select(F.xxhash64("t").alias("h")).collect()]
    want = plain(rows, hashes, least)
    texts = [None if t is None else want[(d is not None, d or 0, h)][1] for (d, t), h in zip(rows, hashes)]
    cleaned = line_dedup.dedup_lines(docs, least)
    assert cleaned.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in cleaned.collect()), key=repr)
    assert got == sorted(((d, t) for (d, _), t in zip(rows, texts)), key=repr)
    counts = sorted((repr(r.doc_id), r.n_removed) for r in line_dedup.removed_lines(docs, least).collect())
    assert counts == sorted((repr(d), 0 if t is None else want[(d is not None, d or 0, h)][0]) for (d, t), h in zip(rows, hashes))
    return {d: t for (d, _), t in zip(rows, texts)}


@pytest.mark.parametrize("seed", range(3))
def test_random_documents(spark, seed):
    draw = random.Random(seed)
    lines = [" ".join(draw.choices("abcdefgh", k=draw.choice([1, 2, 3, 5, 9]))) for _ in range(25)] + ["", "  "]
    passages = [draw.choices(lines, k=draw.randint(2, 9)) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [draw.choice([draw.choices(lines, k=draw.randint(0, 4)), draw.choice(passages)]) for _ in range(draw.randint(0, 5))]
        rows.append((draw.choice([i, i, i, i // 2]), "\n".join(x for p in parts for x in p)))
    check(spark, rows + rows[:3] + [(None, rows[5][1]), (None, None), (500, None)], 12)


def test_single_long_line_blanks_and_context(spark):
    passage = " ".join(f"p{i}" for i in range(55))
    rows = [(1, f"intro\n{passage}\nend"), (2, f"other\n  {passage}\t\n\nmore"), (3, passage), (4, "intro\nend"), (5, " ".join(f"p{i}" for i in range(49)))]
    out = check(spark, rows, 50)
    assert out == {1: rows[0][1], 2: "other\n\nmore", 3: "", 4: "intro\nend", 5: rows[4][1]}


def test_copies_and_periods(spark):
    text = "\n".join(f"line {i} with a few words in it" for i in range(40))
    rows = [(9, text)] * 3 + [(10, text), (11, text + "\nnew line"), (12, "same words here\n" * 100), (13, "a b c\nd e f\n" * 60)]
    out = check(spark, rows, 50)
    assert out[9] == text and out[10] == "" and out[11] == "new line"


def test_long_and_empty(spark):
    rows = [(1, "word " * 100_000), (2, "x\n" * 5000 + "word " * 100_000), (3, ""), (4, "\n\n"), (5, "end")]
    check(spark, rows, 50)
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0 and line_dedup.removed_lines(frame(spark, [])).count() == 0
