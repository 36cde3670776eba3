"""Importance resampling against plain Python."""

import hashlib
import math
import random
import re
import zlib

import pytest

from wagelens.llm import resample


def features(text, longest):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return words, [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def plain(rows, target, percent=25, least_words=20, seed=7, longest=2, buckets=10_000):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s, t = [0] * buckets, [0] * buckets
    for table, texts in ((s, [r[1] for r in rows]), (t, target)):
        for x in texts:
            for f in features(x, longest)[1]:
                table[bucket(f)] += 1
    all_s, all_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((y + 1) * (all_s + buckets) / ((x + 1) * (all_t + buckets)))) for x, y in zip(s, t)]
    found = []
    for doc_id, text in rows:
        words, fs = features(text, longest)
        weight = sum(gain[bucket(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        found.append([doc_id, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    able = sorted((r for r in found if r[5] >= least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in found), key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in df.collect()), key=repr)


def frames(spark, rows, target):
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, weight string, row long, rank int")
    return docs, spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")


def texts(draw, n, most=60):
    words = "Alpha beta GAMMA délta 東京 x1 2y İs 😀z".split() + [f"w{i}" for i in range(40)]
    return [draw.choice([" ", "-", "\n", ", "]).join(draw.choices(words, k=draw.randint(0, most))) for _ in range(n)]


@pytest.mark.parametrize(("small", "percent", "longest"), [(5, 25, 2), (1, 50, 1), (40, 10, 3), (1 << 13, 99, 2), (3, 100, 2)])
def test_equals_plain_python(spark, monkeypatch, small, percent, longest):
    monkeypatch.setattr(resample, "PIECE", 50)
    draw = random.Random(small)
    rows = list(enumerate(texts(draw, 250)))
    target = texts(draw, 20)[:19] + [None]
    docs, wanted = frames(spark, rows, target)
    got = result(resample.resample(docs.repartition(7), wanted, percent=percent, longest=longest, small=small))
    assert got == plain(rows, target, percent, longest=longest)


def test_ties_repeats_nulls_and_long_texts(spark):
    draw = random.Random(9)
    text = texts(draw, 1, 60)[0] + " more" * 30
    rows = [(5, text)] * 9 + [(None, text)] * 6 + [(1, None), (2, ""), (3, "one"), (4, "Word " * 400_000), (6, "x" * 100_000)]
    target = ["word beta", "more"]
    docs, wanted = frames(spark, rows, target)
    got = result(resample.resample(docs, wanted, percent=60, small=2))
    assert got == plain(rows, target, 60)


def test_nothing(spark):
    docs, wanted = frames(spark, [(1, "a b"), (2, None)], ["a"])
    assert [r[4] for r in result(resample.resample(docs, wanted))] == [None, None]
    assert resample.resample(docs.limit(0), wanted).count() == 0
    assert result(resample.resample(docs, wanted.limit(0))) == plain([(1, "a b"), (2, None)], [])


def test_cutoff_by_medians_is_the_kth_key(spark, monkeypatch):
    monkeypatch.setattr(resample, "BLOCK", 50)
    draw = random.Random(4)
    rows = [(draw.choice([0, 0, 0, draw.randint(-50, 50)]), draw.randint(0, 1), draw.randint(0, 30), 0, i) for i in range(2_000)]
    keys = spark.createDataFrame(rows, ", ".join(f"{k} long" for k in resample.KEY)).repartition(6)
    for k in (1, 2, 777, 1_000, 1_999, 2_000):
        assert resample.cutoff(keys, k, small=20) == sorted(rows)[k - 1]


def test_weighted_median_leaves_half_on_either_side():
    draw = random.Random(6)
    for _ in range(200):
        rows = [(draw.randint(0, 9), i, draw.randint(1, 20)) for i in range(draw.randint(1, 9))]
        pivot = resample.weighted_median(rows)
        total = sum(r[-1] for r in rows)
        assert sum(r[-1] for r in rows if r[:-1] <= pivot) * 2 >= total
        assert sum(r[-1] for r in rows if r[:-1] >= pivot) * 2 >= total
