"""Fingerprints and components against plain Python over all pairs."""

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from wagelens.llm import simhash
from wagelens.llm.components import connected_components
from wagelens.llm.forest import spanning_forest

SCHEMA = "doc_id long, text string, fp string, component_id string, bucket int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", 1) for r in rows], SCHEMA)


def plain(text, k):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, linked):
    """Smallest reachable index by search over all pairs."""
    left, name = set(range(len(nodes))), {}
    while left:
        todo = [min(left)]
        root = todo[0]
        left.discard(root)
        while todo:
            i = todo.pop()
            name[i] = root
            near = {j for j in left if linked(nodes[i], nodes[j])}
            left -= near
            todo += near
    return name


@pytest.mark.parametrize("text", ["", None, " \t\n", "one", "ÀB c", "a b c", "a b c d", "A b C d E f g h", "x y z w q", "w " * 70_000])
def test_fingerprint(text):
    assert simhash.fingerprint(None if text is None else text.encode(), 4) == plain(text, 4)


def test_components_of_documents(spark):
    draw = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(25):
        base = draw.choices(words, k=300)
        for _ in range(draw.choice([1, 2, 12])):
            copy = list(base)
            for _ in range(draw.choice([0, 1, 2, 4])):
                copy[draw.randrange(300)] = draw.choice(words)
            rows.append((len(rows) * 3 + 1, " ".join(copy)))
    rows += [(5000, None), (5001, ""), (4999, "  "), (None, rows[0][1]), rows[3], (6000, "Tie tie"), (6001, "tie TIE")]
    prints = [plain(t, 4) for _, t in rows]
    name = groups(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[name[i]] = min(least.get(name[i], d), d)
    want = sorted(((d, f"{p:016x}", least[name[i]]) for i, ((d, _), p) in enumerate(zip(rows, prints))), key=repr)
    got = sorted(map(tuple, simhash.near_duplicates(frame(spark, rows)).collect()), key=repr)
    assert got == want and len({w[2] for w in want}) < len(want) - 20
    kept = simhash.keep_one(frame(spark, rows))
    assert kept.columns == frame(spark, []).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values()))


def test_empty(spark):
    assert simhash.near_duplicates(frame(spark, [])).count() == 0 and simhash.keep_one(frame(spark, [])).count() == 0
    alone = simhash.near_duplicates(frame(spark, [(None, "a")])).collect()
    assert [(r.doc_id, r.component_id) for r in alone] == [(None, None)]


def test_one_row_of_each_component_is_kept(spark):
    draw = random.Random(6)
    texts = [" ".join(draw.choices([f"w{i}" for i in range(400)], k=60)) for _ in range(8)]
    rows = [(None, t) for t in texts[:5]] + [(None, texts[0])]  # several null ids, one copied
    rows += [(1, texts[1])]  # a null id is a copy of a numbered document
    rows += [(2, texts[5]), (2, texts[6])]  # two texts under one id
    rows += [(3, texts[7]), (4, texts[7]), (3, texts[2])]
    got = sorted(((r.doc_id, r.text) for r in simhash.keep_one(frame(spark, rows)).collect()), key=repr)
    want = [(None, texts[0]), (None, texts[3]), (None, texts[4]), (1, texts[1]), (2, texts[5]), (2, texts[6]), (3, texts[7]), (3, texts[2])]
    assert got == sorted(want, key=repr)


def test_masks_cover_all_close_pairs():
    draw = random.Random(1)
    for n, distance in ((10, 4), (10_000, 4), (10_000_000, 4), (10**10, 3), (1000, 0)):
        masks = simhash.block_masks(n, distance)
        for _ in range(300):
            flips = sum(1 << b for b in draw.sample(range(64), distance))
            assert any(not flips & m for m in masks)


@pytest.mark.parametrize("small", [2, 48])
def test_links_within_buckets_connect_all_close_pairs(monkeypatch, small):
    monkeypatch.setattr(simhash, "SMALL", small)
    draw = np.random.default_rng(7)
    centres = draw.integers(0, 2**63, 20, dtype=np.uint64)
    near = [c ^ np.uint64(sum(1 << int(b) for b in draw.integers(0, 64, 3))) for c in centres for _ in range(draw.integers(1, 80))]
    fps = np.unique(np.concatenate((centres, np.array(near, np.uint64))))
    first = np.array([0, len(fps) // 3, len(fps) // 3 + 1, len(fps) - 5])
    a, b = spanning_forest(*simhash.close_within(fps, first, 4))
    assert all((int(x) ^ int(y)).bit_count() for x, y in zip(a, b))
    got = dict(zip(a.tolist(), b.tolist()))
    for lo, hi in zip(first, [*first[1:], len(fps)]):
        part = fps[lo:hi].tolist()
        name = groups(part, lambda x, y: (x ^ y).bit_count() <= 4)
        assert all(got.get(x, x) == part[name[i]] for i, x in enumerate(part))


def test_components_of_chains_hubs_and_loops(spark):
    draw = random.Random(9)
    edges = [(i, i + 1) for i in range(1000, 1400)] + [(5000, 5000 + i) for i in range(1, 500)] + [(7, 7), (None, 3), (9, None)]
    edges += [(draw.randrange(10_000, 10_300), draw.randrange(10_000, 10_300)) for _ in range(200)]
    draw.shuffle(edges)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges + edges[:50], "a long, b long")).collect()}
    nodes = sorted({x for e in edges if None not in e and e[0] != e[1] for x in e})
    linked = {frozenset(e) for e in edges}
    name = groups(nodes, lambda a, b: frozenset((a, b)) in linked)
    assert got == {x: nodes[name[i]] for i, x in enumerate(nodes)}
    assert connected_components(spark.createDataFrame([], "a string, b string")).count() == 0


@pytest.mark.parametrize("bucket", [40])
def test_large_buckets_are_cut_without_losing_links(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    monkeypatch.setattr(simhash, "SAMPLE", 1)
    draw = random.Random(9)
    prints = {0, 1, 2**63, 2**64 - 1}
    for _ in range(30):  # they agree in the upper 40 bits, so every first mask has hot buckets
        base = 0xABCDE12345 << 24 | draw.getrandbits(24)
        prints |= {base ^ sum(1 << x for x in draw.sample(range(24), draw.randrange(5))) for _ in range(12)}
    prints |= {draw.getrandbits(64) for _ in range(200)}
    prints = sorted(prints)
    df = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fp long")
    masks = simhash.block_masks(len(prints), 4)
    sizes = simhash.buckets(df, len(prints), masks, 4).groupBy("mask", "bucket").count().agg(F.max("count")).first()[0]
    plainly = Counter((m, p & m) for m in masks for p in prints)
    assert sizes <= bucket < max(plainly.values()) // 2
    roots = {r.node % 2**64: r.root for r in connected_components(simhash.near_links(df, len(prints), 4)).collect()}
    want = groups(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    got = [roots.get(p, f"alone {p}") for p in prints]
    same = {}
    for i, root in enumerate(got):
        assert same.setdefault(root, want[i]) == want[i]
    assert len(same) == len(set(want.values()))


def test_buckets_that_cannot_be_cut_stay():
    assert simhash.block_masks(1000, 4, fixed=(1 << 60) - 1) == []
    masks = simhash.block_masks(1 << 20, 4, fixed=(1 << 40) - 1, most=330)
    assert len(masks) <= 330 and all(m & (1 << 40) - 1 == (1 << 40) - 1 and m > (1 << 40) for m in masks)
