"""Targets against refilling step by step; the rounding by its guarantees."""

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from wagelens.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, copies int, target string, units string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 9, "clash", "clash") for r in rows], SCHEMA)


def targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    goal, capped = 1.5 * sum(sizes.values()), set()
    while True:
        rest = goal - sum(2 * sizes[s] for s in capped)
        total = sum(weight[s] for s in order if s not in capped)
        want = {s: 2 * sizes[s] if s in capped else rest * weight[s] / total for s in order}
        above = {s for s in order if want[s] > 2 * sizes[s]} - capped
        if not above:
            return want
        capped |= above


@pytest.fixture(scope="module")
def documents():
    draw = random.Random(5)
    names = [f"s{i}" for i in range(9)] + ["Z", "é", "\U0001f600", None]
    rows = []
    for i in range(3000):
        source = names[0] if draw.random() < 0.33 else draw.choice(names)
        rows.append((i, " ".join(["w"] * int(draw.lognormvariate(3, 1))) if draw.random() < 0.97 else draw.choice([None, "", " \t\n"]), source))
    return rows


def test_targets_and_rounding(spark, documents):
    rows, decisions = mixing.mix(frame(spark, documents))
    got = mixing.decided(rows, decisions).collect()
    assert len(got) == len(documents)
    size_of = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in documents}
    sizes, largest = defaultdict(int), defaultdict(int)
    for i, _, s in documents:
        sizes[s] += size_of[i]
        largest[s] = max(largest[s], size_of[i])
    want, taken = targets(sizes), defaultdict(int)
    for r in got:
        assert r["size"] == size_of[r.doc_id] and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-12)
        assert r.taken == r.copies * r["size"] and 0 <= r.copies <= 2
        ratio = r.target / r.source_size
        assert r["size"] == 0 or int(ratio) <= r.copies <= int(ratio) + (ratio > int(ratio))
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in sizes)


def test_reruns_on_other_partitions_agree(spark, documents):
    once, again = (
        sorted((r.doc_id, r.taken) for r in mixing.decided(*mixing.mix(frame(spark, documents).repartition(n))).collect()) for n in (3, 17)
    )
    assert once == again


def test_expectation_is_kept_over_many_sources(spark):
    docs = [(i, "w w w w", f"s{i // 10:03d}") for i in range(3000)]
    got = mixing.decided(*mixing.mix(frame(spark, docs))).collect()
    assert abs(sum(r.taken for r in got) - 1.5 * 12000) < 0.01 * 18000


def test_odd_rows(spark):
    same = [(7, "a b c", "x")] * 40
    docs = [(None, "a b", "x"), (None, "a b c d", None), (1, None, None), (2, "one", "x"), (2, "one two", "y"), *same]
    got = mixing.decided(*mixing.mix(frame(spark, docs))).collect()
    assert len(got) == len(docs)
    assert len({r.copies for r in got if r.doc_id == 7}) == 1
    assert [r.taken for r in got if r["size"] == 0] == [0]
    assert mixing.decided(*mixing.mix(frame(spark, []))).count() == 0
    nothing = mixing.decided(*mixing.mix(frame(spark, [(1, "", "a"), (2, None, None)]))).collect()
    assert [(r.target, r.taken) for r in nothing] == [(0.0, 0), (0.0, 0)]


def test_documents_are_repeated(spark, documents):
    docs = frame(spark, documents[:500])
    out = mixing.repeat_documents(docs)
    assert out.columns == docs.columns
    copies = {r.doc_id: r.copies for r in mixing.decided(*mixing.mix(docs)).collect()}
    counts = defaultdict(int)
    for r in out.collect():
        counts[r.doc_id] += 1
    assert {i: n for i, n in copies.items() if n} == counts


def test_repeated_rows_meet_the_target(spark):
    rows = [(7, "a b c d", "x")] * 300 + [(None, f"n{i} b c", "x") for i in range(300)] + [(i, "w " * (i % 9), "x") for i in range(300)]
    rows += [(1000 + i, "one two", s) for i in range(400) for s in ("y", None)]
    docs = frame(spark, rows)
    want = targets({s: sum(len(t.split()) for _, t, x in rows if x == s) for s in ("x", "y", None)})
    counts = []
    for n in (3, 17):
        got = mixing.decided(*mixing.mix(docs.repartition(n), alike=False)).collect()
        assert len(got) == len(rows)
        for s in want:
            assert abs(sum(r.taken for r in got if r.source == s) - want[s]) <= 8
        counts.append(sorted(((r.doc_id, r.source, r.copies) for r in got), key=repr))
    assert counts[0] == counts[1]
    out = mixing.repeat_documents(docs, alike=False)
    assert out.columns == docs.columns
    assert out.where("source = 'x' and doc_id = 7").count() == sum(n for d, s, n in counts[0] if d == 7 and s == "x")
    assert all(abs(sum(len(r.text.split()) for r in out.where(F.col("source").eqNullSafe(s)).collect()) - want[s]) <= 8 for s in want)
