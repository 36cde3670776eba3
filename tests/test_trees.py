"""Forests of unbounded depth, against a plain tree that looks at every split."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from wagelens.operators import trees

SCHEMA = "grp string, items array<string>, key long, y double, train boolean"


def plain_tree(rows, gains):
    """{items: value} for (items, y, train) rows, by recursion over all features."""
    known = [(i, y) for i, y, train in rows if train]
    mean = sum(y for _, y in known) / len(known)
    sse = sum((y - mean) ** 2 for _, y in known)
    options = []
    for f in sorted({f for i, _ in known for f in i}):
        sides = [[y for i, y in known if (f in i) is side] for side in (True, False)]
        if all(sides):
            left = sum(sum((y - sum(ys) / len(ys)) ** 2 for y in ys) for ys in sides)
            options.append((-round((sse - left) / len(known), 9), f))
    if len({y for _, y in known}) == 1 or not options:
        return {i: mean for i, _, _ in rows}
    gain, best = min(options)
    gains[best] += -gain * len(known)
    out = {}
    for side in (True, False):
        out |= plain_tree([r for r in rows if (best in r[0]) is side], gains)
    return out


def draw(seed, n, group):
    rng = random.Random(seed)
    names = [f"c={i}" for i in range(9)] + [f"s={i}" for i in range(6)] + ["ü=1", "😀"]
    rows = []
    for k in range(n):
        items = tuple(sorted(rng.sample(names, rng.randint(0, 5))))
        y = sum(3.0 * (i > "c=4") + len(i) for i in items) + rng.randint(0, 6)
        rows.append((group, list(items), k, float(y), rng.random() < 0.8))
    return rows


@pytest.mark.parametrize("hand_over", [100_000, 100])
def test_one_tree_per_group_equals_the_plain_one(spark, hand_over):
    rows = draw(1, 300, "a") + draw(2, 180, "b")
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    forest = trees.fit_forest(df, trees=1, bootstrap=False, hand_over=hand_over)
    got = {(r.grp, tuple(r["items"])): r.yhat for r in forest.predictions.collect()}
    weights = {(r.grp, r.feature): r.importance for r in forest.importances.collect()}
    for group in "ab":
        gains = defaultdict(float)
        want = plain_tree([(tuple(i), y, t) for g, i, _, y, t in rows if g == group], gains)
        assert {k for g, k in got if g == group} == set(want)
        for items, y in want.items():
            assert got[group, items] == pytest.approx(y)
        total = sum(gains.values())
        for feature, gain in gains.items():
            assert weights[group, feature] == pytest.approx(gain / total, abs=1e-6)
        assert sum(w for (g, _), w in weights.items() if g == group) == pytest.approx(1.0)


def test_grown_to_purity_beyond_any_fixed_depth(spark):
    # every row its own category: a tree of 79 questions, one below the other
    rows = [("g", [f"c={i:03d}"], i, float(i * 7 % 50), True) for i in range(80)]
    for hand_over in (1000, 76):
        forest = trees.fit_forest(spark.createDataFrame(rows, SCHEMA), trees=1, bootstrap=False, hand_over=hand_over)
        got = {r["items"][0]: r.yhat for r in forest.predictions.collect()}
        assert all(got[i[0]] == pytest.approx(y) for _, i, _, y, _ in rows)


def test_bootstrap_does_not_depend_on_hand_over_or_partitions(spark):
    df = spark.createDataFrame(draw(3, 250, "a"), SCHEMA)
    one = trees.fit_forest(df.repartition(1), trees=8, hand_over=10_000)
    two = trees.fit_forest(df.repartition(9), trees=8, hand_over=150)
    a = {tuple(r["items"]): r.yhat for r in one.predictions.collect()}
    b = {tuple(r["items"]): r.yhat for r in two.predictions.collect()}
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k]) for k in a)
    x = {r.feature: r.importance for r in one.importances.collect()}
    y = {r.feature: r.importance for r in two.importances.collect()}
    assert x.keys() == y.keys() and all(x[k] == pytest.approx(y[k]) for k in x)


def test_draws_are_poisson(spark):
    df = spark.range(40_000).select(trees._draws(F.col("id"), F.lit(3), 42).alias("w"))
    mean, spread = df.agg(F.avg("w"), F.var_pop("w")).first()
    assert mean == pytest.approx(1.0, abs=0.02) and spread == pytest.approx(1.0, abs=0.04)


def test_small_and_empty_inputs(spark):
    rows = [("only scored", ["a"], 1, 5.0, False), ("null y", [], 2, None, True), ("one", ["a"], 3, 7.0, True), ("one", ["b"], 4, 9.0, False),
            ("flat", ["a"], 5, 2.0, True), ("flat", ["b"], 6, 2.0, True)]
    forest = trees.fit_forest(spark.createDataFrame(rows, SCHEMA), trees=1, bootstrap=False)
    got = {(r.grp, tuple(r["items"])): r.yhat for r in forest.predictions.collect()}
    assert got == {("only scored", ("a",)): None, ("null y", ()): None, ("one", ("a",)): 7.0, ("one", ("b",)): 7.0, ("flat", ("a",)): 2.0, ("flat", ("b",)): 2.0}
    assert all(r.importance == 0 for r in forest.importances.collect())
    empty = trees.fit_forest(spark.createDataFrame([], SCHEMA), trees=2)
    assert empty.predictions.count() == 0 and empty.importances.count() == 0


def test_selection_keeps_what_matters_at_least_on_average(spark):
    df = spark.createDataFrame([("g", ["a", "b", "c"], 1, 0.0, True), ("g", ["c"], 2, 0.0, True), ("g", [], 3, None, False)], SCHEMA)
    weights = spark.createDataFrame([("g", "a", 0.7), ("g", "b", 0.2), ("g", "c", 0.1)], "grp string, feature string, importance double")
    got = {r.key: r["items"] for r in trees.select_important(df, weights).collect()}
    assert got == {1: ["a"], 2: [], 3: []}


def test_items_of_a_row(spark):
    df = spark.createDataFrame([("x", ["go", "sql", "go"]), (None, None)], "place string, skills array<string>")
    got = [r[0] for r in df.select(trees.feature_items(["place"], {"skill": "skills"})).collect()]
    assert got == [["place=x", "skill=go", "skill=sql"], []]
