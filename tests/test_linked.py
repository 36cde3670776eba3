"""Postings that are one by address or by content, through any number of steps."""

import random

from pyspark.sql import functions as F

from wagelens.operators import components, dedup
from wagelens.operators.components import connected

SCHEMA = "url string, title string, company string, snapshot int, seq int"


def plain(rows):
    """Newest row of every group, by merging rows that share a key."""
    parent, first, best = list(range(len(rows))), {}, {}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (url, title, company, *_) in enumerate(rows):
        keys = [("a", url)] if url is not None else []
        keys += [("c", title, company)] if (title, company) != (None, None) else []
        for key in keys:
            a, b = find(i), find(first.setdefault(key, i))
            parent[max(a, b)] = min(a, b)
    for i, r in enumerate(rows):
        best[find(i)] = max(best.get(find(i), r), r, key=lambda x: x[3:])
    return sorted(best.values(), key=str)


def kept(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    found = dedup.linked_across_sources(df, "snapshot", "seq", identity=("title", "company"))
    assert found.columns == df.columns
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_chains_of_address_and_content(spark):
    rows = [("u1", "a", None, 1, 1), ("u1", "b", "x", 2, 2), (None, "b", "x", 3, 3), ("u2", "b", "x", 1, 4), ("u2", None, None, 9, 5)]
    rows += [(None, "a", "", 4, 6), (None, None, None, 1, 7), (None, None, None, 1, 8), ("u3", None, None, 1, 9), (None, "", None, 1, 10), (None, "A", None, 1, 11)]
    assert kept(spark, rows) == plain(rows)
    assert ("u2", None, None, 9, 5) in plain(rows) and len(plain(rows)) == 7


def test_random_rows_and_a_hub(spark):
    draw = random.Random(3)
    rows = [(draw.choice([None, f"u{draw.randint(0, 90)}"]), draw.choice([None, f"t{draw.randint(0, 40)}"]), draw.choice([None, "c", "d"]), draw.randint(0, 3), i) for i in range(150)]
    rows += [("hub", f"h{i}", "c", 1, 1_000 + i) for i in range(300)] + [(f"long{i // 2}", f"l{(i + 1) // 2}", "c", 1, 2_000 + i) for i in range(60)]
    draw.shuffle(rows)
    assert kept(spark, rows) == plain(rows)


def test_components_of_nothing_and_loops(spark):
    edges = spark.createDataFrame([("a", "a"), ("b", None), (None, "c")], "a string, b string")
    assert components.connected(edges).count() == 0 and components.connected(edges.limit(0)).count() == 0
    edges = spark.createDataFrame([("d", "c"), ("c", "d"), ("c", "b"), ("x", "y")], "a string, b string")
    assert sorted(map(tuple, components.connected(edges).collect())) == [("b", "b"), ("c", "b"), ("d", "b"), ("x", "x"), ("y", "x")]


def test_links_are_numbers_that_tell_keys_apart(spark, monkeypatch):
    df = spark.createDataFrame([("x", None), ("y", "x"), ("z", "w"), (None, None)], "a string, b string")
    clash = lambda key, seed: F.length(key).cast("long") if seed == 0 else F.xxhash64(key)
    monkeypatch.setattr(dedup, "_number", clash)
    assert dedup.distinct_seed(df, ["a", "b"], [0, 3]) == 3
    seen = []
    monkeypatch.setattr(dedup, "connected", lambda edges: seen.append(edges.dtypes) or connected(edges))
    rows = spark.createDataFrame([(1, "u", "t", "s1"), (2, "u", "v", "s2"), (3, None, "v", "s3"), (4, None, None, "s4")], "n int, url string, title string, s string")
    assert sorted(r.n for r in dedup.linked_across_sources(rows, "s", "n").collect()) == [3, 4]
    assert seen == [[("a", "bigint"), ("b", "bigint")]]
