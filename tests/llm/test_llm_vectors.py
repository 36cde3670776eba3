"""Top-k search and metric join against all pairs in numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wagelens.llm import metric_join, topk

SCHEMA = "vec_id long, embedding array<double>, label int, v string, score string, uid string, unit string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash", "clash") for r in rows], SCHEMA)


def vectors(seed, n=700, width=12, labels=3):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(20, width))
    x = centres[draw.integers(0, 20, n)] + draw.choice([0.05, 0.2, 1.0], n)[:, None] * draw.normal(size=(n, width))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[5], x[6], x[40] = x[4], x[4], x[4]
    return [(i, v.tolist(), int(draw.integers(0, labels))) for i, v in enumerate(x)]


ODD = [
    (9000, None, 1), (9020, [1.0, None] + [0.0] * 10, 1), (9040, [math.nan] + [0.0] * 11, 1), (9060, [math.inf] + [0.0] * 11, 1),
    (9080, [0.0] * 12, 1), (9001, [1.0] + [0.0] * 11, None),
]


def plain_top(rows, every, k):
    good = [(i, np.floor(64 * np.array(v))) for i, v, _ in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    m = np.array([v for _, v in good]).astype(np.int64)
    ids = np.array([i for i, _ in good])
    out = []
    for q in np.flatnonzero(ids % every == 0):
        scores = m @ m[q]
        order = [j for j in np.lexsort((ids, -scores)) if j != q][:k]
        out += [(int(ids[q]), r + 1, int(ids[j]), int(scores[j])) for r, j in enumerate(order)]
    return sorted(out)


@pytest.mark.parametrize("tiles", [(1024, 8192), (7, 50)])
def test_top_k(spark, monkeypatch, tiles):
    monkeypatch.setattr(topk, "QUERY_TILE", tiles[0])
    monkeypatch.setattr(topk, "CANDIDATE_TILE", tiles[1])
    rows = vectors(1) + ODD
    docs = frame(spark, [*rows, rows[0], (None, [1.0] * 12, 1)])
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.search_every(docs).collect())
    assert got == plain_top(rows, 20, 20)


def test_bounds_never_lose_a_winner():
    draw = np.random.default_rng(3)
    for width, scale in ((1, 3), (5, 60), (64, 64), (64, 10**6), (30, 2**28)):
        c = draw.integers(-scale, scale, (3000, width)) * (draw.random((1, width)) < 0.6)
        c[::7] = c[0]
        ids = draw.permutation(3000)
        q = draw.choice(3000, 150, replace=False)
        i, j, score = topk.best_in_tile(ids[q], c[q], ids, c, 9)
        exact = c[q].astype(object) @ c.astype(object).T
        for row in range(150):
            order = sorted((x for x in range(3000) if x != q[row]), key=lambda x: (-exact[row, x], ids[x]))[:9]
            assert j[i == row].tolist() == order
            assert score[i == row].tolist() == [int(exact[row, x]) for x in order]


def test_rows_under_one_id(spark):
    """Different vectors of one id are candidates of each other and queries of their own; equal rows are one."""
    rows = [(0, [1.0, 0.0], 1), (1, [5.0, 0.0], 1), (1, [3.0, 1.0], 1), (1, [3.0, 1.0], 1), (20, [0.0, 1.0], 1), (20, [2.0, 2.0], 1)]
    got = sorted((r.query_id, r.rank, r.vec_id, r.score // 4096) for r in topk.search_every(frame(spark, rows), k=3).collect())
    assert got == sorted([
        (0, 1, 1, 5), (0, 2, 1, 3), (0, 3, 20, 2),
        (20, 1, 20, 2), (20, 2, 1, 1), (20, 3, 0, 0), (20, 1, 1, 10), (20, 2, 1, 8), (20, 3, 0, 2),
    ])


def test_few_empty_and_ragged(spark):
    assert topk.search_every(frame(spark, [])).count() == 0
    two = topk.search_every(frame(spark, [(0, [1.0, 2.0], 1), (1, [0.5], 1), (3, [], 1)])).collect()
    assert sorted((r.rank, r.vec_id, r.score) for r in two) == [(1, 1, 64 * 32), (2, 3, 0)]


def plain_join(rows, least):
    n = len(rows)
    good = [v is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0) and x is not None for _, v, x in rows]
    unit = np.array([np.array(v) / np.linalg.norm(v) if g else np.zeros(12) for (_, v, _), g in zip(rows, good)])
    label = np.array([x if g else -1 - i for i, ((_, _, x), g) in enumerate(zip(rows, good))])
    near = (unit @ unit.T >= least) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    reach = near | np.eye(n, dtype=bool)
    for _ in range(12):
        reach = reach @ reach
    ids = np.array([i for i, _, _ in rows])
    return sorted((int(ids[i]), int(near[i].sum()), int(ids[reach[i]].min()), bool(ids[i] == ids[reach[i]].min())) for i in range(n))


@pytest.mark.parametrize("sizes", [(4096, 4096, 512), (30, 25, 7)])
def test_metric_join(spark, monkeypatch, sizes):
    for name, size in zip(("CELL", "TILE", "ROWS_AT_ONCE"), sizes):
        monkeypatch.setattr(metric_join, name, size)
    rows = vectors(2) + ODD + [(3, vectors(2)[3][1], vectors(2)[3][2])]
    got = sorted(map(tuple, metric_join.near_duplicates(frame(spark, rows)).collect()))
    want = plain_join(rows, 0.93)
    assert got == want and 20 < len({w[2] for w in want}) < 650


def test_metric_join_of_odd_tables(spark):
    assert metric_join.near_duplicates(frame(spark, [])).count() == 0
    got = metric_join.near_duplicates(frame(spark, [*ODD, (None, [1.0, 0.0], 5), (8, [2e200, 1.0], 5), (9, [5e-200], 5), (None, None, 5)])).collect()
    out = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got if r.vec_id is not None}
    assert all(out[i] == (0, i, True) for i, _, _ in ODD)
    assert out[8] == (2, 8, True) and out[9] == (2, 8, False)
    assert sorted((r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None and r.n_links) == [(2, 8, False)]


def test_cells_hold_all_partners():
    draw = np.random.default_rng(5)
    x = metric_join._units(draw.normal(size=(600, 3)))
    pivots = x[:17]
    reach = math.sqrt(2 - 2 * 0.93)
    home, present = metric_join._cells(x, pivots, reach)
    i, j = np.nonzero(x @ x.T >= 0.93)
    assert present[j, home[i]].all() and present.mean() < 0.6


def test_pivots_of_a_hot_label_come_without_sorting_it(spark):
    rows = [(i, [float(i), 1.0], 1 if i % 3 else 100 + i % 30) for i in range(40_000)]
    distinct = frame(spark, rows).select(F.col("vec_id").alias("uid"), F.col("embedding").alias("v"), F.col("label").cast("long").alias("label"))
    pivots = metric_join._pivots(distinct)
    assert {x: len(p) for x, p in pivots.items()} == {1: 26_666 // metric_join.CELL}
    assert metric_join._pivots(distinct.limit(0)) == {}
