"""Exact top-k search by columnar branch-and-bound.

Queries and candidates are dealt into tiles of bounded size, and each pair of tiles
is one task's work.  There, dimensions lie in blocks, the heaviest first.  Scores
grow block by block; what is left can add at most the product of the remaining
norms, so a candidate that cannot reach a query's k-th best any more is dropped and
the survivors are compacted.  The best k of each tile meet in one ranking per query.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wagelens.llm.staging import stage
from wagelens.llm.vectors import matrix, usable, width_of
from wagelens.session import ship_package

QUERY_TILE, CANDIDATE_TILE = 1024, 8192
BLOCKS, QUERIES_AT_ONCE, SEEDS = 4, 64, 1024
#: share of pairs alive below which pairs, not columns, are carried on; and of columns below which they are compacted
FEW_PAIRS, FEW_COLUMNS = 0.05, 0.7
LONG = 2**63 - 1


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, v): floor(scale * component) as longs; equal rows are one."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    rows = vectors.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v")).distinct()


def _tail_norms(m: np.ndarray, edges: list[int]) -> list[np.ndarray]:
    squares = m.astype(np.float64) ** 2
    return [np.sqrt(squares[:, e:].sum(axis=1)) for e in edges[1:]]


def best_in_tile(
    q_rows: np.ndarray, q: np.ndarray, c_rows: np.ndarray, c: np.ndarray, k: int, c_ids: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of query, place of candidate, score) with each query's k best; ties to smaller ids; never its own row.

    Rows are named by number; the ids of candidates are those numbers if not given.
    """
    c_ids = c_rows if c_ids is None else c_ids
    width = q.shape[1]
    most = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(width, 1)
    if most >= 2**53:  # beyond exact floating point: whole numbers throughout
        scores = np.clip(q.astype(object) @ c.astype(object).T, -LONG, LONG).astype(np.int64)
        i, j = np.nonzero(q_rows[:, None] != c_rows[None, :])
        return _ranked(i, j, scores[i, j], c_ids, k)
    kind = np.float32 if most < 2**24 else np.float64  # sums stay exact
    heavy = np.argsort(-(c.astype(np.float64) ** 2).sum(axis=0), kind="stable")
    q, rows = np.ascontiguousarray(q[:, heavy], kind), np.ascontiguousarray(c[:, heavy], kind)
    columns = np.ascontiguousarray(rows.T)
    edges = np.linspace(0, width, BLOCKS + 1).astype(int).tolist()
    q_rest, c_rest = _tail_norms(q, edges), _tail_norms(rows, edges)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for at in range(0, len(q), QUERIES_AT_ONCE):
        own = slice(at, at + QUERIES_AT_ONCE)
        seeds = q[own] @ columns[:, :SEEDS]
        seeds[q_rows[own, None] == c_rows[None, :SEEDS]] = -np.inf
        floor = np.partition(seeds, -k, axis=1)[:, -k] if seeds.shape[1] > k else np.full(len(seeds), -np.inf)
        alive = np.arange(len(rows))
        part = np.zeros((len(seeds), len(rows)), kind)
        for b in range(BLOCKS):
            lo, hi = edges[b], edges[b + 1]
            block = columns[lo:hi] if len(alive) == len(rows) else columns[lo:hi, alive]
            part += q[own, lo:hi] @ block
            # one more than the bound, for rounding of the norms
            hope = part + q_rest[b][own, None] * c_rest[b][alive] + (b < BLOCKS - 1) >= floor[:, None]
            if b == BLOCKS - 1 or hope.mean() < FEW_PAIRS:
                i, j = np.nonzero(hope)
                score = part[i, j].astype(np.float64)
                if b < BLOCKS - 1:
                    score += np.einsum("ij,ij->i", q[own][i, hi:], rows[alive[j], hi:], dtype=np.float64)
                break
            keep = hope.any(axis=0)
            if keep.mean() < FEW_COLUMNS:
                alive, part = alive[keep], part[:, keep]
        j = alive[j]
        other = q_rows[own][i] != c_rows[j]
        i, j, score = _ranked(i[other], j[other], np.rint(score[other]).astype(np.int64), c_ids, k)
        found.append((i + at, j, score))
    return tuple(np.concatenate(x) for x in zip(*found))


def _ranked(i: np.ndarray, j: np.ndarray, score: np.ndarray, c_ids: np.ndarray, k: int):
    order = np.lexsort((c_ids[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    first = np.flatnonzero(np.append(True, i[1:] != i[:-1])) if len(i) else np.empty(0, int)
    place = np.arange(len(i)) - np.repeat(first, np.diff(np.append(first, len(i))))
    return i[place < k], j[place < k], score[place < k]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """The k candidates of largest inner product for each query: query_id, rank, vec_id, score.

    Both inputs are (row, vec_id, v), written, with whole numbers; ``row`` names a row
    and is the same in both.  A query's own row is no candidate of it, others under its
    id are.  Ties go to the smaller id; fewer candidates than k give fewer rows; each
    query row has its own ranks.  Vectors of different length are compared as if filled
    with zeros.
    """
    ship_package(vectors.sparkSession)
    c_tiles = max(1, math.ceil(vectors.count() / CANDIDATE_TILE))
    q_tiles = max(1, math.ceil(queries.count() / QUERY_TILE))

    def tile(n: int):
        return F.pmod(F.xxhash64(F.lit("tile"), "row"), F.lit(n)).cast("int")

    left = vectors.select("row", "vec_id", "v", tile(c_tiles).alias("c"), F.explode(F.sequence(F.lit(0), F.lit(q_tiles - 1))).alias("q"))
    right = queries.select("row", "vec_id", "v", tile(q_tiles).alias("q"), F.explode(F.sequence(F.lit(0), F.lit(c_tiles - 1))).alias("c"))
    kind = pa.schema([("row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def search(c: pa.Table, q: pa.Table) -> pa.Table:
        if not c.num_rows or not q.num_rows:
            return kind.empty_table()
        c_ids, q_ids = c["vec_id"].to_numpy(), q["vec_id"].to_numpy()
        c_rows, q_rows = c["row"].to_numpy(), q["row"].to_numpy()
        width = width_of(c["v"], q["v"])
        i, j, score = best_in_tile(q_rows, matrix(q["v"], width), c_rows, matrix(c["v"], width), k, c_ids)
        return pa.Table.from_arrays([pa.array(q_rows[i]), pa.array(q_ids[i]), pa.array(c_ids[j]), pa.array(score)], schema=kind)

    found = left.groupBy("c", "q").cogroup(right.groupBy("c", "q")).applyInArrow(search, "row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def search_every(vectors: DataFrame, every: int = 20, k: int = 20, scale: int = 64) -> DataFrame:
    """Search with the vectors whose id is divisible by ``every`` among all.

    Vectors that are null or hold null, NaN or infinite components take no part, nor
    do rows without an id.  Repeated rows are one; different vectors under one id are
    rows of their own, as queries and as candidates.  An empty table gives no rows; only
    vec_id and embedding are read.
    """
    whole = stage(quantised(vectors, scale).withColumn("row", F.monotonically_increasing_id()), "quantised")
    return top_k(whole, whole.where(F.col("vec_id") % every == 0), k)
