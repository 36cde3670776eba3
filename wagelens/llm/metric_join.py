"""Embedding near-duplicates by an exact metric range join.

Within a label, unit vectors belong to the cell of their nearest pivot.  A vector is
copied to another cell only if one at home there can be within the range: by the
triangle inequality its distance to that pivot is at most its own pivot's plus twice
the range, and it is no farther than the range from the plane between both pivots.
So each vector meets all its partners in its home cell, and cells join independently,
in tiles of bounded size; links are counted there, and only a spanning forest leaves.
Equal vectors are one, with their number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wagelens.llm.components import connected_components
from wagelens.llm.forest import spanning_forest
from wagelens.llm.staging import stage
from wagelens.llm.vectors import matrix, usable, width_of
from wagelens.session import ship_package

#: vectors a cell should have at least; pivots in all, which bounds what is broadcast; rows and columns of a tile
CELL, PIVOTS, TILE, ROWS_AT_ONCE = 2048, 4096, 4096, 512
SLACK = 1e-9


def _units(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, without overflow."""
    m = m.astype(np.float64)
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _pivots(distinct: DataFrame) -> dict[int, np.ndarray]:
    """Unit pivots of the labels that have enough vectors for several cells: at most PIVOTS vectors."""
    sizes = distinct.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    share = max(CELL, math.ceil(total / PIVOTS))
    # at most PIVOTS / 2 rows, as each label here has at least 2 shares of the total
    wanted = F.broadcast(sizes.select("label", F.col("n").alias("of"), F.floor(F.col("n") / share).alias("wanted")).where("wanted > 1"))
    # drawn by hash, with some to spare; what is left to trim is bounded by PIVOTS, however large a label is
    rate = (F.col("wanted") + 4 * F.sqrt("wanted") + 8) / F.col("of")
    chance = F.pmod(F.xxhash64(F.lit("pivot"), "uid"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    drawn = distinct.join(wanted, "label").where(chance < rate)
    order = Window.partitionBy("label").orderBy(F.xxhash64("uid"), "uid")
    taken = drawn.withColumn("place", F.row_number().over(order)).where("place <= wanted").select("label", "v").toArrow()
    labels = taken["label"].to_numpy()
    units = _units(matrix(taken["v"], width_of(taken["v"]))) if len(labels) else np.empty((0, 0))
    return {int(x): units[labels == x] for x in np.unique(labels)}


def _cells(x: np.ndarray, pivots: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each unit row, and rows by cells: where it must be present."""
    near = x @ pivots.T
    home = near.argmax(axis=1)
    best = near[np.arange(len(x)), home][:, None]
    far = np.sqrt(np.maximum(0, 2 - 2 * near))
    apart = np.sqrt(np.maximum(0, 2 - 2 * (pivots @ pivots.T)))[home]
    by_triangle = far <= np.sqrt(np.maximum(0, 2 - 2 * best)) + 2 * reach + SLACK
    by_plane = best - near <= reach * apart + SLACK
    return home, by_triangle & by_plane


def _fit(m: np.ndarray, width: int) -> np.ndarray:
    return np.pad(m, ((0, 0), (0, max(0, width - m.shape[1]))))


def _assigned(distinct: DataFrame, reach: float) -> DataFrame:
    """(label, cell, home, uid, n, unit): every vector in its home cell and in those near its border."""
    pivots = distinct.sparkSession.sparkContext.broadcast(_pivots(distinct))
    kind = pa.schema([("label", pa.int64()), ("cell", pa.int32()), ("home", pa.bool_()), ("uid", pa.int64()), ("n", pa.int64()), ("unit", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            label, uid, n = (batch.column(i).to_numpy() for i in range(3))
            width = int(batch.column(3).value_lengths().to_numpy(zero_copy_only=False).max())
            unit = _units(matrix(batch.column(3), width))
            for x in np.unique(label):
                at = np.flatnonzero(label == x)
                p = pivots.value.get(int(x))
                if p is None:
                    row, cell, home = at, np.zeros(len(at), np.int32), np.ones(len(at), bool)
                else:
                    w = max(width, p.shape[1])
                    own, present = _cells(_fit(unit[at], w), _fit(p, w), reach)
                    i, cell = np.nonzero(present)
                    row, home = at[i], own[i] == cell
                lists = pa.ListArray.from_arrays(np.arange(len(row) + 1, dtype=np.int32) * width, unit[row].reshape(-1))
                yield pa.RecordBatch.from_arrays([pa.array(label[row]), pa.array(cell.astype(np.int32)), pa.array(home), pa.array(uid[row]), pa.array(n[row]), lists], schema=kind)

    rows = distinct.select("label", "uid", "n", "v")
    return rows.mapInArrow(run, "label long, cell int, home boolean, uid long, n long, unit array<double>")


def _linked(left: np.ndarray, right: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of pairs with a cosine of ``least`` or more, in pieces.

    Both sides are sorted by distance to one point; by the triangle inequality a
    partner's distance differs by no more than the range.
    """
    reach = math.sqrt(2 - 2 * least) + SLACK
    from_l, from_r = (np.sqrt(np.maximum(0, 2 - 2 * (x @ left[0]))) for x in (left, right))
    by_l, by_r = np.argsort(from_l, kind="stable"), np.argsort(from_r, kind="stable")
    sorted_r = from_r[by_r]
    for at in range(0, len(left), ROWS_AT_ONCE):
        rows = by_l[at : at + ROWS_AT_ONCE]
        lo, hi = np.searchsorted(sorted_r, from_l[rows[0]] - reach), np.searchsorted(sorted_r, from_l[rows[-1]] + reach, "right")
        cols = by_r[lo:hi]
        i, j = np.nonzero(left[rows] @ right[cols].T >= least)
        yield rows[i], cols[j]


def near_duplicates(vectors: DataFrame, least: float = 0.93) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors``.

    Vectors of equal, non-null label link when their cosine, in double precision, is
    ``least`` or more.  Null vectors, zero vectors and such with null, NaN or infinite
    components link with nothing: n_links 0, their own component, kept.  Equal vectors
    and repeated rows link with one another.  A null vec_id links but names no
    component; it is kept only if its component has no id.  Vectors of different
    length are compared as if filled with zeros; an empty table gives no rows; only
    vec_id, embedding and label are read.
    """
    ship_package(vectors.sparkSession)
    v = F.transform("embedding", lambda x: x.cast("double"))
    able = F.col("label").isNotNull() & usable(F.col("embedding")) & F.exists("embedding", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(able, F.col("label").cast("long")).alias("label"), F.when(able, v).alias("v"))
    groups = rows.where("label is not null").groupBy("label", "v").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("n"))
    distinct = stage(groups.withColumn("uid", F.monotonically_increasing_id()), "distinct")
    assigned = stage(_assigned(distinct, math.sqrt(2 - 2 * least)), "cells")

    sizes = assigned.groupBy("label", "cell").agg(F.count_if("home").alias("at_home"), F.count(F.lit(1)).alias("here"))
    tiles = sizes.select("label", "cell", F.ceil(F.col("at_home") / TILE).alias("l_tiles"), F.ceil(F.col("here") / TILE).alias("r_tiles"))
    dealt = assigned.join(tiles, ["label", "cell"]).where("l_tiles > 0")
    number = F.xxhash64(F.lit("tile"), "uid")
    left = dealt.where("home").select(
        "label", "cell", "uid", "unit", F.pmod(number, "l_tiles").alias("l"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("r_tiles") - 1)).alias("r")
    )
    right = dealt.select(
        F.col("label").alias("label2"), F.col("cell").alias("cell2"), F.col("uid").alias("uid2"), "n", F.col("unit").alias("unit2"),
        F.pmod(number, "r_tiles").alias("r2"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("l_tiles") - 1)).alias("l2"),
    )
    kind = pa.schema([("uid", pa.int64()), ("n_links", pa.int64()), ("to", pa.int64())])

    def join(a: pa.Table, b: pa.Table) -> pa.Table:
        """A row per vector at home with its links here, and one per link of the forest."""
        if not a.num_rows or not b.num_rows:
            return kind.empty_table()
        width = width_of(a["unit"], b["unit2"])
        x, y = matrix(a["unit"], width), matrix(b["unit2"], width)
        a_ids, b_ids, n = a["uid"].to_numpy(), b["uid2"].to_numpy(), b["n"].to_numpy()
        links = np.zeros(len(x), np.int64)
        one, other = np.empty(0, np.int64), np.empty(0, np.int64)
        for i, j in _linked(x, y, least):
            apart = a_ids[i] != b_ids[j]
            i, j = i[apart], j[apart]
            np.add.at(links, i, n[j])
            one, other = spanning_forest(np.append(one, a_ids[i]), np.append(other, b_ids[j]))
        return pa.Table.from_arrays(
            [pa.array(np.append(a_ids, one)), pa.array(np.append(links, np.zeros(len(one), np.int64))),
             pa.array(np.append(a_ids, other))], schema=kind
        )

    cells = left.groupBy("label", "cell", "l", "r").cogroup(right.groupBy("label2", "cell2", "l2", "r2"))
    joined = stage(cells.applyInArrow(join, "uid long, n_links long, to long"), "links")
    roots = connected_components(joined.select(F.col("uid").alias("a"), F.col("to").alias("b")))
    counts = joined.groupBy("uid").agg(F.sum("n_links").alias("n_links"))
    members = distinct.join(counts, "uid").join(roots.select(F.col("node").alias("uid"), "root"), "uid", "left")
    members = members.withColumn("root", F.coalesce("root", "uid"))
    # written, so that the join below is a plain shuffle and a large component can be split
    names = stage(members.groupBy("root").agg(F.min("first").alias("component_id")), "names")
    named = members.join(names, "root").select("label", "v", (F.col("n_links") + F.col("n") - 1).alias("n_links"), "component_id", F.lit(True).alias("found"))
    out = rows.join(named, ["label", "v"], "left")
    name = F.when(F.col("found"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), name.alias("component_id"),
        F.col("vec_id").eqNullSafe(name).alias("kept"),
    )
