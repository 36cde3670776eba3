"""Regression forests of unbounded depth, many groups in one fit, on rows with sets of features.

A row has the features it shows (a category value, a named skill); a split asks whether
one of them is there, which is every split a one-hot or 0/1 column allows.  Rows with equal
features can't be told apart, so trees grow on distinct feature sets with summed weights.

Nodes with more sets than a task should hold are split level by level: a sum per
(group, tree, node, feature), then the best feature per node.  Smaller nodes are handed whole to
tasks, which grow them to purity.  Rows to be scored go down the trees with weight 0,
so no tree is ever gathered and depth has no limit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagelens.operators.lookup import join_lookup, small_enough
from wagelens.session import scratch_path, ship_package

#: feature sets a task grows a subtree from
HAND_OVER = 20_000
NODE = ["grp", "tree", "node"]
#: gains are compared per unit of weight of a standardised target, to this many places; ties go to the least feature
PLACES = 12
#: chances of at most 0, 1, 2, ... draws of a row by a bootstrap of a large table
_AT_MOST = [0.36787944117144233, 0.73575888234288467, 0.91969860292860584, 0.98101184312384626,
            0.99634015317265634, 0.99940581518241833, 0.99991675885070620, 0.99998975080332532, 0.99999887479740220]
#: the same as whole numbers of 53 bits
_LEAST = [np.uint64(math.ceil(p * (1 << 53))) for p in _AT_MOST]
_TASK = pa.schema([("grp", pa.string()), ("tree", pa.int32()), ("items", pa.list_(pa.string())), ("z", pa.float64()), ("feature", pa.string()), ("gain", pa.float64())])
_OUT = "grp string, tree int, items array<string>, z double, feature string, gain double"


@dataclass
class Forest:
    """``predictions``: (grp, items, yhat); ``importances``: (grp, feature, importance)."""

    predictions: DataFrame
    importances: DataFrame


@dataclass
class Drawn:
    """Rows drawn for a number of trees and summed by feature set, one row per tree and distinct set.

    ``sets``: (grp, tree, node, items, w, s, lo, hi, n), n rows of the set train; ``moments``: (grp, mean, spread).
    """

    sets: DataFrame
    moments: DataFrame


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _prefixed(prefix: str, elements: Column) -> Column:
    return F.transform(elements, lambda x: F.concat(F.lit(prefix), x))


def feature_items(categories: list[str], listed: dict[str, str]) -> Column:
    """The features of a row: ``column=value`` per category column, ``name=element`` per array column."""
    single = [F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in categories]
    many = [_prefixed(f"{n}=", F.coalesce(F.col(c), F.array().cast("array<string>"))) for n, c in listed.items()]
    return F.sort_array(F.array_distinct(F.array_compact(F.concat(F.array(*single).cast("array<string>"), *many))))


def _draws(key: Column, tree: Column, seed: int) -> Column:
    """How often a bootstrap takes the row: Poisson with mean 1, decided by its key."""
    share = F.pmod(F.xxhash64(key, tree, F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    return sum(((share >= F.lit(p)).cast("double") for p in _AT_MOST), F.lit(0.0))


_P1, _P2, _P3, _P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))


def _hash_on(hashed: np.ndarray, number: int) -> np.ndarray:
    """``xxhash64`` of one more int column."""
    h = (hashed + _P5 + np.uint64(4)) ^ (np.uint64(number & 0xFFFFFFFF) * _P1)
    h = ((h << np.uint64(23)) | (h >> np.uint64(41))) * _P2 + _P3
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def draws_of(hashed: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """``_draws`` of the rows whose keys have these hashes."""
    with np.errstate(over="ignore"):
        h = _hash_on(_hash_on(hashed, tree), seed)
    share = h & np.uint64((1 << 53) - 1)
    draws = np.zeros(len(share), np.uint8)
    for least in _LEAST:
        draws += share >= least
    return draws.astype(np.float64)


def _summed(batch: pa.RecordBatch, trees: int, bootstrap: bool, seed: int, kinds: pa.Array, kind: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sums of one batch, by tree and kind of row."""
    trained = np.flatnonzero(batch["train"].to_numpy(zero_copy_only=False))
    trained = trained[np.argsort(kind[trained], kind="stable")]
    starts = np.flatnonzero(np.diff(kind[trained], prepend=-1))
    at = kind[trained][starts]  # the kinds with train rows; the others have no sums
    z, hashed = batch["z"].to_numpy(zero_copy_only=False)[trained], batch["hashed"].to_numpy()[trained].view(np.uint64)

    def by_kind(add: np.ufunc, values: np.ndarray, none: float = 0.0) -> np.ndarray:
        out = np.full(len(kinds), none)
        if len(starts):
            out[at] = add.reduceat(values, starts)
        return out

    n = pa.array(by_kind(np.add, np.ones(len(z))))
    for tree in range(trees):
        w = draws_of(hashed, tree, seed) if bootstrap else np.ones(len(z))
        taken = w > 0
        lo, hi = by_kind(np.minimum, np.where(taken, z, np.inf), np.inf), by_kind(np.maximum, np.where(taken, z, -np.inf), -np.inf)
        none = ~np.isfinite(lo)
        yield pa.RecordBatch.from_arrays(
            [kinds, pa.array(np.full(len(kinds), tree, np.int32)), pa.array(by_kind(np.add, w)),
             pa.array(by_kind(np.add, np.where(taken, w * z, 0.0))), pa.array(lo, mask=none), pa.array(hi, mask=none), n],
            ["of", "tree", "w", "s", "lo", "hi", "n"],
        )


#: rows a task sums before it sends on what it has
SUMMED_ROWS = 400_000


def tree_sums(rows: DataFrame, by: list[str], trees: int, bootstrap: bool, seed: int) -> DataFrame:
    """(by, tree, w, s, lo, hi, n): the draws of rows equal in ``by``, sum and bounds of their ``z``, and the train rows, for every tree.

    ``rows``: the ``by`` columns, key, z, train.  Tasks draw and sum the rows they read, so what is
    sent on grows with the distinct ``by``, at most with the rows.
    """

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= SUMMED_ROWS:
                yield from of_batches(held)
                held, n = [], 0
        if n:
            yield from of_batches(held)

    def of_batches(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        coded = batch["of"].dictionary_encode()
        yield from _summed(batch, trees, bootstrap, seed, coded.dictionary, coded.indices.to_numpy())

    of = F.to_json(F.struct(*by), {"ignoreNullFields": "false"})
    types = rows.select(F.struct(*by).alias("of")).schema["of"].dataType
    z = F.coalesce(F.col("z"), F.lit(0.0))
    sent = rows.select(of.alias("of"), F.xxhash64("key").alias("hashed"), z.cast("double").alias("z"), F.coalesce("train", F.lit(False)).alias("train"))
    parts = sent.mapInArrow(summed, "of string, tree int, w double, s double, lo double, hi double, n double")
    sums = parts.groupBy("of", "tree").agg(F.sum("w").alias("w"), F.sum("s").alias("s"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n"))
    return sums.withColumn("of", F.from_json("of", types)).select("of.*", "tree", "w", "s", "lo", "hi", "n")


def _feature_sets(rows: DataFrame, moments: DataFrame, trees: int, bootstrap: bool, seed: int) -> DataFrame:
    """(grp, tree, node, items, w, s, lo, hi, n): one row per tree and distinct feature set; lo and hi bound its targets."""
    z = F.coalesce(F.try_divide(F.col("y") - F.col("mean"), F.col("spread")), F.lit(0.0))
    drawn = join_lookup(rows, moments, "grp").withColumn("z", z)
    sums = tree_sums(drawn, ["grp", "items"], trees, bootstrap, seed)
    return sums.select("grp", "tree", F.lit("").alias("node"), "items", "w", "s", "lo", "hi", "n")


def _at_nodes(rows: DataFrame, nodes: DataFrame, how: str = "inner") -> DataFrame:
    """Rows with the columns of their node, which are broadcast only if measured few."""
    return rows.join(F.broadcast(nodes) if small_enough(nodes) else nodes, NODE, how)


def _best_features(rows: DataFrame) -> DataFrame:
    """(grp, tree, node, best, gain): the feature whose question lowers the squared error most."""
    shown = rows.where("w > 0").select(*NODE, "w", "s", "in_w", "in_s", F.explode("items").alias("feature"))
    sums = shown.groupBy(*NODE, "feature").agg(F.sum("w").alias("w1"), F.sum("s").alias("s1"), F.first("in_w").alias("w0"), F.first("in_s").alias("s0"))
    rest = F.col("w0") - F.col("w1")
    gain = F.col("s1") ** 2 / F.col("w1") + (F.col("s0") - F.col("s1")) ** 2 / rest - F.col("s0") ** 2 / F.col("w0")
    asked = sums.where("w1 > 0 and w1 < w0").withColumn("gain", gain / F.col("w0"))
    best = asked.groupBy(*NODE).agg(F.min(F.struct((-F.round("gain", PLACES)).alias("g"), F.col("feature"), (F.col("gain") * F.col("w0")).alias("gain"))).alias("b"))
    return best.select(*NODE, F.col("b.feature").alias("best"), F.col("b.gain").alias("gain"))


def _coded(items: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(row, feature number) of every item, with the names in order."""
    lists = items.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    coded = lists.flatten().dictionary_encode()
    names = coded.dictionary.to_pylist()
    order = sorted(range(len(names)), key=names.__getitem__)
    place = np.empty(len(names), np.int64)
    place[order] = np.arange(len(names))
    codes = place[coded.indices.to_numpy()] if len(names) else np.empty(0, np.int64)
    return np.repeat(np.arange(len(lists)), sizes), codes, [names[i] for i in order]


def grow_to_purity(w, s, lo, hi, row, code) -> tuple[np.ndarray, list[tuple[int, float]]]:
    """The leaf value of every feature set and the (feature, gain) of every split."""
    value, splits = np.full(len(w), np.nan), []
    inside = np.zeros(len(w), bool)
    todo = [(np.arange(len(w)), row, code)]
    while todo:
        at, row, code = todo.pop()
        trained = at[w[at] > 0]
        if not len(trained):
            continue
        weight, total = w[trained].sum(), s[trained].sum()
        kinds, kind = np.unique(code, return_inverse=True)
        w1 = np.bincount(kind, w[row], len(kinds))
        asked = np.flatnonzero((w1 > 0) & (w1 < weight))
        if lo[trained].min() == hi[trained].max() or not len(asked):
            value[at] = total / weight
            continue
        s1, w1 = np.bincount(kind, s[row], len(kinds))[asked], w1[asked]
        gain = (s1**2 / w1 + (total - s1) ** 2 / (weight - w1) - total**2 / weight) / weight
        k = np.round(gain, PLACES).argmax()  # the first of equals: the least feature
        splits.append((int(kinds[asked[k]]), float(gain[k] * weight)))
        with_it = row[kind == asked[k]]
        inside[with_it] = True
        here, entry = inside[at], inside[row]
        inside[with_it] = False
        todo += [(at[here], row[entry], code[entry]), (at[~here], row[~entry], code[~entry])]
    return value, splits


def _grow(key: tuple, table: pa.Table) -> pa.Table:
    row, code, names = _coded(table["items"])
    value, splits = grow_to_purity(*(table[c].to_numpy() for c in ("w", "s", "lo", "hi")), row, code)
    gains = np.bincount([f for f, _ in splits], [g for _, g in splits], len(names)) if splits else np.zeros(len(names))
    used = np.flatnonzero(gains)
    n, m = len(value), len(used)
    return pa.Table.from_arrays([
        pa.array([key[0].as_py()] * (n + m), pa.string()), pa.array([key[1].as_py()] * (n + m), pa.int32()),
        pa.chunked_array([*table["items"].cast(pa.list_(pa.string())).chunks, pa.nulls(m, pa.list_(pa.string()))], pa.list_(pa.string())),
        pa.array(np.append(value, np.zeros(m)), from_pandas=True), pa.array([None] * n + [names[i] for i in used], pa.string()),
        pa.array(np.append(np.zeros(n), gains[used])),
    ], schema=_TASK)


def _grown(sets: DataFrame, hand_over: int) -> DataFrame:
    """Values (items, z) and gains (feature, gain) of all trees; ``sets`` is a written table."""
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("items", "array<string>"), ("z", "double"))]
    no_gain = [F.lit(None).cast("string").alias("feature"), F.lit(0.0).alias("gain")]
    current, small, out = sets, [], []
    while True:
        nodes = current.groupBy(*NODE).agg(
            F.count(F.lit(1)).alias("n"), F.sum("w").alias("in_w"), F.sum("s").alias("in_s"), F.min("lo").alias("least"), F.max("hi").alias("most")
        )
        mixed = F.col("least") < F.col("most")
        state = F.when(mixed & (F.col("n") > hand_over), "split").when(mixed, "small").otherwise("leaf")
        nodes = _written(nodes.select(*NODE, "in_w", "in_s", F.coalesce(state, F.lit("leaf")).alias("state")), "nodes")
        placed = _at_nodes(current, nodes)
        leaf = placed.where("state = 'leaf'").select("grp", "tree", "items", F.try_divide("in_s", "in_w").alias("z"), *no_gain)
        small.append(placed.where("state = 'small'").select(*current.columns))
        out.append(leaf)
        if nodes.where("state = 'split'").isEmpty():
            break
        wide = placed.where("state = 'split'")
        best = _written(_best_features(wide), "splits")
        out.append(best.select("grp", "tree", *nothing, F.col("best").alias("feature"), "gain"))
        asked = _at_nodes(wide, best, "left")
        # the trained sets of such a node are one, beside sets that are only scored
        out.append(asked.where("best is null").select("grp", "tree", "items", F.try_divide("in_s", "in_w").alias("z"), *no_gain))
        side = F.when(F.array_contains("items", F.col("best")), "1").otherwise("0")
        current = _written(asked.where("best is not null").withColumn("node", F.concat("node", side)).select(*current.columns), "sets")
    ready = small[0]
    for part in small[1:]:
        ready = ready.unionByName(part)
    grown = ready.groupBy(*NODE).applyInArrow(_grow, _OUT)
    for part in out:
        grown = grown.unionByName(part)
    return _written(grown, "grown")


def fit_forest(
    rows: DataFrame, trees: int = 100, bootstrap: bool = True, seed: int = 42, hand_over: int = HAND_OVER
) -> Forest:
    """Grow ``trees`` trees per group to purity and score every row's feature set with them.

    ``rows``: grp string, items array<string> (sorted, distinct), key, y double, train boolean.
    Rows with train = false or a null y are scored only.  Rows of one key are drawn together;
    without ``bootstrap`` every tree is the same, so one is enough.  A group without a
    training row gets null predictions and no importances.  A leaf is pure, or holds one
    distinct set of features.  Importances of a group sum to 1 unless no tree of it splits;
    features never asked for have 0.
    """
    return forest_on(draw_sets(rows, trees, bootstrap, seed), trees, hand_over)


def draw_sets(rows: DataFrame, trees: int = 100, bootstrap: bool = True, seed: int = 42) -> Drawn:
    """What ``fit_forest`` learns from ``rows``, drawn once; the draws of a tree do not depend on the number of trees."""
    ship_package(rows.sparkSession)
    trained = F.coalesce(F.col("train") & F.col("y").isNotNull(), F.lit(False))
    rows = rows.select("grp", "items", "key", "y", trained.alias("train"))
    moments = rows.where("train").groupBy("grp").agg(F.avg("y").alias("mean"), F.stddev_pop("y").alias("spread"))
    moments = _written(moments, "moments")
    return Drawn(_written(_feature_sets(rows, moments, trees, bootstrap, seed), "sets"), moments)


def without_unimportant(drawn: Drawn, importances: DataFrame) -> tuple[Drawn, DataFrame]:
    """``drawn`` with the features ``select_important`` keeps, and the sets (grp, whole) with what is left of them (items).

    Sets that become equal are summed, so the rows are not read or drawn again.
    """
    every = drawn.sets.where("tree = 0").select("grp", "items", F.col("items").alias("whole"))
    left = _written(select_important(every, importances).select("grp", "whole", "items"), "left")
    side = left.withColumnsRenamed({"grp": "_grp", "items": "_items"})
    side = F.broadcast(side) if small_enough(left) else side
    sets = drawn.sets.join(side, (F.col("grp") == F.col("_grp")) & (F.col("items") == F.col("whole")))
    sums = sets.groupBy(*NODE, F.col("_items").alias("items")).agg(
        F.sum("w").alias("w"), F.sum("s").alias("s"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n")
    )
    return Drawn(_written(sums, "sets"), drawn.moments), left


def forest_on(drawn: Drawn, trees: int, hand_over: int = HAND_OVER) -> Forest:
    """``fit_forest`` on the first ``trees`` trees that rows were drawn for."""
    moments = drawn.moments
    grown = _grown(drawn.sets.where(F.col("tree") < trees).drop("n"), hand_over)

    values = grown.where("items is not null").groupBy("grp", "items").agg(F.avg("z").alias("z"))
    yhat = F.col("z") * F.coalesce("spread", F.lit(0.0)) + F.col("mean")
    predictions = join_lookup(values, moments, "grp").select("grp", "items", yhat.alias("yhat"))

    gains = grown.where("feature is not null").groupBy("grp", "tree", "feature").agg(F.sum("gain").alias("gain"))
    totals = gains.groupBy("grp", "tree").agg(F.sum("gain").alias("total")).where("total > 0")
    shares = gains.join(totals, ["grp", "tree"]).groupBy("grp", "feature").agg(F.sum(F.col("gain") / F.col("total")).alias("share"))
    split_trees = totals.groupBy("grp").agg(F.count(F.lit(1)).alias("n_trees"))
    shown = drawn.sets.where("tree = 0 and n > 0").select("grp", F.explode("items").alias("feature")).distinct()
    shares = join_lookup(shares, split_trees, "grp")
    importances = shown.join(shares, ["grp", "feature"], "left").select(
        "grp", "feature", F.coalesce(F.col("share") / F.col("n_trees"), F.lit(0.0)).alias("importance")
    )
    return Forest(predictions, _written(importances, "importances"))


def select_important(rows: DataFrame, importances: DataFrame) -> DataFrame:
    """``rows`` with the features at least as important as their group's average one.

    Items of a row are matched one by one, so any number of features may be kept.
    """
    average = importances.groupBy("grp").agg(F.avg("importance").alias("average"))
    kept = join_lookup(importances, average, "grp").where("importance >= average").select("grp", "feature")
    sets = rows.select("grp", "items").distinct()
    left = sets.select("grp", "items", F.explode("items").alias("feature")).join(kept, ["grp", "feature"])
    slim = left.groupBy("grp", "items").agg(F.sort_array(F.collect_set("feature")).alias("slim"))
    none = F.array().cast("array<string>")
    out = rows.join(slim, ["grp", "items"], "left").withColumn("items", F.coalesce("slim", none))
    return out.drop("slim")


def score_rows(rows: DataFrame, forest: Forest) -> DataFrame:
    """``rows`` with the ``yhat`` of their group and feature set."""
    return rows.join(forest.predictions, ["grp", "items"], "left")


def ranked(importances: DataFrame) -> DataFrame:
    """``importances`` with their rank within the group, ties by name."""
    order = Window.partitionBy("grp").orderBy(F.desc("importance"), "feature")
    return importances.withColumn("rank", F.row_number().over(order))
