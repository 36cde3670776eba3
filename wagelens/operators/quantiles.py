"""Exact quantiles that no single task has to hold.

``percentile`` keeps a value-to-count map per group in one task; a group with
a third of all rows would not fit.  Here the rows are first reduced to distinct
values with counts (combined before the shuffle, so a hot group or a hot value
costs nothing), then counted per narrow value cell, and only the few cells that
hold a wanted rank are ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELLS_PER_UNIT = 256  # cells are about 0.4 % wide, relative to the value


def value_cell(value: Column) -> Column:
    """A cell number that never decreases with the value; at most 363,000 cells."""
    return F.floor(F.signum(value) * F.log1p(F.abs(value)) * F.lit(CELLS_PER_UNIT)).cast("long")


def value_counts(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Distinct known values per group with their number of rows.

    NULLs and NaNs fall out after the counting, by their count of 0: a filter
    on the value itself would be pushed down and compute the value twice.
    """
    x = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    counts = df.groupBy(*by, x.alias("_v")).agg(F.count(x).alias("_n"))
    return counts.where(F.col("_n") > 0)


def exact_quantiles(
    df: DataFrame, value: str, probs: dict[str, float], by: list[str] | None = None
) -> DataFrame:
    """One row per group with each named quantile, linearly interpolated.

    Same numbers as a full sort of each group.  Groups without values give no
    row; without ``by`` an empty input gives one row of NULLs.
    """
    by = list(by or [])
    cells = value_counts(df, value, by).withColumn("_cell", value_cell(F.col("_v")))

    whole = Window.partitionBy(*by)
    up_to = whole.orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = (
        cells.groupBy(*by, "_cell")
        .agg(F.sum("_n").alias("_in"))
        .withColumn("_before", F.sum("_in").over(up_to) - F.col("_in"))
        .withColumn("_total", F.sum("_in").over(whole))
    )

    def position(p: float) -> Column:
        return F.lit(float(p)) * (F.col("_total") - 1)

    def holds(rank: Column, first: Column, count: Column) -> Column:
        return (rank >= first) & (rank < first + count)

    wanted = F.lit(False)
    for p in probs.values():
        for rank in (F.floor(position(p)), F.ceil(position(p))):
            wanted = wanted | holds(rank, F.col("_before"), F.col("_in"))
    keep = totals.where(wanted).select(
        *[F.col(c).alias(f"_g_{i}") for i, c in enumerate(by)],
        F.col("_cell").alias("_kept"), "_before", "_total",
    )

    # null-safe equality adds no filter on one side, so both sides read the same
    # shuffled counts and the input is scanned once
    same = F.col("_cell").eqNullSafe(F.col("_kept"))
    for i, c in enumerate(by):
        same = same & cells[c].eqNullSafe(F.col(f"_g_{i}"))
    inside = Window.partitionBy(*by, "_cell").orderBy("_v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    ranked = cells.join(keep, same, "inner").withColumn(
        "_first", F.col("_before") + F.sum("_n").over(inside) - F.col("_n")
    )

    picks = []
    for i, p in enumerate(probs.values()):
        for end, rank in (("lo", F.floor(position(p))), ("hi", F.ceil(position(p)))):
            here = holds(rank, F.col("_first"), F.col("_n"))
            picks.append(F.max(F.when(here, F.col("_v"))).alias(f"_{end}_{i}"))
    picked = ranked.groupBy(*by).agg(*picks, F.max("_total").alias("_total"))

    results = []
    for i, (name, p) in enumerate(probs.items()):
        share = position(p) - F.floor(position(p))
        low, high = F.col(f"_lo_{i}"), F.col(f"_hi_{i}")
        results.append((low + (high - low) * share).alias(name))
    return picked.select(*by, *results)


def median(df: DataFrame, value: str, by: list[str] | None = None, name: str = "median") -> DataFrame:
    return exact_quantiles(df, value, {name: 0.5}, by)


def quartiles(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    return exact_quantiles(df, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by)


def approximate_quantiles(
    df: DataFrame, value: str, probs: dict[str, float], by: list[str] | None = None,
    accuracy: int = 10000,
) -> DataFrame:
    """One-pass bounded sketch, where an explicit rank error of 1/accuracy will do."""
    aggs = [F.percentile_approx(value, p, accuracy).alias(n) for n, p in probs.items()]
    return df.groupBy(*(by or [])).agg(*aggs)
