"""Counts, means, spreads, histograms and correlations of postings.

One-row results (bounds, fences) enter later steps as scalar subqueries, never
through a join or the driver.
"""

from __future__ import annotations

import math

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagelens import rules
from wagelens.functions.text import text_array
from wagelens.operators.quantiles import exact_quantiles, quartiles

MONEY = "decimal(18,4)"


def exact_sum(value: Column) -> Column:
    """Sum of money as a decimal, so the order of rows cannot change the result."""
    return F.sum(value.cast(MONEY)).cast("double")


def exact_mean(value: Column) -> Column:
    return F.try_divide(exact_sum(value), F.count(value))


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def count_distinct(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct non-null values per column, in long form.

    Each column is reduced to its distinct values on its own, so a frequent
    value is combined before the shuffle.
    """
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in columns])
    )
    values = df.select(pairs.alias("p")).select("p.*").where(F.col("v").isNotNull()).distinct()
    return values.groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))


def count_present(df: DataFrame, column: str, by: str | None = None) -> DataFrame:
    keys = [by] if by else []
    return df.groupBy(*keys).agg(F.count(column).alias("n_present"))


def frequency(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The k most frequent values; ties by value.

    NULLs fall out by their count of 0: a filter on a computed column would be
    pushed down and compute the column twice.  The same holds below.
    """
    counts = df.groupBy(column).agg(F.count(column).alias("n")).where(F.col("n") > 0)
    return counts.orderBy(F.desc("n"), column).limit(k)


def describe(df: DataFrame, value: str) -> DataFrame:
    """Count, mean, spread, extremes and quartiles as (statistic, value) rows."""
    x = F.col(value)
    base = df.agg(
        F.count(x).cast("double").alias("count"), exact_mean(x).alias("mean"),
        F.stddev_samp(x).alias("std"), F.min(x).cast("double").alias("min"),
        F.max(x).cast("double").alias("max"),
    )
    quarters = exact_quantiles(df, value, {"25%": 0.25, "50%": 0.5, "75%": 0.75})
    return _long(base).unionByName(_long(quarters))


def _long(df: DataFrame) -> DataFrame:
    rows = [F.struct(F.lit(c).alias("statistic"), F.col(f"`{c}`").alias("value")) for c in df.columns]
    return df.select(F.inline(F.array(*rows)))


def group_mean(df: DataFrame, by: str, value: str = "annual_salary") -> DataFrame:
    known = F.count(F.when(F.col(by).isNotNull(), F.col(value)))
    means = df.groupBy(by).agg(exact_mean(F.col(value)).alias("mean_value"), known.alias("n"))
    return means.where(F.col("n") > 0)


def top_by_mean(df: DataFrame, by: str, value: str = "annual_salary", k: int = 5) -> DataFrame:
    """The k groups with the highest mean, numbered from 1."""
    head = group_mean(df, by, value).orderBy(F.desc("mean_value"), by).limit(k)
    order = Window.orderBy(F.desc("mean_value"), by)  # over at most k rows
    return head.select(F.row_number().over(order).alias("rank"), by, "mean_value")


def value_range(df: DataFrame, value: str) -> DataFrame:
    return df.agg(F.min(value).alias("low"), F.max(value).alias("high"))


# ---- outliers ------------------------------------------------------------

def fences(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """Quartiles and the 1.5 IQR bounds around them."""
    q = quartiles(df, value, by)
    reach = F.lit(rules.WHISKER) * (F.col("q3") - F.col("q1"))
    return q.withColumns({"lower": F.col("q1") - reach, "upper": F.col("q3") + reach})


def _bounds(fence: DataFrame) -> tuple[Column, Column]:
    pair = fence.select(F.struct("lower", "upper")).scalar()
    return pair["lower"], pair["upper"]


def outliers(df: DataFrame, value: str, fence: DataFrame | None = None) -> DataFrame:
    """Rows outside the bounds; fitted on the same rows unless given."""
    lower, upper = _bounds(fences(df, value) if fence is None else fence)
    return df.where((F.col(value) < lower) | (F.col(value) > upper))


def count_outliers(df: DataFrame, value: str, fence: DataFrame | None = None) -> DataFrame:
    return outliers(df, value, fence).agg(F.count(F.lit(1)).alias("n_outliers"))


def cap(df: DataFrame, value: str, fence: DataFrame | None = None) -> DataFrame:
    """Values outside the bounds move to the bound; NULL stays NULL."""
    lower, upper = _bounds(fences(df, value) if fence is None else fence)
    x = F.col(value)
    return df.withColumn(value, F.when(x < lower, lower).when(x > upper, upper).otherwise(x))


# ---- top groups, boxes ---------------------------------------------------

def top_group_rows(df: DataFrame, by: str, k: int = 10, counted: str | None = None) -> DataFrame:
    """Rows of the k most frequent groups; the k keys are broadcast (k is fixed).

    ``counted`` ranks the groups by their known values of another column.
    """
    counts = df.groupBy(by).agg(F.count(counted or by).alias("_n")).where(F.col("_n") > 0)
    keys = counts.orderBy(F.desc("_n"), by).limit(k).select(by)
    return df.join(F.broadcast(keys), by, "left_semi")


def box_stats(df: DataFrame, by: str, value: str = "annual_salary", k: int = 10) -> DataFrame:
    """Quartiles, whiskers within 1.5 IQR and flier count of the k largest groups."""
    rows = top_group_rows(df.select(by, value), by, k, counted=value)
    fence = fences(rows, value, [by])  # k rows
    x = F.col(value)
    inside = (x >= F.col("lower")) & (x <= F.col("upper"))
    return (
        rows.join(F.broadcast(fence), by)
        .groupBy(by, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, x)).alias("whisker_low"),
            F.max(F.when(inside, x)).alias("whisker_high"),
            F.count_if(~inside).alias("n_fliers"),
            F.count(x).alias("n"),
        )
    )


# ---- distribution --------------------------------------------------------

def histogram(df: DataFrame, value: str, bins: int = rules.HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins over min..max, empty bins included.

    A column with one distinct value gets bins half a unit to either side.
    """
    known = df.select(F.col(value).cast("double").alias("x"))
    span = known.agg(F.min("x").alias("a"), F.max("x").alias("b"))
    half = F.when(F.col("a") == F.col("b"), F.lit(0.5)).otherwise(F.lit(0.0))
    edge = span.select(F.struct((F.col("a") - half).alias("a"), (F.col("b") + half).alias("b"))).scalar()
    width = edge["b"] - edge["a"]
    slot = F.floor(F.lit(float(bins)) * (F.col("x") - edge["a"]) / width) + 1
    counts = (
        known.select("x", F.least(slot, F.lit(bins)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count("x").alias("n"))
        .where(F.col("n") > 0)
    )
    frame = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return frame.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (edge["a"] + width * (F.col("bin") - 1) / F.lit(float(bins))).alias("bin_low"),
        (edge["a"] + width * F.col("bin") / F.lit(float(bins))).alias("bin_high"),
        F.coalesce("n", F.lit(0).cast("long")).alias("n"),
    )


def density(
    df: DataFrame, value: str, points: int = rules.DENSITY_POINTS, bins: int = rules.HISTOGRAM_BINS
) -> DataFrame:
    """Gaussian kernel density over a grid from min to max, Scott bandwidth.

    ``n_scaled`` is the curve on the count axis of the histogram.  Equal values
    are merged first; each distinct value then adds to every grid point, and
    the sums are combined before the shuffle to one row per point.
    """
    x = F.col(value).cast("double")
    merged = df.groupBy(x.alias("x")).agg(F.count(x).alias("w")).where(F.col("w") > 0)
    base = df.agg(
        F.count(value).cast("double").alias("n"), F.stddev_samp(value).alias("sd"),
        F.min(value).cast("double").alias("a"), F.max(value).cast("double").alias("b"),
    )
    base = base.withColumn("h", F.col("sd") * F.pow("n", F.lit(-0.2)))
    p = base.select(F.struct("n", "h", "a", "b")).scalar()
    step = (p["b"] - p["a"]) / F.lit(float(points - 1))
    grid = F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
    at = p["a"] + step * F.col("point")
    z = (at - F.col("x")) / p["h"]
    sums = (
        merged.select("x", "w", grid.alias("point"))
        .withColumn("k", F.col("w") * F.exp(F.lit(-0.5) * z * z))
        .groupBy("point")
        .agg(F.sum("k").alias("k"))
    )
    dens = F.try_divide(F.col("k"), p["n"] * p["h"] * F.sqrt(F.lit(2.0) * F.pi()))
    return sums.select(
        "point", at.alias("x"), dens.alias("density"),
        (dens * p["n"] * (p["b"] - p["a"]) / F.lit(float(bins))).alias("n_scaled"),
    )


#: half the largest second derivative of the normal curve, over 4: linear interpolation is off by this times (cell / bandwidth)^2 at most
_INTERPOLATION = 1 / (8 * math.sqrt(2 * math.pi))


def binned_density(
    df: DataFrame, value: str, points: int = rules.DENSITY_POINTS, bins: int = rules.HISTOGRAM_BINS, cells: int = 4096
) -> DataFrame:
    """``density`` from sums per cell: the same columns and ``error_bound``.

    Each value is shared between the two ends of its cell, in proportion to its place in
    it, so the curve at a point is interpolated within cells and off by ``error_bound`` at
    most, on the scale of ``density``.  The cost of the curve depends on ``points`` and
    ``cells`` alone; a task sends two sums a cell.  Rows without a value count nowhere; a
    column of one distinct value, or of one row, has no bandwidth and gives no rows.
    """
    x = F.col(value).cast("double")
    base = df.agg(
        F.count(value).cast("double").alias("n"), F.stddev_samp(x).alias("sd"), F.min(x).alias("a"), F.max(x).alias("b")
    ).withColumn("h", F.col("sd") * F.pow("n", F.lit(-0.2)))
    p = base.select(F.struct("n", "h", "a", "b", ((F.col("b") - F.col("a")) / F.lit(float(cells))).alias("d"))).scalar()
    place = df.where(x.isNotNull()).select(F.try_divide(x - p["a"], p["d"]).alias("t")).where("t IS NOT NULL")
    cell = F.least(F.floor("t"), F.lit(cells - 1).cast("long"))
    sums = place.select(cell.alias("cell"), (F.col("t") - cell).alias("right")).groupBy("cell").agg(
        F.count(F.lit(1)).cast("double").alias("w"), F.sum("right").alias("right")
    )
    ends = sums.select(F.explode(F.array(
        F.struct(F.col("cell").alias("at"), (F.col("w") - F.col("right")).alias("w")),
        F.struct((F.col("cell") + 1).alias("at"), F.col("right").alias("w")),
    )).alias("e")).select("e.*")
    grid = F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
    at = p["a"] + (p["b"] - p["a"]) / F.lit(float(points - 1)) * F.col("point")
    z = (at - (p["a"] + p["d"] * F.col("at"))) / p["h"]
    curve = ends.select("at", "w", grid.alias("point")).groupBy("point").agg(F.sum(F.col("w") * F.exp(F.lit(-0.5) * z * z)).alias("k"))
    dens = F.try_divide(F.col("k"), p["n"] * p["h"] * F.sqrt(F.lit(2.0) * F.pi()))
    return curve.select(
        "point", at.alias("x"), dens.alias("density"), (dens * p["n"] * (p["b"] - p["a"]) / F.lit(float(bins))).alias("n_scaled"),
        (F.lit(_INTERPOLATION) * p["d"] * p["d"] / (p["h"] * p["h"] * p["h"])).alias("error_bound"),
    )


# ---- correlation ---------------------------------------------------------

def correlation(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of all column pairs as (x, y, corr) rows.

    One aggregation for all pairs, over rows where both columns are known.  A
    constant column gives NULL.  For up to some 30 columns; indicator columns
    have ``skill_correlation``.
    """
    aggs, rows = [], []
    for i, (a, b) in enumerate(itertools.combinations_with_replacement(columns, 2)):
        x = F.when(F.col(b).isNotNull(), F.col(a).cast("double"))
        y = F.when(F.col(a).isNotNull(), F.col(b).cast("double"))
        aggs += [
            F.covar_pop(x, y).alias(f"c{i}"), F.stddev_pop(x).alias(f"s{i}"), F.stddev_pop(y).alias(f"t{i}"),
        ]
        r = F.try_divide(F.col(f"c{i}"), F.col(f"s{i}") * F.col(f"t{i}"))
        rows.append((a, b, r))
        if a != b:
            rows.append((b, a, r))
    items = [F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), r.alias("corr")) for a, b, r in rows]
    return df.agg(*aggs).select(F.inline(F.array(*items)))


def skill_correlation(
    df: DataFrame, skills: list[str], value: str = "annual_salary", list_column: str = "skills"
) -> DataFrame:
    """Correlation of skill indicators with each other and with a number.

    A posting adds one row per skill it names, holding its full indicator
    vector; the vectors are summed per skill before the shuffle, so what moves
    is one vector per skill and task, whatever the row count.  With 0/1
    columns these sums give every coefficient.  Only observed skills appear; one
    that every posting names gives NULL.
    """
    from pyspark.ml.feature import CountVectorizerModel
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.stat import Summarizer

    y = F.col("_y")
    base = df.select(F.col(list_column).alias("_skills"), F.col(value).cast("double").alias("_y"))
    coder = CountVectorizerModel.from_vocabulary(
        skills, inputCol="_skills", outputCol="_vec"
    ).setBinary(True)
    per_skill = (
        coder.transform(base)
        .select(F.explode(F.array_distinct("_skills")).alias("x"), "_vec", "_y")
        .groupBy("x")
        .agg(
            Summarizer.sum(F.col("_vec")).alias("together"),
            F.count(F.lit(1)).cast("double").alias("nx"),
            F.count(y).cast("double").alias("nxy"),
            F.coalesce(exact_sum(y), F.lit(0.0)).alias("sxy"),
        )
        .where(F.col("x").isin(skills))
    )
    total = df.agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.count(value).cast("double").alias("ny"),
        exact_mean(F.col(value)).alias("mean"), F.stddev_pop(value).alias("sd"),
    ).select(F.struct("n", "ny", "mean", "sd")).scalar()

    # at most one row per vocabulary word is gathered here
    gathered = per_skill.agg(
        F.collect_list(F.struct("x", "nx", "nxy", "sxy", vector_to_array("together").alias("together"))).alias("rows"),
        F.map_from_entries(F.collect_list(F.struct("x", "nx"))).alias("counts"),
    )
    each = gathered.select("counts", F.inline("rows")).withColumn("whole", total)
    n, ny, mean, sd = (F.col(f"whole.{c}") for c in ("n", "ny", "mean", "sd"))

    def pair(y: Column, i: Column) -> Column:
        both = F.get(F.col("together"), i) / n
        px, py = F.col("nx") / n, F.try_element_at(F.col("counts"), y) / n
        corr = F.try_divide(both - px * py, F.sqrt(px * (1 - px) * py * (1 - py)))
        return F.struct(y.alias("y"), corr.alias("corr"))

    named = F.transform(text_array(skills), pair)
    observed = F.filter(named, lambda p: F.map_contains_key(F.col("counts"), p["y"]))
    share = F.col("nxy") / ny
    with_value = F.try_divide(F.col("sxy") / ny - share * mean, F.sqrt(share * (1 - share)) * sd)
    last = F.array(F.struct(F.lit(value).alias("y"), with_value.alias("corr")))
    return each.select("x", F.inline(F.concat(observed, last)))


# ---- role by skill matrices ----------------------------------------------

def top_skills_by_total(df: DataFrame, item: str, weight: str, k: int = 20) -> DataFrame:
    """The k items with the highest total; ties by name."""
    totals = df.groupBy(item).agg(F.round(F.sum(weight), 6).alias("total"))
    return totals.orderBy(F.desc("total"), item).limit(k)


def matrix(df: DataFrame, row: str, item: str, weight: str, items: list[str]) -> DataFrame:
    """Rows by items, 0 where absent; ``items`` bounds the width of the pivot."""
    wide = df.where(F.col(item).isin(items)).groupBy(row).pivot(item, items).agg(F.sum(weight))
    return wide.na.fill(0.0)


# ---- roles ---------------------------------------------------------------

def roles_by_appearance(df: DataFrame, role: str, seq: str, k: int | None = None) -> DataFrame:
    """Distinct roles in order of their first row, optionally the first k."""
    firsts = df.groupBy(role).agg(F.min(seq).alias("first_seq")).orderBy("first_seq", role)
    return firsts if k is None else firsts.limit(k)


def roles_with_enough(df: DataFrame, role: str, value: str, least: int = rules.MIN_ROLE_ROWS) -> DataFrame:
    """Roles with at least this many known values."""
    counts = df.groupBy(role).agg(F.count(value).alias("n_known"))
    return counts.where(F.col("n_known") >= least)
