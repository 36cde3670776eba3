"""Exact quantiles against numpy, with hot groups, hot values and holes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wagelens.operators import impute, quantiles, stats


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    out = [("hot", 50000.0)] * 3000  # one value holds a third of all rows
    out += [("hot", float(v)) for v in np.round(rng.lognormal(11, 0.6, 3000), 2)]
    out += [(f"g{i % 40}", float(v)) for i, v in enumerate(rng.normal(0, 1e-3, 3000))]
    out += [(None, float(v)) for v in range(11)] + [("empty", None)] * 5 + [("one", -7.25), ("big", 1e300)]
    out += [("hot", None)] * 50 + [("hot", float("nan"))] * 20
    return out


def expected(rows, p, group):
    known = [v for g, v in rows if v is not None and v == v and (group == "all" or g == group)]
    return float(np.quantile(known, p)) if known else None


@pytest.mark.parametrize("parts", [1, 17])
def test_by_group(spark, rows, parts):
    df = spark.createDataFrame(rows, "g string, v double").repartition(parts)
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    got = {r["g"]: r for r in quantiles.exact_quantiles(df, "v", probs, ["g"]).collect()}
    assert set(got) == {g for g, v in rows if v is not None}
    for g, r in got.items():
        for name, p in probs.items():
            assert r[name] == pytest.approx(expected(rows, p, g), rel=1e-12, abs=1e-15)


def test_overall_and_empty(spark, rows):
    df = spark.createDataFrame(rows, "g string, v double")
    r = quantiles.exact_quantiles(df, "v", {"m": 0.5, "q": 0.03}).first()
    assert r["m"] == pytest.approx(expected(rows, 0.5, "all"))
    assert r["q"] == pytest.approx(expected(rows, 0.03, "all"))
    assert quantiles.median(df.where("g = 'empty'"), "v").first()["median"] is None


def test_group_fill_leaves_groups_without_values_to_the_overall_median(spark):
    data = [("a", 1.0), ("a", 3.0), ("a", None), ("b", None), ("c", 10.0)]
    df = spark.createDataFrame(data, "standardized_title string, annual_salary double").withColumn(
        "salary_origin", F.when(F.col("annual_salary").isNotNull(), "observed")
    )
    filled = impute.fill_overall_median(impute.fill_group_median(df))
    got = sorted((r[0], r[1], r[2]) for r in filled.select("standardized_title", "annual_salary", "salary_origin").collect())
    # the overall median is taken after the group fill: of 1, 2, 3, 10
    assert got == [("a", 1.0, "observed"), ("a", 2.0, "imputed"), ("a", 3.0, "observed"), ("b", 2.5, "imputed"), ("c", 10.0, "observed")]


def test_cap_and_outliers(spark):
    values = [10.0, 11.0, 12.0, 13.0, 14.0, 1000.0, -500.0, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    q1, q3 = np.quantile(values[:-1], [0.25, 0.75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    got = sorted(r["v"] for r in stats.cap(df, "v").collect() if r["v"] is not None)
    assert got == pytest.approx(sorted(min(max(v, low), high) for v in values[:-1]))
    assert stats.count_outliers(df, "v").first()["n_outliers"] == 2
    assert stats.cap(df, "v").where("v IS NULL").count() == 1


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(5.0,)] * 4, "v double")
    rows = stats.histogram(df, "v", 30).orderBy("bin").collect()
    assert len(rows) == 30 and sum(r["n"] for r in rows) == 4
    assert rows[0]["bin_low"] == 4.5 and rows[-1]["bin_high"] == pytest.approx(5.5)


def test_correlation_of_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, 4.0, 3.0), (3.0, None, 3.0)], "a double, b double, c double")
    got = {(r["x"], r["y"]): r["corr"] for r in stats.correlation(df, ["a", "b", "c"]).collect()}
    assert got[("a", "b")] == pytest.approx(1.0) and got[("a", "c")] is None and got[("c", "c")] is None
