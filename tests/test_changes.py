"""Runs of a growing export, and the binned density."""

import random

import pytest
from pyspark.sql import functions as F

from wagelens.operators import stats
from wagelens.sources import tables

SCHEMA = "id int, text string, value double"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_any_run_is_rebuilt_and_unchanged_rows_are_written_once(spark, tmp_path):
    path = str(tmp_path)
    first = [(1, "a", 1.0), (2, None, None), (2, None, None), (3, "", 0.5)]
    second = [(1, "a", 1.0), (2, None, None), (3, "x", 0.5), (4, "a", 1.0)]
    third = [(3, "", 0.5), (1, "a", 1.0), (1, "a", 1.0)]
    for run, rows in (("20240101_000000", first), ("20240102_000000", [(7, "z", 0.0), *first]), ("20240102_000000", second), ("20240102_000000", second), ("20240103_000000", third), ("20240104_000000", [])):
        tables.write_changes(spark.createDataFrame(rows, SCHEMA), path, run)
    for run, rows in (("20240101_000000", first), ("20240102_000000", second), ("20240103_000000", third), ("20240104_000000", [])):
        assert rows_of(tables.read_run(spark, path, run)) == sorted(rows, key=str)
    assert spark.read.parquet(f"{path}/rows").count() == 5  # of 11
    with pytest.raises(ValueError):
        tables.write_changes(spark.createDataFrame(first, SCHEMA), path, "20240102_000000")
    with pytest.raises(Exception):
        tables.read_run(spark, path, "20240109_000000").count()


@pytest.mark.parametrize("cells", [200, 4096])
def test_binned_density_is_within_its_bound(spark, cells):
    draw = random.Random(8)
    values = [(draw.choice([draw.gauss(0, 1), draw.gauss(9, 0.3), 20.0]),) for _ in range(3_000)] + [(None,)] * 10
    df = spark.createDataFrame(values, "x double").repartition(5)
    exact = {r.point: r for r in stats.density(df, "x").collect()}
    binned = stats.binned_density(df, "x", cells=cells).collect()
    assert len(binned) == len(exact) == 200
    for r in binned:
        assert abs(r.density - exact[r.point].density) <= r.error_bound + 1e-12 and abs(r.x - exact[r.point].x) < 1e-9
    assert binned[0].error_bound < (0.01 if cells == 200 else 1e-4)


def test_binned_density_of_little(spark):
    for values in ([], [(None,)], [(1.0,)], [(2.0,)] * 5):
        assert stats.binned_density(spark.createDataFrame(values, "x double"), "x").count() == 0
