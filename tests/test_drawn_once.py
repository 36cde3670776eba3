"""Forests after a selection of features draw the rows once and grow as from rows with the features left."""

import pytest
from pyspark.sql import functions as F

from wagelens.operators import models, trees

SOME = models.Settings(forest_trees=6, selection_trees=3)


def test_selection_draws_rows_once_and_fits_alike(spark, monkeypatch):
    data = [
        (f"k{i}", "test" if i % 7 == 0 else "train", f"t{i % 5}", f"p{i % 3}", ["go"] * (i % 2) + ["sql"] * (i % 4 == 0) + ["unseen"] * (i == 7), float(i * i % 41 + 50 * (i % 5)))
        for i in range(300)
    ]
    df = spark.createDataFrame(data, "model_key string, split string, standardized_title string, standardized_location string, skills array<string>, y double")
    prepared = models.item_rows(df, models.categories_of(SOME))
    scout = trees.fit_forest(prepared, SOME.selection_trees, seed=42)
    slim = trees.select_important(prepared, scout.importances)
    plain = trees.fit_forest(slim, SOME.forest_trees, seed=42)
    want = {r.model_key: r.yhat for r in trees.score_rows(slim, plain).collect()}
    draws, draw = [], trees.tree_sums
    monkeypatch.setattr(trees, "tree_sums", lambda *a: draws.append(1) or draw(*a))
    rows, importances = models.fit_deep_forest(df, SOME)
    got = {r.model_key: r.yhat for r in rows.collect()}
    assert len(draws) == 1 and len(got) == 300 and got == pytest.approx(want)
    assert {r.feature: r.importance for r in importances.collect()} == pytest.approx({r.feature: r.importance for r in plain.importances.collect()})


def test_draws_of_tasks_are_those_of_columns(spark):
    df = spark.range(5000).select(F.xxhash64("id").alias("h"), trees._draws(F.col("id"), F.lit(3), 42).alias("w")).toPandas()
    assert (trees.draws_of(df["h"].to_numpy().view("uint64"), 3, 42) == df["w"].to_numpy()).all()
