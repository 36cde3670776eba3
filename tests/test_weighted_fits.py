"""Fits read postings a bounded number of times: feature steps and folds come from summed feature sets."""

import pytest
from pyspark.sql import functions as F

from wagelens.checks import base
from wagelens.operators import models, skills

TINY = models.Settings(forest_trees=4, boost_rounds=3, selection_trees=4, forest_depth=3, folds=3)


@pytest.fixture(scope="module")
def train(spark, small):
    return models.training_rows(base.skilled(spark, small), "url", TINY).where("split = 'train'").persist()


@pytest.fixture(scope="module")
def skill_list(spark, small):
    return skills.observed_list(base.skilled(spark, small))


def test_steps_learnt_from_sets_are_those_of_rows(train, skill_list):
    cats, numeric = models.categories_of(TINY), [skills.indicator_name(s) for s in skill_list]
    wide = skills.with_indicators(train, skill_list)
    merged = skills.with_indicators(models.merge_equal_rows(train, cats), skill_list)
    of_rows, of_sets = models.fit_features(wide, cats, numeric), models.fit_features(merged, cats, numeric, "weight")
    names = [models.feature_names(s.transform(wide.limit(1))) for s in (of_rows, of_sets)]
    assert names[0] == names[1] and len(names[0]) == len(set(names[0]))
    for a, b in zip(*([r["features"].toArray() for r in s.transform(merged).orderBy(*cats, "skills").collect()] for s in (of_rows, of_sets))):
        assert a == pytest.approx(b)


def test_moments_of_sets_skip_nulls_and_know_constants(spark):
    data = [(1.0, 0.1, 3.0), (None, 0.1, 5.0), (4.0, 0.1, 1.0)]
    df = spark.createDataFrame(data, "x double, flat double, w double")
    long = df.select("x", "flat", F.explode(F.sequence(F.lit(1), F.col("w").cast("int"))))
    (mean, spread), (flat, none) = models._weighted_moments(df, ["x", "flat"], "w")
    assert (mean, spread) == pytest.approx(models._moments(long, ["x"])[0])
    assert flat == pytest.approx(0.1) and none == 0.0


def test_folds_are_summed_once_and_fitted_on_sets(train, skill_list, monkeypatch):
    rows_read, sizes = [], []
    draw, fit = models.trees.tree_sums, models.fit_features
    monkeypatch.setattr(models.trees, "tree_sums", lambda *a: rows_read.append(1) or draw(*a))
    monkeypatch.setattr(models, "fit_features", lambda df, *a: sizes.append(df.count()) or fit(df, *a))
    again = train.unionByName(train).unionByName(train)
    held = models.fold_scores(again, skill_list, TINY)
    assert held.groupBy("model").count().where(F.col("count") != again.count()).count() == 0
    assert held.where("yhat is null").count() == 0
    n_sets = train.select(*models.categories_of(TINY), "skills").distinct().count()
    assert len(rows_read) == 1 and len(sizes) == 2 * TINY.folds and max(sizes) <= n_sets


def test_held_out_boosting_is_the_fit_on_the_other_folds(train, skill_list):
    cats = [*models.categories_of(TINY), "skills"]
    held = models.fold_scores(train, skill_list, TINY).where("model = 'gradient_boosting'")
    total = 0.0
    for fold in range(TINY.folds):
        fitted = models.fit_boosting(train.where(F.col("fold") != fold), skill_list, TINY)
        total += fitted.predict(train.where(F.col("fold") == fold).select(*cats)).agg(F.sum("yhat")).first()[0]
    assert held.agg(F.sum("yhat")).first()[0] == pytest.approx(total)
