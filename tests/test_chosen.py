"""The model is chosen by fits as large, and on the same features, as those that are scored."""

import zlib
from dataclasses import replace

import pytest

from wagelens.checks import catalog, modelling
from wagelens.operators import models


@pytest.fixture
def fresh(monkeypatch):
    """No fit of another test is used, none of these is kept."""
    monkeypatch.setattr(modelling, "_FITS", {})


@pytest.fixture
def fitted_with(monkeypatch):
    """(name, settings) of every fit, which is then made with few trees and rounds."""
    seen = []
    forest, boosting = models.forest_on_sets, models.boosting_on_sets

    def small_forest(drawn, merged, skill_list, settings, name="random_forest"):
        seen.append((name, settings))
        return forest(drawn, merged, skill_list, replace(settings, forest_trees=1, selection_trees=1, forest_depth=2), name)

    def small_boosting(merged, skill_list, settings, name="gradient_boosting"):
        seen.append((name, settings))
        return boosting(merged, skill_list, replace(settings, boost_rounds=2), name)

    monkeypatch.setattr(models, "forest_on_sets", small_forest)
    monkeypatch.setattr(models, "boosting_on_sets", small_boosting)
    return seen


def test_folds_are_fitted_as_the_scored_models(spark, small, fresh, fitted_with):
    best = {(r["model"], r["metric"]): r["value"] for r in catalog.queries()["M9_best_model"](spark, small).collect()}
    n = models.MARKET.folds + 1  # those of the folds, and the one that is scored
    assert sorted(name for name, _ in fitted_with) == ["gradient_boosting"] * n + ["random_forest"] * n
    assert {settings for _, settings in fitted_with} == {models.MARKET}
    choice = modelling.chosen(spark, small)
    assert {m for m, _ in best} == {choice} and len(best) == 3
    block = {(r["model"], r["metric"]): r["value"] for r in catalog.queries()["R4_best_model_block"](spark, small).collect()}
    assert {m for m, _ in block} == {choice, "group_mean"} and len(block) == 6
    assert {k: v for k, v in block.items() if k[0] == choice} == pytest.approx(best)
    assert len(fitted_with) == 2 * n


def test_choice_sees_all_features_of_the_scored_models(spark, fresh, monkeypatch):
    # the company alone decides the salary and a forest tells all of them apart; without it there is only noise, which flat boosted trees learn less of
    drawn = lambda name, i, kinds: zlib.crc32(f"{name}:{i}".encode()) % kinds
    data = [
        (i, f"u{i}", "data scientist", f"p{drawn('p', i, 60)}", f"c{i % 9}", ["go"] if drawn("s", i, 2) else ["sql"], 50_000.0 + 20_000 * (i % 9 * 4 % 9), "observed", i, "matched")
        for i in range(900)
    ]
    df = spark.createDataFrame(
        data, "posting_id long, url string, standardized_title string, standardized_location string, company string, "
              "skills array<string>, annual_salary double, salary_origin string, seq long, skill_origin string"
    )
    monkeypatch.setattr(modelling, "modelled", lambda *_: df)
    monkeypatch.setattr(models, "MARKET", replace(models.MARKET, forest_trees=10, boost_rounds=10))
    assert modelling.chosen(spark, "by_company") == "random_forest"
    scores = [(m, "test", f"u{i}", 1.0 * i, i + 1.0) for m in ("random_forest", "gradient_boosting", "group_mean") for i in range(4)]
    scored = spark.createDataFrame(scores, "model string, split string, model_key string, y double, yhat double")
    monkeypatch.setattr(modelling, "all_scores", lambda *_: scored)
    shown = lambda name: {r["model"] for r in catalog.queries()[name](spark, "by_company").collect()}
    assert shown("M9_best_model") == {"random_forest"}
    assert shown("R4_best_model_block") == {"random_forest", "group_mean"}
