"""Both runs from CSV files to result tables."""

from pyspark.sql import functions as F

from wagelens.checks import base
from wagelens.operators import models
from wagelens.plans import market

TINY = models.Settings(forest_trees=4, boost_rounds=4, selection_trees=4, forest_depth=3, folds=2)


def test_both_runs(spark, small, tmp_path):
    raw = base.postings(spark, small)
    folder = str(tmp_path / "csv")
    raw.select("title", "url", "agency", "location", "salary", "search_term", "description").coalesce(1).write.option(
        "header", True).option("escape", '"').csv(folder)
    run = market.analyse(spark, folder, str(tmp_path / "out"), TINY)
    clean = spark.read.parquet(run.clean_path)
    assert clean.count() == raw.select("url").distinct().count()
    assert run.best_model in ("random_forest", "gradient_boosting")
    metrics = spark.read.parquet(run.results["model_metrics"])
    assert metrics.count() == 3 * 2 * 3
    us = market.analyse_us(spark, run.clean_path, str(tmp_path / "out"), TINY)
    table = spark.read.parquet(us.clean_path)
    assert table.where("annual_salary IS NULL").count() == 0
    assert {r[0] for r in table.select("salary_origin").distinct().collect()} == {"observed", "imputed"}
    assert spark.read.parquet(us.results["us_skill_correlation"]).count() > 0


def test_no_salary_at_all_skips_the_models(spark, small, tmp_path):
    folder = str(tmp_path / "csv")
    base.postings(spark, small).select("title", "location").coalesce(1).write.option("header", True).csv(folder)
    run = market.analyse(spark, folder, str(tmp_path / "out"), TINY)
    assert run.best_model is None and "model_metrics" not in run.results
    filled = market.analyse(spark, folder, str(tmp_path / "out2"), TINY, synthesise=True)
    table = spark.read.parquet(filled.clean_path)
    assert table.where(F.col("salary_origin") != "synthetic").count() == 0 and filled.best_model is None
