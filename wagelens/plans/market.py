"""From raw postings to cleaned table, models and report.

Two runs: ``analyse`` works on all postings, ``analyse_us`` on the cleaned
table, for US postings with filled and capped salaries.  Steps are written as
tables in between, so that text is parsed once and a lost executor costs a
re-read, not a re-run.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagelens import rules
from wagelens.operators import clean, dedup, impute, models, regress, sampling, skills, stats
from wagelens.plans import report
from wagelens.sources import csv_folder, tables


@dataclass
class Run:
    """Where the tables of a run were written."""

    clean_path: str
    results: dict[str, str] = field(default_factory=dict)
    best_model: str | None = None


def prepare(
    df: DataFrame, reference_mode: bool = False, synthesise: bool = False, seq: str | None = None
) -> DataFrame:
    """Cleaned postings with skills, from raw ones.

    ``synthesise`` allows stand-in salaries where (nearly) all are missing;
    such rows are marked and never scored.
    """
    df = clean.with_missing_columns(df, ["title", "url", "company", "location", "salary", "description"])
    df = clean.normalise_missing(df)
    if synthesise:
        df = impute.fill_salary_text(df)
    df = skills.with_skills(clean.clean_postings(df, reference_mode))
    if synthesise:
        df = impute.fill_title_mean(df, seq or "url")
    return df


def model_tables(
    df: DataFrame, settings: models.Settings, work_dir: str, key: str = "url"
) -> tuple[str, dict[str, DataFrame]]:
    """Fit, choose on held-out folds, score the test rows once, explain.

    Training rows and predictions are written tables, so each model runs over
    the rows once however many results are made from it.
    """
    spark = df.sparkSession
    rows_path = tables.write_table(models.training_rows(df, key, settings), f"{work_dir}/training_rows")
    rows = spark.read.parquet(rows_path)
    skill_list = skills.observed_list(df)
    held = tables.write_table(models.fold_scores(rows, skill_list, settings), f"{work_dir}/held_out")
    choice = models.better_model(regress.regression_metrics(spark.read.parquet(held)), "held_out")
    fitted = {m.name: m for m in models.fit_both(rows.where("split = 'train'"), skill_list, settings)}
    scores = models.baseline_scores(rows)
    for m in fitted.values():
        scores = scores.unionByName(models.scored(m, rows))
    scores = spark.read.parquet(tables.write_table(scores, f"{work_dir}/predictions"))
    best = scores.where((F.col("model") == choice) & (F.col("split") == "test"))
    weights = models.importance_table(spark, fitted[choice])
    return choice, {
        "model_metrics": regress.regression_metrics(scores),
        "feature_importance": weights,
        "top_features": report.bars(weights, report.FEATURES_IN_BARS),
        "predicted_against_actual": sampling.random_rows(best, "model_key", report.SAMPLE, settings.seed),
        "residuals": regress.residuals(best).select("model_key", "yhat", "residual"),
    }


def analyse(
    spark: SparkSession, data_dir: str | None, output_dir: str, settings: models.Settings = models.MARKET,
    reference_mode: bool = False, synthesise: bool = False,
) -> Run:
    """All postings: load, deduplicate, clean, report, model, explain."""
    root = output_dir.rstrip("/")
    loaded = csv_folder.load_folder(spark, data_dir)
    raw = loaded.rows.withColumn("seq", F.monotonically_increasing_id())
    raw_path = tables.write_table(raw, f"{root}/raw")
    tables.write_table(loaded.load_errors, f"{root}/load_errors")
    stored = spark.read.parquet(raw_path)
    stored = clean.with_missing_columns(stored, ["url", "company"])
    unique = dedup.across_sources(stored, "source_file", "seq")
    path = tables.write_table(prepare(unique, reference_mode, synthesise, "seq"), f"{root}/clean", source=raw_path)
    df = spark.read.parquet(path)
    df = df.withColumn("model_key", F.coalesce("url", F.col("seq").cast("string")))

    run = Run(path)
    results = report.report_tables(df) | report.chart_tables(df)
    enough = df.where(F.col("salary_origin") == "observed").limit(rules.MIN_ROLE_ROWS).count() >= rules.MIN_ROLE_ROWS
    if enough:
        run.best_model, tables_of_models = model_tables(df, settings, root, "model_key")
        by_role = models.skill_importance_by_role(df, "model_key", "seq", settings)
        results |= tables_of_models
        results["skill_importance_by_role"] = by_role
        results["skill_importance_matrix"] = report.importance_heatmap(by_role)
    run.results = tables.write_results(results, f"{root}/results")
    return run


def us_table(df: DataFrame, fit_on_train: bool = True, key: str = "url") -> DataFrame:
    """US postings with filled and capped salaries.

    Medians and bounds come from the train rows, and observed test salaries
    are left as they are; ``fit_on_train=False`` uses and changes all rows.
    """
    us = regress.with_split(clean.us_only(df), key)
    fit = us.where("split = 'train'") if fit_on_train else us
    filled = impute.fill_group_median(us, fit_on=fit)
    filled = impute.fill_overall_median(filled, fit_on=fit)
    filled = impute.fill_indicators(filled, clean.columns_with_prefix(filled))
    fence = stats.fences(fit, "annual_salary")
    if not fit_on_train:
        return stats.cap(filled, "annual_salary", fence)
    untouched = (F.col("split") == "test") & (F.col("salary_origin") == "observed")
    original = filled.withColumn("_observed", F.col("annual_salary"))
    capped = stats.cap(original, "annual_salary", fence)
    kept = F.when(untouched, F.col("_observed")).otherwise(F.col("annual_salary"))
    return capped.withColumn("annual_salary", kept).drop("_observed")


def analyse_us(
    spark: SparkSession, clean_path: str, output_dir: str, settings: models.Settings = models.US_MARKET
) -> Run:
    """US postings of a cleaned table: fill, cap, model, report."""
    root = output_dir.rstrip("/")
    df = spark.read.parquet(clean_path)
    df = df.withColumn("model_key", F.coalesce("url", F.col("seq").cast("string")))
    path = tables.write_table(us_table(df, key="model_key"), f"{root}/us_clean", source=clean_path)
    us = spark.read.parquet(path)
    run = Run(path)
    results = {f"us_{k}": v for k, v in (report.report_tables(us) | report.chart_tables(us)).items()}
    results["us_skill_correlation"] = stats.skill_correlation(us, skills.observed_list(us))
    run.best_model, tables_of_models = model_tables(us, settings, f"{root}/us", "model_key")
    results |= {f"us_{k}": v for k, v in tables_of_models.items()}
    run.results = tables.write_results(results, f"{root}/us_results")
    return run
