"""Report tables.  Each is a small long table; text layout is left to the reader."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagelens import rules
from wagelens.operators import skills, stats

TITLE, PLACE, PAY = "standardized_title", "standardized_location", "annual_salary"


def summary(df: DataFrame) -> DataFrame:
    """Rows, distinct titles and places, and salaries by how they came about."""
    origin = F.col("salary_origin")
    wide = df.agg(
        F.count(F.lit(1)).alias("postings"),
        F.count_distinct(TITLE).alias("titles"),
        F.count_distinct(PLACE).alias("locations"),
        F.count_if(F.col(PAY).isNotNull() & (origin == "observed")).alias("salaries_observed"),
        F.count_if(F.col(PAY).isNotNull() & (origin == "imputed")).alias("salaries_imputed"),
        F.count_if(F.col(PAY).isNotNull() & (origin == "synthetic")).alias("salaries_synthetic"),
    )
    items = [F.struct(F.lit(c).alias("item"), F.col(c).alias("n")) for c in wide.columns]
    return wide.select(F.inline(F.array(*items)))


REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "summary": summary,
    "top_titles": lambda df: stats.frequency(df, TITLE, 10),
    "top_locations": lambda df: stats.frequency(df, PLACE, 10),
    "salary_statistics": lambda df: stats.describe(df, PAY),
    "top_paying_titles": lambda df: stats.top_by_mean(df, TITLE),
    "top_paying_locations": lambda df: stats.top_by_mean(df, PLACE),
}

# the numbers behind the charts that need no model
CHARTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "box_by_title": lambda df: stats.box_stats(df, TITLE),
    "box_by_location": lambda df: stats.box_stats(df, PLACE),
    "salary_histogram": lambda df: stats.histogram(df, PAY),
    "salary_density": lambda df: stats.density(df, PAY),
    "salary_map": lambda df: stats.group_mean(df, PLACE),
    "skill_cloud": lambda df: skills.skill_frequency(df, words=True),
    "skill_demand_by_title": lambda df: skills.skill_demand(df, TITLE),
    "skill_demand_by_location": lambda df: skills.skill_demand(df, PLACE),
}


def report_tables(df: DataFrame) -> dict[str, DataFrame]:
    """The report of one cleaned table."""
    return {name: make(df) for name, make in REPORTS.items()}


def chart_tables(df: DataFrame) -> dict[str, DataFrame]:
    """The chart tables of one cleaned table with skills."""
    return {name: make(df) for name, make in CHARTS.items()}


def importance_heatmap(importances: DataFrame, top: int = 20) -> DataFrame:
    """Roles by their most important skills, 0 where a role lacks one.

    Reads a result table with at most one row per role and known skill.
    """
    known = importances.where(F.col("importance").isNotNull())
    best = stats.top_skills_by_total(known, "skill", "importance", top)
    items = [r["skill"] for r in best.collect()]
    return stats.matrix(known, "role", "skill", "importance", items)


def bars(importances: DataFrame, k: int) -> DataFrame:
    """The k most important features or skills."""
    return importances.where(F.col("rank") <= k)


def range_line(df: DataFrame) -> DataFrame:
    """Ends of the diagonal in the predicted-against-actual chart."""
    return stats.value_range(df, "y")


SKILLS_IN_BARS, FEATURES_IN_BARS, SKILLS_LISTED = 15, 20, 15
SAMPLE = rules.SCATTER_SAMPLE
