"""Filling missing values.  Every filled salary says so in ``salary_origin``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagelens import rules
from wagelens.functions import text
from wagelens.operators.quantiles import median


def missing_share(df: DataFrame, column: str = "annual_salary") -> DataFrame:
    """Share of NULLs, one row."""
    return df.agg(F.avg(F.col(column).isNull().cast("double")).alias("missing_share"))


def _all_missing(df: DataFrame, column: str) -> Column:
    return df.agg(F.count(column).alias("n")).scalar() == 0


def fill_salary_text(df: DataFrame) -> DataFrame:
    """Stand-in salary texts by title, only when no row has a salary text.

    The test is a one-row subquery, so nothing runs until the result is used.
    """
    if "salary" not in df.columns:
        df = df.withColumn("salary", F.lit(None).cast("string"))
        empty = F.lit(True)
    else:
        empty = _all_missing(df, "salary")
    stand_in = text.salary_text_for_title(F.lower(F.coalesce(F.col("title"), F.lit(""))))
    return df.withColumns(
        {
            "salary": F.when(empty, stand_in).otherwise(F.col("salary")),
            "salary_origin": F.when(empty, F.lit("synthetic")),
        }
    )


def title_mean(title: Column) -> Column:
    """Listed mean salary of a standard title."""
    table = F.create_map(*[F.lit(x) for t, m in rules.MEAN_BY_TITLE.items() for x in (t, float(m))])
    return F.coalesce(F.try_element_at(table, title), F.lit(float(rules.MEAN_DEFAULT)))


def fill_title_mean(
    df: DataFrame, key: str, seed: int = rules.SPLIT_SEED, share_limit: float = rules.MISSING_SHARE_LIMIT,
    overwrite_known: bool = False,
) -> DataFrame:
    """Listed title mean with a jitter of up to a fifth, when most salaries are missing.

    The jitter comes from the key, so a re-run gives the same values.  Known
    salaries stay; ``overwrite_known=True`` replaces them too.
    """
    mostly_missing = missing_share(df).scalar() > share_limit
    width = rules.JITTER_HIGH - rules.JITTER_LOW
    jitter = F.lit(rules.JITTER_LOW) + F.lit(width) * text.hash_unit(F.col(key), seed)
    target = mostly_missing if overwrite_known else mostly_missing & F.col("annual_salary").isNull()
    return df.withColumns(
        {
            "annual_salary": F.when(target, title_mean(F.col("standardized_title")) * jitter).otherwise(
                F.col("annual_salary")
            ),
            "salary_origin": F.when(target, F.lit("synthetic")).otherwise(F.col("salary_origin")),
        }
    )


def fill_group_median(
    df: DataFrame, value: str = "annual_salary", by: str = "standardized_title",
    fit_on: DataFrame | None = None, bounded_groups: bool = True,
) -> DataFrame:
    """NULLs take the median of their group.

    ``bounded_groups`` says that the group column has a fixed value set (title
    classes: 22), so its medians may be broadcast; otherwise the join is left
    to the optimizer, which broadcasts by measured size and splits hot keys.
    """
    medians = median(df if fit_on is None else fit_on, value, [by], "_group_median")
    medians = medians.withColumnRenamed(by, "_group")
    if bounded_groups:
        medians = F.broadcast(medians)
    joined = df.join(medians, df[by] == F.col("_group"), "left")
    return _fill(joined, value, F.col("_group_median")).drop("_group", "_group_median")


def fill_overall_median(df: DataFrame, value: str = "annual_salary", fit_on: DataFrame | None = None) -> DataFrame:
    """Remaining NULLs take the overall median, a one-row subquery."""
    overall = median(df if fit_on is None else fit_on, value).scalar()
    return _fill(df, value, overall)


def _fill(df: DataFrame, value: str, by: Column) -> DataFrame:
    filled = {value: F.coalesce(F.col(value), by)}
    if "salary_origin" in df.columns:
        newly = F.col(value).isNull() & by.isNotNull()
        filled["salary_origin"] = F.when(newly, F.lit("imputed")).otherwise(F.col("salary_origin"))
    return df.withColumns(filled)


def fill_indicators(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("int") for c in columns})


def fill_categories(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.na.fill(rules.FILL_CATEGORY, subset=columns)


def fill_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.na.fill(0, subset=columns)
