"""Cleaning: raw posting rows to standard columns, row by row, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagelens import rules
from wagelens.functions import text

RAW_COLUMNS = [
    "title", "url", "agency", "company", "location", "salary",
    "closing_date", "search_term", "description",
]
REQUIRED_FOR_COMPLETE = ["title", "location", "salary"]


def with_missing_columns(df: DataFrame, columns: list[str], default: str | None = None) -> DataFrame:
    """Add absent text columns."""
    absent = [c for c in columns if c not in df.columns]
    return df.withColumns({c: F.lit(default).cast("string") for c in absent}) if absent else df


def normalise_missing(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Trim text and turn sentinel and missing-value texts into NULL."""
    stand_ins = rules.CSV_MISSING + rules.SENTINELS
    names = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    if columns is not None:
        names = [n for n in names if n in columns]
    return df.withColumns({n: text.null_texts(text.strip(F.col(n)), stand_ins) for n in names})


def with_completeness(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Count missing required fields and flag incomplete records."""
    required = REQUIRED_FOR_COMPLETE if required is None else required
    missing = sum((F.col(c).isNull().cast("int") for c in required), F.lit(0))
    return df.withColumn("n_missing", missing).withColumn("is_incomplete", F.col("n_missing") > 0)


def company_of(df: DataFrame, by_table: bool = False) -> Column:
    """Agency, else company, else "Unknown".

    ``by_table=True`` picks one column for the whole table instead: agency if
    the table has it, so rows with only a company become "Unknown".
    """
    present = [c for c in ("agency", "company") if c in df.columns]
    if by_table:
        present = present[:1]
    return F.coalesce(*[F.col(c) for c in present], F.lit(rules.FILL_COMPANY))


def fill_defaults(df: DataFrame) -> DataFrame:
    """Defaults for missing description, title and location."""
    return df.na.fill(
        {"description": "", "title": rules.FILL_TITLE, "location": rules.FILL_LOCATION}
    )


def with_salary(df: DataFrame, reference_mode: bool = False) -> DataFrame:
    """Add salary_value, salary_period, annual_salary and salary_origin."""
    shown = text.null_texts(F.col("salary"), rules.SENTINELS)
    staged = df.withColumn("_pay", F.lower(shown)).withColumns(
        {
            "salary_value": text.salary_value(F.col("salary"), reference_mode),
            "salary_period": text.salary_period(F.col("_pay")),
        }
    )
    # straight from the text: predicates on it stay short when they are pushed down
    annual = F.col("salary_value") * text.annual_factor(F.col("_pay"))
    staged = staged.withColumn("annual_salary", annual).drop("_pay")
    return with_origin(staged)


def with_origin(df: DataFrame) -> DataFrame:
    """'observed' where a salary was read; keep a 'synthetic' mark made earlier."""
    observed = F.when(F.col("annual_salary").isNotNull(), F.lit("observed"))
    if "salary_origin" in df.columns:
        observed = F.coalesce(F.col("salary_origin"), observed)
    return df.withColumn("salary_origin", observed)


def clean_postings(
    df: DataFrame,
    reference_mode: bool = False,
    word_boundary: bool = False,
    valid_codes_only: bool = False,
) -> DataFrame:
    """Standard title, place, company and pay of every posting.

    Columns the caller does not use are pruned from the scan, since this is
    only projections.
    """
    df = with_missing_columns(df, ["title", "location", "salary", "description"], "")
    company = company_of(df, by_table=reference_mode)
    df = fill_defaults(df).withColumn("company", company)
    df = df.withColumn("_title", F.lower("title")).withColumns(
        {
            "standardized_title": text.standard_title(F.col("_title"), word_boundary),
            "standardized_location": text.standard_location(F.col("location"), valid_codes_only),
        }
    )
    return with_salary(df.drop("_title"), reference_mode)


def us_only(df: DataFrame) -> DataFrame:
    """Rows placed in the US; a literal set, so parquet readers can skip by it."""
    return df.where(F.col("standardized_location").isin(rules.US_CODES))


def columns_with_prefix(df: DataFrame, prefix: str = "has_") -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def feature_columns(df: DataFrame, with_company: bool = True) -> list[str]:
    """Categorical feature columns, then the indicator columns."""
    categorical = ["standardized_title", "standardized_location"]
    if with_company:
        categorical.append("company")
    return categorical + columns_with_prefix(df)


def drop_null_target(df: DataFrame, target: str = "annual_salary") -> DataFrame:
    return df.where(F.col(target).isNotNull())
