"""Checks of cleaning, filters and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from wagelens import rules
from wagelens.checks.base import (
    ANNUAL_SQL, LOCATION_SQL, PERIOD_SQL, TITLE_SQL, VALUE_REFERENCE_SQL, VALUE_SQL, check, cleaned, cleaned_from_text, lit,
    postings, read_once, skilled, sql, sql_in, sql_list, sql_mean, sql_rules, table,
)
from wagelens.functions import text
from wagelens.operators import clean, lookup, skills, stats


@check("C1_null_defaults", sql("SELECT posting_id, title, location, company, description FROM v_filled"))
def _(spark, sf):
    df = postings(spark, sf)
    df = clean.fill_defaults(df).withColumn("company", clean.company_of(df))
    return df.select("posting_id", "title", "location", "company", "description")


@check("C2_standard_title", sql("SELECT posting_id, title, standardized_title FROM v_clean"))
def _(spark, sf):
    return cleaned_from_text(spark, sf).select("posting_id", "title", "standardized_title")


def _word(words):
    body = "|".join(w.replace("-", "\\-") for w in words)
    return f"regexp_matches(lower(title), '(^|[^\\p{{L}}\\p{{N}}_])({body})($|[^\\p{{L}}\\p{{N}}_])')"


_WORD_TITLES = " ".join(f"WHEN {_word(ws)} THEN {lit(n)}" for n, ws in rules.TITLE_RULES)


@check(
    "C2_standard_title_whole_words",
    sql(f"SELECT posting_id, CASE {_WORD_TITLES} ELSE 'other' END AS standardized_title FROM v_filled"),
)
def _(spark, sf):
    df = clean.clean_postings(postings(spark, sf), word_boundary=True)
    return df.select("posting_id", "standardized_title")


@check(
    "C2_null_title_is_unknown",
    sql(
        f"SELECT CASE WHEN title IS NULL THEN 'unknown' ELSE {TITLE_SQL} END AS standardized_title, "
        "count(*) AS n FROM v_postings GROUP BY 1"
    ),
)
def _(spark, sf):
    titled = postings(spark, sf).select(text.standard_title(F.lower("title")).alias("standardized_title"))
    return titled.groupBy("standardized_title").agg(F.count(F.lit(1)).alias("n"))


@check("C3_standard_location", sql("SELECT posting_id, location, standardized_location FROM v_clean"))
def _(spark, sf):
    return cleaned_from_text(spark, sf).select("posting_id", "location", "standardized_location")


_NAMED = rules.LOCATION_NAMED + [(c, [c]) for c in rules.COUNTRIES]


@check(
    "C3_standard_location_valid_codes",
    sql(
        f"SELECT posting_id, CASE WHEN ({LOCATION_SQL}) IN {sql_in(rules.US_CODES)} AND "
        f"regexp_matches(location, '{rules.LOCATION_PATTERN}') THEN ({LOCATION_SQL}) "
        f"ELSE {sql_rules('location', _NAMED, 'Other')} END AS standardized_location FROM v_filled"
    ),
)
def _(spark, sf):
    df = clean.clean_postings(postings(spark, sf), valid_codes_only=True)
    return df.select("posting_id", "standardized_location")


@check("C4_company_by_row", sql("SELECT posting_id, company FROM v_clean"))
def _(spark, sf):
    return cleaned_from_text(spark, sf).select("posting_id", "company")


@check("C4_company_by_table", sql("SELECT posting_id, coalesce(agency, 'Unknown') AS company FROM v_postings"))
def _(spark, sf):
    df = postings(spark, sf)
    return df.select("posting_id", clean.company_of(df, by_table=True).alias("company"))


@check("C5_salary_value", sql(f"SELECT posting_id, {VALUE_SQL} AS salary_value FROM v_postings"))
def _(spark, sf):
    return postings(spark, sf).select("posting_id", text.salary_value(F.col("salary")).alias("salary_value"))


@check("C5_salary_value_reference", sql(f"SELECT posting_id, {VALUE_REFERENCE_SQL} AS salary_value FROM v_postings"))
def _(spark, sf):
    value = text.salary_value(F.col("salary"), reference_mode=True)
    return postings(spark, sf).select("posting_id", value.alias("salary_value"))


@check("C6_salary_period", sql(f"SELECT posting_id, {PERIOD_SQL} AS salary_period FROM v_postings"))
def _(spark, sf):
    return cleaned_from_text(spark, sf).select("posting_id", "salary_period")


@check("C7_annual_salary", sql("SELECT posting_id, annual_salary FROM v_clean"))
def _(spark, sf):
    return cleaned_from_text(spark, sf).select("posting_id", "annual_salary")


_REFERENCE = f"""
v_ref AS (
  SELECT *, {ANNUAL_SQL} AS annual_salary FROM (
    SELECT posting_id, {VALUE_REFERENCE_SQL} AS salary_value, {PERIOD_SQL} AS salary_period FROM v_postings))"""


@check("C7_annual_salary_reference", sql("SELECT posting_id, annual_salary FROM v_ref", _REFERENCE))
def _(spark, sf):
    return clean.clean_postings(postings(spark, sf), reference_mode=True).select("posting_id", "annual_salary")


@check(
    "C8_us_only",
    sql(f"SELECT posting_id, standardized_location FROM v_clean WHERE standardized_location IN {sql_in(rules.US_CODES)}"),
)
def _(spark, sf):
    return clean.us_only(cleaned(spark, sf)).select("posting_id", "standardized_location")


@check("C9_drop_null_target", sql("SELECT posting_id, annual_salary FROM v_clean WHERE annual_salary IS NOT NULL"))
def _(spark, sf):
    return clean.drop_null_target(cleaned(spark, sf)).select("posting_id", "annual_salary")


_TOP = """
v_top AS (SELECT standardized_title FROM v_clean WHERE annual_salary IS NOT NULL
  GROUP BY 1 ORDER BY count(*) DESC, standardized_title LIMIT 10)"""


@check(
    "C10_top_group_rows",
    sql(
        "SELECT posting_id, standardized_title, annual_salary FROM v_clean "
        "WHERE annual_salary IS NOT NULL AND standardized_title IN (SELECT * FROM v_top)", _TOP,
    ),
)
def _(spark, sf):
    df = cleaned(spark, sf).select("posting_id", "standardized_title", "annual_salary")
    return stats.top_group_rows(clean.drop_null_target(df), "standardized_title", 10)


_FENCE = """
v_saving AS (SELECT l_orderkey, l_linenumber, l_extendedprice * l_discount AS saving FROM lineitem),
v_fence AS (SELECT q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM (
  SELECT quantile_cont(saving, 0.25) AS q1, quantile_cont(saving, 0.75) AS q3 FROM v_saving))"""


def _savings(spark, sf):
    saving = (F.col("l_extendedprice") * F.col("l_discount")).alias("saving")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", saving)


@check(
    "C11_outliers",
    f"WITH {_FENCE} SELECT l_orderkey, l_linenumber, saving FROM v_saving, v_fence WHERE saving < lower OR saving > upper",
)
def _(spark, sf):
    return stats.outliers(_savings(spark, sf), "saving")


@check(
    "C12_cap_at_bounds",
    f"WITH {_FENCE} SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 3 THEN NULL "
    "ELSE round(least(greatest(saving, lower), upper), 4) END AS saving FROM v_saving, v_fence",
)
def _(spark, sf):
    df = _savings(spark, sf)
    holes = df.withColumn("saving", F.when(F.col("l_linenumber") != 3, F.col("saving")))
    capped = stats.cap(holes, "saving", stats.fences(df, "saving"))
    return capped.withColumn("saving", F.round("saving", 4))


@check("C13_one_role", sql("SELECT posting_id FROM v_clean WHERE standardized_title = 'data scientist'"))
def _(spark, sf):
    return cleaned(spark, sf).where(F.col("standardized_title") == "data scientist").select("posting_id")


_FLAGS = ["python", "sql", "c++", ".net", "ci/cd", "machine learning", "tcp/ip", "go"]
_FLAG_SQL = ", ".join(
    f"CAST(list_contains(skills, {lit(s)}) AS INT) AS {skills.indicator_name(s)}" for s in _FLAGS
)


@check("C14_indicator_columns", sql(f"SELECT {_FLAG_SQL} FROM v_skills"))
def _(spark, sf):
    df = skills.with_indicators(skilled(spark, sf), _FLAGS)
    return df.select(*clean.columns_with_prefix(df))


@check("C15_feature_columns", sql(f"SELECT standardized_title, standardized_location, company, {_FLAG_SQL} FROM v_skills"))
def _(spark, sf):
    df = skills.with_indicators(skilled(spark, sf), _FLAGS)
    return df.select(*clean.feature_columns(df))


_SLUGS = ", ".join(f"({lit(skills.indicator_name(s))}, {lit(s)})" for s in skills.known_skills())


@check(
    "C16_skill_names",
    sql(
        "SELECT slug, skill, count(*) AS n FROM (SELECT unnest(skills) AS skill FROM v_skills) "
        f"JOIN (VALUES {_SLUGS}) AS d(slug, skill) USING (skill) GROUP BY ALL"
    ),
)
def _(spark, sf):
    counts = skills.skill_frequency(skilled(spark, sf))
    return counts.join(F.broadcast(skills.skill_dictionary(spark)), "skill").select("slug", "skill", "n")


@check("C17_strip", "SELECT doc_id, trim(text, chr(32) || chr(9) || chr(10) || chr(13) || chr(11) || chr(12) || chr(160)) AS text FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.strip(F.col("text")).alias("text"))


_GONE = sql_in(rules.CSV_MISSING + rules.SENTINELS)


@check(
    "C18_incomplete_records",
    sql(
        "SELECT posting_id, n_missing, n_missing > 0 AS is_incomplete FROM (SELECT posting_id, "
        "CAST(title IS NULL AS INT) + CAST(location IS NULL AS INT) + "
        f"CAST(salary IS NULL OR salary IN {_GONE} AS INT) AS n_missing FROM v_postings)"
    ),
)
def _(spark, sf):
    df = clean.with_completeness(clean.normalise_missing(postings(spark, sf)))
    return df.select("posting_id", "n_missing", "is_incomplete")


# ---- lookups -------------------------------------------------------------

_MEANS = ", ".join(f"({lit(t)}, {m})" for t, m in rules.MEAN_BY_TITLE.items() if t != "ai engineer")


@check(
    "J1_lookup_with_default",
    sql(
        "SELECT posting_id, CAST(coalesce(m, 90000) AS BIGINT) AS mean_salary FROM v_clean "
        f"LEFT JOIN (VALUES {_MEANS}) AS d(t, m) ON standardized_title = t"
    ),
)
def _(spark, sf):
    rows = [(t, m) for t, m in rules.MEAN_BY_TITLE.items() if t != "ai engineer"]
    means = spark.createDataFrame(rows, "standardized_title string, mean_salary bigint")
    df = read_once(spark, sf, "posting_id", "standardized_title")
    joined = lookup.value_or_default(
        df, means, "standardized_title", "mean_salary", F.lit(rules.MEAN_DEFAULT).cast("bigint")
    )
    return joined.select("posting_id", "mean_salary")


_TEXTS = " ".join(f"WHEN contains(lower(coalesce(title, '')), {lit(k)}) THEN {lit(v)}" for k, v in rules.SALARY_TEXT_BY_TITLE)
TEXT_SQL = f"CASE {_TEXTS} ELSE {lit(rules.SALARY_TEXT_DEFAULT)} END"


@check("J2_first_contained_key", sql(f"SELECT posting_id, {TEXT_SQL} AS salary_text FROM v_postings"))
def _(spark, sf):
    lowered = F.lower(F.coalesce(F.col("title"), F.lit("")))
    return postings(spark, sf).select("posting_id", text.salary_text_for_title(lowered).alias("salary_text"))


@check(
    "J3_members",
    "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')",
)
def _(spark, sf):
    keys = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").selectExpr("c_custkey AS o_custkey")
    return lookup.members(table(spark, sf, "orders"), keys, "o_custkey").select("o_orderkey")


@check(
    "J4_features_with_target",
    sql("SELECT posting_id, standardized_location, company, annual_salary FROM v_clean WHERE annual_salary IS NOT NULL"),
)
def _(spark, sf):
    rows = clean.drop_null_target(cleaned(spark, sf))
    return rows.select("posting_id", "standardized_location", "company", "annual_salary")


@check(
    "J5_group_value_on_rows",
    sql(
        "SELECT posting_id, annual_salary, mean_value FROM v_clean JOIN (SELECT standardized_title, "
        f"{sql_mean('annual_salary')} AS mean_value FROM v_clean GROUP BY 1) USING (standardized_title)"
    ),
)
def _(spark, sf):
    df = cleaned(spark, sf).select("posting_id", "standardized_title", "annual_salary")
    means = stats.group_mean(df, "standardized_title").drop("n")
    joined = lookup.attach_group_value(df, means, "standardized_title")
    return joined.select("posting_id", "annual_salary", "mean_value")


_DEFAULTS = ", ".join(f"({lit(t)}, {sql_list(s)})" for t, s in rules.DEFAULT_SKILLS_BY_TITLE.items())


@check(
    "J6_keyed_assignment",
    sql(
        "SELECT posting_id, coalesce(array_to_string(s, ','), '') AS skills FROM v_clean "
        f"LEFT JOIN (VALUES {_DEFAULTS}) AS d(t, s) ON standardized_title = t"
    ),
)
def _(spark, sf):
    rows = list(rules.DEFAULT_SKILLS_BY_TITLE.items())
    defaults = spark.createDataFrame(rows, "standardized_title string, s array<string>")
    df = read_once(spark, sf, "posting_id", "standardized_title")
    joined = lookup.join_lookup(df, defaults, "standardized_title")
    return joined.select("posting_id", F.coalesce(F.array_join("s", ","), F.lit("")).alias("skills"))
