"""Checks of imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from wagelens import rules
from wagelens.checks.base import check, cleaned, lit, postings, skilled, sql, table
from wagelens.checks.cleaning import TEXT_SQL
from wagelens.operators import impute, regress, skills


@check(
    "I1_salary_text_by_title",
    sql(f"SELECT posting_id, {TEXT_SQL} AS salary, 'synthetic' AS salary_origin FROM v_postings"),
)
def _(spark, sf):
    bare = postings(spark, sf).withColumn("salary", F.lit(None).cast("string"))
    return impute.fill_salary_text(bare).select("posting_id", "salary", "salary_origin")


@check(
    "I1_kept_when_any_known",
    sql("SELECT posting_id, salary, CAST(NULL AS VARCHAR) AS salary_origin FROM v_postings"),
)
def _(spark, sf):
    return impute.fill_salary_text(postings(spark, sf)).select("posting_id", "salary", "salary_origin")


@check("I2_missing_share", sql("SELECT avg(CAST(annual_salary IS NULL AS INT)) AS missing_share FROM v_clean"))
def _(spark, sf):
    return impute.missing_share(cleaned(spark, sf))


_MEAN = " ".join(f"WHEN {lit(t)} THEN {float(m)}" for t, m in rules.MEAN_BY_TITLE.items())
_UNIT = "CAST(('0x' || substr(md5(CAST(posting_id AS VARCHAR) || '|42'), 1, 8)) AS BIGINT) / 4294967296.0"


@check(
    "I3_title_mean_with_jitter",
    sql(
        "SELECT posting_id, round(CASE WHEN salary_period = 'Daily' AND salary_value > 550 THEN annual_salary ELSE "
        f"(CASE standardized_title {_MEAN} ELSE 90000.0 END) * (0.8 + 0.4 * {_UNIT}) END, 4) AS annual_salary, "
        "CASE WHEN salary_period = 'Daily' AND salary_value > 550 THEN 'observed' ELSE 'synthetic' END AS salary_origin FROM v_clean"
    ),
)
def _(spark, sf):
    df = cleaned(spark, sf)
    few = (F.col("salary_period") == "Daily") & (F.col("salary_value") > 550)
    sparse = df.withColumns({c: F.when(few, F.col(c)) for c in ("annual_salary", "salary_origin")})
    filled = impute.fill_title_mean(sparse, "posting_id")
    return filled.select("posting_id", F.round("annual_salary", 4).alias("annual_salary"), "salary_origin")


@check("I3_kept_below_limit", sql("SELECT posting_id, annual_salary FROM v_clean"))
def _(spark, sf):
    return impute.fill_title_mean(cleaned(spark, sf), "posting_id").select("posting_id", "annual_salary")


@check(
    "I4_group_median",
    sql(
        "SELECT posting_id, round(coalesce(annual_salary, m), 6) AS annual_salary, "
        "CASE WHEN annual_salary IS NULL THEN 'imputed' ELSE 'observed' END AS salary_origin FROM v_clean "
        "JOIN (SELECT standardized_title, median(annual_salary) AS m FROM v_clean GROUP BY 1) USING (standardized_title)"
    ),
)
def _(spark, sf):
    filled = impute.fill_group_median(cleaned(spark, sf))
    return filled.select("posting_id", F.round("annual_salary", 6).alias("annual_salary"), "salary_origin")


_HOLES = "(SELECT l_orderkey, l_linenumber, l_returnflag, CASE WHEN l_linenumber <> 3 THEN l_extendedprice END AS price FROM lineitem)"


def _holes(spark, sf):
    price = F.when(F.col("l_linenumber") != 3, F.col("l_extendedprice")).alias("price")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", price)


@check(
    "I4_group_median_any_group",
    f"SELECT l_orderkey, l_linenumber, round(coalesce(price, m), 6) AS price FROM {_HOLES} "
    f"JOIN (SELECT l_returnflag, median(price) AS m FROM {_HOLES} GROUP BY 1) USING (l_returnflag)",
)
def _(spark, sf):
    filled = impute.fill_group_median(_holes(spark, sf), "price", "l_returnflag", bounded_groups=False)
    return filled.select("l_orderkey", "l_linenumber", F.round("price", 6).alias("price"))


@check(
    "I5_overall_median",
    f"SELECT l_orderkey, l_linenumber, round(coalesce(price, (SELECT median(price) FROM {_HOLES})), 6) AS price FROM {_HOLES}",
)
def _(spark, sf):
    filled = impute.fill_overall_median(_holes(spark, sf), "price")
    return filled.select("l_orderkey", "l_linenumber", F.round("price", 6).alias("price"))


@check(
    "I6_indicator_nulls",
    sql(
        "SELECT posting_id, CAST(CASE WHEN skill_origin = 'none' THEN 0 ELSE list_contains(skills, 'sql') END AS INT) AS has_sql, "
        "CAST(CASE WHEN skill_origin = 'none' THEN 0 ELSE list_contains(skills, 'go') END AS INT) AS has_go FROM v_skills"
    ),
)
def _(spark, sf):
    wide = skills.with_indicators(skilled(spark, sf), ["sql", "go"])
    known = F.col("skill_origin") != "none"
    holes = wide.withColumns({c: F.when(known, F.col(c)) for c in ("has_sql", "has_go")})
    return impute.fill_indicators(holes, ["has_sql", "has_go"]).select("posting_id", "has_sql", "has_go")


@check("I7_missing_category", sql("SELECT posting_id, coalesce(title, 'missing') AS title, coalesce(location, 'missing') AS location FROM v_postings"))
def _(spark, sf):
    return impute.fill_categories(postings(spark, sf), ["title", "location"]).select("posting_id", "title", "location")


_SIDE = "CASE WHEN substr(md5(CAST(o_orderkey AS VARCHAR) || '|42'), 1, 8) < '33333333' THEN 'test' ELSE 'train' END"
_PRICED = f"(SELECT o_orderkey, {_SIDE} AS split, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_totalprice END AS price FROM orders)"


@check(
    "I8_median_from_train",
    f"SELECT o_orderkey, round(coalesce(price, (SELECT median(price) FROM {_PRICED} WHERE split = 'train')), 6) AS price FROM {_PRICED}",
)
def _(spark, sf):
    price = F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_totalprice")).alias("price")
    df = regress.with_split(table(spark, sf, "orders").select("o_orderkey", price), "o_orderkey")
    filled = impute.fill_overall_median(df, "price", fit_on=df.where("split = 'train'"))
    return filled.select("o_orderkey", F.round("price", 6).alias("price"))


@check("I9_constant_zero", sql("SELECT posting_id, coalesce(annual_salary, 0.0) AS annual_salary FROM v_clean"))
def _(spark, sf):
    return impute.fill_zero(cleaned(spark, sf), ["annual_salary"]).select("posting_id", "annual_salary")
