"""Checks of report tables and of the US table."""

from __future__ import annotations

from pyspark.sql import functions as F

from wagelens import rules
from wagelens.checks.base import SPLIT_SQL, check, skilled, sql, sql_in, sql_mean
from wagelens.checks.modelling import best, role_importances
from wagelens.checks.stats import box_sql, describe_rounded, describe_sql, histogram_sql, rounded, top_mean_sql
from wagelens.checks.inputs import remote_pages
from wagelens.operators import models
from wagelens.plans import harvest, market, report
from wagelens.sources import html

TITLE, PLACE = report.TITLE, report.PLACE


@check(
    "R1_summary",
    sql(
        "SELECT 'postings' AS item, count(*) AS n FROM v_clean UNION ALL SELECT 'titles', count(DISTINCT standardized_title) FROM v_clean "
        "UNION ALL SELECT 'locations', count(DISTINCT standardized_location) FROM v_clean "
        "UNION ALL SELECT 'salaries_observed', count(annual_salary) FROM v_clean "
        "UNION ALL SELECT 'salaries_imputed', 0 UNION ALL SELECT 'salaries_synthetic', 0"
    ),
)
def _(spark, sf):
    return report.summary(skilled(spark, sf))


@check(
    "R2_top_titles_and_locations",
    sql(
        "(SELECT 'title' AS kind, standardized_title AS name, count(*) AS n FROM v_clean GROUP BY 2 ORDER BY n DESC, name LIMIT 10) UNION ALL "
        "(SELECT 'location', standardized_location AS name, count(*) AS n FROM v_clean GROUP BY 2 ORDER BY n DESC, name LIMIT 10)"
    ),
)
def _(spark, sf):
    made = report.report_tables(skilled(spark, sf))
    one = made["top_titles"].select(F.lit("title").alias("kind"), F.col(TITLE).alias("name"), "n")
    return one.unionByName(made["top_locations"].select(F.lit("location").alias("kind"), F.col(PLACE).alias("name"), "n"))


@check("R3_salary_statistics", sql(describe_sql("v_clean", "annual_salary")))
def _(spark, sf):
    return describe_rounded(skilled(spark, sf), "annual_salary")


for _name, _by in (("R6_top_paying_titles", TITLE), ("R6_top_paying_locations", PLACE)):

    @check(_name, sql(top_mean_sql(_by)))
    def _(spark, sf, by=_by):
        key = "top_paying_titles" if by == TITLE else "top_paying_locations"
        return report.REPORTS[key](skilled(spark, sf))


@check("R7_box_chart", sql(box_sql(TITLE)))
def _(spark, sf):
    return rounded(report.CHARTS["box_by_title"](skilled(spark, sf)), ["q1", "median", "q3"])


@check("R7_histogram_chart", sql(histogram_sql("v_clean", "annual_salary")))
def _(spark, sf):
    return rounded(report.CHARTS["salary_histogram"](skilled(spark, sf)), ["bin_low", "bin_high"])


@check("R7_salary_map", sql(f"SELECT {PLACE}, {sql_mean('annual_salary')} AS mean_value, count(annual_salary) AS n FROM v_clean WHERE annual_salary IS NOT NULL GROUP BY 1"))
def _(spark, sf):
    return report.CHARTS["salary_map"](skilled(spark, sf))


@check("R7_skill_cloud", sql("SELECT skill, count(*) AS n FROM (SELECT unnest(string_split(skill, ' ')) AS skill FROM (SELECT unnest(skills) AS skill FROM v_skills)) GROUP BY 1"))
def _(spark, sf):
    return report.CHARTS["skill_cloud"](skilled(spark, sf))


@check("R7_importance_bars")
def _(spark, sf):
    return report.bars(models.importance_table(spark, best(spark, sf)), report.FEATURES_IN_BARS)


@check("R7_importance_matrix")
def _(spark, sf):
    by_role = role_importances(spark, sf)
    return report.importance_heatmap(by_role)


_US = f"""
v_us AS (SELECT *, {SPLIT_SQL} AS split FROM v_clean WHERE standardized_location IN {sql_in(rules.US_CODES)}),
v_fit AS (SELECT * FROM v_us WHERE split = 'train'),
v_bounds AS (SELECT quantile_cont(annual_salary, 0.25) AS q1, quantile_cont(annual_salary, 0.75) AS q3 FROM v_fit),
v_us_done AS (
  SELECT posting_id, split, CASE WHEN annual_salary IS NULL THEN 'imputed' ELSE 'observed' END AS salary_origin,
    round(CASE WHEN split = 'test' AND annual_salary IS NOT NULL THEN annual_salary
      ELSE least(greatest(coalesce(annual_salary, m), q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1)) END, 6) AS annual_salary
  FROM v_us LEFT JOIN (SELECT standardized_title, median(annual_salary) AS m FROM v_fit GROUP BY 1) USING (standardized_title), v_bounds)"""


@check("us_table", sql("SELECT posting_id, split, salary_origin, annual_salary FROM v_us_done", _US))
def _(spark, sf):
    us = market.us_table(skilled(spark, sf))
    return rounded(us.select("posting_id", "split", "salary_origin", "annual_salary"), ["annual_salary"])


_US_ALL = _US.replace("WHERE split = 'train'", "").replace("split = 'test' AND annual_salary IS NOT NULL", "false")


@check("us_table_reference", sql("SELECT posting_id, annual_salary FROM v_us_done", _US_ALL))
def _(spark, sf):
    us = market.us_table(skilled(spark, sf), fit_on_train=False)
    return rounded(us.select("posting_id", "annual_salary"), ["annual_salary"])


@check("X9_harvest", sql("SELECT posting_id AS page_id, 0 AS card_no, title FROM v_postings WHERE posting_id % 10 <> 0 AND posting_id % 7 <> 0 AND title IS NOT NULL UNION ALL SELECT posting_id, 1, title FROM v_postings WHERE posting_id % 10 <> 0 AND title IS NOT NULL"))
def _(spark, sf):
    return harvest.harvest(remote_pages(spark, sf), html.REMOTE_BOARD).select("page_id", "card_no", "title")


@check(
    "X7_page_report",
    sql(
        "SELECT posting_id AS page_id, posting_id % 10 = 0 AS no_results, "
        "CAST(CASE WHEN posting_id % 10 = 0 OR title IS NULL THEN 0 WHEN posting_id % 7 = 0 THEN 1 ELSE 2 END AS BIGINT) AS n_usable, "
        "CAST(CASE WHEN posting_id % 10 = 0 THEN 0 WHEN title IS NULL THEN 2 WHEN posting_id % 7 = 0 THEN 1 ELSE 0 END AS BIGINT) AS n_no_title FROM v_postings"
    ),
)
def _(spark, sf):
    return harvest.harvest_report(remote_pages(spark, sf), html.REMOTE_BOARD)
