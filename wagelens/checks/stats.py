"""Checks of aggregates, order, samples and sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from wagelens import rules
from wagelens.checks.base import check, cleaned, lit, postings, skilled, sql, sql_mean, table
from wagelens.functions.keys import split_digest
from wagelens.operators import clean, quantiles, sampling, skills, stats

TITLE = "standardized_title"
PLACE = "standardized_location"


def rounded(df, columns, places=6):
    return df.withColumns({c: F.round(c, places) for c in columns})


@check("G1_row_count", sql("SELECT count(*) AS n FROM v_postings"))
def _(spark, sf):
    return stats.count_rows(postings(spark, sf))


@check(
    "G2_distinct_values",
    sql(
        "SELECT 'standardized_title' AS \"column\", count(DISTINCT standardized_title) AS n_distinct FROM v_clean "
        "UNION ALL SELECT 'standardized_location', count(DISTINCT standardized_location) FROM v_clean "
        "UNION ALL SELECT 'agency', count(DISTINCT agency) FROM v_postings "
        "UNION ALL SELECT 'url', count(DISTINCT url) FROM v_postings"
    ),
)
def _(spark, sf):
    return stats.count_distinct(cleaned(spark, sf), [TITLE, PLACE, "agency", "url"])


@check(
    "G3_known_values",
    sql(
        "SELECT CASE WHEN annual_salary IS NULL THEN 'missing' ELSE 'observed' END AS salary_origin, "
        "count(annual_salary) AS n_present FROM v_clean GROUP BY 1"
    ),
)
def _(spark, sf):
    df = cleaned(spark, sf).na.fill("missing", subset=["salary_origin"])
    return stats.count_present(df, "annual_salary", "salary_origin")


for _name, _by in (("G4_top_titles", TITLE), ("G4_top_locations", PLACE)):

    @check(_name, sql(f"SELECT {_by}, count(*) AS n FROM v_clean GROUP BY 1 ORDER BY n DESC, {_by} LIMIT 10"))
    def _(spark, sf, by=_by):
        return stats.frequency(cleaned(spark, sf), by, 10)


def describe_sql(source: str, x: str) -> str:
    parts = [
        ("count", f"CAST(count({x}) AS DOUBLE)"), ("mean", f"round({sql_mean(x)}, 6)"),
        ("std", f"round(stddev_samp({x}), 4)"), ("min", f"min({x})"), ("max", f"max({x})"),
        ("25%", f"round(quantile_cont({x}, 0.25), 6)"), ("50%", f"round(quantile_cont({x}, 0.5), 6)"),
        ("75%", f"round(quantile_cont({x}, 0.75), 6)"),
    ]
    return " UNION ALL ".join(
        f"SELECT {lit(n)} AS statistic, CAST({e} AS DOUBLE) AS value FROM {source}" for n, e in parts
    )


def describe_rounded(df, column):
    places = F.when(F.col("statistic") == "std", F.round("value", 4)).otherwise(F.round("value", 6))
    return stats.describe(df, column).withColumn("value", places)


@check("G5_describe", sql(describe_sql("v_clean", "annual_salary")))
def _(spark, sf):
    return describe_rounded(cleaned(spark, sf), "annual_salary")


for _name, _by in (("G6_mean_by_title", TITLE), ("G6_mean_by_location", PLACE)):

    @check(
        _name,
        sql(
            f"SELECT {_by}, {sql_mean('annual_salary')} AS mean_value, count(annual_salary) AS n "
            f"FROM v_clean WHERE annual_salary IS NOT NULL GROUP BY 1"
        ),
    )
    def _(spark, sf, by=_by):
        return stats.group_mean(cleaned(spark, sf), by)


def top_mean_sql(by: str) -> str:
    return (
        f"SELECT CAST(row_number() OVER (ORDER BY mean_value DESC, {by}) AS INT) AS rank, {by}, mean_value FROM ("
        f"SELECT {by}, {sql_mean('annual_salary')} AS mean_value FROM v_clean WHERE annual_salary IS NOT NULL "
        f"GROUP BY 1 ORDER BY mean_value DESC, {by} LIMIT 5)"
    )


for _name, _by in (("G7_top_paying_titles", TITLE), ("G7_top_paying_locations", PLACE)):

    @check(_name, sql(top_mean_sql(_by)))
    def _(spark, sf, by=_by):
        return stats.top_by_mean(cleaned(spark, sf), by)


@check(
    "G8_quartiles_by_group",
    "SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.25), 6) AS q1, "
    "round(quantile_cont(l_extendedprice, 0.5), 6) AS median, round(quantile_cont(l_extendedprice, 0.75), 6) AS q3 "
    "FROM lineitem GROUP BY 1",
)
def _(spark, sf):
    q = quantiles.quartiles(table(spark, sf, "lineitem"), "l_extendedprice", ["l_returnflag"])
    return rounded(q, ["q1", "median", "q3"])


@check("G9_median", "SELECT round(median(o_totalprice), 6) AS median FROM orders")
def _(spark, sf):
    return rounded(quantiles.median(table(spark, sf, "orders"), "o_totalprice"), ["median"])


def box_sql(by: str) -> str:
    return f"""
SELECT {by}, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  min(annual_salary) FILTER (WHERE inside) AS whisker_low, max(annual_salary) FILTER (WHERE inside) AS whisker_high,
  count(*) FILTER (WHERE NOT inside) AS n_fliers, count(*) AS n
FROM (SELECT {by}, annual_salary, q1, median, q3,
        annual_salary BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
      FROM v_clean JOIN (
        SELECT {by}, quantile_cont(annual_salary, 0.25) AS q1, quantile_cont(annual_salary, 0.5) AS median,
          quantile_cont(annual_salary, 0.75) AS q3, count(*) AS c FROM v_clean
        WHERE annual_salary IS NOT NULL GROUP BY 1 ORDER BY c DESC, {by} LIMIT 10) USING ({by})
      WHERE annual_salary IS NOT NULL)
GROUP BY {by}, q1, median, q3"""


for _name, _by in (("G10_box_by_title", TITLE), ("G10_box_by_location", PLACE)):

    @check(_name, sql(box_sql(_by)))
    def _(spark, sf, by=_by):
        return rounded(stats.box_stats(cleaned(spark, sf), by), ["q1", "median", "q3"])


def histogram_sql(source: str, x: str) -> str:
    return f"""
SELECT CAST(b AS INT) AS bin, round(lo + (hi - lo) * (b - 1) / 30, 6) AS bin_low,
  round(lo + (hi - lo) * b / 30, 6) AS bin_high, coalesce(n, 0) AS n
FROM range(1, 31) r(b)
CROSS JOIN (SELECT min({x}) AS lo, max({x}) AS hi FROM {source})
LEFT JOIN (SELECT least(CAST(floor(30.0 * ({x} - lo) / (hi - lo)) AS INT) + 1, 30) AS slot, count(*) AS n
  FROM {source}, (SELECT min({x}) AS lo, max({x}) AS hi FROM {source}) WHERE {x} IS NOT NULL GROUP BY 1) ON slot = b"""


@check("G11_histogram", histogram_sql("orders", "o_totalprice"))
def _(spark, sf):
    return rounded(stats.histogram(table(spark, sf, "orders"), "o_totalprice"), ["bin_low", "bin_high"])


@check("G11_salary_histogram", sql(histogram_sql("v_clean", "annual_salary")))
def _(spark, sf):
    return rounded(stats.histogram(cleaned(spark, sf), "annual_salary"), ["bin_low", "bin_high"])


@check(
    "G12_density",
    sql(
        """
SELECT CAST(g AS INT) AS point, round(lo + (hi - lo) / 199 * g, 6) AS x,
  round(sum(exp(-0.5 * pow((lo + (hi - lo) / 199 * g - annual_salary) / h, 2))) / (m * h * sqrt(2 * pi()))
    * m * (hi - lo) / 30, 6) AS n_scaled
FROM v_clean, range(200) r(g), (SELECT count(annual_salary) AS m, min(annual_salary) AS lo, max(annual_salary) AS hi,
  stddev_samp(annual_salary) * pow(count(annual_salary), -0.2) AS h FROM v_clean)
WHERE annual_salary IS NOT NULL GROUP BY g, lo, hi, h, m"""
    ),
)
def _(spark, sf):
    curve = stats.density(cleaned(spark, sf), "annual_salary")
    return rounded(curve.select("point", "x", "n_scaled"), ["x", "n_scaled"])


@check(
    "G12_density_binned",
    """
WITH v AS (SELECT l_extendedprice AS y FROM lineitem),
s AS (SELECT count(y) AS m, min(y) AS lo, max(y) AS hi, stddev_samp(y) * pow(count(y), -0.2) AS h, (max(y) - min(y)) / 4096 AS d FROM v),
t AS (SELECT (y - lo) / d AS t FROM v, s),
c AS (SELECT least(floor(t), 4095) AS c, count(*) AS w, sum(t - least(floor(t), 4095)) AS r FROM t GROUP BY 1),
e AS (SELECT c AS a, w - r AS w FROM c UNION ALL SELECT c + 1, r FROM c)
SELECT CAST(g AS INT) AS point, round(lo + (hi - lo) / 199 * g, 6) AS x,
  round(sum(w * exp(-0.5 * pow((lo + (hi - lo) / 199 * g - (lo + d * a)) / h, 2))) / (h * sqrt(2 * pi())) * (hi - lo) / 30, 4) AS n_scaled
FROM e, range(200) r(g), s GROUP BY g, lo, hi, h, d""",
)
def _(spark, sf):
    curve = stats.binned_density(table(spark, sf, "lineitem").select("l_extendedprice"), "l_extendedprice")
    return curve.select("point", F.round("x", 6).alias("x"), F.round("n_scaled", 4).alias("n_scaled"))


_COLS = ["l_quantity", "l_extendedprice", "l_discount", "flat"]
_CORR = " UNION ALL ".join(
    f"SELECT {lit(a)} AS x, {lit(b)} AS y, "
    + ("max(CAST(NULL AS DOUBLE))" if "flat" in (a, b) else f"round(corr({a}, {b}), 6)")
    + " AS corr FROM lineitem"
    for a in _COLS for b in _COLS
)


@check("G13_correlation", _CORR)
def _(spark, sf):
    df = table(spark, sf, "lineitem").select(*_COLS[:3], F.lit(1.0).alias("flat"))
    return rounded(stats.correlation(df, _COLS), ["corr"])


_PAIRED = ["python", "java", "sql", "go", "terraform", "networking", "rest", "cobol"]


def _indicator(s):
    return f"CAST(list_contains(skills, {lit(s)}) AS INT)"


@check(
    "G13_skill_correlation",
    sql(
        " UNION ALL ".join(
            f"SELECT {lit(a)} AS x, {lit(b)} AS y, round(corr({_indicator(a)}, "
            + ("annual_salary" if b == "annual_salary" else _indicator(b))
            + "), 6) AS corr FROM v_skills"
            for a in _PAIRED[:-1] for b in [*_PAIRED[:-1], "annual_salary"]
        )
    ),
)
def _(spark, sf):
    return rounded(stats.skill_correlation(skilled(spark, sf), _PAIRED[:-1]), ["corr"])


@check("G14_rows_per_search_term", sql("SELECT search_term, count(*) AS n FROM v_postings GROUP BY 1"))
def _(spark, sf):
    return postings(spark, sf).groupBy("search_term").agg(F.count(F.lit(1)).alias("n"))


@check(
    "G15_outlier_count",
    "SELECT count(*) AS n_outliers FROM (SELECT l_extendedprice * l_discount AS s FROM lineitem), "
    "(SELECT quantile_cont(l_extendedprice * l_discount, 0.25) AS q1, "
    "quantile_cont(l_extendedprice * l_discount, 0.75) AS q3 FROM lineitem) "
    "WHERE s < q1 - 1.5 * (q3 - q1) OR s > q3 + 1.5 * (q3 - q1)",
)
def _(spark, sf):
    df = table(spark, sf, "lineitem").select((F.col("l_extendedprice") * F.col("l_discount")).alias("s"))
    return stats.count_outliers(df, "s")


@check("G16_value_range", sql("SELECT min(annual_salary) AS low, max(annual_salary) AS high FROM v_clean"))
def _(spark, sf):
    return stats.value_range(cleaned(spark, sf), "annual_salary")


_USERS = [f"u{i}" for i in range(30)]


def _event_cells(spark, sf):
    return table(spark, sf, "events").select(
        "event_type", F.concat(F.lit("u"), (F.col("user_id") % 30).cast("string")).alias("item"),
        F.col("value").cast("decimal(18,4)").alias("value"),
    )


_CELLS = "(SELECT event_type, 'u' || CAST(user_id % 30 AS VARCHAR) AS item, CAST(value AS DECIMAL(18,4)) AS value FROM events)"


@check(
    "G17_matrix",
    "SELECT event_type, "
    + ", ".join(f"coalesce(CAST(sum(value) FILTER (WHERE item = {lit(u)}) AS DOUBLE), 0.0) AS {u}" for u in _USERS)
    + f" FROM {_CELLS} GROUP BY 1",
)
def _(spark, sf):
    wide = stats.matrix(_event_cells(spark, sf), "event_type", "item", "value", _USERS)
    return wide.select("event_type", *[F.col(u).cast("double").alias(u) for u in _USERS])


@check(
    "G18_top_items_by_total",
    f"SELECT item, round(CAST(sum(value) AS DOUBLE), 6) AS total FROM {_CELLS} GROUP BY 1 ORDER BY total DESC, item LIMIT 20",
)
def _(spark, sf):
    top = stats.top_skills_by_total(_event_cells(spark, sf), "item", "value", 20)
    return top.withColumn("total", F.col("total").cast("double"))


@check("G19_roles_by_appearance", sql(f"SELECT {TITLE}, min(seq) AS first_seq FROM v_clean GROUP BY 1"))
def _(spark, sf):
    return stats.roles_by_appearance(cleaned(spark, sf), TITLE, "seq")


@check(
    "G20_roles_with_enough_rows",
    sql(f"SELECT {TITLE}, count(annual_salary) AS n_known FROM v_clean GROUP BY 1 HAVING count(annual_salary) >= 1000"),
)
def _(spark, sf):
    return stats.roles_with_enough(cleaned(spark, sf), TITLE, "annual_salary", 1000)


# ---- windows, order, samples, sets ---------------------------------------

@check(
    "W1_group_median_on_rows",
    "SELECT l_orderkey, l_linenumber, round(median(l_extendedprice) OVER (PARTITION BY l_returnflag), 6) AS median FROM lineitem",
)
def _(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    medians = quantiles.median(df, "l_extendedprice", ["l_returnflag"])
    return rounded(df.join(medians, "l_returnflag").select("l_orderkey", "l_linenumber", "median"), ["median"])


@check(
    "W2_numbered_head",
    "SELECT CAST(row_number() OVER (ORDER BY mean_value DESC, o_orderpriority) AS INT) AS rank, o_orderpriority, mean_value FROM ("
    f"SELECT o_orderpriority, {sql_mean('o_totalprice')} AS mean_value FROM orders GROUP BY 1 "
    "ORDER BY mean_value DESC, o_orderpriority LIMIT 3)",
)
def _(spark, sf):
    return stats.top_by_mean(table(spark, sf, "orders"), "o_orderpriority", "o_totalprice", 3)


@check("T1_sorted_means", sql(f"SELECT {PLACE}, {sql_mean('annual_salary')} AS mean_value, count(*) AS n FROM v_clean WHERE annual_salary IS NOT NULL GROUP BY 1 ORDER BY mean_value DESC, 1"))
def _(spark, sf):
    return stats.group_mean(cleaned(spark, sf), PLACE).orderBy(F.desc("mean_value"), PLACE)


@check("T2_top_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return sampling.top_rows(df, "o_totalprice", "o_orderkey", 20)


@check(
    "T3_random_rows",
    sql("SELECT posting_id, annual_salary FROM v_clean WHERE annual_salary IS NOT NULL ORDER BY md5(CAST(posting_id AS VARCHAR) || '|7'), posting_id LIMIT 100"),
)
def _(spark, sf):
    df = clean.drop_null_target(cleaned(spark, sf)).select("posting_id", "annual_salary")
    return sampling.random_rows(df, "posting_id", rules.SCATTER_SAMPLE, 7)


@check(
    "T4_shuffled_terms",
    sql("SELECT search_term, md5(search_term || '|7') AS place, count(*) AS n FROM v_postings GROUP BY 1 ORDER BY 2"),
)
def _(spark, sf):
    terms = postings(spark, sf).groupBy("search_term").agg(F.count(F.lit(1)).alias("n"))
    placed = terms.withColumn("place", split_digest(F.col("search_term"), 7))
    return sampling.shuffled(placed, "search_term", 7).select("search_term", "place", "n")


@check(
    "U2_union_of_lists",
    sql("SELECT array_to_string(list_sort(list_distinct(flatten(list(skills)))), ',') AS all_skills FROM v_skills"),
)
def _(spark, sf):
    seen = skills.observed_skills(skilled(spark, sf))
    return seen.agg(F.array_join(F.sort_array(F.collect_list("skill")), ",").alias("all_skills"))
