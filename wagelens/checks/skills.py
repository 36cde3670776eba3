"""Checks of skill extraction and what is counted from it."""

from __future__ import annotations

from pyspark.sql import functions as F

from wagelens import rules
from wagelens.checks.base import check, cleaned, lit, skilled, skilled_from_text, sql, sql_list, sql_skills, text_table
from wagelens.operators import skills, stats


def joined(column="skills"):
    return F.array_join(column, ",").alias(column)


@check(
    "K1_skills_in_postings",
    sql("SELECT posting_id, array_to_string(named, ',') AS skills FROM v_named"),
)
def _(spark, sf):
    return skills.with_skills(cleaned(spark, sf), fallback=False).select("posting_id", joined())


@check(
    "K1_skills_in_documents",
    f"SELECT doc_id, array_to_string({sql_skills('t')}, ',') AS skills FROM (SELECT doc_id, lower(text) AS t FROM documents)",
)
def _(spark, sf):
    df = skills.with_skills(text_table(spark, sf, "documents", "doc_id", "text"), "text", fallback=False)
    return df.select("doc_id", joined())


# words that the documents hold, some of them as phrases
WORDS = ["the", "and", "la", "der", "rest", "ai", "of the", "les", "und", "que", "ñ", "éreau", "c++"]


@check(
    "K1_words_in_documents",
    f"SELECT doc_id, array_to_string({sql_skills('t', WORDS)}, ',') AS skills FROM (SELECT doc_id, lower(text) AS t FROM documents)",
)
def _(spark, sf):
    df = skills.with_skills(text_table(spark, sf, "documents", "doc_id", "text"), "text", vocabulary=WORDS, fallback=False)
    return df.select("doc_id", joined())


@check("K2_fallback_skills", sql("SELECT posting_id, array_to_string(skills, ',') AS skills, skill_origin FROM v_skills"))
def _(spark, sf):
    return skilled_from_text(spark, sf).select("posting_id", joined(), "skill_origin")


@check("K3_observed_skills", sql("SELECT DISTINCT unnest(skills) AS skill FROM v_skills"))
def _(spark, sf):
    return skills.observed_skills(skilled(spark, sf))


_OBSERVED = "python java javascript html css sql aws docker kubernetes k8s ci/cd terraform react go .net".split()


@check(
    "K4_skill_indicators",
    sql(
        "SELECT posting_id, "
        + ", ".join(f"CAST(list_contains(skills, {lit(s)}) AS INT) AS {skills.indicator_name(s)}" for s in _OBSERVED)
        + " FROM v_skills"
    ),
)
def _(spark, sf):
    df = skilled(spark, sf)
    seen = [s for s in skills.observed_list(df) if s in _OBSERVED]
    wide = skills.with_indicators(df, seen)
    return wide.select("posting_id", *[skills.indicator_name(s) for s in _OBSERVED])


_ARMS = " ".join(f"WHEN {lit(t)} THEN {sql_list(s)}" for t, s in rules.DEFAULT_SKILLS_BY_TITLE.items())


@check(
    "K5_skills_by_title",
    sql(
        f"SELECT posting_id, coalesce(array_to_string(CASE standardized_title {_ARMS} END, ','), '') AS skills, "
        f"CASE WHEN standardized_title IN ({', '.join(lit(t) for t in rules.DEFAULT_SKILLS_BY_TITLE)}) "
        "THEN 'title_default' ELSE 'none' END AS skill_origin FROM v_clean"
    ),
)
def _(spark, sf):
    bare = cleaned(spark, sf).withColumn("description", F.lit(""))
    df = skills.with_title_defaults(skills.with_skills(bare))
    return df.select("posting_id", joined(), "skill_origin")


@check("K5_not_used_when_named", sql("SELECT posting_id, array_to_string(skills, ',') AS skills, skill_origin FROM v_skills"))
def _(spark, sf):
    return skills.with_title_defaults(skilled(spark, sf)).select("posting_id", joined(), "skill_origin")


@check(
    "K6_list_from_indicators",
    sql(
        "SELECT posting_id, array_to_string(list_filter("
        + sql_list(_OBSERVED)
        + ", lambda s: list_contains(skills, s)), ',') AS skills FROM v_skills"
    ),
)
def _(spark, sf):
    wide = skills.with_indicators(skilled(spark, sf), _OBSERVED)
    return skills.skills_from_indicators(wide, _OBSERVED).select("posting_id", joined())


@check("K7_skill_frequency", sql("SELECT skill, count(*) AS n FROM (SELECT unnest(skills) AS skill FROM v_skills) GROUP BY 1"))
def _(spark, sf):
    return skills.skill_frequency(skilled(spark, sf))


@check(
    "K7_word_frequency",
    sql(
        "SELECT skill, count(*) AS n FROM (SELECT unnest(string_split(skill, ' ')) AS skill FROM "
        "(SELECT unnest(skills) AS skill FROM v_skills)) GROUP BY 1"
    ),
)
def _(spark, sf):
    return skills.skill_frequency(skilled(spark, sf), words=True)


def _demand_sql(by):
    return (
        f"SELECT {by}, skill, n, CAST(row_number() OVER (PARTITION BY {by} ORDER BY n DESC, skill) AS INT) AS rank "
        f"FROM (SELECT {by}, skill, count(*) AS n FROM (SELECT {by}, unnest(skills) AS skill FROM v_skills) GROUP BY ALL)"
    )


@check("K8_skill_demand_by_title", sql(_demand_sql("standardized_title")))
def _(spark, sf):
    return skills.skill_demand(skilled(spark, sf))


@check("K9_skill_demand_by_location", sql(_demand_sql("standardized_location")))
def _(spark, sf):
    return skills.skill_demand(skilled(spark, sf), "standardized_location")


_PIVOT = ["python", "java", "sql", "html", "networking", "docker"]


@check(
    "G17_role_skill_matrix",
    sql(
        "SELECT standardized_title, "
        + ", ".join(f"CAST(count(*) FILTER (WHERE skill = {lit(s)}) AS BIGINT) AS {s}" for s in _PIVOT)
        + f" FROM (SELECT standardized_title, unnest(skills) AS skill FROM v_skills) WHERE skill IN ({', '.join(map(lit, _PIVOT))}) GROUP BY 1"
    ),
)
def _(spark, sf):
    demand = skills.skill_demand(skilled(spark, sf))
    return stats.matrix(demand, "standardized_title", "skill", "n", _PIVOT).na.fill(0)


@check(
    "G18_top_skills",
    sql("SELECT skill, count(*) AS total FROM (SELECT unnest(skills) AS skill FROM v_skills) GROUP BY 1 ORDER BY total DESC, skill LIMIT 20"),
)
def _(spark, sf):
    return stats.top_skills_by_total(skills.skill_frequency(skilled(spark, sf)), "skill", "n", 20)
