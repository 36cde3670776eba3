"""Skill lists of postings and what is counted from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wagelens import rules
from wagelens.functions import text


def with_skills(
    df: DataFrame, source: str = "description", vocabulary: list[str] | None = None,
    fallback: bool = True,
) -> DataFrame:
    """Add ``skills`` (vocabulary order) and ``skill_origin``.

    The text is lowered in a projection of its own: all patterns then share it.
    """
    lowered = df.withColumn("_text", F.lower(F.coalesce(F.col(source), F.lit(""))))
    found = lowered.withColumn("skills", text.matched_skills(F.col("_text"), vocabulary))
    named = F.size("skills") > 0
    if not fallback:
        origin = F.when(named, F.lit("matched")).otherwise(F.lit("none"))
        return found.withColumn("skill_origin", origin).drop("_text")
    assumed = found.withColumn(
        "_assumed", F.when(~named, text.fallback_skills(F.col("_text"))).otherwise(text.text_array([]))
    )
    origin = (
        F.when(named, F.lit("matched"))
        .when(F.size("_assumed") > 0, F.lit("fallback"))
        .otherwise(F.lit("none"))
    )
    return assumed.withColumns(
        {"skills": F.when(named, F.col("skills")).otherwise(F.col("_assumed")), "skill_origin": origin}
    ).drop("_text", "_assumed")


def observed_skills(df: DataFrame) -> DataFrame:
    """Distinct skills over all postings; at most as many rows as known skills."""
    return df.select(F.explode("skills").alias("skill")).distinct()


def known_skills() -> list[str]:
    """Every skill any rule can produce, in a fixed order."""
    extra = [s for _, skills in rules.FALLBACK_SKILLS for s in skills]
    extra += [s for skills in rules.DEFAULT_SKILLS_BY_TITLE.values() for s in skills]
    return list(dict.fromkeys(rules.SKILLS + extra))


def observed_list(df: DataFrame) -> list[str]:
    """The observed skills as a sorted list; bounded by the vocabulary."""
    return sorted(row["skill"] for row in observed_skills(df).collect())


def indicator_name(skill: str) -> str:
    return f"has_{text.slug(skill)}"


def with_indicators(df: DataFrame, skills: list[str]) -> DataFrame:
    """One 0/1 column per skill."""
    flags = {indicator_name(s): F.array_contains("skills", s).cast("int") for s in skills}
    return df.withColumns(flags) if flags else df


def skill_dictionary(spark: SparkSession, skills: list[str] | None = None) -> DataFrame:
    """(slug, skill) pairs, to turn column names back into skills."""
    skills = known_skills() if skills is None else skills
    return spark.createDataFrame([(indicator_name(s), s) for s in skills], "slug string, skill string")


def skills_from_indicators(df: DataFrame, skills: list[str]) -> DataFrame:
    """Rebuild the list from the 0/1 columns, in the order given."""
    flags = [F.when(F.col(indicator_name(s)) == 1, F.lit(s)) for s in skills]
    return df.withColumn("skills", F.array_compact(F.array(*flags)) if flags else text.text_array([]))


def with_title_defaults(df: DataFrame) -> DataFrame:
    """Default skills by title, used only when no posting names any skill.

    Whether any does is a one-row subquery, decided while the job runs.
    """
    any_named = df.agg(F.max(F.size("skills")).alias("most")).select(F.coalesce("most", F.lit(0))).scalar()
    cases = [(F.col("standardized_title") == t, text.text_array(s)) for t, s in rules.DEFAULT_SKILLS_BY_TITLE.items()]
    default = text.first_match(cases, text.text_array([]))
    origin = F.when((any_named == 0) & (F.size(default) > 0), F.lit("title_default")).otherwise(F.col("skill_origin"))
    return df.withColumns(
        {"skills": F.when(any_named == 0, default).otherwise(F.col("skills")), "skill_origin": origin}
    )


def skill_frequency(df: DataFrame, words: bool = False) -> DataFrame:
    """Rows per skill, or per single word of the skill names."""
    items = df.select(F.explode("skills").alias("skill"))
    if words:
        items = items.select(F.explode(F.split("skill", " ")).alias("skill"))
    return items.groupBy("skill").agg(F.count(F.lit(1)).alias("n"))


def skill_demand(df: DataFrame, by: str = "standardized_title") -> DataFrame:
    """Rows per (group, skill) with the rank of the skill inside its group.

    The ranking window runs over counts: at most one row per known skill in a
    group, however many postings the group has.
    """
    counts = (
        df.select(F.col(by), F.explode("skills").alias("skill"))
        .groupBy(by, "skill")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    order = Window.partitionBy(by).orderBy(F.desc("n"), "skill")
    return counts.withColumn("rank", F.row_number().over(order))
