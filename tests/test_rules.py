"""Cleaning rules against values worked out by hand."""

import pytest
from pyspark.sql import functions as F

from wagelens.functions import text
from wagelens.operators import clean, skills

TITLES = [
    ("Senior Software Engineer", "software engineer"), ("Data Scientist", "data scientist"),
    ("ML Engineer", "machine learning engineer"), ("Site Reliability (SRE)", "devops engineer"),
    ("Front-End Developer", "frontend engineer"), ("Linux Administrator", "ux/ui designer"),
    ("Audit Specialist", "it support specialist"), ("Cloud Security Engineer", "security engineer"),
    ("Systems Analyst", "system administrator"), ("Cloud Engineer", "cloud engineer"),
    ("Maintenance Technician", "ai engineer"), ("Chef", "other"), (None, "other"),
]
LOCATIONS = [
    ("San Francisco, CA", "CA"), ("Austin,TX", "TX"), ("USA", "US"), ("U.S.", "US"),
    ("Washington DC, VA", "DC"), ("United Kingdom", "UK"), ("Remote", "Remote"),
    ("Berlin Germany", "Germany"), ("IT Center", "IT"), ("Location Negotiable", "Other"), (None, "Other"),
]
# text, value, period, yearly in reference mode; value and yearly corrected
SALARIES = [
    ("$90,000 to $110,000 per year", 100000.0, "Annually", 100000.0, 100000.0, 100000.0),
    ("$50 hourly", 50.0, "Hourly", 104000.0, 50.0, 104000.0),
    ("$4000 per month", 4000.0, "Monthly", 48000.0, 4000.0, 48000.0),
    ("300 per day", 300.0, "Daily", 78000.0, 300.0, 78000.0),
    ("Not specified", None, "Unknown", None, None, None),
    ("Not Provided", None, "Unknown", None, None, None),
    (None, None, "Unknown", None, None, None),
    ("USD , 60,000 annually", 60000.0, "Annually", 60000.0, 60000.0, 60000.0),
    ("$45.50 hourly", 47.5, "Hourly", 98800.0, 45.5, 94640.0),
    ("$1,000 weekly", 1000.0, "Unknown", 1000.0, 1000.0, 1000.0),
    ("120K per year", 120.0, "Annually", 120.0, 120000.0, 120000.0),
    ("$90k - $110k a year", 100.0, "Annually", 100.0, 100000.0, 100000.0),
    ("to be agreed", None, "Unknown", None, None, None),
]
SKILLS = [
    ("Python, SQL and Spark on AWS", ["python", "sql", "aws", "spark"], "matched"),
    ("We use C++ and C#", [], "none"),
    ("c++17 and c#x", ["c++", "c#"], "matched"),
    ("asp.net developer", [".net"], "matched"),
    ("software wizard", ["java", "python", "javascript"], "fallback"),
    ("data  Science", ["python", "r", "machine learning", "sql"], "fallback"),
    ("data engineering", ["sql", "python", "spark", "aws"], "fallback"),
    ("cybersecurity", ["security", "encryption", "firewall"], "fallback"),
    ("ready to go", ["go"], "matched"), ("R&D", ["r"], "matched"), ("üsql", [], "none"),
    ("", [], "none"), (None, [], "none"),
]


def columns(df, *names):
    return [tuple(r[n] for n in names) for r in df.orderBy("i").collect()]


def frame(spark, values, name):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} string")


def test_titles(spark):
    df = clean.clean_postings(frame(spark, [t for t, _ in TITLES], "title"))
    assert columns(df, "standardized_title") == [(c,) for _, c in TITLES]


def test_titles_by_whole_words(spark):
    df = clean.clean_postings(frame(spark, ["Linux Administrator", "UX Lead", "Trainer", "AI Lead"], "title"), word_boundary=True)
    assert columns(df, "standardized_title") == [("other",), ("ux/ui designer",), ("other",), ("ai engineer",)]


def test_locations(spark):
    df = clean.clean_postings(frame(spark, [t for t, _ in LOCATIONS], "location"))
    assert columns(df, "standardized_location") == [(c,) for _, c in LOCATIONS]


@pytest.mark.parametrize("reference", [True, False])
def test_salaries(spark, reference):
    df = clean.clean_postings(frame(spark, [s[0] for s in SALARIES], "salary"), reference_mode=reference)
    want = [(s[1], s[2], s[3]) if reference else (s[4], s[2], s[5]) for s in SALARIES]
    assert columns(df, "salary_value", "salary_period", "annual_salary") == want


def test_skills(spark):
    df = skills.with_skills(frame(spark, [s[0] for s in SKILLS], "description"))
    assert columns(df, "skills", "skill_origin") == [(s[1], s[2]) for s in SKILLS]


def test_slugs_are_distinct():
    names = [skills.indicator_name(s) for s in skills.known_skills()]
    assert len(set(names)) == len(names)
    assert all(n.replace("_", "").isalnum() for n in names)


def test_missing_texts_become_null(spark):
    df = clean.normalise_missing(frame(spark, ["NA", " Not specified ", "x ", "", None], "salary"))
    assert columns(df, "salary") == [(None,), (None,), ("x",), (None,), (None,)]


def test_jitter_is_fixed_by_key(spark):
    df = frame(spark, ["a", "b", "c"], "k").withColumn("u", text.hash_unit(F.col("k"), 1))
    first = columns(df, "u")
    assert first == columns(df.repartition(7), "u")
    assert all(0 <= u < 1 for (u,) in first) and len(set(first)) == 3
