"""Queries write only the steps they read again, and salary texts are searched once."""

import pytest
from pyspark.sql import functions as F

from wagelens.checks import base, catalog
from wagelens.functions import text


@pytest.fixture
def written(monkeypatch):
    """The steps written since, by name."""
    steps = {}
    monkeypatch.setattr(base, "_STAGED", steps)
    return lambda: sorted(name for _, _, name in steps)


def sorted_rows(df):
    return sorted(map(tuple, df.collect()))


def test_a_lookup_writes_no_table(spark, small, written):
    query = catalog.queries()["J6_keyed_assignment"]
    found = sorted_rows(query(spark, small))
    assert written() == []
    base.skilled(spark, small)
    assert found == sorted_rows(query(spark, small)) and written() == ["postings_clean"]


def test_metrics_write_only_what_they_read(spark, small, written):
    query = catalog.queries()["M8_metrics"]
    found = sorted_rows(query(spark, small))
    assert written() == ["postings_scored"]
    scored = base.staged(spark, small, "postings_scored", None)
    assert "description" not in scored.columns
    whole = base.skilled(spark, small).select(*scored.columns)
    assert whole.exceptAll(scored).count() == 0 and scored.exceptAll(whole).count() == 0
    assert found == sorted_rows(query(spark, small))


def test_clean_postings_are_the_same_from_written_ones(spark, small, written):
    direct = base.skilled_from_text(spark, small)
    base.postings(spark, small)
    again = base.skilled_from_text(spark, small)
    assert direct.exceptAll(again).count() == 0 and again.exceptAll(direct).count() == 0


def test_a_salary_text_is_searched_once(spark):
    data = [("$1,000 to 3k",), ("12.5 hourly",), ("none",), ("Not specified",), (None,), ("7",), ("1 2 3",)]
    df = spark.createDataFrame(data, "salary string").select(text.salary_value(F.col("salary")).alias("v"))
    assert [r.v for r in df.collect()] == [2000.0, 12.5, None, None, None, 7.0, 1.5]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
