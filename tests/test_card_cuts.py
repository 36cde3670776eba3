"""Elements cut out by plain names are those that the patterns find; costly columns are computed once."""

import random

from pyspark.sql import functions as F

from wagelens.checks import catalog
from wagelens.operators.layout import settled
from wagelens.sources import html

PARTS = ['<p class="card">', '<p class="a card b" id="J1">', '<b class="x" title="card">', "<i>", "</i>", "</p>", "card", ' card "', '"', "<", ">", "<p ", 'class="', 'class="a < card"',
         "<br/>", '<p class="cards">', '<p class="a\ncard\t">', "é😀", "\n", " ", '<p class="card card">', "</P>", "<p>", '<P class="card"/>', "<input class='card'>", '<input class="card">']


def _pages(spark):
    draw = random.Random(5)
    pages = ["", None, "card", '<p class="card', '<p class="a <b card" class="card">c', '<p class="card">x</p>' * 3]
    pages += ["".join(draw.choices(PARTS, k=draw.randint(1, 9))) for _ in range(4_000)]
    return spark.createDataFrame(list(enumerate(pages)), "n int, html string")


def test_elements_are_those_of_the_pattern(spark):
    start = html.opening_tag("card")
    df = html._with_elements(_pages(spark), "html", {"a": "card"}).withColumn("b", html._from(F.col("html"), start))
    rows = df.select("a", "b").collect()
    assert all(r.a == r.b for r in rows) and sum(r.a is not None for r in rows) > 500


def test_pieces_are_those_of_the_pattern(spark):
    start = html.opening_tag("card")
    split = F.filter(F.split("html", f"(?={start})"), lambda piece: piece.rlike(f"^{start}"))
    rows = _pages(spark).select(html._each(F.col("html"), "card").alias("a"), split.alias("b")).collect()
    assert all(r.a == r.b for r in rows) and sum(len(r.a or []) > 1 for r in rows) > 100


def test_contents_are_those_of_the_pattern(spark):
    df = html._with_elements(_pages(spark), "html", {"e": "card"}).where("e is not null")
    e = F.col("e")
    closing = F.concat(F.lit("</"), F.regexp_extract(e, r"^<(\w+)", 1), F.lit(">"))
    plain = F.when(F.instr(e, closing) > 0, F.regexp_replace(F.substring_index(e, "</p>", 1), "^<[^<>]*>", ""))
    df = df.withColumns({"was": plain, "balanced": html.balanced(e), "flat": e, "deep": e, "one": html._up_to_closing(e)}).where("e like '<p%'")
    rows = html._with_contents(html._with_contents(df, ["flat"]), ["deep"], nested=True).collect()
    assert all(r.flat == r.was and r.one == r.was and r.deep == r.balanced for r in rows) and sum(r.was is not None for r in rows) > 200


def test_filters_stay_after_costly_columns(spark, small):
    found = settled(spark.range(10).select("id", F.md5(F.col("id").cast("string")).alias("h"), F.lit(1).alias("unused")))
    plan = found.where("h > '8'").select("h")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1 and "unused" not in plan
    assert sorted(found.collect()) == sorted(spark.range(10).select("id", F.md5(F.col("id").cast("string")), F.lit(1)).collect())
    for name, part in (("X4_salary_tag", "annually"), ("X3_company_in_text", "company-name, 1"), ("X9_harvest", "sc-jv5lm6-13, 1")):
        plan = catalog.queries()[name](spark, small)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count(part) == 1, name


def test_helper_columns_take_no_names_of_the_pages(spark):
    pages = spark.createDataFrame([(1, 2, 3, '<p class="card" id="J"><b class="t">x</b></p>')], "_id int, _title int, _row int, html string")
    found = html.extract_cards(pages, "html", html.BoardLayout(sentinel="", card_class="card", field_classes={"title": "t"}))
    assert found.select("_id", "_title", "_row", "title", "job_id").collect() == [(1, 2, 3, "x", "J")]
