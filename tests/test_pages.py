"""Nested cards, hidden texts and links against a parser, and hostile markup."""

import random
import time
from html import unescape
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from wagelens.sources import html

BOARD = html.BoardLayout(sentinel="", card_class="card", field_classes={"title": "t", "place": "p"})
VOID = set(html.VOID_TAGS)


class Reader(HTMLParser):
    """Cards and fields of well-formed markup, with a stack."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.cards, self.shown = [], [], ""

    def handle_starttag(self, tag, attrs):
        given = dict(attrs)
        classes = (given.get("class") or "").split()
        mark = None
        if "card" in classes:
            mark = "card"
            self.cards.append({"job_id": given.get("id")})
        elif any(m == "card" for _, m, _ in self.open):
            mark = next((f for f, c in BOARD.field_classes.items() if c in classes and f not in self.cards[-1]), None)
            if mark:
                self.cards[-1][mark] = ""
                if given.get("href"):
                    self.cards[-1].setdefault("url", given["href"])
        style = (given.get("style") or "").replace(" ", "")
        hides = "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style
        if tag not in VOID:
            self.open.append((tag, mark, hides))

    def handle_endtag(self, tag):
        if tag not in VOID:
            assert self.open.pop()[0] == tag

    def handle_data(self, data):
        if not any(h for *_, h in self.open):
            self.shown += data
        for _, mark, _ in self.open:
            if mark not in (None, "card"):
                self.cards[-1][mark] += data


def tree(draw, depth, cards=True):
    """Well-formed markup; cards do not hold cards."""
    out = []
    for _ in range(draw.randint(0, 4)):
        kind = draw.random()
        if kind < 0.3 or depth == 0:
            out.append(draw.choice(["text ", "a &amp; b", " ", "say <br> so", "é", "<!-- <div class='t'> -->", "x<img class=\"q\">"]))
            continue
        tag = draw.choice(["div", "div", "span", "a", "p", "DIV"])
        attrs = draw.choice(["", "", ' class="t"', ' class="x t y"', ' class="p"', ' class="tt"', ' href="/h" class="p"', " hidden", ' style="display: none"', ' aria-hidden="true"', ' title="hidden one"', ' class="a hidden b"'])
        own = cards and kind > 0.8
        if own:
            attrs = f' class="card z" id="J{draw.randint(1, 99)}"'
        out.append(f"<{tag}{attrs}>{tree(draw, depth - 1, cards and not own)}</{tag}>")
    return "".join(out)


def test_cards_equal_a_parser(spark):
    draw = random.Random(11)
    pages = [(i, tree(draw, 5)) for i in range(1_500)]
    got = {}
    for r in html.extract_nested_cards(spark.createDataFrame(pages, "page_id int, html string"), "page_id", "html", BOARD).collect():
        got.setdefault(r.page_id, []).append((r.card_no, r.job_id, r.url, r.title, r.place))
    n = 0
    for i, markup in pages:
        reader = Reader()
        reader.feed(markup)
        reader.close()
        want = [(k, *((c.get(f) or "").strip() or None for f in ("job_id", "url", "title", "place"))) for k, c in enumerate(reader.cards)]
        assert sorted(got.get(i, [])) == want, markup
        n += sum(c[3] is not None for c in want)
    assert n > 300


def test_text_in_view_equals_a_parser(spark):
    draw = random.Random(12)
    pages = []
    for i in range(1_500):
        markup = tree(draw, 5, cards=False)
        at = draw.choice([k for k in range(len(markup) + 1) if k == 0 or markup[k - 1] == ">" and not markup.startswith("-->", k - 3)])
        pages.append((i, markup[:at] + "<b>NOTHING</b>" + markup[at:]))
    shown = spark.createDataFrame(pages, "page_id int, html string").select("page_id", html.shows(F.col("html"), "<b>NOTHING").alias("shown"))
    got = {r.page_id: r.shown for r in shown.collect()}
    seen = 0
    for i, markup in pages:
        reader = Reader()
        reader.feed(markup)
        reader.close()
        assert got[i] == ("NOTHING" in reader.shown), markup
        seen += got[i]
    assert 300 < seen < 1_490


@pytest.mark.parametrize(
    ("markup", "said"),
    [
        ("<div>No jobs found</div>", True), ("<div hidden>No jobs found</div>", False), ("<div hidden><div>x</div><div>No jobs found</div></div>", False),
        ("<div hidden><div>x</div></div><div>No jobs found</div>", True), ('<p style="visibility :hidden"><div>No Results Found</div></p>', False),
        ("<img hidden><div>No jobs found</div>", True), ("<div hidden><p hidden>x</div><div>No jobs found</div>", True),
        ('<input type="hidden" value="a"><div>No jobs found</div>', True), ("<section HIDDEN=''><div>No jobs found</div>", False),
        ("<!--<div>No jobs found</div>", False), ("", False), (None, None), ("<div hidden/><div>No jobs found</div>", True),
    ],
)
def test_no_results_in_view(spark, markup, said):
    card = '<article class="card"></article>'
    page = None if markup is None else card + markup
    df = spark.createDataFrame([(page,)], "html string")
    assert df.select(html.has_no_results(F.col("html"), BOARD).alias("x")).first().x == said


def test_unclosed_and_crossing_elements(spark):
    pages = [
        (1, '<div class="card" id="a"><b class="t">one <i>two</b> three<div class="card" id="b"><b class="t">four</div> five'),
        (2, '<div class="card"><a class="t" href="/x"/><span class="p">q</span></div><span class="t">out</span>'),
        (3, '<div class="card"><div class="t">x<DIV>y</DIV>z</div>w</div>'), (4, None), (5, ""),
    ]
    rows = html.extract_nested_cards(spark.createDataFrame(pages, "page_id int, html string"), "page_id", "html", BOARD).collect()
    assert sorted((r.page_id, r.card_no, r.title or "", r.place or "", r.url or "") for r in rows) == [
        (1, 0, "one two", "", ""), (1, 1, "four", "", ""), (2, 0, "", "q", "/x"), (3, 0, "xyz", "", ""),
    ]


def test_hostile_markup_is_linear(spark):
    n = 60_000
    pages = ["<b>" * n, "<a href=x>" * n, '<div class="card">' * (n // 10), "<!--" * n, '<div class="card">' + "<b class='t'>" * n, "<" * n, "<a " * n, "</a>" * n, '<p class="' * n]
    pages += ['<div class="card"><b class="t">' + "<b>" * n, "<div hidden>" * (n // 4), "<li>" * n + "<a>x</a>", '<p class="card">' + "<span class=\"t\">x" * (n // 4)]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id int, html string").repartition(8)
    start = time.perf_counter()
    html.extract_nested_cards(df, "page_id", "html", BOARD).count()
    html.extract_cards(df, "html", html.BoardLayout(sentinel="", card_class="card", field_classes={"title": "t"}, tag_class="p")).collect()
    html.page_links(df, "page_id", "html").count()
    df.select(html.has_no_results(F.col("html"), BOARD)).collect()
    assert time.perf_counter() - start < 60


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "x")], "page_id int, html string")
    plan = html.extract_nested_cards(df, "page_id", "html", BOARD)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_entities():
    assert all(unescape(e) == c or e == "&nbsp;" for e, c in html.ENTITIES)


def test_markup_from_a_tag_on_is_that_of_a_split(spark):
    start = html.opening_tag("card")
    pages = ["", "x", None, '<p class="card">a\n<p class="b card">😀b', 'x<p class="card">', '😀<p class="a <b card" class="card">c']
    df = spark.createDataFrame([(p,) for p in pages], "html string")
    after = df.select(html._from(F.col("html"), start).alias("a"), F.get(F.split(F.concat(F.lit(" "), "html"), f"(?={start})", 2), F.lit(1)).alias("b"))
    assert all(r.a == r.b for r in after.collect())
    # a split compiles its pattern anew for every value
    assert "split(" not in after.select("a")._jdf.queryExecution().optimizedPlan().toString()


def test_hidden_elements_are_looked_for_only_where_the_text_is(spark):
    df = spark.createDataFrame([('<article class="card"></article><div>No <!-- x -->jobs found</div>',)], "html string")
    said = df.select(html.has_no_results(F.col("html"), BOARD).alias("x"))
    assert said.first().x
    plan = said._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("RLIKE") < plan.index("aggregate(")
