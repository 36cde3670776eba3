"""CSV folders, result pages and tables."""

import pytest
from pyspark.sql import functions as F

from wagelens.operators import dedup
from wagelens.plans import harvest
from wagelens.sources import csv_folder, html, tables


def test_odd_csv_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('title,url,agency\nDev,u1,A\nOps,u2\nLong,u3,B,extra\n"Q ""x"", y\nz",u4,C\n')
    (tmp_path / "b.csv").write_text("title,company\nDev2,CC\n")
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "d.csv").write_bytes(b"\xff\xfe\x00bad\n")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "e.csv").write_text("title\nhidden\n")
    loaded = csv_folder.load_folder(spark, str(tmp_path))
    rows = {r["title"]: r for r in loaded.rows.collect()}
    assert set(rows) == {"Dev", "Ops", "Dev2", 'Q "x", y\nz'}
    assert rows["Dev2"]["company"] == "CC" and rows["Dev2"]["url"] is None
    assert rows["Ops"]["agency"] is None and rows["Dev"]["source_file"] == "a.csv"
    assert loaded.rows.count() == 4 and "description" in loaded.rows.columns
    assert [r["_corrupt_record"] for r in loaded.corrupt_rows.collect()] == ["Long,u3,B,extra"]
    assert loaded.corrupt_rows.count() == 1
    assert sorted(r["path"][-5:] for r in loaded.load_errors.collect()) == ["c.csv", "d.csv"]


def test_file_names_with_odd_characters(spark, tmp_path):
    (tmp_path / "a b+%20[1]{x}.csv").write_text("title\nDev\n")
    for survey in (False, True):
        loaded = csv_folder.load_folder(spark, str(tmp_path), survey=survey)
        assert [(r["title"], r["source_file"]) for r in loaded.rows.collect()] == [("Dev", "a b+%20[1]{x}.csv")]
    assert loaded.accounts().first()["n_read"] == 1


def test_every_record_of_damaged_files_is_accounted_for(spark, tmp_path):
    sound = 'title,url\n"a, ""b""\nc",u1\n6" pipe,u2\n\nshort\nx,y,z\n'
    files = {
        "sound.csv": sound.encode(),
        "latin.csv": "title,url\nCafé,u1\nBar,u2\nx,y,z\n".encode("latin-1"),
        "cut.csv": b'title,url\nA,u1\n"B\nC",u2\n"cut here,u3\nD,u4\nE,u',  # the last record ends early
        "open_last.csv": b'title,url\nA,u1\nB,"u',
        "nul.csv": b"\xef\xbb\xbftitle,url\r\nA\0,u1\r\nB,u2\r\n",
        "packed.csv": __import__("gzip").compress(sound.encode()),
        "wide.csv": "title,url\nA,u1\n".encode("utf-16"),
        "twice.csv": b"title,title\nA,u1\nB,u2\n",
        "empty.csv": b"",
        "only_header.csv": b"title,url\n",
    }
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    loaded = csv_folder.load_folder(spark, str(tmp_path), survey=True)
    got = {r["source_file"]: r for r in loaded.accounts().collect()}
    assert {n: r["n_bytes"] for n, r in got.items()} == {n: len(c) for n, c in files.items()}
    assert {n: (r["n_records"], r["n_read"], r["n_corrupt"], r["n_unread"], r["reason"]) for n, r in got.items()} == {
        "sound.csv": (4, 3, 1, 0, None), "latin.csv": (3, 1, 2, 0, None), "cut.csv": (5, 4, 1, 0, None),
        "open_last.csv": (2, 1, 1, 0, None), "nul.csv": (2, 1, 1, 0, None), "only_header.csv": (0, 0, 0, 0, None),
        "packed.csv": (None, 0, 0, None, "compressed (gzip)"), "wide.csv": (None, 0, 0, None, "UTF-16"),
        "twice.csv": (2, 0, 0, 2, "repeated column name"), "empty.csv": (0, 0, 0, 0, "no header line"),
    }
    rows = sorted((r["source_file"], r["title"], r["url"]) for r in loaded.rows.fillna("").collect())
    assert rows == [
        ("cut.csv", "A", "u1"), ("cut.csv", "B\nC", "u2"), ("cut.csv", "D", "u4"), ("cut.csv", "E", "u"),
        ("latin.csv", "Bar", "u2"), ("nul.csv", "B", "u2"), ("open_last.csv", "A", "u1"),
        ("sound.csv", '6" pipe', "u2"), ("sound.csv", 'a, "b"\nc', "u1"), ("sound.csv", "short", ""),
    ]
    bad = sorted((r["source_file"], r["_corrupt_record"]) for r in loaded.corrupt_rows.collect())
    assert bad == [("cut.csv", '"cut here,u3'), ("latin.csv", "Caf\ufffd,u1"), ("latin.csv", "x,y,z"),
                   ("nul.csv", "A,u1"), ("open_last.csv", 'B,"u'), ("sound.csv", "x,y,z")]
    assert sorted(r["path"].rsplit("/", 1)[1] for r in loaded.load_errors.collect()) == ["empty.csv", "packed.csv", "twice.csv", "wide.csv"]
    with pytest.raises(ValueError):
        csv_folder.load_folder(spark, str(tmp_path)).accounts()


def test_only_damaged_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"title\nA\n\xff\n")
    loaded = csv_folder.load_folder(spark, str(tmp_path), survey=True)
    assert loaded.rows.count() == 1 and loaded.corrupt_rows.count() == 1


def test_no_readable_csv(spark, tmp_path):
    (tmp_path / "c.csv").write_text("")
    with pytest.raises(ValueError):
        csv_folder.load_folder(spark, str(tmp_path))


def test_output_must_differ_from_input(spark, tmp_path):
    with pytest.raises(ValueError):
        tables.write_table(spark.range(1), str(tmp_path / "t"), source=str(tmp_path / "t") + "/")


FEDERAL = """<html><body><div id="usajobs-search-results">
<div class="usajobs-search-result--core"><h2><a class="usajobs-search-result--core__title" href="/j/1"> IT <b>Specialist</b> &amp; Lead </a></h2>
<p class="usajobs-search-result--core__agency">Agency A</p><div><p class="usajobs-search-result--core__location">Austin, TX</p></div>
<p class="usajobs-search-result--core__salary">$50,000 per year</p></div>
<div class="usajobs-search-result--core"><h2><a class="usajobs-search-result--core__title" href="/j/2">Clerk</a></h2>
<p class="usajobs-search-result--core__closing-date">05/01</p></div>
</div><a class="usajobs-search-pagination__next-page-link is-disabled" href="/n">Next</a></body></html>"""
COMPANY = "<ul>" + "".join(
    f'<li class="jobCard"><a class="jobTitle">T{i}</a><span class="companyName">C</span><span class="jobLocation">L</span></li>'
    for i in range(5)
) + "</ul>"


def test_federal_cards(spark):
    df = spark.createDataFrame([(1, FEDERAL)], "page_id int, html string")
    for rows in (
        html.extract_cards(df, "html", html.FEDERAL_BOARD, missing_as_null=True).orderBy("card_no").collect(),
        html.extract_nested_cards(df, "page_id", "html", html.FEDERAL_BOARD).orderBy("card_no").collect(),
    ):
        assert [(r["title"], r["url"], r["agency"], r["location"], r["salary"], r["closing_date"]) for r in rows] == [
            ("IT Specialist & Lead", "/j/1", "Agency A", "Austin, TX", "$50,000 per year", None),
            ("Clerk", "/j/2", None, None, None, "05/01"),
        ]
    filled = html.extract_cards(df, "html", html.FEDERAL_BOARD).where("card_no = 1").first()
    assert filled["agency"] == filled["salary"] == "Not specified"
    assert html.next_links(html.page_links(df, "page_id", "html"), "page_id").count() == 0


def test_company_cards_are_limited(spark):
    df = spark.createDataFrame([(1, COMPANY)], "page_id int, html string")
    rows = html.extract_cards(df, "html", html.COMPANY_BOARD).collect()
    assert [r["title"] for r in rows] == ["T0", "T1", "T2"] and rows[0]["salary"] == "Not Provided"


def test_next_link_prefers_marked_links(spark):
    pages = [
        (1, '<a href="/a">Next</a><li class="next"><a href="/b">2</a></li>'),
        (2, '<a href="/a">»</a>'),
        (3, '<a href="/a">Next</a><a aria-label="Next Page" class="x disabled" href="/b">2</a>'),
        (4, '<a href="/a">home</a>'),
    ]
    df = spark.createDataFrame(pages, "page_id int, html string")
    links = html.next_links(html.page_links(df, "page_id", "html"), "page_id")
    # page 3 has a marked link, but it is disabled, so there is no next page
    assert {r["page_id"]: r["next_href"] for r in links.collect()} == {1: "/b", 2: "/a"}


def test_harvest_keeps_first_search_term(spark):
    card = '<article class="sc-jv5lm6-0" id="J1"><a class="sc-jv5lm6-13" href="/1">Dev</a></article>'
    pages = [(2, card, "later"), (1, card, "first"), (3, "<div>No jobs found</div>", "none")]
    df = spark.createDataFrame(pages, "page_id int, html string, search_term string")
    rows = harvest.harvest(df, html.REMOTE_BOARD).collect()
    assert [(r["search_term"], r["title"]) for r in rows] == [("first", "Dev")]
    report = {r["page_id"]: r for r in harvest.harvest_report(df, html.REMOTE_BOARD).collect()}
    assert report[3]["no_results"] and not report[1]["no_results"] and report[1]["n_usable"] == 1


def test_dedup_with_a_hot_key_is_one_row_per_task(spark):
    df = spark.range(9000, numPartitions=9).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"), F.col("id").alias("seq")
    )
    first = dedup.first_seen(df, "key", ["seq"])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_min_by" in plan
    assert first.where("key = 'hot'").first()["seq"] == 0 and first.count() == 6001
