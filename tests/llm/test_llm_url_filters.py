"""URL rules and their propagation to aliases, against plain Python."""

from collections import defaultdict
from urllib.parse import urljoin

from compare import mismatch

from wagelens.llm import oracles, queries, url_filters

RULES = queries.RULES
SCHEMA = "page_id long, url string, html string, host string, verdict int, address string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", 7, "clash") for r in rows], SCHEMA)


def verdicts(spark, rows, **more):
    found = url_filters.filter_urls(pages(spark, rows), RULES, **more).collect()
    return {r.page_id: (r.host, r.path, r.rule, r.verdict, r.via_alias) for r in found}


def canonical(url):
    return f'<html><head><LINK href="{url}" rel=canonical></head>'


def test_rules_alone(spark):
    got = verdicts(spark, [
        (1, "https://A.Example.ORG/es/x?q#f", None), (2, "http://example.org/en/19", ""), (3, "http://example.org/en/2", ""),
        (4, "http://notexample.org/es/", ""), (5, "http://shop.com/fr/", ""), (6, "http://shop.com/de/a", ""),
        (7, "http://x.net/de/", ""), (8, None, ""), (9, "example.org/es/", ""), (10, "http://example.org", ""),
        (11, "http://a.org?x/", ""), (12, "", canonical("http://shop.com/de/a")),
    ])
    assert got == {
        1: ("a.example.org", "/es/x", "example.org/es/", "block", False), 2: ("example.org", "/en/19", "example.org/en/1", "block", False),
        3: ("example.org", "/en/2", "org/", "allow", False), 4: ("notexample.org", "/es/", "org/", "allow", False),
        5: ("shop.com", "/fr/", "com/fr/", "allow", False), 6: ("shop.com", "/de/a", "com/de/", "block", False),
        7: ("x.net", "/de/", None, "allow", False), 8: ("", "", None, "allow", False), 9: ("", "", None, "allow", False),
        10: ("example.org", "", None, "allow", False), 11: ("a.org", "", None, "allow", False), 12: ("", "", None, "allow", False),
    }


def test_blocks_reach_aliases_but_not_allowed_ones(spark):
    rows = [
        (1, "https://a.net/1", canonical("http://b.net/2?x=1&amp;y=2")),
        (2, "http://b.net/2?x=1&y=2#top", '<meta http-equiv="Refresh" content="0; URL=/3">'),
        (3, "https://b.net/3", canonical("//shop.com/de/z")),  # not a page, but blocked
        (4, "http://free.org/ok", canonical("http://a.net/1")),  # allowed by its own rule
        (5, "http://a.net/1?other", ""), (6, "http://c.net/d/e", canonical("f")), (7, "http://c.net/d/f", None),
        (7, "http://c.net/d/f", None),
    ]
    got = verdicts(spark, rows)
    assert [got[i][3:] for i in range(1, 8)] == [
        ("block", True), ("block", True), ("block", True), ("allow", False), ("allow", False), ("allow", False), ("allow", False),
    ]
    assert url_filters.filter_urls(pages(spark, rows), RULES).count() == len(rows)


def test_forms_of_a_link(spark):
    blocked = "http://s.com/de/1"
    pages_ = [
        (1, "http://s.com/a/b/c", canonical("../../de/1")), (2, "http://s.com/a/b", canonical("./../x/./../de/1#top")),
        (3, "http://t.net/", '<link rel="nofollow Canonical" href="http://s.com/de/1">'), (4, "http://t.net/4", '<link rel="canonical-not" href="http://s.com/de/1">'),
        (5, "http://t.net/5", '<base target=x href="//s.com/fr/y"><link rel=canonical href="../de/1">'),
        (6, "http://t.net/6", '<base target=x><link rel=canonical href="/de/1">'), (7, "http://t.net/7", canonical("http://s.com/../../de/z/..")),
        (8, "http://t.net/8", canonical("http://s.com/de/..")), (9, "http://t.net/9", '<base href="http://s.com"><meta http-equiv=refresh content="0;url=de/q?a/../b">'),
        (10, "http://t.net/10", None), (11, "http://t.net/11", None), (12, blocked, None),
    ]
    hops = spark.createDataFrame([("http://s.com/n/10", "../de/9"), ("http://t.net/10", "http://s.com/n/10"), ("http://t.net/11", "?x"), (None, "/"), ("http://t.net/11", None)], "src string, dst string")
    got = verdicts(spark, pages_, redirects=hops)
    assert {i for i, v in got.items() if v[3] == "block"} == {1, 2, 3, 5, 7, 9, 10, 12}


def test_dot_segments(spark):
    from pyspark.sql import functions as F

    paths = ["/a/b/../c", "/a/..", "/..", "/../x", "/a/./b/.", "/./", "/.", "/a/b/../../../c/", "/.../..a/b..", "/a//b/./../c", "/x", "", "/a/./.././b/.."]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = [r[0] for r in df.select(url_filters._without_dots(F.col("p"))).collect()]
    assert got == ["/a/c", "/", "/", "/x", "/a/b/", "/", "/", "/c/", "/.../..a/b..", "/a//c", "/x", "", "/"]


def test_logged_redirects_and_long_chains(spark):
    n = 300
    hops = [(f"http://r{i}.net/", f"http://r{i + 1}.net/") for i in range(n)] + [(f"http://r{n}.net/", "http://x.com/de/"), (None, "http://a.net/")]
    rows = [(i, f"https://r{i}.net/", None) for i in range(n + 1)] + [(n + 1, "https://other.net/", None)]
    got = verdicts(spark, rows, redirects=spark.createDataFrame(hops, "src string, dst string"))
    assert all(got[i][3] == "block" for i in range(n + 1)) and got[n + 1][3] == "allow"


def test_random_graphs_against_search(spark):
    import random

    draw = random.Random(3)
    hosts = ["a.net", "b.net", "c.org", "d.com", "e.net"]
    urls = [f"http://{draw.choice(hosts)}/{draw.choice(['de', 'fr', 'x'])}/{i}" for i in range(120)]
    rows = [(i, u, canonical(draw.choice(urls)) if draw.random() < 0.5 else "") for i, u in enumerate(urls)]
    links = defaultdict(set)
    for _, u, html in rows:
        if html:
            v = urljoin(u, html.split('"')[1])
            links[u].add(v)
            links[v].add(u)
    own = {i: v for i, v in verdicts(spark, [(i, u, "") for i, u, _ in rows]).items()}
    rule = {u: own[i][3] if own[i][2] else None for i, u, _ in rows}
    got = verdicts(spark, rows)
    for i, u, _ in rows:
        seen, todo = {u}, [u]
        while todo:
            for v in links[todo.pop()] - seen:
                seen.add(v)
                todo.append(v)
        assert got[i][3] == (rule[u] or ("block" if "block" in map(rule.get, seen) else "allow")), u


def test_empty_table(spark):
    assert url_filters.filter_urls(pages(spark, []), RULES).count() == 0


def test_sql_with_links(spark, tmp_path):
    import duckdb

    rows = [(1, "https://a.net/1", canonical("/2")), (2, "http://a.net/2", canonical("http://x.com/de/1")), (3, "http://a.org/", canonical("http://a.net/1")),
            (4, None, None), (5, "http://q.net/", "canonical"),
            (6, "http://s.com/a/b/c", canonical("../../x/./../de/1")), (7, "http://t.net/", '<link rel="me canonical" href="http://s.com/a/../de/..">'),
            (8, "http://t.net/8", '<base href="//s.com/fr/y/"><link rel=canonical href="../../de/1">'), (9, "http://t.net/9?x", '<base><link rel=canonical href="../../de/1">'),
            (10, "http://t.net/10", '<base href=http://s.com><link rel=canonical href="de/./1">'), (11, "http://t.net/11", canonical("http://s.com/de/x/.."))]
    path = str(tmp_path / "pages")
    pages(spark, rows).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{path}/*.parquet'")
    assert mismatch(url_filters.filter_urls(pages(spark, rows), RULES), con, oracles.OP1) is None
