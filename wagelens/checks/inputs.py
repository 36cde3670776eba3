"""Checks of sources, sinks, deduplication, result pages and streams."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructType

from wagelens import rules
from wagelens.checks.base import check, cleaned, lit, postings, skilled, sql, sql_in, staged, table, text_table
from wagelens.operators import clean, dedup, stats
from wagelens.operators.layout import settled
from wagelens.plans import fixtures
from wagelens.session import scratch_path
from wagelens.sources import csv_folder, html, search_terms, tables
from wagelens.streaming import demand, feeds

LAYOUTS = [
    ["posting_id", "title", "url", "agency", "location", "salary", "closing_date", "search_term"],
    ["title", "url", "agency", "location", "salary", "closing_date", "search_term", "posting_id", "description"],
    ["title", "company", "location", "salary", "posting_id"],
]
ALL_COLUMNS = list(dict.fromkeys(c for names in LAYOUTS for c in names))
_FOLDERS: dict[tuple[str, str], str] = {}


def _layout_parts(spark, sf):
    """The postings in three layouts, each row in one of them."""
    df = postings(spark, sf).withColumn("closing_date", F.col("snapshot"))
    return [df.where(F.col("posting_id") % 3 == i).select(*names) for i, names in enumerate(LAYOUTS)]


def _csv_folder(spark, sf):
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FOLDERS:
        path = scratch_path(spark, "mixed_csv")
        for part in _layout_parts(spark, sf):
            part.write.mode("append").option("header", True).option("escape", '"').csv(path)
        _FOLDERS[key] = path
    return _FOLDERS[key]


def _layout_sql(i):
    named = {"closing_date": "snapshot"}
    items = []
    for c in ALL_COLUMNS:
        if c not in LAYOUTS[i]:
            items.append(f"CAST(NULL AS VARCHAR) AS {c}")
        elif c == "posting_id":
            items.append("CAST(posting_id AS VARCHAR) AS posting_id")
        else:
            items.append(f"{named.get(c, c)} AS {c}")
    return f"SELECT {', '.join(items)} FROM v_postings WHERE posting_id % 3 = {i}"


_UNION = "v_union AS (" + " UNION ALL ".join(_layout_sql(i) for i in range(3)) + ")"
_GONE = sql_in(rules.CSV_MISSING + rules.SENTINELS)


def _known(c):
    return f"CASE WHEN trim({c}) NOT IN {_GONE} THEN trim({c}) END AS {c}"


@check("S1_load_folder", sql(f"SELECT {', '.join(_known(c) for c in ALL_COLUMNS)} FROM v_union", _UNION))
def _(spark, sf):
    loaded = csv_folder.load_folder(spark, _csv_folder(spark, sf))
    return clean.normalise_missing(loaded.rows.select(*ALL_COLUMNS))


@check(
    "S2_tolerant_load",
    sql("SELECT 'rows' AS kind, count(*) AS n FROM v_postings UNION ALL SELECT 'corrupt_rows', 0 UNION ALL SELECT 'load_errors', 1"),
)
def _(spark, sf):
    path = scratch_path(spark, "with_unreadable")
    for part in _layout_parts(spark, sf):
        part.write.mode("append").option("header", True).option("escape", '"').csv(path)
    # one more file that has no header line, so it cannot be read as a table
    blank = postings(spark, sf).agg(F.lit("").alias("value"))
    blank.write.mode("append").option("emptyValue", "").csv(path)
    loaded = csv_folder.load_folder(spark, path)
    parts = [("rows", loaded.rows), ("corrupt_rows", loaded.corrupt_rows), ("load_errors", loaded.load_errors)]
    return reduce(
        lambda a, b: a.unionByName(b),
        [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("kind"), "n") for k, df in parts],
    )


@check(
    "S2_damaged_files",
    sql(
        "SELECT posting_id, CASE WHEN NOT bad THEN title END AS title, CASE WHEN bad THEN 'corrupt' ELSE 'read' END AS status FROM v_damaged "
        "UNION ALL SELECT NULL, 'UTF-16', 'unread' UNION ALL SELECT count(*), NULL, 'records' FROM v_postings",
        """v_damaged AS (SELECT posting_id, title, CASE posting_id % 4 WHEN 1 THEN posting_id % 5 = 0 WHEN 2 THEN posting_id % 7 = 0
          WHEN 3 THEN posting_id = (SELECT min(posting_id) FROM v_postings WHERE posting_id % 4 = 3) ELSE false END AS bad FROM v_postings)""",
    ),
)
def _(spark, sf):
    """Files with text of another encoding, with NUL characters, with an open quote, and one in UTF-16."""
    rows = postings(spark, sf).select(F.col("posting_id"), "title", "url")
    path = scratch_path(spark, "damaged")
    opened = rows.where("posting_id % 4 = 3").agg(F.min("posting_id")).first()[0]

    def write(rest, url, where="true", **options):
        part = rows.where(f"posting_id % 4 = {rest}").withColumn("url", F.when(F.expr(where), url).otherwise(F.col("url")))
        part.coalesce(1).write.mode("append").options(header=True, **options).csv(path)

    write(0, F.col("url"))
    write(1, F.lit("café"), "posting_id % 5 = 0", encoding="ISO-8859-1")
    write(2, F.lit("a\0b"), "posting_id % 7 = 0")
    write(3, F.lit('"open'), f"posting_id = {opened}", quote="\0")
    rows.coalesce(1).write.mode("append").options(header=True, encoding="UTF-16").csv(path)
    loaded = csv_folder.load_folder(spark, path, survey=True)
    number = lambda c: c.cast("bigint").alias("posting_id")
    nothing, accounts = F.lit(None).cast("string").alias("title"), loaded.accounts()
    parts = [
        loaded.rows.select(number(F.col("posting_id")), "title", F.lit("read").alias("status")),
        loaded.corrupt_rows.select(number(F.split(csv_folder.CORRUPT, ",")[0]), nothing, F.lit("corrupt").alias("status")),
        accounts.where("reason IS NOT NULL").select(number(F.lit(None)), F.col("reason").alias("title"), F.lit("unread").alias("status")),
        accounts.where("n_records = n_read + n_corrupt + n_unread").agg(F.sum("n_records")).select(number(F.col("sum(n_records)")), nothing, F.lit("records").alias("status")),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


@check("S3_source_file", sql("SELECT posting_id, true AS has_source FROM v_postings"))
def _(spark, sf):
    rows = csv_folder.load_folder(spark, _csv_folder(spark, sf)).rows
    good = F.col("source_file").rlike(r"^[^/]+\.csv$")
    return rows.select(F.col("posting_id").cast("bigint").alias("posting_id"), good.alias("has_source"))


@check("S4_missing_columns", sql("SELECT posting_id, title, '' AS description, CAST(NULL AS VARCHAR) AS url FROM v_postings"))
def _(spark, sf):
    df = postings(spark, sf).select("posting_id", "title")
    df = clean.with_missing_columns(clean.with_missing_columns(df, ["description"], ""), ["url"])
    return df.select("posting_id", "title", "description", "url")


PROCESSED = (
    StructType().add("posting_id", LongType()).add("standardized_title", StringType())
    .add("annual_salary", DoubleType()).add("skills", ArrayType(StringType()))
)
_PROCESSED_SQL = sql("SELECT posting_id, standardized_title, annual_salary, array_to_string(skills, ',') AS skills FROM v_skills")

for _name, _fmt in (("S5_read_processed", "parquet"), ("S5_read_processed_csv", "csv")):

    @check(_name, _PROCESSED_SQL)
    def _(spark, sf, fmt=_fmt):
        df = skilled(spark, sf).select(*PROCESSED.names)
        path = tables.write_table(df, scratch_path(spark, "processed"), fmt=fmt)
        back = tables.read_processed(spark, path, PROCESSED, fmt)
        return back.withColumn("skills", F.array_join("skills", ","))


@check("S6_write_raw_and_clean", sql("SELECT 'raw' AS step, count(*) AS n, count(salary) AS n_salary FROM v_postings UNION ALL SELECT 'clean', count(*), count(annual_salary) FROM v_clean"))
def _(spark, sf):
    raw = tables.write_table(postings(spark, sf), scratch_path(spark, "raw"))
    done = tables.write_table(cleaned(spark, sf), scratch_path(spark, "clean"), source=raw)
    one = spark.read.parquet(raw).select(F.lit("raw").alias("step"), F.col("salary").alias("s"))
    two = spark.read.parquet(done).select(F.lit("clean").alias("step"), F.col("annual_salary").cast("string").alias("s"))
    return one.unionByName(two).groupBy("step").agg(F.count(F.lit(1)).alias("n"), F.count("s").alias("n_salary"))


@check(
    "S7_snapshots",
    sql("SELECT run_ts, count(*) AS n FROM v_postings, (VALUES ('20240101_000000'), ('20240102_000000')) r(run_ts) GROUP BY 1"),
)
def _(spark, sf):
    path = scratch_path(spark, "exports")
    for run in ("20240101_000000", "20240102_000000", "20240101_000000"):  # the first run twice
        tables.write_snapshot(postings(spark, sf), path, run)
    return spark.read.option("spark.sql.sources.partitionColumnTypeInference.enabled", "false").parquet(path).groupBy(
        F.col("run_ts").cast("string").alias("run_ts")
    ).agg(F.count(F.lit(1)).alias("n"))


@check(
    "S7_changes",
    sql("""
SELECT '20240101' AS run, posting_id, salary, '20240101' AS stored FROM v_postings WHERE posting_id % 10 <> 0
UNION ALL SELECT '20240102', posting_id, CASE WHEN posting_id % 7 = 0 THEN 'on request' ELSE salary END,
  CASE WHEN posting_id % 10 = 0 OR posting_id % 7 = 0 THEN '20240102' ELSE '20240101' END FROM v_postings"""),
)
def _(spark, sf):
    """Two runs, the second with new and changed postings and written twice; both are rebuilt."""
    rows = postings(spark, sf).select("posting_id", "title", "salary")
    path = scratch_path(spark, "changes")
    later = rows.withColumn("salary", F.when(F.col("posting_id") % 7 == 0, "on request").otherwise(F.col("salary")))
    for run, df in (("20240101", rows.where("posting_id % 10 <> 0")), ("20240102", later.limit(0)), ("20240102", later)):
        tables.write_changes(df, path, run)
    stored = spark.read.parquet(f"{path}/rows").select(F.col("run_ts").cast("string").alias("stored"), "row.posting_id", "row.salary")
    runs = [tables.read_run(spark, path, run).withColumn("run", F.lit(run)) for run in ("20240101", "20240102")]
    every, s = runs[0].unionByName(runs[1]), stored.alias("s")
    same = (every["posting_id"] == F.col("s.posting_id")) & every["salary"].eqNullSafe(F.col("s.salary"))
    return every.join(s, same).select("run", every["posting_id"], every["salary"], "stored")


def _feed(spark, sf):
    schema = table(spark, sf, "events").schema
    return feeds.read_feed(spark, sf, schema, "events.parquet")


@check("S8_append_feed", "SELECT event_id, user_id, event_type FROM events")
def _(spark, sf):
    path, state = scratch_path(spark, "feed"), scratch_path(spark, "feed_state")
    for _ in range(2):  # a second start finds nothing new
        feeds.append_feed(_feed(spark, sf).select("event_id", "user_id", "event_type"), path, state).awaitTermination()
    return spark.read.parquet(path)


@check("S9_write_results", sql("SELECT standardized_title, count(*) AS n FROM v_clean GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10"))
def _(spark, sf):
    top = stats.frequency(cleaned(spark, sf), "standardized_title", 10)
    paths = tables.write_results({"top_titles": top}, scratch_path(spark, "results"))
    return spark.read.parquet(paths["top_titles"])


_TERMS = ", ".join(f"({lit(c)}, {lit(t)})" for c, ts in rules.SEARCH_TITLES.items() for t in ts)
_TERM_CTE = f"v_terms(category, search_term) AS (VALUES {_TERMS})"


@check(
    "S10_search_terms",
    sql("SELECT category, search_term, count(posting_id) AS n FROM v_terms LEFT JOIN v_postings USING (search_term) GROUP BY ALL", _TERM_CTE),
)
def _(spark, sf):
    per_term = postings(spark, sf).groupBy("search_term").agg(F.count(F.lit(1)).alias("n"))
    terms = search_terms.search_terms(spark).drop("seq")
    return terms.join(per_term, "search_term", "left").select("category", "search_term", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


@check(
    "S11_search_url",
    sql(f"SELECT posting_id, {lit(rules.SEARCH_URL[0])} || replace(search_term, ' ', '%20') || {lit(rules.SEARCH_URL[1])} AS search_url FROM v_postings"),
)
def _(spark, sf):
    return search_terms.with_search_url(postings(spark, sf)).select("posting_id", "search_url")


@check("U1_union_by_name", sql(f"SELECT {', '.join(ALL_COLUMNS)} FROM v_union", _UNION))
def _(spark, sf):
    parts = [p.withColumn("posting_id", F.col("posting_id").cast("string")) for p in _layout_parts(spark, sf)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).select(*ALL_COLUMNS)


# ---- deduplication -------------------------------------------------------

_FIRST = "SELECT event_id, user_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1"


@check("D1_first_seen", _FIRST)
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    return dedup.first_seen(events, "user_id", ["ts", "event_id"]).drop("ts")


@check("D1_first_search_term", sql("SELECT url, search_term, posting_id FROM v_postings QUALIFY row_number() OVER (PARTITION BY url ORDER BY seq) = 1"))
def _(spark, sf):
    df = postings(spark, sf).select("url", "search_term", "posting_id", "seq")
    return dedup.first_seen(df, "url", ["seq"]).drop("seq")


_KEY = "coalesce(url, md5(concat_ws('|', coalesce(title, ''), coalesce(company, ''), coalesce(location, ''), coalesce(salary, ''))))"
_MIXED = "v_mixed AS (SELECT * REPLACE (CASE WHEN posting_id % 2 = 0 THEN url END AS url) FROM v_postings)"


@check(
    "D2_across_sources",
    sql(f"SELECT posting_id, url, title, snapshot FROM v_mixed QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY snapshot DESC, seq DESC) = 1", _MIXED),
)
def _(spark, sf):
    df = postings(spark, sf).withColumn("url", F.when(F.col("posting_id") % 2 == 0, F.col("url")))
    return dedup.across_sources(df, "snapshot", "seq").select("posting_id", "url", "title", "snapshot")


_BOARDS = """v_boards AS (
  SELECT posting_id, 0 AS board, url, title, company, location, salary, snapshot || '-0' AS snapshot FROM v_postings
  UNION ALL SELECT posting_id, 1, NULL, title, company, location, salary, snapshot || '-1' FROM v_postings WHERE posting_id % 3 = 0
  UNION ALL SELECT posting_id, 2, 'https://other.example/' || (posting_id % 50), title, company, location, salary, snapshot || '-2' FROM v_postings WHERE posting_id % 40 = 0)"""
_LINKED = """v_keys AS (
  SELECT *, 'a' || url AS a, CASE WHEN coalesce(title, company, location, salary) IS NOT NULL THEN 'c' || to_json([title, company, location, salary]) END AS b FROM v_boards),
v_edges AS (SELECT DISTINCT a, b FROM v_keys WHERE a IS NOT NULL AND b IS NOT NULL),
v_both AS (SELECT a AS x, b AS y FROM v_edges UNION SELECT b, a FROM v_edges),
v_reach(x, y) AS (SELECT x, x FROM v_both UNION SELECT r.x, e.y FROM v_reach r JOIN v_both e ON e.x = r.y),
v_roots AS (SELECT x, min(y) AS root FROM v_reach GROUP BY 1)"""


@check(
    "D2_linked_sources",
    sql(
        "SELECT posting_id, CAST(board AS INT) AS board, url, snapshot FROM v_keys LEFT JOIN v_roots ON x = coalesce(a, b) "
        "QUALIFY row_number() OVER (PARTITION BY coalesce(root, a, b) ORDER BY snapshot DESC, posting_id DESC) = 1",
        _BOARDS, _LINKED,
    ).replace("WITH", "WITH RECURSIVE", 1),
)
def _(spark, sf):
    """Postings of one board, copies without an address on a second, a third with addresses of its own."""
    rows = postings(spark, sf).select("posting_id", "url", "title", "company", "location", "salary", "snapshot")

    def board(number, url, where="true"):
        of = rows.where(where).withColumns({"board": F.lit(number), "url": url, "snapshot": F.concat("snapshot", F.lit(f"-{number}"))})
        return of.select("posting_id", "board", "url", "title", "company", "location", "salary", "snapshot")

    other = F.concat(F.lit("https://other.example/"), (F.col("posting_id") % 50).cast("string"))
    every = board(0, F.col("url")).unionByName(board(1, F.lit(None).cast("string"), "posting_id % 3 = 0"))
    every = every.unionByName(board(2, other, "posting_id % 40 = 0"))
    return dedup.linked_across_sources(every, "snapshot", "posting_id").select("posting_id", "board", "url", "snapshot")


@check("D3_streaming_first_seen", _FIRST)
def _(spark, sf):
    """The events arrive in three lots of files, the later days first, and a closing row."""
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    source, path, state = (scratch_path(spark, n) for n in ("arrivals", "seen", "seen_state"))
    span = events.agg(F.max("ts").alias("last")).first()["last"]
    files = spark.sparkContext.defaultParallelism  # so that no task writes a lot alone
    for day in (2, 0, 1):  # each lot has the events of every third day
        part = events.where(F.datediff("ts", F.lit("2000-01-01")) % 3 == day)
        part.repartition(files).write.mode("append").parquet(source)
    feeds.close_feed(spark, source, events.schema, {"ts": span + timedelta(days=4001), "user_id": -1})
    feed = feeds.read_feed(spark, source, events.schema, per_batch=files)
    kept = feeds.first_seen_feed(feed, "user_id", F.col("ts"), "4000 days", ("event_id",))
    feeds.append_feed(kept, path, state).awaitTermination()
    return spark.read.schema(events.schema).parquet(path).drop("ts")


# ---- demand over time ----------------------------------------------------

_DAY = "date_trunc('day', ts)"
_DUE = f"{_DAY} + INTERVAL 1 DAY <= (SELECT max(ts) FROM events WHERE event_id % 2 = 0) - INTERVAL 3 DAY"


def _demand(spark, parts, closing, keys, width, delay):
    """Demand of a feed whose parts arrive one by one, and then a closing row."""
    source, path, state = (scratch_path(spark, n) for n in ("demand_feed", "demand", "demand_state"))
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(source)
    schema = parts[0].schema
    feeds.close_feed(spark, source, schema, closing)
    found = demand.windowed_demand(feeds.read_feed(spark, source, schema, per_batch=1), keys, F.col("ts"), width, delay)
    feeds.append_feed(found, path, state).awaitTermination()
    return spark.read.schema(found.schema).parquet(path)


def _seconds(column):
    return F.unix_seconds(column).alias(column)


@check(
    "W3_demand_with_late_rows",
    f"SELECT CAST(epoch({_DAY}) AS BIGINT) AS window_start, event_type, CASE WHEN event_id % 2 = 1 AND {_DUE} THEN 'late' ELSE 'closed' END AS status, "
    "count(*) AS n FROM events GROUP BY ALL",
)
def _(spark, sf):
    """The even events come first, with those of the last days, so most odd ones are late."""
    events = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    span = events.agg(F.max("ts").alias("last")).first()["last"]
    parts = [events.where(F.col("event_id") % 2 == i) for i in (0, 1)]
    found = _demand(spark, parts, {"ts": span + timedelta(days=10)}, ["event_type"], "1 day", "3 days")
    return found.groupBy(_seconds("window_start"), "event_type", "status").agg(F.sum("n").alias("n"))


_SKILL_WINDOWS = """v_windows AS (
  SELECT CAST(floor(epoch(CAST(snapshot AS TIMESTAMP)) / 7776000) AS BIGINT) * 7776000 AS window_start, skill, count(*) AS n
  FROM (SELECT snapshot, unnest(skills) AS skill FROM v_skills) GROUP BY ALL),
v_totals AS (SELECT window_start, sum(n) AS total FROM v_windows GROUP BY 1)"""


@check(
    "W3_skill_demand_trend",
    sql(
        "SELECT w.window_start, w.skill, w.n, CAST(w.n / t.total AS DOUBLE) AS share, "
        "CASE WHEN p.total IS NOT NULL THEN coalesce(b.n, 0) END AS n_before, "
        "CASE WHEN p.total IS NOT NULL THEN CAST(w.n / t.total - coalesce(b.n, 0) / p.total AS DOUBLE) END AS share_change "
        "FROM v_windows w JOIN v_totals t USING (window_start) LEFT JOIN v_totals p ON p.window_start = w.window_start - 7776000 "
        "LEFT JOIN v_windows b ON b.window_start = w.window_start - 7776000 AND b.skill = w.skill",
        _SKILL_WINDOWS,
    ),
)
def _(spark, sf):
    """Skills named in postings per 90 days, from a feed in three files out of order."""
    posted = F.to_timestamp(F.concat("snapshot", F.lit(" 00:00:00+00:00")))
    rows = skilled(spark, sf).select("posting_id", posted.alias("ts"), F.explode("skills").alias("skill"))
    span = rows.agg(F.max("ts").alias("last")).first()["last"]
    parts = [rows.where(F.col("posting_id") % 3 == i).drop("posting_id") for i in (2, 0, 1)]
    found = _demand(spark, parts, {"ts": span + timedelta(days=4100)}, ["skill"], "90 days", "4000 days")
    over_time = demand.demand_over_time(found, ["skill"])
    return demand.demand_trend(over_time, "skill").drop("window_end").withColumn("window_start", _seconds("window_start"))


# ---- result pages --------------------------------------------------------

LINKS = html.BoardLayout(
    sentinel=rules.NOT_SPECIFIED,
    card_pattern=r"(?s)<li>.*?</li>",
    field_patterns={"title": r"(?s)<a\b[^>]*>(.*?)</a>", "url": r'href="([^"]*)"'},
    attributes=("url",),
)
_LI = r"regexp_extract_all(html, '(?s)<li>.*?</li>')"


@check(
    "X1_cards_in_pages",
    f"SELECT page_id, CAST(i - 1 AS INT) AS card_no, cards[i] AS card FROM (SELECT page_id, {_LI} AS cards, "
    f"unnest(range(1, len({_LI}) + 1)) AS i FROM pages)",
)
def _(spark, sf):
    return html.split_cards(text_table(spark, sf, "pages", "page_id", "html"), "html", LINKS)


def remote_pages(spark, sf):
    return staged(spark, sf, "remote_pages", lambda s, d: fixtures.remote_pages(postings(s, d)))


def _sent(e):
    return f"coalesce(nullif(trim({e}), ''), 'Not specified')"


_CARDS = f"""
v_cards AS (SELECT posting_id AS page_id, search_term, CAST(k AS INT) AS card_no,
  'J' || posting_id || '-' || k AS job_id,
  CASE WHEN k = 1 OR posting_id % 7 <> 0 THEN title END AS title,
  CASE WHEN (k = 1 OR posting_id % 7 <> 0) AND title IS NOT NULL THEN url END AS url,
  {_sent('coalesce(agency, company)')} AS agency, {_sent('location')} AS location,
  CASE WHEN regexp_matches(lower(salary), 'salary|usd|annually|hourly|\\$') THEN salary ELSE 'Not specified' END AS salary,
  '3 days ago' AS posted_text
  FROM v_postings, range(2) r(k) WHERE posting_id % 10 <> 0)"""
_CARD_COLUMNS = "page_id, card_no, job_id, title, url, agency, location, salary, posted_text"


@check("X2_card_fields", sql(f"SELECT {_CARD_COLUMNS} FROM v_cards", _CARDS))
def _(spark, sf):
    return html.extract_cards(remote_pages(spark, sf), "html", html.REMOTE_BOARD).select(*_CARD_COLUMNS.split(", "))


@check("X2_nested_cards", sql(
    "SELECT page_id, card_no, job_id, title, url, CASE WHEN agency = company_only THEN NULL ELSE agency END AS agency, "
    "nullif(location, 'Not specified') AS location FROM (SELECT *, NULL AS company_only FROM v_nested)",
    _CARDS, "v_nested AS (SELECT c.page_id, c.card_no, c.job_id, c.title, c.url, p.agency, c.location FROM v_cards c "
    "JOIN v_postings p ON p.posting_id = c.page_id)",
))
def _(spark, sf):
    found = html.extract_nested_cards(remote_pages(spark, sf), "page_id", "html", html.REMOTE_BOARD)
    return found.select("page_id", "card_no", "job_id", "title", "url", "agency", "location")


_UNESCAPE = "replace(replace(replace(replace(replace(replace({0}, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&')"
_TEXT = _UNESCAPE.format("regexp_replace(regexp_extract({0}, '(?s)<a\\b[^>]*>(.*?)</a>', 1), '<[^>]*>', '', 'g')")


@check(
    "X2_fields_in_pages",
    f"SELECT page_id, CAST(i - 1 AS INT) AS card_no, nullif(trim({_TEXT.format('cards[i]')}), '') AS title, "
    f"nullif(regexp_extract(cards[i], 'href=\"([^\"]*)\"', 1), '') AS url FROM (SELECT page_id, {_LI} AS cards, "
    f"unnest(range(1, len({_LI}) + 1)) AS i FROM pages)",
)
def _(spark, sf):
    found = html.extract_cards(text_table(spark, sf, "pages", "page_id", "html"), "html", LINKS)
    return found.select("page_id", "card_no", "title", "url")


@check("X3_company_in_text", sql("SELECT posting_id AS page_id, card_no, company FROM v_postings JOIN v_cards ON page_id = posting_id WHERE agency_missing", _CARDS.replace("'3 days ago' AS posted_text", "'x' AS posted_text, agency IS NULL AS agency_missing")))
def _(spark, sf):
    raw = html.extract_cards(
        remote_pages(spark, sf), "html",
        html.BoardLayout(
            sentinel="", card_class=html.REMOTE_BOARD.card_class,
            field_classes={"title": "sc-jv5lm6-13", "stated": "company-name"},
            field_patterns={"about": html.REMOTE_BOARD.field_patterns["description"]},
        ),
        missing_as_null=True,
    )
    return raw.where("stated IS NULL").select("page_id", "card_no", html.company_in(F.col("about")).alias("company"))


@check("X4_salary_tag", sql("SELECT page_id, card_no, salary FROM v_cards WHERE salary <> 'Not specified'", _CARDS))
def _(spark, sf):
    cards = html.split_cards(remote_pages(spark, sf), "html", html.REMOTE_BOARD)
    tag = html.salary_tag(html.tags_in(F.col("card"), html.REMOTE_BOARD.tag_class))
    return settled(cards.select("page_id", "card_no", tag.alias("salary"))).where("salary IS NOT NULL")


@check(
    "X5_first_cards",
    f"SELECT page_id, CAST(i - 1 AS INT) AS card_no, cards[i] AS card FROM (SELECT page_id, {_LI} AS cards, "
    f"unnest(range(1, least(len({_LI}), 3) + 1)) AS i FROM pages)",
)
def _(spark, sf):
    layout = html.BoardLayout(sentinel="", card_pattern=LINKS.card_pattern, cards_per_page=rules.CARDS_PER_PREVIEW)
    return html.split_cards(text_table(spark, sf, "pages", "page_id", "html"), "html", layout)


@check("X6_search_term_of_card", sql("SELECT page_id, card_no, search_term, category FROM v_cards JOIN v_terms USING (search_term)", _CARDS, _TERM_CTE))
def _(spark, sf):
    cards = html.extract_cards(remote_pages(spark, sf), "html", html.REMOTE_BOARD)
    return search_terms.with_category(cards).select("page_id", "card_no", "search_term", "category")


@check("X7_no_results", sql("SELECT posting_id AS page_id, posting_id % 10 = 0 AS no_results FROM v_postings"))
def _(spark, sf):
    empty = html.has_no_results(F.col("html"), html.REMOTE_BOARD).alias("no_results")
    return remote_pages(spark, sf).select("page_id", empty)


@check("X7_displayed", sql("SELECT posting_id AS page_id, posting_id % 10 = 0 OR posting_id % 5 IN (0, 3) AS no_results FROM v_postings"))
def _(spark, sf):
    """Pages that say there is nothing in view, out of view, or not at all, whatever cards they have."""
    said = [
        "<div>No Results Found</div>", "<div hidden>No Results Found</div>",
        '<section style="color: red; display: none"><p>x</p><div>No jobs found</div></section>',
        '<p aria-hidden="true">a<b>b</b></p><div>No jobs found</div>', '<!-- <div>No jobs found</div> --><div class="hidden">No</div>',
    ]
    extra = F.element_at(F.array(*map(F.lit, said)), (F.col("page_id") % 5 + 1).cast("int"))
    pages = remote_pages(spark, sf).withColumn("html", F.replace("html", F.lit('<ul class="pagination">'), F.concat(extra, F.lit("<ul>"))))
    return pages.select("page_id", html.has_no_results(F.col("html"), html.REMOTE_BOARD).alias("no_results"))


_A = r"regexp_extract_all(html, '(?s)(?:<li\b[^>]*>\s*)?<a\b[^>]*>.*?</a>')"


@check(
    "X8_links_in_pages",
    f"SELECT page_id, CAST(i - 1 AS INT) AS link_no, regexp_extract(l[i], '<a\\b[^>]*\\bhref=\"([^\"]*)\"', 1) AS href, "
    f"trim({_TEXT.format('l[i]')}) AS text FROM (SELECT page_id, {_A} AS l, unnest(range(1, len({_A}) + 1)) AS i FROM pages)",
)
def _(spark, sf):
    links = html.page_links(text_table(spark, sf, "pages", "page_id", "html"), "page_id", "html")
    return links.select("page_id", "link_no", "href", "text")


@check("X8_next_link", sql("SELECT posting_id AS page_id, '/p/' || (posting_id + 1) AS next_href FROM v_postings WHERE posting_id % 3 <> 0"))
def _(spark, sf):
    return html.next_links(html.page_links(remote_pages(spark, sf), "page_id", "html"), "page_id")


@check("X9_quarantine", sql("SELECT 'usable' AS kind, count(title) AS n FROM v_cards UNION ALL SELECT 'no_title', count(*) - count(title) FROM v_cards", _CARDS))
def _(spark, sf):
    cards = html.extract_cards(remote_pages(spark, sf), "html", html.REMOTE_BOARD).select("title")
    path = tables.write_table(cards, scratch_path(spark, "card_titles"))  # pages are read once for both sides
    good, bad = html.quarantine(spark.read.schema(cards.schema).parquet(path))
    count = F.count(F.lit(1)).alias("n")
    return good.agg(count).select(F.lit("usable").alias("kind"), "n").unionByName(
        bad.agg(count).select(F.lit("no_title").alias("kind"), "n")
    )
