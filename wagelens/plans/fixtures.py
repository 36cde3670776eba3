"""Postings and result pages derived row by row from the ``orders`` table.

Synthetic inputs for checks and benchmarks: they grow with the table, but say
nothing about any job market.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wagelens import rules
from wagelens.functions.text import first_match
from wagelens.operators.layout import spread

TITLES = [
    "Senior Software Engineer", "Data Scientist", "ML Engineer", "Site Reliability (SRE)",
    "Front-End Developer", "Linux Administrator", "Audit Specialist", "Cloud Security Engineer",
    "Systems Analyst", "Cloud Engineer", "Maintenance Technician", "Chef", None,
]
LOCATIONS = [
    "San Francisco, CA", "Austin,TX", "USA", "U.S.", "Washington DC, VA", "United Kingdom",
    "Remote", "Berlin Germany", "IT Center", "Location Negotiable", None,
]
AGENCIES = ["Agency A", None, "Agency B"]
COMPANIES = [None, "Company X"]
DESCRIPTIONS = [
    "Python, SQL and Spark on AWS", "We use C++ and C#", "asp.net developer", "software wizard",
    "ready to go", "", None, "Machine learning with scikit-learn, pandas & NumPy; CI/CD a plus",
    "Kubernetes (K8s), Docker and Terraform", "Data science lead", "web shop", "network cabling",
    "React Native and TypeScript for iOS", "customer support desk", "TCP/IP, DNS, SSL/TLS and VPN",
    "Plain filler without any hit", "Java/JavaScript; REST API; Node", "NA",
    'Quote "Go", comma\nand a second line',
]
TERMS = [t for titles in rules.SEARCH_TITLES.values() for t in titles]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str | None], number: Column) -> Column:
    items = F.array(*[F.lit(v).cast("string") for v in values])
    return F.element_at(items, (number % len(values) + 1).cast("int"))


def _whole(number: Column, by: int) -> Column:
    return F.floor(number / by).cast("long")


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One posting per order."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    low = F.lit(40000) + (key * 7919) % 100000
    text = lambda c: c.cast("string")
    money = lambda c: F.format_number(c, 0)
    pay = [
        F.concat(F.lit("$"), money(low), F.lit(" to $"), money(low + 20000), F.lit(" per year")),
        F.concat(F.lit("$"), text(_whole(low, 2000)), F.lit(" hourly")),
        F.concat(F.lit("$"), text(_whole(low, 12)), F.lit(" per month")),
        F.concat(text(_whole(low, 260)), F.lit(" per day")),
        _pick([rules.NOT_SPECIFIED, rules.NOT_PROVIDED, None], _whole(key, 8)),
        F.concat(F.lit("USD , "), money(low), F.lit(" annually")),
        F.concat(F.lit("$"), text(_whole(low, 2000)), F.lit(".50 hourly")),
        F.concat(F.lit("$"), money(_whole(low, 52)), F.lit(" weekly")),
    ]
    salary = first_match([(key % 8 == i, shape) for i, shape in enumerate(pay)], F.lit(None))
    orders = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"))
    return orders.select(
        key.alias("posting_id"), key.alias("seq"),
        F.concat(F.lit("https://jobs.example/"), text(key - key % 2)).alias("url"),
        _pick(TITLES, cust).alias("title"),
        _pick(LOCATIONS, key).alias("location"),
        _pick(AGENCIES, cust).alias("agency"),
        _pick(COMPANIES, key).alias("company"),
        salary.alias("salary"),
        _pick(DESCRIPTIONS, key).alias("description"),
        _pick(TERMS, cust).alias("search_term"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("snapshot"),
    )


def _element(tag: str, css: str, content: Column) -> Column:
    """An element, or nothing where the content is NULL."""
    return F.coalesce(F.concat(F.lit(f'<{tag} class="{css}">'), content, F.lit(f"</{tag}>")), F.lit(""))


def remote_pages(postings_df: DataFrame) -> DataFrame:
    """One result page per posting: the posting, then a repeat of it.

    Every tenth page has no card, every seventh page no title in its first
    card, every third page a disabled next link.
    """
    key = F.col("posting_id")
    jid = key.cast("string")

    def card(number: str, title: Column) -> Column:
        heading = F.coalesce(
            F.concat(F.lit('<a class="x sc-jv5lm6-13" href="'), F.col("url"), F.lit('">'), title, F.lit("</a>")),
            F.lit(""),
        )
        about = F.coalesce(F.concat(F.lit("\nCompany: "), F.col("company")), F.lit(""))
        return F.concat(
            F.lit('<article class="sc-jv5lm6-0" id="J'), jid, F.lit(f'-{number}"><h3>'), heading, F.lit("</h3><div>"),
            _element("span", "company-name", F.col("agency")),
            F.lit(f'<p id="description-J'), jid, F.lit(f'-{number}">About the role'), about, F.lit("\nApply now</p>"),
            _element("span", "allowed-location", F.col("location")),
            F.lit('<span class="sc-1 ifOAWE">Full-Time</span>'),
            _element("span", "sc-1 ifOAWE", F.col("salary")),
            F.lit(f'<span id="date-diff-J'), jid, F.lit(f'-{number}">3 days ago</span></div></article>'),
        )

    first = card("0", F.when(key % 7 != 0, F.col("title")))
    body = F.when(key % 10 == 0, F.lit("<div>No jobs found</div>")).otherwise(
        F.concat(F.lit('<div id="job-table-wrapper">'), first, card("1", F.col("title")), F.lit("</div>"))
    )
    next_class = F.when(key % 3 == 0, F.lit("page-link disabled")).otherwise(F.lit("page-link"))
    return postings_df.select(
        key.alias("page_id"), "search_term",
        F.concat(
            F.lit("<html><body>"), body,
            F.lit('<ul class="pagination"><li><a class="page-link" href="/p/'), jid, F.lit('">1</a></li>'),
            F.lit('<li><a aria-label="Next Page" class="'), next_class, F.lit('" href="/p/'),
            (key + 1).cast("string"), F.lit('">&raquo;</a></li></ul></body></html>'),
        ).alias("html"),
    )
