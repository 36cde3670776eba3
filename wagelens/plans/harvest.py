"""From fetched result pages to a raw posting table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagelens.operators import dedup
from wagelens.sources import html


def harvest(pages: DataFrame, layout: html.BoardLayout, page: str = "page_id", nested: bool = False) -> DataFrame:
    """Postings of a board's pages, each once, first search term first.

    ``pages`` holds the page id, its html and, for the pattern form, a
    ``search_term``.  Cards without a title are left out.
    """
    if nested:
        cards = html.extract_nested_cards(pages, page, "html", layout)
        cards = cards.join(pages.drop("html"), page)
    else:
        cards = html.extract_cards(pages, "html", layout)
    good, _ = html.quarantine(cards)
    keyed = good.withColumn("posting_key", F.coalesce("job_id", "url"))
    return dedup.first_seen(keyed, "posting_key", [page, "card_no"])


def harvest_report(pages: DataFrame, layout: html.BoardLayout, page: str = "page_id") -> DataFrame:
    """Per page: usable cards, cards without a title, whether it is empty."""
    cards = html.extract_cards(pages, "html", layout)
    per_page = cards.groupBy(page).agg(
        F.count("title").alias("n_usable"), F.count_if(F.col("title").isNull()).alias("n_no_title")
    )
    empty = pages.select(page, html.has_no_results(F.col("html"), layout).alias("no_results"))
    return empty.join(per_page, page, "left").na.fill(0, subset=["n_usable", "n_no_title"])
