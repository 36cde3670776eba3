"""Both sides of the quarantine come from one reading of the pages."""

from wagelens.checks import catalog, inputs
from wagelens.sources import html


def test_quarantine_counts_without_parsing_twice(spark, small):
    found = catalog.queries()["X9_quarantine"](spark, small)
    assert "split(" not in found._jdf.queryExecution().optimizedPlan().toString()
    cards = html.extract_cards(inputs.remote_pages(spark, small), "html", html.REMOTE_BOARD).select("title").collect()
    missing = sum(r["title"] is None for r in cards)
    assert {r["kind"]: r["n"] for r in found.collect()} == {"usable": len(cards) - missing, "no_title": missing}
    assert missing > 0
