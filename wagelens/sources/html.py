"""Fetched result pages to posting rows.

Two ways to read a card: patterns, for fields without markup of their own kind
inside, and balanced elements, for nested markup.  Both are built-in expressions,
and both look at a character a bounded number of times: tags are matched up to the
next bracket, and elements by splitting at the tags of their name and counting.
Selectors are data, see ``BoardLayout``.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagelens import rules
from wagelens.functions.text import any_of, strip
from wagelens.operators.layout import settled


@dataclass(frozen=True)
class BoardLayout:
    """How one board marks its cards and their fields.

    Cards and fields are named by CSS class, or by a pattern where a class will
    not do: ``card_pattern`` is a whole card, ``field_patterns`` give a field
    as group 1.  ``attributes`` names the fields that are attribute values
    rather than markup.  ``tag_class`` marks loose tags, one of which may be
    the salary.
    """

    sentinel: str
    card_class: str = ""
    card_pattern: str = ""
    field_classes: dict[str, str] = field(default_factory=dict)
    field_patterns: dict[str, str] = field(default_factory=dict)
    attributes: tuple[str, ...] = ()
    cards_per_page: int | None = None
    tag_class: str = ""


def has_class(css_class: str) -> str:
    """Pattern of a class attribute that lists the class."""
    return rf'class="(?:[^"]*\s)?{re.escape(css_class)}(?:\s[^"]*)?"'


def opening_tag(css_class: str) -> str:
    return rf"<\w+\b[^<>]*{has_class(css_class)}"


# Markers of the three boards' result pages.
FEDERAL_BOARD = BoardLayout(
    sentinel=rules.NOT_SPECIFIED,
    cards_per_page=rules.CARDS_PER_PAGE,
    card_class="usajobs-search-result--core",
    field_classes={
        "title": "usajobs-search-result--core__title",
        "agency": "usajobs-search-result--core__agency",
        "location": "usajobs-search-result--core__location",
        "salary": "usajobs-search-result--core__salary",
        "closing_date": "usajobs-search-result--core__closing-date",
    },
)
REMOTE_BOARD = BoardLayout(
    sentinel=rules.NOT_SPECIFIED,
    card_class="sc-jv5lm6-0",
    field_classes={
        "title": "sc-jv5lm6-13",
        "agency": "company-name",
        "location": "allowed-location",
    },
    field_patterns={
        # the boundary before "id" is asked for behind it, as it takes longer to test than a text
        "description": r'(?s)<\w+\b[^>]*id="(?<=\bid=")description-[^"]*"[^>]*>(.*?)</',
        "posted_text": r'(?s)<\w+\b[^>]*id="(?<=\bid=")date-diff-[^"]*"[^>]*>(.*?)</',
    },
    tag_class="ifOAWE",
)
COMPANY_BOARD = BoardLayout(
    sentinel=rules.NOT_PROVIDED,
    cards_per_page=rules.CARDS_PER_PREVIEW,
    card_class="jobCard",
    field_classes={
        "title": "jobTitle",
        "company": "companyName",
        "location": "jobLocation",
        "salary": "salaryEstimate",
    },
)

# Entities that occur in visible text.
ENTITIES = [
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"),
]


def visible_text(markup: Column) -> Column:
    """Markup without tags, common entities resolved, trimmed; "" becomes NULL."""
    plain = F.regexp_replace(markup, "<[^<>]*>", "")
    for entity, char in ENTITIES:
        plain = F.replace(plain, F.lit(entity), F.lit(char))
    return F.nullif(strip(plain), F.lit(""))


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _from(markup: Column, pattern: str) -> Column:
    """The markup from the first match of a pattern on, NULL without one."""
    return F.nullif(F.regexp_extract(markup, f"(?:{pattern})(?s:.*)", 0), F.lit(""))


def _before(markup: Column, mark: Column) -> Column:
    """The markup up to the first mark, all of it without one."""
    return F.call_function("substring_index", markup, mark, F.lit(1))


def _last_tag(markup: Column) -> Column:
    """What follows the last opening bracket, all of it without one."""
    return F.call_function("substring_index", markup, F.lit("<"), F.lit(-1))


def _shorter(part: Column, whole: Column) -> Column:
    return F.octet_length(part) < F.octet_length(whole)


def _tag_name(markup: Column) -> Column:
    return F.regexp_extract(_before(markup, F.lit(">")), r"^<(\w+)", 1)


def _past_tag(markup: Column, tag: Column) -> Column:
    """The markup without the tag that it begins with, if it begins with one; ``tag`` is what comes before its first ``>``."""
    whole = F.startswith(markup, F.lit("<")) & ~F.contains(F.substr(tag, F.lit(2)), F.lit("<")) & _shorter(tag, markup)
    return F.when(whole, F.substr(markup, F.length(tag) + 2)).otherwise(markup)


# Elements are cut out in columns that build on each other: each is computed once, in generated code,
# where functions on arrays of one element would be interpreted.  A few such functions stand at the
# beginnings, since they end a stage of generated code: what gets too long is not compiled by the JVM.

def _with_elements(df: DataFrame, markup: str, classes: dict[str, str]) -> DataFrame:
    """Add, by column, the markup from the first opening tag of a class on, NULL without one.

    The name of the class is looked for as plain text, and the tag around it must be one that lists
    it.  With a quote between the tag's bracket and the name no tag before it can reach to the name, so
    that tag is the first; else the pattern goes through all of the markup.
    """
    m, of = F.col(markup), classes.items()

    def head_of(css: str) -> Callable[[Column], Column]:
        return lambda x: F.when(F.contains(x, F.lit(css)), _before(x, F.lit(css)))

    df = df.withColumns({f"_{c}_head": _with(m, head_of(css)) for c, css in of})
    df = df.withColumns({f"_{c}_last": _last_tag(F.col(f"_{c}_head")) for c in classes})

    def tag(c: str) -> Column:
        head, last = F.col(f"_{c}_head"), F.col(f"_{c}_last")
        sure = F.contains(head, F.lit("<")) & F.contains(last, F.lit('"'))
        return F.when(sure, F.concat(F.lit("<"), last, F.substr(m, F.length(head) + 1)))

    def found(c: str, start: str) -> Column:
        plain, named = F.col(f"_{c}_tag"), F.col(f"_{c}_head").isNotNull()
        searched = F.regexp_extract(m, f"(?:{start})(?s:.*)", 0)
        return F.when(plain.rlike(f"^{start}"), plain).when(named & m.rlike(start), searched)

    df = df.withColumns({f"_{c}_tag": tag(c) for c in classes})
    df = df.withColumns({c: found(c, opening_tag(css)) for c, css in of})
    return df.drop(*(f"_{c}_{part}" for c in classes for part in ("head", "last", "tag")))


def _with_contents(df: DataFrame, columns: list[str], nested: bool = False) -> DataFrame:
    """Replace elements by their contents: up to the first closing tag, or, ``nested``, up to the balancing one.

    Most elements hold none of their own name: the first closing tag balances them, and nothing need be counted.
    """
    df = df.withColumns({f"_{c}_name": _with(F.col(c), _tag_name) for c in columns})
    df = df.withColumns({f"_{c}_head": _before(F.col(c), F.concat(F.lit("</"), F.col(f"_{c}_name"), F.lit(">"))) for c in columns})
    df = df.withColumns({f"_{c}_tag": _before(F.col(f"_{c}_head"), F.lit(">")) for c in columns})
    if nested:
        df = df.withColumns({f"_{c}_low": F.lower(F.substr(f"_{c}_head", F.lit(2))) for c in columns})

    def content(c: str) -> Column:
        head, tag = F.col(f"_{c}_head"), F.col(f"_{c}_tag")
        closed, inside = _shorter(head, F.col(c)), _past_tag(head, tag)
        if not nested:
            return F.when(closed, inside)
        name, low = F.lower(f"_{c}_name"), F.col(f"_{c}_low")
        names = F.contains(low, F.concat(F.lit("<"), name)) | F.contains(low, F.concat(F.lit("</"), name))
        return F.when(closed & ~names & ~F.endswith(tag, F.lit("/")) & ~name.isin(VOID_TAGS), inside).otherwise(balanced(F.col(c)))

    df = df.withColumns({c: content(c) for c in columns})
    return df.drop(*(f"_{c}_{part}" for c in columns for part in ("name", "head", "tag", "low")))


def _each(markup: Column, css_class: str) -> Column:
    """The markup from each opening tag of a class up to the next one, as an array.

    As in ``_with_elements``, tags are found by the plain name; where any place of it is no class of the
    tag right before it, the pattern goes through all of the markup.
    """
    start, name = opening_tag(css_class), re.escape(css_class)

    def of_pieces(x: Column) -> Column:
        tags = F.transform(x["pieces"], lambda piece: _last_tag(piece))
        return _with(F.struct(x["m"].alias("m"), x["pieces"].alias("pieces"), tags.alias("tags")), of_tags)

    def of_tags(x: Column) -> Column:
        pieces, tags = x["pieces"], x["tags"]

        def element(piece: Column, n: Column) -> Column:
            tag = F.get(tags, n)
            lists = F.contains(F.get(pieces, n), F.lit("<")) & tag.rlike(r'^\w+\b[^<>]*class="(?:[^"]*\s)?\z') & piece.rlike(r'^(?:\s[^"]*)?"')
            rest = F.when(n + 2 == F.size(pieces), piece).otherwise(F.substr(piece, F.lit(1), F.length(piece) - F.length(F.get(tags, n + 1)) - 1))
            return F.when(lists, F.concat(F.lit("<"), tag, F.lit(css_class), rest))

        found = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), element)
        return _with(found, lambda all_of: F.when(F.forall(all_of, lambda e: e.isNotNull()), all_of).otherwise(searched(x["m"])))

    def searched(m: Column) -> Column:
        return F.filter(F.split(m, f"(?={start})"), lambda piece: piece.rlike(f"^{start}"))

    # the name between blanks or quotes; plain text comes first, which Java looks for in leaps
    pieces = F.split(markup, rf'{name}(?<=[\s"]{name})(?=[\s"])')
    return _with(F.struct(markup.alias("m"), pieces.alias("pieces")), of_pieces)


def _up_to_closing(markup: Column) -> Column:
    """Content of the element that ``markup`` begins with, up to the first closing tag of its name; NULL without one."""

    def content(m: Column) -> Column:
        return _with(F.struct(m.alias("m"), _before(m, F.concat(F.lit("</"), _tag_name(m), F.lit(">"))).alias("head")), closed)

    def closed(x: Column) -> Column:
        return F.when(_shorter(x["head"], x["m"]), _past_tag(x["head"], _before(x["head"], F.lit(">"))))

    return _with(markup, content)


# Elements without content.
VOID_TAGS = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]


def _named_tags(markup: Column, name: Column) -> Column:
    """The markup cut before each opening or closing tag of a name."""
    return F.split(markup, F.concat(F.lit("(?i)(?=</?"), name, F.lit(r"\b)")))


def _closes_at(pieces: Column, depth: Column, first: Column) -> Column:
    """Number of the piece, from 0, that takes the depth to 0, and the depth at the end: (at, depth); at is -1 if none does.

    All pieces begin with a tag of the name, the first one if ``first``.
    """

    def step(acc: Column, piece: Column) -> Column:
        counts = first | (acc["n"] > 0)
        change = F.when(~counts | piece.rlike("^<[^<>]*/>"), 0).when(F.startswith(piece, F.lit("</")), -1).otherwise(1)
        now = F.when(acc["at"] >= 0, acc["depth"]).otherwise(acc["depth"] + change)
        ends = (acc["at"] < 0) & (now <= 0) & counts
        return F.struct((acc["n"] + 1).alias("n"), now.alias("depth"), F.when(ends, acc["n"]).otherwise(acc["at"]).alias("at"))

    start = F.struct(F.lit(0).alias("n"), depth.alias("depth"), F.lit(-1).alias("at"))
    return F.aggregate(pieces, start, step)


def balanced(markup: Column) -> Column:
    """Content of the element that ``markup`` begins with, up to the closing tag that balances its name, or to the end."""

    def content(m: Column) -> Column:
        return _with(F.struct(m.alias("m"), _tag_name(m).alias("name")), of_name)

    def of_name(x: Column) -> Column:
        m, name = x["m"], x["name"]
        head = F.call_function("substring_index", m, F.concat(F.lit("</"), name, F.lit(">")), F.lit(1))
        low = F.lower(F.substr(head, F.lit(2)))
        simple = (F.length(head) < F.length(m)) & ~m.rlike("^<[^<>]*/>") & (F.instr(low, F.concat(F.lit("<"), F.lower(name))) == 0) & (F.instr(low, F.concat(F.lit("</"), F.lower(name))) == 0)
        whole = F.when(F.lower(name).isin(VOID_TAGS), F.lit(""))
        # most elements hold none of their name: the first closing tag is theirs, and nothing need be counted
        return whole.when(simple, F.regexp_replace(head, "^<[^<>]*>", "")).otherwise(_with(_named_tags(m, name), inside))

    def inside(pieces: Column) -> Column:
        return _with(_closes_at(pieces, F.lit(0), F.lit(True))["at"], lambda at: first(pieces, F.when(at < 0, F.size(pieces)).otherwise(at)))

    def first(pieces: Column, n: Column) -> Column:
        return F.regexp_replace(F.array_join(F.slice(pieces, F.lit(1), n), ""), "^<[^<>]*>", "")

    return _with(markup, content)


def without_comments(html: Column) -> Column:
    """Markup without comments; one that is never closed reaches to the next opening of one."""

    def rest(piece: Column, n: Column) -> Column:
        closed = F.instr(piece, F.lit("-->"))
        return F.when(n == 0, piece).when(closed > 0, F.substr(piece, closed + 3)).otherwise("")

    return F.when(F.contains(html, F.lit("<!--")), F.array_join(F.transform(F.split(html, "<!--"), rest), "")).otherwise(html)


def cards_in(html: Column, layout: BoardLayout) -> Column:
    """The cards of a page as an array.

    With a card class, a card runs from its opening tag to the next card's, so
    markup nested inside does not matter.
    """
    if layout.card_pattern:
        return F.regexp_extract_all(html, F.lit(layout.card_pattern), F.lit(0))
    return _each(html, layout.card_class)


def split_cards(df: DataFrame, html: str, layout: BoardLayout) -> DataFrame:
    """One row per card with its position; pages without cards give none.

    A per-page limit cuts the list before it is exploded.
    """
    cards = cards_in(F.col(html), layout)
    if layout.cards_per_page is not None:
        cards = F.slice(cards, 1, layout.cards_per_page)
    kept = [c for c in df.columns if c != html]
    return df.select(*kept, F.posexplode(cards).alias("card_no", "card"))


def company_in(description: Column) -> Column:
    """Text after "Company:" up to the end of the line, else NULL."""
    return F.nullif(strip(F.regexp_extract(description, r"Company:([^\n]*)", 1)), F.lit(""))


def salary_tag(tags: Column) -> Column:
    """First tag that names pay, else NULL."""
    words = "|".join(re.escape(w) for w in rules.SALARY_TAG_WORDS)
    return F.try_element_at(F.filter(tags, lambda t: F.lower(t).rlike(words)), F.lit(1))


def tags_in(card: Column, css_class: str) -> Column:
    """Texts of all elements of a class, in page order."""
    inner = F.filter(F.transform(_each(card, css_class), _up_to_closing), lambda t: t.isNotNull())
    return F.transform(inner, lambda t: strip(F.regexp_replace(t, "<[^<>]*>", "")))


def extract_cards(df: DataFrame, html: str, layout: BoardLayout, missing_as_null: bool = False) -> DataFrame:
    """Posting rows of a board's pages; missing fields hold the sentinel.

    A card without a title is kept with a NULL title, so that ``quarantine``
    can count it.
    """
    card = F.col("card")
    elements = {f"_cut_{name}": css_class for name, css_class in layout.field_classes.items()}
    cards = _with_elements(split_cards(df, html, layout), "card", elements)
    fields = {}
    if layout.card_class:
        title_tag = F.regexp_extract("_cut_title", opening_tag(layout.field_classes["title"]) + "[^<>]*>", 0)
        cards = cards.withColumns({"_cut_title_tag": title_tag, "_cut_id": F.regexp_extract(card, r'^<\w+\b[^<>]*\bid="([^"]*)"', 1)})
        fields["url"] = F.nullif(F.regexp_extract("_cut_title_tag", r'\bhref="([^"]*)"', 1), F.lit(""))
        fields["job_id"] = F.nullif(F.col("_cut_id"), F.lit(""))
    cards = _with_contents(cards, list(elements))
    fields = {name: visible_text(F.col(f"_cut_{name}")) for name in layout.field_classes} | fields
    for name, pattern in layout.field_patterns.items():
        raw = F.regexp_extract(card, pattern, 1)
        fields[name] = F.nullif(strip(raw), F.lit("")) if name in layout.attributes else visible_text(raw)
    found = cards.withColumns(fields)
    if "description" in fields and "agency" in fields:
        found = found.withColumn("agency", F.coalesce("agency", company_in(F.col("description"))))
    if layout.tag_class:
        found = found.withColumn("salary", salary_tag(tags_in(card, layout.tag_class)))
    found = settled(found.drop("card", "_cut_title_tag", "_cut_id", *elements))
    if missing_as_null:
        return found
    may_miss = ("agency", "company", "location", "salary", "closing_date", "posted_text")
    return found.na.fill(layout.sentinel, subset=[c for c in may_miss if c in found.columns])


def quarantine(cards: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable cards, cards without a title)."""
    return cards.where(F.col("title").isNotNull()), cards.where(F.col("title").isNull())


_ATTRIBUTE = r"""\s+[^\s=<>"'/]+(?:\s*=\s*(?:"[^"<>]*"|'[^'<>]*'|[^\s"'<>]+))?"""
_UNSEEN = r"(?:display\s*:\s*none|visibility\s*:\s*hidden)"
#: an opening tag that hides its element by an attribute of its own
HIDING_TAG = (
    rf"(?i)<\w+(?:{_ATTRIBUTE})*?\s+(?:hidden(?=[\s=>/])|aria-hidden\s*=\s*[\"']?true|"
    rf"style\s*=\s*(?:\"[^\"<>]*{_UNSEEN}|'[^'<>]*{_UNSEEN}))"
)


def shows(html: Column, pattern: str) -> Column:
    """Does a pattern match outside of all hidden elements?

    An element is hidden by ``hidden``, ``aria-hidden`` or an inline style of its own or
    of an element around it.  Pieces between hiding tags are gone through in order; while
    a hidden element is open, only what follows its balancing tag is looked at.
    """

    def step(acc: Column, piece: Column) -> Column:
        opens = (acc["depth"] == 0) & piece.rlike(f"^{HIDING_TAG}")
        name = F.when(opens, _tag_name(piece)).otherwise(acc["name"])
        return F.when((acc["depth"] == 0) & ~opens, after(acc["name"], F.lit(0), acc, piece)).otherwise(
            _with(
                F.struct(name.alias("name"), _named_tags(piece, name).alias("pieces"), (F.lower(_tag_name(piece)) == F.lower(name)).alias("first")),
                lambda x: hidden(acc, x),
            )
        )

    def hidden(acc: Column, x: Column) -> Column:
        void = F.lower(x["name"]).isin(VOID_TAGS) & (acc["depth"] == 0)
        pieces = x["pieces"]
        return _with(
            _closes_at(pieces, acc["depth"], x["first"]),
            lambda end: after(
                x["name"], F.when(void | (end["at"] >= 0), 0).otherwise(end["depth"]), acc,
                F.when(void, F.array_join(pieces, "")).when(end["at"] < 0, "").otherwise(
                    F.array_join(F.slice(pieces, end["at"] + 1, F.size(pieces)), "")
                ),
            ),
        )

    def after(name: Column, depth: Column, acc: Column, seen: Column) -> Column:
        return F.struct(name.alias("name"), depth.cast("int").alias("depth"), (acc["found"] | seen.rlike(pattern)).alias("found"))

    start = F.struct(F.lit("").alias("name"), F.lit(0).alias("depth"), F.lit(False).alias("found"))
    return F.aggregate(F.split(without_comments(html), f"(?={HIDING_TAG})"), start, step)["found"]


def has_no_results(html: Column, layout: BoardLayout) -> Column:
    """An empty-result text displayed in a div, or no card at all.

    What style sheets and scripts hide cannot be told from the markup.
    """
    texts = "|".join(re.escape(t) for t in rules.NO_RESULT_TEXTS)
    text = rf"<div\b[^<>]*>[^<]*({texts})"
    said = without_comments(html).rlike(text) & shows(html, text)  # few pages have it at all
    return said | ~html.rlike(layout.card_pattern or opening_tag(layout.card_class))


# Markers of a link to the next page.
NEXT_LABEL = "Next Page"
NEXT_CLASSES = ["usajobs-search-pagination__next-page-link", "pagination-next"]


def anchors_in(html: Column) -> Column:
    """Links in page order: (a, item), the markup from its opening tag to its closing one, and a list item's tag right before.

    A link without a closing tag, or with the next link opened before it, is none.
    """

    def links(pieces: Column) -> Column:
        return F.filter(F.transform(pieces, lambda piece, n: link(piece, F.get(pieces, n - 1))), lambda x: x["a"].isNotNull())

    def link(piece: Column, before: Column) -> Column:
        whole = F.concat(F.substring_index(piece, "</a>", 1), F.lit("</a>"))
        return F.struct(
            F.when(piece.rlike(r"^<a\b[^<>]*>") & (F.instr(piece, F.lit("</a>")) > 0), whole).alias("a"),
            F.regexp_extract(F.coalesce(before, F.lit("")), r"<li\b[^<>]*>\s*$", 0).alias("item"),
        )

    return _with(F.split(html, r"(?=<a\b)"), links)


def page_links(df: DataFrame, page: str, html: str) -> DataFrame:
    """All links of a page: position, address, text, and the next-page marks."""
    rows = df.select(page, F.posexplode(anchors_in(F.col(html))).alias("link_no", "_link")).select(page, "link_no", "_link.a", "_link.item")
    a = F.col("a")
    rows = rows.withColumns(
        {
            "href": F.regexp_extract(a, r'^<a\b[^<>]*\bhref="([^"]*)"', 1),
            "text": F.coalesce(visible_text(F.regexp_replace(a, "^<[^<>]*>", "")), F.lit("")),
            "_class": F.regexp_extract(a, r'^<a\b[^<>]*\bclass="([^"]*)"', 1),
            "_label": F.regexp_extract(a, r'^<a\b[^<>]*\baria-label="([^"]*)"', 1),
            "_item": F.regexp_extract("item", r'^<li\b[^<>]*\bclass="([^"]*)"', 1),
        }
    )
    marked = (F.col("_label") == NEXT_LABEL) | any_of(F.col("_class"), NEXT_CLASSES)
    marked = marked | F.col("_item").rlike(r"(^|\s)next(\s|$)")
    return rows.select(
        page, "link_no", "href", "text",
        marked.alias("is_marked_next"),
        any_of(F.col("text"), rules.NEXT_LINK_TEXTS).alias("is_text_next"),
        F.col("_class").contains("disabled").alias("is_disabled"),
    )


def next_links(links: DataFrame, page: str) -> DataFrame:
    """First usable next link per page: marked links if the page has any, else by text."""
    usable = ~F.col("is_disabled")
    best = links.groupBy(page).agg(
        F.bool_or("is_marked_next").alias("_any_marked"),
        F.min_by("href", F.when(F.col("is_marked_next") & usable, F.col("link_no"))).alias("_marked"),
        F.min(F.when(F.col("is_marked_next") & usable, F.col("link_no"))).alias("_has_marked"),
        F.min_by("href", F.when(F.col("is_text_next") & usable, F.col("link_no"))).alias("_by_text"),
        F.min(F.when(F.col("is_text_next") & usable, F.col("link_no"))).alias("_has_text"),
    )
    href = F.when(F.col("_has_marked").isNotNull(), F.col("_marked")).when(
        ~F.col("_any_marked") & F.col("_has_text").isNotNull(), F.col("_by_text")
    )
    return best.select(page, href.alias("next_href")).where(F.col("next_href").isNotNull())


# ---- nested markup -------------------------------------------------------

def extract_nested_cards(df: DataFrame, page: str, html: str, layout: BoardLayout) -> DataFrame:
    """Posting rows where cards hold nested markup: (page, card_no, job_id, url, fields).

    A card and a field reach to the closing tag that balances their own name; without one
    a field reaches to the end of its card, a card to the next card or the end of the page.
    What follows a card belongs to none, nor do comments.  Of several elements of a field's
    class the first counts; the address is that of the first field with a link.
    """
    pages = df.select(page, without_comments(F.col(html)).alias("_html"))
    cards = split_cards(pages, "_html", layout).withColumn("_cut_id", F.regexp_extract("card", r'^<\w+\b[^<>]*\bid="([^"]*)"', 1))
    elements = {f"_cut_{name}": css_class for name, css_class in layout.field_classes.items()}
    found = _with_elements(_with_contents(cards, ["card"], nested=True), "card", elements).drop("card")
    found = found.withColumns({f"{e}_href": F.regexp_extract(e, r'^<[^<>]*\bhref="([^"]*)"', 1) for e in elements})
    # what is longer begins earlier
    links = [F.when(F.col(f"{e}_href") != "", F.struct((-F.length(e)).alias("at"), F.col(f"{e}_href").alias("href"))) for e in elements]
    found = _with_contents(found.withColumn("_cut_url", F.array_min(F.array(*links))["href"]), list(elements), nested=True)
    return settled(found.select(
        page, "card_no", F.nullif(strip(F.col("_cut_id")), F.lit("")).alias("job_id"), strip(F.col("_cut_url")).alias("url"),
        *(visible_text(F.col(f"_cut_{name}")).alias(name) for name in layout.field_classes),
    ))
