"""URL filter by redirect equivalence.

Rules judge single URLs.  Redirects and canonical links make URLs aliases of one
another; connected components over those edges carry a block to every alias that
no rule judges itself, so an explicit allow always holds.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from string import ascii_lowercase, ascii_uppercase
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagelens.llm.components import connected_components
from wagelens.llm.staging import stage

ALLOW, BLOCK = "allow", "block"


class Rule(NamedTuple):
    """A verdict for a host with all its subdomains, below a path prefix."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def _rest(url: Column) -> Column:
    at = F.instr(url, F.lit("://"))
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), ascii_uppercase, ascii_lowercase)


def path_of(url: Column) -> Column:
    """From the host to ``?``, ``#`` or the end; without ``://`` empty."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def address_of(url: Column) -> Column:
    """Host, path and query: what a server is asked for, whatever scheme and fragment."""
    query = F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)", 1)
    return F.concat(host_of(url), path_of(url), query)


def judged(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest fitting rule as (rule, verdict); of equals an allow; null if none fits."""
    none = F.lit(None).cast("struct<size:int,allow:int,rule:string,verdict:string>")
    fits = [
        F.when(
            ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
            F.struct(
                F.lit(len(r.text)).alias("size"), F.lit(int(r.verdict == ALLOW)).alias("allow"),
                F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"),
            ),
        )
        for r in rules
    ]
    return F.greatest(none, none, *fits)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value evaluated once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), lambda x: use(x)), 1)


def _without_dots(path: Column) -> Column:
    """The path with ``.`` and ``..`` segments folded, as a browser asks for it.

    Cut at the ``..`` segments; each takes the last segment off what was folded before it.
    """

    def step(before: Column, part: Column) -> Column:
        last = F.length(F.substring_index(before, "/", -1))
        return F.concat(F.left(before, F.length(before) - last - 1), part)

    def fold(parts: Column) -> Column:
        return F.aggregate(F.slice(parts, 2, F.size(parts)), F.element_at(parts, 1), step)

    plain = F.regexp_replace(F.regexp_replace(path, r"/\.(?=/)", ""), r"/\.$", "/")
    end = F.when(path.endswith("/.."), "/").otherwise("")
    return F.concat(_bound(F.split(plain, r"/\.\.(?=/|$)"), fold), end)


def _folded(url: Column) -> Column:
    tail = F.regexp_extract(_rest(url), "^[^?#]*(.*)", 1)
    folded = F.concat(F.lit("x://"), host_of(url), _bound(path_of(url), _without_dots), tail)
    return F.when(path_of(url).rlike(r"/\.\.?(/|$)"), folded).otherwise(url)


def _target(base: Column, href: Column) -> Column:
    """A link as an absolute URL, with its dot segments."""
    site = F.concat(F.lit("x://"), host_of(base))
    folder = F.regexp_replace(path_of(base), "[^/]*$", "")
    return (
        F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), href)
        .when(href.startswith("//"), F.concat(F.lit("x:"), href))
        .when(href.startswith("/"), F.concat(site, href))
        .when(href.startswith("?"), F.concat(site, path_of(base), href))
        .when((href == "") | href.startswith("#") | href.contains(":"), F.lit(None))
        .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), href))
    )


def _resolved(base: Column, href: Column) -> Column:
    """A link as an absolute URL."""
    return _bound(_bound(base, lambda b: _bound(F.trim(href), lambda h: _target(b, h))), _folded)


def _attribute(tag: Column, pattern: str) -> Column:
    return F.concat(*(F.regexp_extract(tag, rf"(?i){pattern}", g) for g in (1, 2, 3)))


def _unescaped(value: Column) -> Column:
    return F.regexp_replace(value, "&amp;", "&")


def page_links(pages: DataFrame) -> DataFrame:
    """(src, dst) URLs of canonical links and meta refreshes in ``html``, relative to its ``<base>`` if it has one."""
    some = pages.where(F.col("html").rlike("(?i)canonical|refresh") & F.col("url").contains("://"))
    quoted = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    first_base = F.regexp_extract("html", r"(?i)<base\b[^>]*>", 0)
    base = _resolved(F.col("url"), _unescaped(_attribute(first_base, r"\bhref" + quoted)))
    links = F.explode(F.regexp_extract_all("html", F.lit(r"(?i)<(?:link|meta)\b[^>]*>"), 0))
    tags = some.select("url", F.coalesce(base, "url").alias("base"), links.alias("tag"))
    rel, equiv = _attribute(F.col("tag"), r"\brel" + quoted), _attribute(F.col("tag"), r"\bhttp-equiv" + quoted)
    refresh = F.regexp_extract(_attribute(F.col("tag"), r"\bcontent" + quoted), r"""(?i)url\s*=\s*['"]?([^'">]*)""", 1)
    href = F.when(rel.rlike(r"(?i)(^|\s)canonical(\s|$)"), _attribute(F.col("tag"), r"\bhref" + quoted)).when(
        F.lower(equiv) == "refresh", refresh
    )
    return tags.select(F.col("url").alias("src"), _resolved(F.col("base"), _unescaped(href)).alias("dst")).where("dst is not null")


def _logged(redirects: DataFrame) -> DataFrame:
    """(src, dst) of logged redirects; a target may be relative to its source."""
    target = _resolved(F.col("src"), F.col("dst"))
    return redirects.where("src like '%://%'").select("src", target.alias("dst")).where("dst is not null")


def filter_urls(pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None = None) -> DataFrame:
    """Judge every page by its URL: page_id, host, path, rule, verdict, via_alias.

    ``redirects`` (src, dst) adds logged redirects to the links found in ``html``.
    Targets may be relative; their dot segments are folded, those of ``url`` are not.
    A rule that fits decides; else the page is blocked if a rule blocks any alias
    of it, listed as a page or not (``via_alias``), and allowed otherwise.

    A null URL or one without ``://`` has empty host and path and no aliases; null
    ``html`` has no links; repeated rows are judged alike, one result each; an empty
    table gives no rows; other columns are ignored.
    """
    url = F.col("url")
    rows = pages.select("page_id", "url", host_of(F.coalesce(url, F.lit(""))).alias("host"),
                        path_of(F.coalesce(url, F.lit(""))).alias("path"))
    links = page_links(pages.select("url", "html"))
    if redirects is not None:
        links = links.unionByName(_logged(redirects))
    links = stage(links, "links")
    aliases = connected_components(links.select(address_of(F.col("src")).alias("a"), address_of(F.col("dst")).alias("b")))
    # an address keeps host and path, so it can be judged by itself
    at = F.concat(F.lit("x://"), F.col("node"))
    aliases = aliases.withColumn("verdict", judged(host_of(at), path_of(at), rules)["verdict"])
    blocked = aliases.where(F.col("verdict") == BLOCK).select("root").distinct()
    blocked = aliases.join(blocked, "root", "left_semi").where("verdict is null").select(
        F.col("node").alias("address"), F.lit(True).alias("found")
    )
    own = judged(F.col("host"), F.col("path"), rules)
    address = F.when(url.contains("://"), address_of(url))
    judgement = rows.withColumns({"own": own, "address": address}).join(blocked, "address", "left")
    via = F.col("own").isNull() & F.col("found").isNotNull()
    return judgement.select(
        "page_id", "host", "path", F.col("own.rule").alias("rule"),
        F.coalesce("own.verdict", F.when(via, BLOCK).otherwise(ALLOW)).alias("verdict"), via.alias("via_alias"),
    )
