"""URL filter: host and path rules, carried over to aliases of a page.

*Rules.*  A rule names a host and the start of a path; it fits the host and all its subdomains
if the url's path starts with the rule's.  The longest fitting rule decides; of equally long
ones an allow does.

*Aliases.*  A canonical link, a refresh to another url and a known redirect say that two urls
are the same page.  Urls are compared without scheme and fragment.  Connected components over
these edges (distributed, see `components.py`) make the aliases, urls that are not pages
themselves included.  A page that no rule fits is blocked if a rule blocks one of its aliases
and none allows one: explicit allows take precedence.  Pages without rule or ruled alias are
allowed.

Nulls: a url that is null or has no `://` has an empty host and path, fits no rule and has no
aliases; a null html has no links.  A link to a url with an empty host is none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.plan import once
from .components import components
from .store import doc_field, packed, unpacked

# verdict, host, path
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

# the tags that name another url of the same page; the last group of each is that url
_TAGS = r"(?is)<(?:link|meta)\b[^>]*>"
_CANONICAL = r"(?is)\brel\s*=\s*[\"']?\s*canonical\b"
_HREF = r"(?is)\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
_REFRESH = r"(?is)\bhttp-equiv\s*=\s*[\"']?\s*refresh\b"
_TARGET = r"(?is)\burl\s*=\s*[\"']?([^\"'>\s;]+)"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def after_scheme(url: Column) -> Column:
    """What follows the first `://`; empty where there is none."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))


def host_of(rest: Column) -> Column:
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))


def path_of(rest: Column) -> Column:
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def node_of(rest: Column) -> Column:
    """The url without scheme and fragment."""
    return F.concat(host_of(rest), F.regexp_extract(rest, r"^[^/?#]*([^#]*)", 1))


def decided(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """Struct of the longest fitting rule (`text`) and its `verdict`; null where none fits."""
    best = F.lit(None).cast("struct<text:string,verdict:string>")
    # later cases win: shorter rules first, allows after blocks of the same length
    for verdict, at, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "allow")):
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(start)
        rule = F.struct(F.lit(at + start).alias("text"), F.lit(verdict).alias("verdict"))
        best = F.when(fits, rule).otherwise(best)
    return best


def _resolved(link: Column, host: Column, path: Column) -> Column:
    """The node of a link found on a page; null where it names no other url."""
    link = F.replace(F.trim(link), F.lit("&amp;"), F.lit("&"))
    folder = F.regexp_replace(path, r"[^/]*$", "")
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    rest = (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), after_scheme(link))
        .when(link.startswith("//"), F.substr(link, F.lit(3)))
        .when(link.rlike(r"^(#|$|[A-Za-z][A-Za-z0-9+.-]*:)"), F.lit(None))
        .when(link.startswith("/"), F.concat(host, link))
        .when(link.startswith("?"), F.concat(host, path, link))
        .otherwise(F.concat(host, folder, link))
    )
    return node_of(rest)


def page_links(pages: DataFrame, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """Edges (`a`, `b`) from each page to the urls it names as its own."""
    rest = after_scheme(F.col(url_column))
    tags = F.explode(F.regexp_extract_all(F.col(html_column), F.lit(_TAGS), F.lit(0)))
    # most pages hold neither word, and a search for words is far cheaper than one for tags
    telling = F.col(html_column).rlike(r"(?i)canonical|http-equiv")
    found = pages.where(telling).select(rest.alias("rest"), tags.alias("tag")).where("rest <> ''")
    href = F.concat(*[F.regexp_extract("tag", _HREF, n) for n in (1, 2, 3)])
    link = F.when(F.col("tag").rlike(_CANONICAL), href).when(
        F.col("tag").rlike(_REFRESH), F.regexp_extract("tag", _TARGET, 1)
    )
    named = found.select("rest", link.alias("link")).where("link <> ''")
    there = _resolved(F.col("link"), host_of(F.col("rest")), path_of(F.col("rest")))
    # a link without a host, such as `http://`, names no page
    edges = once(named, there, "b").select(node_of(F.col("rest")).alias("a"), "b")
    return edges.where("a <> b").where(host_of(F.col("b")) != "")


def filter_urls(
    pages: DataFrame,
    redirects: DataFrame | None = None,
    rules: Sequence[tuple[str, str, str]] = RULES,
    url_column: str = "url",
    html_column: str = "html",
    carry: list[str] | None = None,
) -> DataFrame:
    """`pages` (or its columns `carry`) with `host`, `path`, `rule` and `verdict`.

    `redirects` (`from_url`, `to_url`) adds edges to those found in the pages.
    """
    edges = page_links(pages, url_column, html_column)
    if redirects is not None:
        ends = [node_of(after_scheme(F.col(c))) for c in ("from_url", "to_url")]
        edges = edges.unionByName(redirects.select(ends[0].alias("a"), ends[1].alias("b")).where("a <> '' and b <> ''"))
    members = components(edges)
    own = decided(host_of(F.col("node")), path_of(F.col("node")), rules).getField("verdict")
    verdicts = members.select("node", "root", own.alias("own"))
    groups = verdicts.groupBy("root").agg(
        F.coalesce(F.bool_or(F.col("own") == "allow"), F.lit(False)).alias("allowed"),
        F.coalesce(F.bool_or(F.col("own") == "block"), F.lit(False)).alias("blocked"),
    )
    aliases = verdicts.select("node", "root").join(groups, "root").select(
        F.col("node").alias("_node"), (F.col("blocked") & ~F.col("allowed")).alias("_blocked")
    )
    wanted = pages.select(*[f"`{c}`" for c in carry or pages.columns])
    rest = after_scheme(doc_field(url_column))
    judged = packed(pages).select(
        F.struct(*[doc_field(c).alias(c) for c in wanted.columns]).alias("_doc"),
        host_of(rest).alias("host"),
        path_of(rest).alias("path"),
        F.nullif(node_of(rest), F.lit("")).alias("_node"),
        decided(host_of(rest), path_of(rest), rules).alias("_rule"),
    )
    named = judged.join(aliases, "_node", "left").select(
        "_doc",
        "host",
        "path",
        F.col("_rule.text").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), F.when(F.col("_blocked"), "block").otherwise("allow")).alias("verdict"),
    )
    return unpacked(named, wanted, "host", "path", "rule", "verdict")
