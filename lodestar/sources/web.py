"""Saved web pages: titles, headings, first paragraphs, links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.text import article_link
from lodestar.sources.layout import unescape

CAP = 20


def _plain(html: Column) -> Column:
    return F.trim(F.regexp_replace(unescape(F.regexp_replace(html, "<[^>]*>", "")), r"[ \t\r\n\f]+", " "))


def _first(html: str, pattern: str) -> Column:
    return _plain(F.regexp_extract(F.coalesce(F.col(html), F.lit("")), pattern, 1))


def page_content(pages: DataFrame, html: str = "html") -> DataFrame:
    """(page_id, url, title, heading, paragraph, n_links): the first of each kind, tags off, references decoded."""
    return pages.select(
        "page_id",
        "url",
        _first(html, "(?s)<title>(.*?)</title>").alias("title"),
        _first(html, "(?s)<h1[^>]*>(.*?)</h1>").alias("heading"),
        _first(html, "(?s)<p[^>]*>(.*?)</p>").alias("paragraph"),
        F.size(F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit('<a [^>]*href="[^"]*"'), F.lit(0))).alias("n_links"),
    )


def without_dots(path: Column) -> Column:
    """A path with its ``.`` and ``..`` segments taken in; ``..`` above the root goes."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda done, part: F.when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))).when(part == ".", done).otherwise(F.array_append(done, part)))
    return F.concat(F.array_join(kept, "/"), F.when(last.isin(".", "..") & ~F.array_join(kept, "/").endswith("/"), "/").otherwise(""))


def resolve(base: Column, href: Column) -> Column:
    """Absolute, script and fragment links as they are; others against the page's address, dot segments taken in."""
    origin = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_replace(base, r"[?#].*$", "")
    folder = F.regexp_extract(page, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/]*(?:/.*/|/)?)", 1)
    path, rest = F.regexp_extract(href, r"^([^?#]*)", 1), F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    whole = F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/")))
    inside = F.concat(F.substring(whole, F.length(origin) + 1, F.length(whole)), path)
    return (
        F.when(href.rlike(r"^([a-zA-Z][a-zA-Z0-9+.-]*:|#)"), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, "^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1), href))
        .when(href.startswith("?"), F.concat(page, href))
        .when(href.startswith("/"), F.concat(origin, without_dots(path), rest))
        .when(href == "", base)
        .otherwise(F.concat(origin, without_dots(inside), rest))
    )


def page_links(pages: DataFrame, html: str = "html", cap: int = CAP) -> DataFrame:
    """(page_id, link_no, url, text, is_article): the first links of each page, each signature once."""
    found = F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit('(?s)<a [^>]*href="([^"]*)"[^>]*>(.*?)</a>'), F.lit(0))
    part = lambda a, g: F.regexp_extract(a, '(?s)<a [^>]*href="([^"]*)"[^>]*>(.*?)</a>', g)
    links = F.array_distinct(F.transform(found, lambda a: F.struct(part(a, 1).alias("href"), F.substring(_plain(part(a, 2)), 1, 50).alias("text"))))
    rows = pages.select("page_id", F.col("url").alias("base"), F.posexplode(F.slice(links, 1, cap)).alias("at", "a"))
    return rows.select("page_id", (F.col("at") + 1).alias("link_no"), resolve(F.col("base"), F.col("a.href")).alias("url"), F.col("a.text").alias("text"), article_link("a.href").alias("is_article"))
