"""Link extraction, link filters and keyword scores."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.constants import LINKS_PER_SITE, SITES
from tidemark.functions.ids import url_domain

_SITE_OF = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)"
_FOLDER_OF = r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(?:/[^?#]*/|/)?)"


def glob_to_regex(pattern: str) -> str:
    """Anchored regular expression of a URL glob: ``*`` is any text, ``?`` any character."""
    special = {"*": ".*", "?": "."}
    return "^" + "".join(special.get(ch, re.escape(ch)) for ch in pattern) + "$"


def matches_any_pattern(url: Column, patterns: Sequence[str]) -> Column:
    """The URL matches at least one glob."""
    return url.rlike("|".join(glob_to_regex(p) for p in patterns))


def on_site(url: Column, site_url: Column, include_external: Column) -> Column:
    """The URL is on the site's host, or external links are allowed."""
    return include_external | (url_domain(url) == url_domain(site_url))


def is_html(body: Column, content_type: Column | None = None) -> Column:
    """The declared content type is text/html; without one, the body starts like HTML."""
    sniffed = body.rlike(r"(?i)^\s*<(!doctype\s+html|html)\b")
    if content_type is None:
        return F.coalesce(sniffed, F.lit(False))
    return F.coalesce(F.lower(content_type).startswith("text/html"), sniffed, F.lit(False))


def site_rules(spark: SparkSession, sites: Sequence[dict] = SITES) -> DataFrame:
    """One row per (site, pattern): ``_site_host``, ``_site_regex`` (the anchored glob) and
    ``_site_external``. Of sites with the same host the one listed last holds; a site without
    patterns lets nothing pass. The table is as large as the configuration."""
    rows = [
        (order, site["url"], glob_to_regex(pattern), bool(site.get("include_external", False)))
        for order, site in enumerate(sites)
        for pattern in site.get("url_patterns") or ()
    ]
    listed = spark.createDataFrame(rows, "_site_order int, _site_url string, _site_regex string, _site_external boolean")
    listed = listed.withColumn("_site_host", url_domain(F.col("_site_url")))
    hosts = spark.createDataFrame(
        [(order, site["url"]) for order, site in enumerate(sites)], "_site_order int, _site_url string"
    ).select(url_domain(F.col("_site_url")).alias("_site_host"), "_site_order")
    last = hosts.groupBy("_site_host").agg(F.max("_site_order").alias("_site_order"))
    return listed.join(last, ["_site_host", "_site_order"]).select("_site_host", "_site_regex", "_site_external")


def passing_pages(pages: DataFrame, sites: Sequence[dict] = SITES) -> DataFrame:
    """Stored pages (``start_url``, ``url``, ``html``) that pass their site's filters.

    The rules are a broadcast table joined on the start URL's host: a page passes when its URL
    matches one of the patterns of the site listed last for that host, it is on that host or
    the site allows external pages, and it is HTML (or has no body). Pages keep their columns.
    """
    rules = site_rules(pages.sparkSession, sites)
    # Both sides are named through their frames, so pages may hold columns of the same names.
    host, regex, external = rules["_site_host"], rules["_site_regex"], rules["_site_external"]
    fits = (
        (url_domain(pages["start_url"]) == host)
        & F.regexp_like(pages["url"], regex)
        & (external | (url_domain(pages["url"]) == host))
    )
    kept = pages.join(F.broadcast(rules), fits, "left_semi")
    return kept.where(F.col("html").isNull() | is_html(F.col("html")))


def split_query_terms(query: str) -> list[str]:
    """Whitespace-separated terms; a blank query is its own single term."""
    return query.split() or [query]


def keyword_relevance(url: Column, query: str) -> Column:
    """Share of the query's terms found in the lower-cased URL."""
    query_terms = [t.lower() for t in split_query_terms(query)]
    hits = sum(
        (F.when(F.lower(url).contains(t), 1).otherwise(0) for t in query_terms), F.lit(0)
    )
    return hits / F.lit(len(query_terms))


def resolve_link(href: Column, base: Column) -> Column:
    """An href made absolute against the page URL; null for non-web and fragment-only links.

    Covers absolute, scheme-relative, host-relative, query-only and path-relative links. Dot
    segments are kept as written.
    """
    scheme = F.regexp_extract(base, _SITE_OF, 1)
    host = F.regexp_extract(base, _SITE_OF, 2)
    folder = F.regexp_extract(base, _FOLDER_OF, 1)
    folder = F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/")))
    return (
        F.when(href.rlike(r"(?i)^https?://"), href)
        .when((href == "") | href.startswith("#") | href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), None)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(scheme, F.lit("://"), host, href))
        .when(href.startswith("?"), F.concat(F.regexp_extract(base, r"^([^?#]*)", 1), href))
        .otherwise(F.concat(folder, href))
    )


def extract_links(pages: DataFrame, *, html: str, base: str, keep: Sequence[str]) -> DataFrame:
    """One row per href: the ``keep`` columns, ``link``, ``is_internal`` and ``n_links`` of its page."""
    hrefs = F.regexp_extract_all(F.col(html), F.lit(r'href="([^"]*)"'), F.lit(1))
    resolved = F.transform(hrefs, lambda h: resolve_link(h, F.col(base)))
    found = F.filter(resolved, lambda link: link.isNotNull())
    return (
        pages.select(*keep, F.col(base).alias("_base"), found.alias("_links"))
        .select(
            *keep, "_base", F.size("_links").alias("n_links"),
            # Exploding the bare column would make the optimizer resolve all links twice.
            F.explode(F.array_compact("_links")).alias("link"),
        )
        .select(
            *keep,
            "link",
            (url_domain(F.col("link")) == url_domain(F.col("_base"))).alias("is_internal"),
            "n_links",
        )
    )


def count_internal_links(html: Column, base: Column) -> Column:
    """Number of links of a page that stay on its host."""
    hrefs = F.regexp_extract_all(html, F.lit(r'href="([^"]*)"'), F.lit(1))
    host = url_domain(base)
    return F.size(
        F.filter(hrefs, lambda h: url_domain(resolve_link(h, base)) == host)
    )


def rank_links(links: DataFrame, *, site: str, score: str, cap: int = LINKS_PER_SITE) -> DataFrame:
    """The best ``cap`` links of each site by score, URL breaking ties.

    The rank limit also runs before the shuffle, so a site holding most links sends at most
    ``cap`` rows per map task.
    """
    order = Window.partitionBy(site).orderBy(F.desc(score), F.asc("link"))
    ranked = links.dropDuplicates([site, "link"]).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= cap)
