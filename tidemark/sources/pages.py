"""Stored raw pages (url, html) in place of fetched results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import unescape_html

_HIDDEN = (
    r"(?is)<script\b.*?</script>|<style\b.*?</style>|<title\b.*?</title>|<!--.*?-->|<!doctype[^>]*>"
)
_BREAKS = (
    r"(?i)</?(?:p|br|div|h[1-6]|li|ul|ol|tr|table|article|section|header|footer|nav|body|html)\b[^>]*>"
)
_META = r"""(?i)<meta\s+(?:name|property)="{name}"\s+content="([^"]*)\""""
META_NAMES = ("og:title", "article:published_time", "og:article:published_time", "date")


def html_title(html: Column) -> Column:
    """Content of the title element, entities still encoded; empty when there is none."""
    return F.trim(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def html_meta(html: Column, name: str) -> Column:
    """Content of a named meta element; empty when there is none."""
    return F.regexp_extract(html, _META.format(name=name), 1)


def html_lines(html: Column) -> Column:
    """Visible text, one line per block element, entities still encoded."""
    text = F.regexp_replace(html, _HIDDEN, "")
    text = F.regexp_replace(text, _BREAKS, "\n")
    text = F.regexp_replace(text, r"<[^>]*>", "")
    text = F.regexp_replace(text, r"[ \t\r]+", " ")
    text = F.regexp_replace(text, r" ?\n[ \n]*", "\n")
    return F.btrim(text, F.lit(" \n"))


def site_url(url: Column) -> Column:
    """Scheme and host of a URL, with a trailing slash."""
    return F.concat(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1), F.lit("/"))


def pages_to_fetched(pages: DataFrame) -> DataFrame:
    """Stored pages as fetch results: success flag, URL, start URL, body and metadata."""
    html = F.col("html")
    meta = F.create_map(
        F.lit("title"), unescape_html(html_title(html)),
        *[
            part
            for name in META_NAMES
            for part in (F.lit(name), html_meta(html, name))
        ],
    )
    rest = [c for c in pages.columns if c not in ("url", "html")]
    return pages.select(
        *rest,
        "url",
        site_url(F.col("url")).alias("start_url"),
        html.isNotNull().alias("success"),
        F.when(html.isNull(), F.lit("no content stored")).alias("error"),
        unescape_html(html_lines(html)).alias("raw_markdown"),
        F.map_filter(meta, lambda _, v: v != "").alias("metadata"),
        html,
    )


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored pages from parquet, as fetch results."""
    return pages_to_fetched(spark.read.parquet(path))
