"""Content identity and URL shape."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.constants import ID_SEPARATOR, WS

_SCHEME_AND_HOST = r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+)([^?#]*)"
_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"


def sha256_id(*parts: Column, prefix: str | None = None) -> Column:
    """SHA-256 over the parts joined by U+001F, null counting as the empty string."""
    joined = F.concat_ws(
        ID_SEPARATOR, *[F.coalesce(part.cast("string"), F.lit("")) for part in parts]
    )
    digest = F.sha2(joined, 256)
    return F.concat(F.lit(prefix + "_"), digest) if prefix else digest


def day_of(stamp: Column) -> Column:
    """The day part of an ISO stamp; null gives the empty string."""
    return F.left(F.coalesce(stamp, F.lit("")), F.lit(10))


def strip_whitespace(text: Column) -> Column:
    """Trim what Python's ``str.strip`` trims, NBSP and U+001C..U+001F included."""
    return F.regexp_replace(text, rf"(?U)^[{WS}]+|[{WS}]+$", "")


def normalize_url(url: Column) -> Column:
    """Lower-case scheme and authority, without query, fragment and trailing slashes.

    Null when the input is blank, has no scheme or no authority, or has an unbalanced
    IPv6 bracket. The path keeps its case.
    """
    text = F.regexp_replace(strip_whitespace(url), r"[\t\r\n]", "")
    head = F.regexp_extract(text, _SCHEME_AND_HOST, 1)
    path = F.regexp_extract(text, _SCHEME_AND_HOST, 2)
    balanced = head.contains("[") == head.contains("]")
    return F.when(
        (head != "") & balanced, F.concat(F.lower(head), F.rtrim(path, F.lit("/")))
    )


def url_domain(url: Column) -> Column:
    """The authority part of a URL, as written; empty when there is none."""
    return F.regexp_extract(url, _AUTHORITY, 1)


def bronze_id(crawled_at: Column, source_url: Column, title: Column) -> Column:
    """One id per article, URL variant-insensitive, per UTC day; the text takes no part."""
    return sha256_id(day_of(crawled_at), normalize_url(source_url), title, prefix="bronze")
