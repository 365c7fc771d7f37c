"""Raw page payload to record fields.

A raw page may carry any of ``url, source_url, _source_start_url, _source_domain, title,
date_published, fit_markdown, raw_markdown, markdown, content, text, metadata (string map),
relevance_score, score``; absent columns read as null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.constants import DATE_FORMS, LINE_BREAK, TEXT_CHAR_CAP, TITLE_CHAR_CAP, WS
from tidemark.functions.ids import strip_whitespace
from tidemark.functions.text import first_truthy

_BLANK = rf"[{WS}&&[^{LINE_BREAK}]]"
# Leftmost line with something on it besides blanks and leading hash signs.
_FIRST_LINE = rf"(?U)(?:^|[{LINE_BREAK}]){_BLANK}*+#*+{_BLANK}*+([^{LINE_BREAK}]+)"


class PageFields:
    """The columns of a raw-page frame by name, null where the frame lacks them."""

    def __init__(self, pages: DataFrame):
        self._types = {f.name: f.dataType for f in pages.schema.fields}

    def __getitem__(self, name: str) -> Column:
        return F.col(name) if name in self._types else F.lit(None).cast("string")

    def text(self, name: str) -> Column:
        return self[name].cast("string")

    def meta(self, key: str) -> Column:
        if "metadata" not in self._types:
            return F.lit(None).cast("string")
        return F.col("metadata")[key]

    def number(self, name: str) -> Column:
        """A score field with its missing values as null: '' in text, 0 in numbers."""
        if isinstance(self._types.get(name), T.NumericType):
            return F.nullif(self[name].cast("double"), F.lit(0.0)).cast("string")
        return F.nullif(self.text(name), F.lit(""))


def markdown_fields(fit: Column, raw: Column, plain: Column) -> tuple[Column, Column]:
    """(fit, raw) with nulls as empty text; plain text counts as raw when both are missing."""
    neither = fit.isNull() & raw.isNull()
    return (
        F.coalesce(fit, F.lit("")),
        F.coalesce(F.when(neither, plain).otherwise(raw), F.lit("")),
    )


def extract_body(candidates: Sequence[Column], cap: int | None = TEXT_CHAR_CAP) -> Column:
    """First non-empty body, cut to the record's text cap if any; empty text when there is none."""
    body = F.coalesce(first_truthy(*candidates), F.lit(""))
    return body if cap is None else F.left(body, F.lit(cap))


def extract_title(explicit: Sequence[Column], body: Column) -> Column:
    """An explicit title, trimmed but never cut; else the first content line, cut to 200."""
    line = strip_whitespace(F.regexp_extract(body, _FIRST_LINE, 1))
    return F.coalesce(
        strip_whitespace(first_truthy(*explicit)),
        F.nullif(F.left(line, F.lit(TITLE_CHAR_CAP)), F.lit("")),
    )


def extract_date(explicit: Sequence[Column], body: Column) -> Column:
    """An explicit date; else ISO, then month-name, then slash form anywhere in the body."""
    found = [
        F.nullif(F.regexp_extract(body, "(?U)" + form, 1), F.lit("")) for form in DATE_FORMS
    ]
    return F.coalesce(first_truthy(*explicit), *found)


def extract_url(*candidates: Column) -> Column:
    """First non-empty URL."""
    return first_truthy(*candidates)


def extract_score(*candidates: Column) -> Column:
    """First given score as a double; text that is no number gives null.

    The candidates hold text, '' and null counting as missing. Note that this is the page's
    own score, which the quality rules later compare with the relevance floor.
    """
    text = F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates])
    java_suffix = text.rlike(r"(?i)[0-9.][df]\s*$")
    return F.when(~java_suffix, text).try_cast("double")


def normalize_records(
    pages: DataFrame, *, query: str, crawled_at: str, text_cap: int | None = TEXT_CHAR_CAP
) -> DataFrame:
    """Raw pages to landing records with one query and one crawl stamp; row by row, no shuffle.

    Bodies are cut to ``text_cap`` characters; None keeps them whole.
    """
    f = PageFields(pages)
    fit, raw = markdown_fields(f.text("fit_markdown"), f.text("raw_markdown"), f.text("markdown"))
    body = extract_body([fit, raw, *(f.text(n) for n in ("markdown", "content", "text"))], text_cap)
    title = [f.text("title"), f.meta("og:title"), f.meta("title")]
    date = [
        f.text("date_published"),
        f.meta("article:published_time"),
        f.meta("og:article:published_time"),
        f.meta("date"),
    ]
    return pages.withColumn("_body", body).select(
        extract_title(title, F.col("_body")).alias("title"),
        extract_date(date, F.col("_body")).alias("date_published"),
        F.col("_body").alias("text"),
        extract_url(f.text("url"), f.text("source_url"), f.text("_source_start_url")).alias(
            "source_url"
        ),
        f.text("_source_domain").alias("source_domain"),
        extract_score(f.number("relevance_score"), f.number("score")).alias("relevance_score"),
        F.lit(query).alias("query"),
        F.lit(crawled_at).alias("crawled_at"),
    )
