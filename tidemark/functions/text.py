"""Text cleaning, text measures and text predicates."""

from __future__ import annotations

import html
from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.constants import (
    BLOCK_PHRASES,
    BLOCK_SCAN_CHARS,
    ERROR_PHRASES,
    JUNK_RATIO_CAP,
    NAV_PHRASES,
    PREVIEW_CHARS,
    URL_OR_LINK,
    WS,
)

_WS_RUN = rf"(?U)[{WS}]+"
#: Texts whose entities are decoded at once within a batch.
UNESCAPE_ROWS = 512


@F.arrow_udf(T.StringType())
def _unescape_batch(text: pa.Array) -> pa.Array:
    # Repeats are decoded once per slice; nulls (rows without "&") cost one validity bit each.
    # The slices bound the texts that are Python strings at one time.
    parts = []
    for start in range(0, len(text), UNESCAPE_ROWS):
        encoded = text[start : start + UNESCAPE_ROWS].dictionary_encode()
        decoded = pa.array([html.unescape(v.as_py()) for v in encoded.dictionary], pa.string())
        parts.append(pc.take(decoded, encoded.indices))
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


def unescape_html(text: Column) -> Column:
    """Decode HTML entities in one pass, as browsers do.

    Spark has no such function. Only rows holding an ampersand hand their text to the Python
    worker; every other row hands over a null and keeps its own value.
    """
    decoded = _unescape_batch(F.when(text.contains("&"), text))
    return F.coalesce(decoded, text)


def collapse_whitespace(text: Column) -> Column:
    """Any whitespace run becomes one space; the ends are trimmed."""
    return F.trim(F.regexp_replace(text, _WS_RUN, " "))


def clean_text(text: Column, *, unescape: bool = True) -> Column:
    """Null to empty, entities decoded, whitespace collapsed and trimmed."""
    decoded = unescape_html(text) if unescape else text
    return F.coalesce(collapse_whitespace(decoded), F.lit(""))


def char_count(text: Column) -> Column:
    """Number of code points."""
    return F.length(text)


def words(text: Column) -> Column:
    """Whitespace-separated words, without empty ones."""
    return F.filter(F.split(text, _WS_RUN), lambda w: w != "")


def terms(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def has_any(
    text: Column, phrases: Sequence[tuple[str, Sequence[str]]], lowered: Column | None = None
) -> Column:
    """The text matches at least one phrase, ignoring case.

    Substring tests on bytes are far cheaper than patterns, so a phrase's pattern only runs on
    texts that hold its fragments. ``lowered`` is the lower-cased text where it is at hand.
    """
    low = F.lower(text) if lowered is None else lowered

    def found(pattern: str, fragments: Sequence[str]) -> Column:
        return reduce(lambda a, b: a & b, [low.contains(f) for f in fragments]) & text.rlike(
            "(?iu)" + pattern
        )

    return reduce(lambda a, b: a | b, [found(*phrase) for phrase in phrases])


def url_junk_ratio(text: Column) -> Column:
    """Share of characters inside markdown links or URLs; null and empty give 0."""
    covered = F.aggregate(
        F.regexp_extract_all(text, F.lit("(?U)" + URL_OR_LINK), F.lit(0)),
        F.lit(0),
        lambda acc, match: acc + F.length(match),
    )
    # Plain substring tests first: most texts hold no link, and the pattern is the costly part.
    may_match = text.contains("](") | text.contains("://") | text.contains("www.")
    return F.when(may_match, covered / F.length(text)).otherwise(F.lit(0.0))


def passes_junk(text: Column) -> Column:
    """At most half of the characters are URLs or links."""
    return url_junk_ratio(text) <= JUNK_RATIO_CAP


def is_error_page(text: Column, lowered: Column | None = None) -> Column:
    """The text reads like an error, maintenance or paywall page; null does not."""
    return F.coalesce(has_any(text, ERROR_PHRASES, lowered), F.lit(False))


def nav_junk_ratio(text: Column) -> Column:
    """Navigation phrases per 200 words; null and empty give 1."""
    all_phrases = F.regexp_count(text, F.lit("(?iu)" + "|".join(p for p, _ in NAV_PHRASES)))
    hits = F.when(has_any(text, NAV_PHRASES), all_phrases).otherwise(0)
    n_words = F.greatest(F.size(words(text)), F.lit(1))
    return F.when(F.length(text) > 0, hits / (n_words / 200.0)).otherwise(F.lit(1.0))


def detect_block(text: Column) -> Column:
    """The bot-wall phrase found near the top, by phrase priority; null when there is none."""
    head = F.left(text, F.lit(BLOCK_SCAN_CHARS))
    found = [
        F.when(has_any(head, [phrase]), F.regexp_extract(head, "(?iu)" + phrase[0], 0))
        for phrase in BLOCK_PHRASES
    ]
    return F.coalesce(*found)


def probe_verdict(chars: Column, links: Column, block: Column) -> Column:
    """GOOD, BLOCKED, WEAK or FAIL for one fetched page."""
    blocked = F.coalesce(block, F.lit("")) != ""
    return (
        F.when((chars > 1500) & (links > 10) & ~blocked, "GOOD")
        .when(blocked, "BLOCKED")
        .when(chars > 0, "WEAK")
        .otherwise("FAIL")
    )


def preview_text(text: Column) -> Column:
    """First 200 characters, then whitespace runs collapsed (ends are not trimmed)."""
    return F.regexp_replace(F.left(text, F.lit(PREVIEW_CHARS)), _WS_RUN, " ")


def first_truthy(*values: Column) -> Column:
    """First value that is neither null nor the empty string.

    For numbers use :func:`first_nonzero`: a zero counts as missing there.
    """
    return F.coalesce(*[F.nullif(value, F.lit("")) for value in values])


def first_nonzero(*values: Column) -> Column:
    """First number that is neither null nor zero (NaN counts as a value)."""
    return F.coalesce(*[F.nullif(value, F.lit(0).cast("double")) for value in values])
