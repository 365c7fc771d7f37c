"""BM25 of a page's text blocks against a query.

Statistics are per page, over its own blocks, so everything is computed inside the row: no
explode, no shuffle, no join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.constants import LINE_BREAK, RELEVANCE_FLOOR
from tidemark.functions.links import split_query_terms
from tidemark.functions.text import terms

K1 = 1.2
B = 0.75


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def text_blocks(text: Column) -> Column:
    """The non-blank lines of a text."""
    return F.filter(F.split(text, f"[{LINE_BREAK}]"), lambda b: F.trim(b) != "")


def _block_stats(blocks: Column, query_terms: list[str]) -> Column:
    """Per block: its text, its length in terms, and how often each query term occurs."""

    def occurrences(found: Column, term: str) -> Column:
        return F.size(F.filter(found, lambda t: t == F.lit(term)))

    def stats(block: Column) -> Column:
        return _let(
            terms(block),
            lambda ts: F.struct(
                block.alias("block"),
                F.size(ts).alias("length"),
                F.array(*[occurrences(ts, q) for q in query_terms]).alias("tf"),
            ),
        )

    return F.transform(blocks, stats)


def bm25_blocks(text: Column, query: str) -> Column:
    """Array of (block, score) over the text's blocks; terms add up in query order."""
    query_terms = [t.lower() for t in split_query_terms(query)]

    def page_stats(rows: Column) -> Column:
        n = F.size(rows)

        def idf(i: int) -> Column:
            df = F.size(F.filter(rows, lambda r: r["tf"][i] > 0))
            return F.log(1.0 + (n - df + 0.5) / (df + 0.5))

        total = F.aggregate(rows, F.lit(0), lambda acc, r: acc + r["length"])
        return F.struct(
            rows.alias("rows"),
            F.try_divide(total, n).alias("mean_length"),
            F.array(*[idf(i) for i in range(len(query_terms))]).alias("idf"),
        )

    def scored(page: Column) -> Column:
        def score(row: Column) -> Column:
            share = F.try_divide(row["length"], page["mean_length"])
            norm = K1 * (1.0 - B + B * share)
            total = F.lit(0.0)
            for i in range(len(query_terms)):
                tf = row["tf"][i]
                gain = page["idf"][i] * tf * (K1 + 1.0) / (tf + norm)
                total = total + F.when(tf > 0, gain).otherwise(0.0)
            return F.struct(row["block"].alias("block"), total.alias("score"))

        return F.transform(page["rows"], score)

    stats = _block_stats(text_blocks(text), query_terms)
    return _let(_let(stats, page_stats), scored)


def bm25_fit(text: Column, query: str, floor: float = RELEVANCE_FLOOR) -> Column:
    """The blocks scoring at least ``floor``, in page order, one per line."""
    kept = F.filter(bm25_blocks(text, query), lambda b: b["score"] >= floor)
    return F.array_join(F.transform(kept, lambda b: b["block"]), "\n")
