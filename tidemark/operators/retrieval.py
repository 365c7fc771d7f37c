"""Scoring chunks against a query vector and turning them into page hits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.vectors import VECTOR, dot_similarity


def score_chunks(
    chunks: DataFrame, query: Sequence[float], keep: Sequence[str] = ("page_id",)
) -> DataFrame:
    """The ``keep`` columns and the float ``similarity`` of each chunk; reads nothing else."""
    return chunks.select(*keep, dot_similarity(F.col("embedding"), query).alias("similarity"))


def above(similarity: Column, threshold: float) -> Column:
    """Strictly greater, compared as floats."""
    return similarity > F.lit(threshold).cast("float")


def similarity_filter(scored: DataFrame, threshold: float) -> DataFrame:
    """Chunks scoring above the threshold."""
    return scored.where(above(F.col("similarity"), threshold))


def search_stats(scored: DataFrame, threshold: float) -> DataFrame:
    """Chunks scanned, distinct pages, chunks above the threshold, best similarity; one row."""
    return scored.agg(
        F.count("*").alias("n_chunks"),
        F.count_distinct("page_id").alias("n_pages"),
        F.count_if(above(F.col("similarity"), threshold)).alias("n_above"),
        F.coalesce(F.max("similarity"), F.lit(0.0).cast("float")).alias("max_similarity"),
    )


def best_chunk_per_page(scored: DataFrame, keys: Sequence[str] = ("page_id",)) -> DataFrame:
    """Best similarity per page; combines before the shuffle."""
    return scored.groupBy(*keys).agg(F.max("similarity").alias("similarity"))


def top_k_pages(best: DataFrame, k: int) -> DataFrame:
    """The ``k`` best pages, page id breaking ties."""
    return best.orderBy(F.desc("similarity"), F.asc("page_id")).limit(k)


def hits_with_pages(
    hits: DataFrame, pages: DataFrame, *, keys: Sequence[str] = ("page_id",)
) -> DataFrame:
    """Hits joined to their page's title, URL, crawl stamp and text.

    Spark broadcasts the hits where it measures them as small; with the crawl day among the
    keys it then reads only the partitions of the hits.
    """
    columns = [*keys, "title", "source_url", "crawled_at", "text"]
    return pages.select(*columns).join(hits, list(keys))


def order_hits(hits: DataFrame) -> DataFrame:
    """Final order and columns of a search result."""
    return hits.orderBy(F.desc("similarity"), F.asc("page_id")).select(
        F.col("page_id").alias("row_id"), "similarity", "title", "source_url", "crawled_at", "text"
    )


def best_pages(
    chunks: DataFrame,
    query: Sequence[float],
    *,
    threshold: float,
    top_k: int,
    keys: Sequence[str] = ("page_id",),
) -> DataFrame:
    """The ``top_k`` pages by their best chunk above the threshold."""
    scored = similarity_filter(score_chunks(chunks, query, keys), threshold)
    return top_k_pages(best_chunk_per_page(scored, keys), top_k)


def search_pages(
    chunks: DataFrame,
    pages: DataFrame,
    query: Sequence[float],
    *,
    threshold: float,
    top_k: int,
) -> DataFrame:
    """The whole search as one lazy plan. ``top_k`` applies before the join, so a page missing
    from ``pages`` leaves fewer rows."""
    best = best_pages(chunks, query, threshold=threshold, top_k=top_k)
    return order_hits(hits_with_pages(best, pages))


def mean_pool(df: DataFrame, *, key: str, vector: str, dim: int) -> DataFrame:
    """Element-wise mean of the vectors of each key; null vectors are left out, so a key with
    only null vectors has no row.

    One vector aggregate (``Summarizer.mean``) with partial results in each map task, so each
    task sends one row per key whatever ``dim`` is. Vectors must have ``dim`` elements.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    rows = df.where(F.col(vector).isNotNull()).select(key, array_to_vector(F.col(vector)).alias("_v"))
    means = rows.groupBy(key).agg(Summarizer.mean(F.col("_v")).alias("_m"))
    return means.select(key, vector_to_array("_m").cast(VECTOR).alias(vector))


def bad_vectors(df: DataFrame, *, row_id: str, vector: str, dim: int, n: int = 5) -> DataFrame:
    """The first ``n`` rows, by id, whose vector is not of length ``dim``."""
    size = F.coalesce(F.size(vector), F.lit(-1))
    return (
        df.where(size != dim).select(row_id, size.alias("length")).orderBy(row_id).limit(n)
    )
