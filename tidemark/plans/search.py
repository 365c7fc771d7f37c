"""Search over the silver tables, with an optional refresh when there are too few hits."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.constants import SEARCH_MIN_ARTICLES, SEARCH_THRESHOLD, SEARCH_TOP_K
from tidemark.functions.vectors import Embedder, HashedEmbedder
from tidemark.operators.retrieval import (
    best_pages,
    hits_with_pages,
    order_hits,
    score_chunks,
    search_stats,
)
from tidemark.plans.bronze import ingest_datasets
from tidemark.plans.crawl import extract_pages
from tidemark.plans.silver import build_silver
from tidemark.schemas import HITS
from tidemark.sources import lake as tables
from tidemark.sources.audit import utc_now_iso
from tidemark.sources.lake import DAY, Lake

log = logging.getLogger(__name__)


def query_vector(lake: Lake, query: str, embedder: Embedder) -> list[float]:
    """The query's own vector."""
    one = lake.spark.createDataFrame([(query,)], "text string")
    return list(one.select(embedder.embed(F.col("text"))).first()[0])


def search(
    lake: Lake,
    query: str,
    *,
    threshold: float = SEARCH_THRESHOLD,
    top_k: int = SEARCH_TOP_K,
    embedder: Embedder | None = None,
) -> DataFrame:
    """The best pages for a query; empty when silver is.

    The chunks are ranked first. The hits, at most ``top_k`` rows, carry their crawl day, which
    prunes the page partitions when the join runs.
    """
    if not (lake.exists(tables.CHUNKS) and lake.exists(tables.PAGES)):
        return lake.spark.createDataFrame([], HITS)
    keys = ("page_id", DAY)
    chunks = lake.read(tables.CHUNKS, [*keys, "embedding"])
    vector = query_vector(lake, query, embedder or HashedEmbedder())
    best = best_pages(chunks, vector, threshold=threshold, top_k=top_k, keys=keys)
    pages = lake.read(tables.PAGES, [*keys, "title", "source_url", "crawled_at", "text"])
    return order_hits(hits_with_pages(best, pages, keys=keys))


def scan_stats(
    lake: Lake, query: str, *, threshold: float = SEARCH_THRESHOLD, embedder: Embedder | None = None
) -> DataFrame:
    """What a search scans and how well it scores, one row."""
    vector = query_vector(lake, query, embedder or HashedEmbedder())
    chunks = lake.read(tables.CHUNKS, ["page_id", "embedding"])
    return search_stats(score_chunks(chunks, vector), threshold)


@dataclass(frozen=True)
class QueryResult:
    """A search outcome: at most ``top_k`` hits, and whether a refresh ran."""

    query: str
    hits: DataFrame
    initial_matches: int
    final_matches: int
    refreshed: bool
    threshold: float
    min_articles: int
    top_k: int
    status_message: str


def refresh(
    lake: Lake,
    query: str,
    *,
    pages_path: str,
    data_dir: str,
    crawled_at: str | None = None,
    embedder: Embedder | None = None,
) -> tuple[int, int, int]:
    """Stored pages to landing, bronze and silver; returns rows written to each lake table.

    Only the dataset just written is ingested, and only its crawl day is promoted.
    """
    stamp = crawled_at or utc_now_iso()
    path = extract_pages(lake, pages_path, query=query, data_dir=data_dir, crawled_at=stamp)
    embedder = embedder or HashedEmbedder()
    rows = ingest_datasets(lake.spark, [path], lake, mode="append", embedder=embedder)
    return rows, *build_silver(lake, embedder=embedder, days=[stamp[:10]])


def search_or_refresh(
    lake: Lake,
    query: str,
    refresher: Callable[[str], object],
    *,
    threshold: float = SEARCH_THRESHOLD,
    min_articles: int = SEARCH_MIN_ARTICLES,
    top_k: int = SEARCH_TOP_K,
    force: bool = False,
    no_refresh: bool = False,
    embedder: Embedder | None = None,
) -> QueryResult:
    """Search; with too few hits (or when forced) run ``refresher(query)`` and search again."""
    if force and no_refresh:
        raise ValueError("force and no_refresh exclude each other")

    def hits() -> tuple[DataFrame, int]:
        found = search(lake, query, threshold=threshold, top_k=top_k, embedder=embedder)
        return found, found.count()

    result, initial = (lake.spark.createDataFrame([], HITS), 0) if force else hits()
    final, compared = initial, f"{initial} < {min_articles} articles above {threshold}"
    refreshing = force or (initial < min_articles and not no_refresh)
    if refreshing:
        message = f"too few matches in the lake ({compared}); refreshed"
        refresher(query)
        result, final = hits()
    elif initial < min_articles:
        message = f"too few matches in the lake ({compared}); refresh not allowed"
    else:
        message = (
            f"enough matches in the lake ({initial} >= {min_articles} articles above {threshold})"
        )
    return QueryResult(
        query, result, initial, final, refreshing, threshold, min_articles, top_k, message
    )
