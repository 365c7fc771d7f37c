"""Stored pages to landing records."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.constants import TEXT_CHAR_CAP
from tidemark.functions.bm25 import bm25_fit
from tidemark.functions.extraction import normalize_records
from tidemark.functions.ids import url_domain
from tidemark.functions.links import keyword_relevance, passing_pages
from tidemark.operators.crawl import crawl_status, failed_pages, page_gate, site_stats
from tidemark.session import stage, staging
from tidemark.sources import lake as tables
from tidemark.sources.audit import record_run, utc_now_iso
from tidemark.sources.lake import Lake
from tidemark.sources.landing import write_landing
from tidemark.sources.pages import read_pages


def fetched_pages(pages: DataFrame, query: str) -> DataFrame:
    """Fetched pages with their query-filtered body, score and site."""
    return (
        pages.withColumn("fit_markdown", bm25_fit(F.col("raw_markdown"), query))
        .withColumn("score", keyword_relevance(F.col("url"), query))
        .withColumn("_source_start_url", F.col("start_url"))
        .withColumn("_source_domain", url_domain(F.col("start_url")))
    )


def extract_pages(
    lake: Lake,
    pages_path: str,
    *,
    query: str,
    data_dir: str,
    crawled_at: str | None = None,
    sites: Sequence[dict] | None = None,
    text_cap: int | None = TEXT_CHAR_CAP,
) -> str:
    """Gate and normalise stored pages into one landing dataset; returns its path.

    One pass over the pages, staged once: the kept rows go to landing, the flags to the table of
    site statistics. ``sites`` (dicts with ``url``, ``url_patterns`` and ``include_external``)
    limits the pages to those that pass their site's filters; ``text_cap`` cuts bodies, None
    keeps them whole.
    """
    stamp = crawled_at or utc_now_iso()
    with staging(lake.spark, lake.staging), record_run("crawl", lake, query=query) as handle:
        stored = read_pages(lake.spark, pages_path)
        if sites is not None:
            stored = passing_pages(stored, sites)
        fetched = fetched_pages(stored, query)
        gated = stage(page_gate(fetched).drop("html"), "gated-pages")
        file_stamp = datetime.fromisoformat(stamp).strftime("%Y%m%dT%H%M%SZ")
        records = normalize_records(gated.where("keep"), query=query, crawled_at=stamp, text_cap=text_cap)
        path = write_landing(records, data_dir, file_stamp)
        stats = stage(site_stats(gated, failed_pages(stored)), "site-stats")
        lake.append(tables.SITE_STATS, stats.withColumn("run_id", F.lit(handle.run_id)))
        totals = crawl_status(stats).first()
        handle.set_status(totals["status"])
        handle.rows_out = totals["records"]
        handle.details.update(
            output=path, n_sites=totals["n_sites"], n_errors=totals["n_errors"]
        )
    return path
