"""Gates and statistics over fetched pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.constants import MIN_FIT_CHARS, MIN_RAW_CHARS
from tidemark.functions.ids import url_domain


def page_gate(pages: DataFrame) -> DataFrame:
    """Fetched article pages with a ``keep`` flag.

    Failed fetches and the start page itself are left out and not counted. A page is kept when
    its raw body or its query-filtered body is long enough; ``keep = false`` counts as dropped.
    A page without a URL is no start page.
    """
    slash = F.lit("/")
    same = F.rtrim(F.col("url"), slash) == F.rtrim(F.col("start_url"), slash)
    is_hub = F.coalesce(same, F.lit(False))
    fit, raw = (F.coalesce(F.col(c), F.lit("")) for c in ("fit_markdown", "raw_markdown"))
    return pages.where(F.coalesce("success", F.lit(False)) & ~is_hub).withColumn(
        "keep", (F.length(raw) >= MIN_RAW_CHARS) | (F.length(fit) >= MIN_FIT_CHARS)
    )


def failed_pages(pages: DataFrame) -> DataFrame:
    """Start URL and error of every page whose fetch failed."""
    error = F.col("error") if "error" in pages.columns else F.lit(None).cast("string")
    failed = pages.where(~F.coalesce("success", F.lit(False)))
    return failed.select("start_url", F.coalesce(error, F.lit("fetch failed")).alias("error"))


def site_stats(gated: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """Per site: pages fetched, kept and dropped, and one error when the site had any.

    ``failed`` adds the errors of :func:`failed_pages`, which count as no fetched page.
    """
    error = F.col("error") if "error" in gated.columns else F.lit(None).cast("string")
    rows = gated.select("start_url", "keep", error.alias("error"))
    if failed is not None:
        rows = rows.unionByName(failed, allowMissingColumns=True)
    return rows.groupBy(url_domain(F.col("start_url")).alias("site"), "start_url").agg(
        F.count("keep").alias("pages_fetched"),
        F.count_if("keep").alias("pages_kept"),
        F.count_if(~F.col("keep")).alias("pages_dropped"),
        F.min(error).alias("error"),
    )


def status_of(records: Column, errors: Column) -> Column:
    """fail without records, partial with any site error, else success."""
    return (
        F.when(records == 0, "fail").when(errors > 0, "partial").otherwise("success")
    )


def crawl_status(stats: DataFrame) -> DataFrame:
    """Totals over all sites and the run's status, one row."""
    totals = stats.agg(
        F.coalesce(F.sum("pages_kept"), F.lit(0)).alias("records"),
        F.count("*").alias("n_sites"),
        F.count_if(F.col("error").isNotNull()).alias("n_errors"),
    )
    return totals.withColumn("status", status_of(F.col("records"), F.col("n_errors")))
