"""Aligning, deduplicating, previewing and incremental filtering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.ids import sha256_id
from tidemark.functions.text import clean_text, preview_text


def align_frame(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to the schema: absent columns as typed nulls, unfit values as null."""
    have = {f.name: f.dataType for f in df.schema.fields}

    def aligned(field: T.StructField) -> Column:
        if field.name not in have:
            return F.lit(None).cast(field.dataType).alias(field.name)
        if have[field.name] == field.dataType:
            return F.col(field.name)
        return F.col(field.name).try_cast(field.dataType).alias(field.name)

    return df.select(*[aligned(field) for field in schema.fields])


def union_aligned(frames: Sequence[DataFrame], schema: T.StructType) -> DataFrame:
    """Vertical concatenation after alignment."""
    first, *rest = [align_frame(df, schema) for df in frames]
    for df in rest:
        first = first.unionByName(df)
    return first


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key in the given total order.

    Spark applies the rank limit before the shuffle as well (WindowGroupLimit), so a key that
    holds a third of all rows sends one row per map task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def rows_not_in(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is absent from the existing table (left anti join).

    Keys are content ids and never null. The engine picks broadcast or shuffle at run time
    from the real size of the ``existing`` keys.
    """
    return df.join(existing.select(*keys), list(keys), "left_anti")


def new_bronze_rows(batch: DataFrame, bronze: DataFrame) -> DataFrame:
    """Batch rows not yet in bronze."""
    return rows_not_in(batch, bronze, ["bronze_id"])


def new_silver_rows(bronze: DataFrame, pages: DataFrame) -> DataFrame:
    """Bronze rows not yet promoted to pages."""
    return rows_not_in(bronze, pages, ["bronze_id"])


def passing_rows(batch: DataFrame, failures: DataFrame) -> DataFrame:
    """The batch without every row that shares an id with a failed row."""
    return rows_not_in(batch, failures, ["bronze_id"])


def nonblank_pages(bronze: DataFrame) -> DataFrame:
    """Bronze rows with cleaned, non-empty text and their text hash."""
    return (
        bronze.withColumn("text", clean_text(F.col("text")))
        .where(F.length("text") > 0)
        .withColumn("text_hash", sha256_id(F.col("text")))
    )


def with_page_ids(pages: DataFrame) -> DataFrame:
    """Add the page id: bronze id, raw URL, query and text hash."""
    return pages.withColumn(
        "page_id",
        sha256_id(
            F.col("bronze_id"), F.col("source_url"), F.col("query"), F.col("text_hash"),
            prefix="page",
        ),
    )


def dedup_pages(pages: DataFrame) -> DataFrame:
    """One row per page id.

    Rows sharing a page id agree on every column the id is made of; the remaining columns
    break the tie so that reruns keep the same row.
    """
    rest = [c for c in ("crawled_at", "title", "date_published", "source_domain") if c in pages.columns]
    return keep_first(pages, ["page_id"], rest or ["bronze_id"])


def preview(df: DataFrame, *, order: Sequence[str], n: int, full_text: bool = False) -> DataFrame:
    """The first ``n`` rows (all when 0), long text cut and flattened unless asked otherwise."""
    rows = df.orderBy(*order)
    if n > 0:
        rows = rows.limit(n)
    return rows if full_text else rows.withColumn("text", preview_text(F.col("text")))
