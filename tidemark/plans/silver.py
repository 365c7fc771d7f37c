"""Bronze to silver: page and chunk tables with vectors."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.constants import CHUNK_OVERLAP, CHUNK_TOKENS
from tidemark.functions.ids import sha256_id
from tidemark.functions.text import char_count
from tidemark.functions.vectors import Embedder, HashedEmbedder, checked_vector
from tidemark.operators.chunking import chunk_settings, chunk_windows
from tidemark.operators.shaping import (
    align_frame,
    dedup_pages,
    new_silver_rows,
    nonblank_pages,
    rows_not_in,
    with_page_ids,
)
from tidemark.schemas import CHUNKS, PAGES
from tidemark.session import stage, staging
from tidemark.sources import lake as tables
from tidemark.sources.audit import record_run, utc_now_iso
from tidemark.sources.lake import DAY, Lake, days_of

log = logging.getLogger(__name__)


def _with_vectors(df: DataFrame, embedder: Embedder, text: str, row_id: str, at: str) -> DataFrame:
    vector = embedder.embed(F.col(text))
    return (
        df.withColumn("embedding", vector)
        .withColumn("embedding", checked_vector(F.col("embedding"), F.col(row_id), embedder.dim))
        .withColumn("embedding_model", F.lit(embedder.model_name))
        .withColumn("embedding_dim", F.lit(embedder.dim))
        .withColumn("embedded_at", F.lit(at))
    )


def page_rows(bronze: DataFrame) -> DataFrame:
    """Cleaned, identified, deduplicated pages, without vectors."""
    return dedup_pages(with_page_ids(nonblank_pages(bronze)))


def build_pages(bronze: DataFrame, embedder: Embedder, *, embedded_at: str) -> DataFrame:
    """Pages with a vector each. Deduplication comes first, so no text is embedded twice."""
    rows = _with_vectors(page_rows(bronze), embedder, "text", "page_id", embedded_at)
    return align_frame(rows, PAGES)


def chunk_rows(
    pages: DataFrame, embedder: Embedder, *, chunk_tokens: int, chunk_overlap: int
) -> DataFrame:
    """Chunks with id and length, without vectors."""
    chunks = chunk_windows(
        pages, embedder, chunk_tokens=chunk_tokens, chunk_overlap=chunk_overlap
    )
    return chunks.withColumn(
        "chunk_id",
        sha256_id(F.col("page_id"), F.col("chunk_index"), F.col("chunk_text"), prefix="chunk"),
    ).withColumn("chunk_char_count", char_count(F.col("chunk_text")))


def build_chunks(
    pages: DataFrame,
    embedder: Embedder,
    *,
    embedded_at: str,
    chunk_tokens: int = CHUNK_TOKENS,
    chunk_overlap: int = CHUNK_OVERLAP,
) -> DataFrame:
    """Chunks with a vector each; row by row from pages, no shuffle."""
    rows = chunk_rows(pages, embedder, chunk_tokens=chunk_tokens, chunk_overlap=chunk_overlap)
    return align_frame(
        _with_vectors(rows, embedder, "chunk_text", "chunk_id", embedded_at), CHUNKS
    )


def build_silver(
    lake: Lake,
    *,
    embedder: Embedder | None = None,
    chunk_tokens: int = CHUNK_TOKENS,
    chunk_overlap: int = CHUNK_OVERLAP,
    rebuild: bool = False,
    since_day: str | None = None,
    days: Sequence[str] | DataFrame | None = None,
    embedded_at: str | None = None,
) -> tuple[int, int]:
    """Promote new bronze rows (all of them on ``rebuild``); returns (pages, chunks) written.

    ``since_day`` limits both sides of the lookup to the crawl days from then on, ``days`` to
    those days. The lookup moves ids and days only; the text of the new rows is then read from
    their own days. Chunks are
    written before pages, and each table only gets ids it lacks: pages decide what is new, so
    a crash between the two writes is made good by the next run.
    """
    embedder = embedder or HashedEmbedder()
    settings = chunk_settings(embedder, chunk_tokens, chunk_overlap)
    with staging(lake.spark, lake.staging):
        return _promote(lake, embedder, settings, rebuild, since_day, days, embedded_at or utc_now_iso())


def _promote(
    lake: Lake,
    embedder: Embedder,
    settings: tuple[int, int],
    rebuild: bool,
    since_day: str | None,
    within: Sequence[str] | DataFrame | None,
    stamp: str,
) -> tuple[int, int]:
    size, overlap = settings
    columns = ["bronze_id", "title", "date_published", "text", "source_url", "source_domain",
               "query", "crawled_at"]

    def ids(table) -> DataFrame:
        rows = lake.read(table, ["bronze_id", DAY], days=within)
        return rows if since_day is None else rows.where(F.col(DAY) >= since_day)

    todo = ids(tables.BRONZE)
    everything = rebuild or not lake.exists(tables.PAGES)
    if not everything:
        todo = new_silver_rows(todo, ids(tables.PAGES))
    todo = stage(todo.distinct(), "todo")
    if todo.isEmpty():
        log.info("no new bronze rows")
        return 0, 0
    days = stage(todo.select(DAY).distinct(), "days")
    bronze = lake.read(tables.BRONZE, [*columns, DAY], days=days)
    if everything:  # all rows of these days; their texts need not move to be looked up
        fresh = bronze.where(F.col("bronze_id").isNotNull()).drop(DAY)
    else:
        fresh = bronze.join(todo, ["bronze_id", DAY], "left_semi").drop(DAY)

    # Cleaning and embedding happen once, here; the staged pages feed the count, the chunks and
    # the write. Chunks go straight to their table.
    with record_run("silver_pages", lake) as handle:
        pages = stage(build_pages(fresh, embedder, embedded_at=stamp), "silver-pages")
        n_pages = pages.count()
        handle.rows_in = handle.rows_out = n_pages
        handle.details.update(model=embedder.model_name)
    with record_run("silver_chunks", lake, rows_in=n_pages) as handle:
        chunks = build_chunks(
            pages, embedder, embedded_at=stamp, chunk_tokens=size, chunk_overlap=overlap
        )
        _write(lake, tables.CHUNKS, chunks, "chunk_id", rebuild, days)
        _write(lake, tables.PAGES, pages, "page_id", rebuild, days)
        written = lake.read(tables.CHUNKS, ["embedded_at"], days=days)
        n_chunks = written.where(F.col("embedded_at") == stamp).count()
        handle.rows_out = n_chunks
        handle.details.update(
            chunk_tokens=size, chunk_overlap=overlap, model=embedder.model_name
        )
    return n_pages, n_chunks


def _write(lake, table, rows: DataFrame, key: str, rebuild: bool, days) -> None:
    if rebuild:
        lake.overwrite(table, rows)
        return
    if lake.exists(table):
        # Only ids meet the table's ids. The rows themselves move only when some of them are new;
        # few new ids are broadcast to them. A null key is in no table, so it counts as new.
        ids = rows_not_in(rows.select(key), lake.read(table, [key], days=days), [key])
        new = stage(ids.select(F.col(key).alias("_new")).distinct(), "new-ids")
        if new.isEmpty():
            return
        rows = rows.join(new, F.col(key).eqNullSafe(F.col("_new")), "left_semi")
    lake.append(table, rows)


def write_silver(pages: DataFrame, chunks: DataFrame, lake: Lake, *, mode: str = "append") -> None:
    """Align and write both silver tables, chunks first."""
    with staging(lake.spark, lake.staging):
        for table, rows, key in ((tables.CHUNKS, chunks, "chunk_id"), (tables.PAGES, pages, "page_id")):
            aligned = align_frame(rows, table.schema)
            _write(lake, table, aligned, key, mode == "overwrite", days_of(aligned))
