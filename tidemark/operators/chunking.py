"""Token windows over page text."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.vectors import Embedder

log = logging.getLogger(__name__)


def chunk_settings(embedder: Embedder, chunk_tokens: int, chunk_overlap: int) -> tuple[int, int]:
    """Validated window size and overlap, then clamped to what the model can take."""
    if chunk_tokens <= 0:
        raise ValueError("chunk_tokens must be greater than zero")
    if not 0 <= chunk_overlap < chunk_tokens:
        raise ValueError("chunk_overlap must be non-negative and smaller than chunk_tokens")
    limit = max(1, embedder.max_tokens - embedder.special_tokens)
    if chunk_tokens <= limit:
        return chunk_tokens, chunk_overlap
    log.info("chunk_tokens clamped from %d to %d", chunk_tokens, limit)
    return limit, chunk_overlap if chunk_overlap < limit else limit // 8


def chunk_texts(text: Column, embedder: Embedder, size: int, overlap: int) -> Column:
    """Decoded windows of ``size`` tokens, ``size - overlap`` apart.

    The last window is the first one to reach the end of the text; empty windows are dropped.
    """
    step = size - overlap

    def windows(tokens: Column) -> Column:
        last = F.greatest(F.lit(0), F.ceil((F.size(tokens) - size) / step).cast("int"))
        decoded = F.transform(
            F.sequence(F.lit(0), last),
            lambda i: embedder.decode(F.slice(tokens, i * step + 1, size)),
        )
        return F.filter(decoded, lambda t: t != "")

    return F.transform(F.array(embedder.encode(text)), windows)[0]


def chunk_windows(
    pages: DataFrame, embedder: Embedder, *, chunk_tokens: int, chunk_overlap: int
) -> DataFrame:
    """One row per chunk: the page's columns, ``chunk_index`` and ``chunk_text``; no shuffle."""
    size, overlap = chunk_settings(embedder, chunk_tokens, chunk_overlap)
    chunks = chunk_texts(F.col("text"), embedder, size, overlap)
    rest = [c for c in pages.columns if c != "text"]
    return pages.select(*rest, F.posexplode(chunks).alias("chunk_index", "chunk_text"))
