"""Vector expressions and the embedder plug-in point.

Scoring and embedding work on Arrow batches with numpy: a lambda over ``zip_with`` costs tens
of nanoseconds per dimension, a matrix product over the batch well under one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from hashlib import md5
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.constants import EMBEDDING_DIM, MAX_TOKENS
from tidemark.functions.text import clean_text, terms, words

VECTOR = T.ArrayType(T.FloatType())
#: Rows and terms that are counted at once within a batch; they bound the scratch arrays.
SLICE_ROWS, SLICE_TERMS = 256, 1 << 16


def _matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """The non-null vectors of a batch as rows of one matrix."""
    rows = len(vectors) - vectors.null_count
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    if flat.size != rows * dim:
        raise ValueError(f"expected {dim}-dimensional embeddings")
    return flat.reshape(rows, dim).astype(np.float64)


def _spread(values: np.ndarray, like: pa.Array, kind: pa.DataType) -> pa.Array:
    """Put per-valid-row values back at their rows; null vectors stay null."""
    valid = like.is_valid().to_numpy(zero_copy_only=False)
    out = np.zeros(len(like), dtype=values.dtype)
    out[valid] = values
    return pa.array(out, type=kind, mask=~valid)


def dot_similarity(vector: Column, query: Sequence[float]) -> Column:
    """Dot product with a fixed query vector, as float. Cosine only for unit vectors."""
    weights = np.asarray(query, dtype=np.float64)

    @F.arrow_udf(T.FloatType())
    def score(vectors: pa.Array) -> pa.Array:
        sims = (_matrix(vectors, len(weights)) @ weights).astype(np.float32)
        return _spread(sims, vectors, pa.float32())

    # Called non-deterministic so that a filter on the score is not pushed below the projection,
    # where every row would be scored a second time.
    return score.asNondeterministic()(vector)


def l2_normalize(vector: Column) -> Column:
    """Scale to unit length; a zero vector stays zero."""

    @F.arrow_udf(VECTOR)
    def scale(vectors: pa.Array) -> pa.Array:
        lengths = pa.compute.list_value_length(vectors).drop_null().to_numpy()
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        norms = np.sqrt(np.bincount(owner, weights=flat * flat, minlength=len(lengths)))
        unit = (flat / np.maximum(norms, 1e-12)[owner]).astype(np.float32)
        valid = vectors.is_valid().to_numpy(zero_copy_only=False)
        sizes = np.zeros(len(vectors), dtype=np.int64)
        sizes[valid] = lengths
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return pa.ListArray.from_arrays(
            pa.array(offsets), pa.array(unit), mask=pa.array(~valid)
        )

    return scale(vector)


def checked_vector(vector: Column, row_id: Column, dim: int = EMBEDDING_DIM) -> Column:
    """The vector itself; the job fails, naming the row, when its length is not ``dim``."""
    problem = F.concat(
        F.lit(f"expected {dim}-dimensional embeddings; bad row: "),
        F.coalesce(row_id.cast("string"), F.lit("?")),
    )
    return F.when(F.coalesce(F.size(vector), F.lit(-1)) == dim, vector).otherwise(
        F.raise_error(problem)
    )


class Embedder(Protocol):
    """What the silver build and the search need from a text model."""

    model_name: str
    dim: int
    max_tokens: int
    special_tokens: int
    sparse: bool  # few nonzero elements for short texts

    def embed(self, text: Column) -> Column:
        """Text to a unit vector of ``dim`` floats; null counts as the empty text."""

    def encode(self, text: Column) -> Column:
        """Text to an array of tokens."""

    def decode(self, tokens: Column) -> Column:
        """Array of tokens back to text."""


def _whitespace_decode(tokens: Column) -> Column:
    return clean_text(F.array_join(tokens, " "), unescape=False)


def _row_slices(sizes: np.ndarray, rows: int, values: int) -> Iterator[slice]:
    """Runs of rows of at most ``rows`` rows and ``values`` list elements, one row at least."""
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        before = ends[start] - sizes[start]
        stop = int(np.searchsorted(ends, before + values, side="right"))
        stop = max(start + 1, min(stop, start + rows))
        yield slice(start, stop)
        start = stop


def _term_codes(terms_of_batch: pa.Array) -> np.ndarray:
    """First four bytes of each term's MD5 as an unsigned number."""
    digests = [md5(term.encode()).digest()[:4] for term in terms_of_batch.to_pylist()]
    return np.frombuffer(b"".join(digests), dtype=">u4").astype(np.int64)


@dataclass(frozen=True)
class HashedEmbedder:
    """Signed hashed bag of words, the built-in model.

    Spark splits the text into terms; distinct terms are hashed once per slice of a batch (MD5, so
    any SQL engine can repeat it), counted per bucket and scaled to unit length with numpy. The
    slices bound a worker's memory, however long the texts of a batch are together. There is no
    shuffle, and the whole text counts.
    """

    dim: int = EMBEDDING_DIM
    max_tokens: int = MAX_TOKENS
    special_tokens: int = 0
    model_name: str = "hashed-bag-of-words"
    sparse: bool = True

    def embed(self, text: Column) -> Column:
        dim = self.dim

        def unit_vectors(part: pa.Array) -> np.ndarray:
            sizes = pa.compute.list_value_length(part).to_numpy()
            encoded = part.flatten().dictionary_encode()
            codes = _term_codes(encoded.dictionary)[encoded.indices.to_numpy()]
            cell = np.repeat(np.arange(len(sizes)), sizes) * dim + codes % dim
            sign = np.where(codes // dim % 2 == 0, 1.0, -1.0)
            counts = np.bincount(cell, weights=sign, minlength=len(sizes) * dim).reshape(-1, dim)
            norms = np.maximum(np.sqrt((counts * counts).sum(axis=1, keepdims=True)), 1e-12)
            return (counts / norms).astype(np.float32)

        @F.arrow_udf(VECTOR)
        def count(batch: pa.Array) -> pa.Array:
            unit = np.empty((len(batch), dim), dtype=np.float32)
            for at in _row_slices(pa.compute.list_value_length(batch).to_numpy(), SLICE_ROWS, SLICE_TERMS):
                unit[at] = unit_vectors(batch[at])
            offsets = np.arange(len(batch) + 1, dtype=np.int32) * dim
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(unit.ravel()))

        return count(terms(F.coalesce(text, F.lit(""))))

    def entries(self, text: Column) -> Column:
        """The sparse unit vector of a text's term counts: (index, weight) per distinct bucket.

        A term's bucket is the first 32 bits of its MD5 (2**32 buckets, so two terms share one
        only by an MD5 collision of those bits); all in SQL functions, no Python worker. A text
        without terms has no entries.
        """
        codes = F.transform(
            terms(F.coalesce(text, F.lit(""))),
            lambda term: F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("long"),
        )
        counted = F.transform(
            F.array_distinct(codes),
            lambda i: F.struct(i.alias("index"), F.size(F.filter(codes, lambda c: c == i)).cast("double").alias("n")),
        )
        norm = F.sqrt(F.aggregate(counted, F.lit(0.0), lambda total, e: total + e["n"] * e["n"]))
        return F.transform(counted, lambda e: F.struct(e["index"].alias("index"), (e["n"] / norm).alias("weight")))

    def encode(self, text: Column) -> Column:
        return words(text)

    def decode(self, tokens: Column) -> Column:
        return _whitespace_decode(tokens)


_LOADED: dict[str, Callable[[list[str]], np.ndarray]] = {}


@dataclass(frozen=True)
class ModelEmbedder:
    """A user's own model: ``load()`` returns a function from texts to a matrix of vectors.

    The model is loaded once per Python worker and fed ``batch_size`` texts at a time. Tokens
    default to whitespace words; pass ``encoder``/``decoder`` for the model's own tokens.
    """

    load: Callable[[], Callable[[list[str]], np.ndarray]]
    model_name: str
    dim: int = EMBEDDING_DIM
    batch_size: int = 8
    max_tokens: int = MAX_TOKENS
    special_tokens: int = 0
    sparse: bool = False
    encoder: Callable[[Column], Column] = words
    decoder: Callable[[Column], Column] = _whitespace_decode

    def embed(self, text: Column) -> Column:
        load, name, step = self.load, self.model_name, self.batch_size

        @F.arrow_udf(VECTOR)
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            if name not in _LOADED:
                _LOADED[name] = load()
            model = _LOADED[name]
            for batch in batches:
                texts = [value or "" for value in batch.to_pylist()]
                vectors: list[np.ndarray] = []
                for start in range(0, len(texts), step):
                    part = np.asarray(model(texts[start : start + step]), dtype=np.float32)
                    vectors.extend(part)
                yield pa.array(vectors, pa.list_(pa.float32()))

        return run(text)

    def encode(self, text: Column) -> Column:
        return self.encoder(text)

    def decode(self, tokens: Column) -> Column:
        return self.decoder(tokens)
