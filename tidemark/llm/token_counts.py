"""Token counts by a two-tier lookup, without a shuffle of pre-tokens.

White space never becomes part of a token of this tokenizer, so the tokens of a text are the
tokens of its blank-separated pieces, one after the other. The first tier is a broadcast table
from frequent pieces to their number of tokens. A piece that is not in it is encoded by the
tokenizer once per Python worker and kept in that worker's cache. Texts with characters whose
white space or composition could reach beyond a piece are encoded whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_or_empty

#: Documents, on average, whose pieces choose the first tier. The table only saves work: any other piece is
#: encoded, so the counts do not depend on this sample.
TABLE_DOCUMENTS = 2000
#: Pieces in the broadcast table (a few megabytes) and in a worker's cache.
TABLE_PIECES = 65_536
CACHE_PIECES = 500_000

#: Basic Latin and Latin-1 letters, digits, punctuation and the plain blanks. In such a text a
#: piece is what stands between blanks, and composition changes nothing.
_PLAIN = re.compile("[^\\x20-\\x7e\\t\\n\\r\\u00a1-\\u017f]")


def _load(tokenizer_json: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(tokenizer_json)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def read_tokenizer(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


class _Counter:
    """Counts texts with the two tiers; one per Python worker task."""

    def __init__(self, tokenizer_json: str, table: dict[str, int]):
        self.tokenizer, self.table, self.cache = _load(tokenizer_json), table, {}

    def whole(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def miss(self, piece: str) -> int:
        found = self.cache.get(piece)
        if found is None:
            if len(self.cache) >= CACHE_PIECES:
                self.cache.clear()
            found = self.cache[piece] = self.whole(piece)
        return found

    def count(self, text: str) -> int:
        if _PLAIN.search(text):
            return self.whole(text)
        table, total = self.table, 0
        for piece, times in Counter(text.split()).items():
            length = table.get(piece)
            total += times * (self.miss(piece) if length is None else length)
        return total


def frequent_pieces(docs: DataFrame, tokenizer_json: str, *, text: str = "text") -> dict[str, int]:
    """Token numbers of the most frequent pieces of a bounded sample of documents.

    The pieces are counted in Spark with partial sums, and ranked with ties by the piece.
    """
    share = min(1.0, TABLE_DOCUMENTS / max(1, docs.count()))
    pieces = (
        docs.select(text_or_empty(text).alias("t"))
        .sample(share, seed=1)
        .select(F.explode(F.split("t", r"[\t\n\r ]+")).alias("piece"))
        .where((F.col("piece") != "") & (F.length("piece") <= 64))
        .groupBy("piece")
        .count()
        .orderBy(F.desc("count"), "piece")
        .limit(TABLE_PIECES)
    )
    names = [row["piece"] for row in pieces.collect()]
    encoded = _load(tokenizer_json).encode_batch(names, add_special_tokens=False)
    return {n: len(e.ids) for n, e in zip(names, encoded, strict=True) if not _PLAIN.search(n)}


def token_counts(
    docs: DataFrame, tokenizer_path: str, *, text: str = "text", carry: tuple[str, ...] = ("doc_id",), limit: int = 2048
) -> DataFrame:
    """``carry`` columns, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every document.

    Null texts and empty texts have 0 bytes and 0 tokens. Repeated rows stay repeated, an empty
    table gives an empty result, and no other column of the input is read. Texts of any length
    are counted whole. Special strings inside a text are what the tokenizer makes of them.
    ``tokenizer_path`` is read on the driver and sent to the workers.
    """
    spark = docs.sparkSession
    source = read_tokenizer(tokenizer_path)
    shared = spark.sparkContext.broadcast((source, frequent_pieces(docs, source, text=text)))
    rows = docs.select(*carry, text_or_empty(text).alias("_text"))
    kinds = rows.select(*carry).schema
    schema = kinds.add("n_bytes", "long").add("n_tokens", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(*shared.value)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            counts = [
                pa.array([len(t.encode()) for t in texts], pa.int64()),
                pa.array([counter.count(t) for t in texts], pa.int64()),
            ]
            names = [*batch.schema.names[:-1], "n_bytes", "n_tokens"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *counts], names=names)

    return rows.mapInArrow(run, schema).withColumn("over_limit", over_limit("n_tokens", limit))


def over_limit(column: str, limit: int) -> Column:
    return F.col(column) > F.lit(limit)
