"""Ranked lexical search, reversed: documents stream through an inverted index of the items.

Each query item (a benchmark row) is a set of terms. The index, term to items, is built from the
items alone and broadcast once its size is checked; beyond ``INDEX_PAIRS`` (term, item) pairs the
items are cut into blocks that are searched one after the other, so no broadcast grows without
a bound. Two Python passes read every document:

1. statistics: per task, the number of documents with a term (N), all terms (L), and for the
   indexed terms only the number of documents holding them (df); Spark sums the task rows;
2. scoring: each document's counts of indexed terms are turned into one score per item it
   touches, and every task keeps a bounded heap of the ``TOP`` best documents per item.

The heaps of all tasks are merged by a window per item (at most ``TOP`` rows per item and task).
Nothing of the documents reaches the driver; the statistics that do are one row per indexed term.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import text_or_empty

#: A term: a maximal run of characters other than ASCII controls, blanks and punctuation (fixed values).
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Documents returned per item.
TOP = 10
#: (term, item) pairs broadcast at once; more items are searched in blocks of this many pairs.
INDEX_PAIRS = 2_000_000
#: Score constants (fixed values of the contract): term weight scale, length norm, saturation.
W_SCALE, M_BASE, M_SLOPE, TF_SCALE, TF_K, M_K = 1000, 10, 90, 1_000_000_000, 1000, 8

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_FOLD = str.maketrans(_UPPER, _UPPER.lower())

__all__ = ["TERM", "TOP", "item_terms", "search", "weight"]


def terms_of(text: str | None) -> list[str]:
    """Terms of a text, A-Z lower-cased; none for null."""
    return re.findall(TERM, text.translate(_FOLD)) if text else []


def weight(n_docs: int, df: int) -> int:
    """Term weight: floor(1000 ln((2N+2)/(2df+1))) computed in doubles."""
    return math.floor(W_SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


def item_terms(items: DataFrame, *, key: str = "item_id", text: str = "text") -> DataFrame:
    """(item, term) pairs: each item's distinct terms. Equal (id, text) rows are one item."""
    folded = F.translate(text_or_empty(text), _UPPER, _UPPER.lower())
    return (
        items.select(F.col(key).cast("long").alias("item_id"), F.xxhash64(F.col(key), F.col(text)).alias("item"), folded.alias("t"))
        .select("item_id", "item", F.explode(F.array_distinct(F.regexp_extract_all("t", F.lit(TERM), 0))).alias("term"))
        .distinct()
    )


def _statistics(docs: DataFrame, terms: set[str]) -> tuple[int, int, dict[str, int]]:
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexed, n_docs, n_terms, df = shared.value, 0, 0, Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = terms_of(text)
                if found:
                    n_docs += 1
                    n_terms += len(found)
                    df.update(indexed.intersection(found))
        names = [None, *df]
        yield pa.RecordBatch.from_pydict(
            {"term": names, "df": [0, *df.values()], "docs": [n_docs, *[0] * len(df)], "terms": [n_terms, *[0] * len(df)]},
            schema=pa.schema([("term", pa.string()), ("df", pa.int64()), ("docs", pa.int64()), ("terms", pa.int64())]),
        )

    rows = (
        docs.select(F.col("text").cast("string"))
        .mapInArrow(run, "term string, df long, docs long, terms long")
        .groupBy("term")
        .agg(F.sum("df").alias("df"), F.sum("docs").alias("docs"), F.sum("terms").alias("terms"))
        .collect()
    )
    totals = next((r for r in rows if r["term"] is None), None)
    n_docs, n_terms = (totals["docs"], totals["terms"]) if totals else (0, 0)
    return n_docs, n_terms, {r["term"]: r["df"] for r in rows if r["term"] is not None}


def _scores(docs: DataFrame, index: dict[str, tuple[int, list[int]]], n_docs: int, n_terms: int) -> DataFrame:
    """Per task, the best ``TOP`` documents of each item: (item, doc_id, score)."""
    shared = docs.sparkSession.sparkContext.broadcast((index, n_docs, n_terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, big_n, big_l = shared.value
        heaps: dict[int, list] = {}
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = terms_of(text)
                if not found:
                    continue
                norm = M_BASE + (M_SLOPE * len(found) * big_n) // big_l
                totals: dict[int, int] = {}
                for term, tf in Counter(t for t in found if t in index).items():
                    w, items = index[term]
                    part = w * ((TF_SCALE * tf) // (TF_K * tf + M_K * norm))
                    for item in items:
                        totals[item] = totals.get(item, 0) + part
                # Larger is better: score, then a present id, then a smaller id.
                rank = (doc_id is not None, -(doc_id or 0))
                for item, score in totals.items():
                    if score <= 0:
                        continue
                    heap = heaps.setdefault(item, [])
                    entry = (score, rank, doc_id)
                    if len(heap) < TOP:
                        heapq.heappush(heap, entry)
                    elif entry[:2] > heap[0][:2]:
                        heapq.heapreplace(heap, entry)
        rows = [(item, doc, score) for item, heap in heaps.items() for score, _, doc in heap]
        yield pa.RecordBatch.from_pydict(
            {"item": [r[0] for r in rows], "doc_id": [r[1] for r in rows], "score": [r[2] for r in rows]},
            schema=pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())]),
        )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, *, key: str = "item_id", text: str = "text") -> DataFrame:
    """Each item's ``TOP`` best documents with a score above 0: ``item_id, rank, doc_id, score``.

    Terms are maximal matches of :data:`TERM` after lower-casing A-Z; a null text has none. Ranks
    run from 1, highest score first, equal scores by ascending ``doc_id`` (null ids last); equal
    (id, text) items are one item, and a repeated document row is ranked once per row. Only
    ``doc_id`` and ``text`` of the documents and ``key`` and ``text`` of the items are read, so
    other columns, whatever their names, change nothing. An empty table of either kind gives no
    rows; so does an item whose terms no document holds.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pairs = item_terms(items, key=key, text=text)
    n_pairs = pairs.count()
    blocks = max(1, -(-n_pairs // INDEX_PAIRS))
    found: DataFrame | None = None
    for block in range(blocks):
        part = pairs.where(F.pmod(F.col("item"), F.lit(blocks)) == block) if blocks > 1 else pairs
        listed = part.collect()
        ids = {r["item"]: r["item_id"] for r in listed}
        by_term: dict[str, list[int]] = {}
        for r in listed:
            by_term.setdefault(r["term"], []).append(r["item"])
        n_docs, n_terms, df = _statistics(docs, set(by_term))
        if n_terms == 0:
            continue
        index = {t: (weight(n_docs, df[t]), items) for t, items in by_term.items() if df.get(t)}
        scored = _scores(docs, index, n_docs, n_terms)
        names = docs.sparkSession.createDataFrame(list(ids.items()), "item long, item_id long")
        scored = scored.join(F.broadcast(names), "item")
        found = scored if found is None else found.unionByName(scored)
    if found is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= TOP)
        .select("item_id", F.col("rank").cast("int"), "doc_id", "score")
    )


SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
),
dn AS (SELECT rid, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM d),
stats AS (SELECT CAST(count(*) FILTER (WHERE n > 0) AS BIGINT) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM dn),
items AS (
    SELECT DISTINCT item_id, itext, term FROM (
        SELECT item_id, text AS itext,
               unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark)
),
occ AS (
    SELECT rid, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf
    FROM (SELECT rid, doc_id, n, unnest(terms) AS term FROM dn) u
    WHERE term IN (SELECT term FROM items)
    GROUP BY rid, doc_id, n, term
),
df AS (SELECT term, CAST(count(*) AS BIGINT) AS df FROM occ GROUP BY term),
w AS (
    SELECT term, CAST(floor(1000 * ln((2.0 * big_n + 2) / (2.0 * df + 1))) AS BIGINT) AS w
    FROM df CROSS JOIN stats
),
scored AS (
    SELECT i.item_id, i.itext, o.rid, o.doc_id,
           sum(w.w * ((1000000000 * o.tf) // (1000 * o.tf + 8 * (10 + (90 * o.n * s.big_n) // s.big_l)))) AS score
    FROM items i JOIN occ o ON o.term = i.term JOIN w ON w.term = i.term CROSS JOIN stats s
    GROUP BY i.item_id, i.itext, o.rid, o.doc_id
),
ranked AS (
    SELECT item_id, doc_id, CAST(score AS BIGINT) AS score,
           row_number() OVER (PARTITION BY item_id, itext ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
