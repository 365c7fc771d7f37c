"""Find benchmark items in documents: SimHash of item-sized windows, multi-index Hamming blocks.

Everything here is DataFrame and SQL functions. A window has as many words as an item, and may
start at any word; a document with fewer words than the item is one window. A similarity bounds
from below how many shingles a window shares with an item, so windows are laid where that many
of their shingles stand in items of their size, and no others can match. Each window gets the
SimHash of its shingles. Cutting the 64 bits into one block more than the radius makes two
fingerprints within the radius agree in at least one block, so joining windows and items of one
size by (block, bits) misses none. The candidates within the radius are then verified by the
weighted Jaccard similarity of their shingles, each weighed by how often it occurs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, fresh, stage, text_or_empty
from tidemark.llm.repeats import id_back, id_key, keyed

#: Words in a shingle; shorter items are one shingle.
SHINGLE = 5
#: Least weighted Jaccard similarity of a window and an item.
SIMILARITY = 0.75
#: Bits in which fingerprints may differ. Random hyperplanes put a similarity of 0.75 near 11 of
#: 64 bits with a standard deviation of 3, so this radius is four deviations above.
RADIUS = 23

_KEY = ["id", "row"]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def shingles(words: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words, in order; empty for fewer words."""

    def hashes(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(w) - (size - 1))
        all_of = F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, size)))
        return F.when(F.size(w) >= size, all_of).otherwise(F.array().cast("array<long>"))

    # The inner function is applied to an array of one list of words, so these are computed once.
    return F.element_at(F.transform(F.array(words), hashes), 1)


def simhash(hashes: str) -> Column:
    """64-bit SimHash of an array of hashes, each as heavy as it is frequent."""
    return F.expr(
        f"""aggregate(sequence(0, 63), 0L, (print, b) -> print | if(
          aggregate({hashes}, 0, (sum, h) -> sum + 2 * cast(shiftright(h, b) & 1L AS int) - 1) > 0, shiftleft(1L, b), 0L))"""
    )


def blocks(fingerprint: str, radius: int) -> Column:
    """``radius + 1`` structs of block number and bits, which together are the fingerprint."""
    cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
    parts = [
        F.struct(F.lit(i).alias("block"), F.expr(f"shiftrightunsigned({fingerprint}, {a}) & {(1 << (b - a)) - 1}L").alias("bits"))
        for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))
    ]
    return F.array(*parts)


def weighted_similarity(left: str, right: str) -> Column:
    """Sum of the smaller counts of each shingle over the sum of the larger ones."""
    shared = F.expr(
        f"""aggregate(array_distinct({left}), 0L, (sum, x) ->
          sum + least(size(filter({left}, y -> y = x)), size(filter({right}, y -> y = x))))"""
    )
    return shared / (F.size(left) + F.size(right) - shared)


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """``item_id, n, k, hashes, print`` of every item with words."""
    words = benchmark.select("item_id", words_of(text_or_empty("text")).alias("words")).where(F.size("words") > 0)
    k = F.least(F.lit(SHINGLE), F.size("words"))
    by_size = reduce(
        lambda rest, size: F.when(F.col("k") == size, shingles(F.col("words"), size)).otherwise(rest),
        range(1, SHINGLE),
        shingles(F.col("words"), SHINGLE),
    )
    items = words.select("item_id", "words", F.size("words").alias("n"), k.alias("k"))
    items = items.select("item_id", "n", "k", by_size.alias("hashes"))
    return items.select("*", simhash("hashes").alias("print"))


def _least_shared(own: str, size: str) -> str:
    """Shingles that ``own`` shingles must share with an item of ``size`` to reach the similarity."""
    share = SIMILARITY / (1 + SIMILARITY)
    return f"cast(ceil({share!r} * ({own} + {size}) - 1e-6) AS int)"


def _dense(hits: str, least: str, size: str) -> str:
    """For each of ``hits`` (sorted) that begins ``least`` of them within ``size``: that and the last one."""
    pairs = f"transform(sequence(1, size({hits}) - {least} + 1), i -> struct({hits}[i - 1] AS first, {hits}[i + {least} - 2] AS last))"
    some = f"if(size({hits}) >= {least}, {pairs}, cast(array() AS array<struct<first: int, last: int>>))"
    return f"filter({some}, x -> x.last - x.first < {size})"


def _windows(rows: DataFrame, items: DataFrame, size: int) -> DataFrame:
    """``id, row, start, n, hashes`` of the windows of items with shingles of ``size`` words."""
    own = items.where(F.col("k") == size)
    index = stage(own.select("n", F.explode("hashes").alias("hash")).distinct(), "index")
    hits = rows.select(*_KEY, F.posexplode(shingles(words_of(F.col("text")), size)).alias("at", "hash")).join(index, "hash")
    hits = hits.groupBy(*_KEY, "n").agg(F.array_sort(F.collect_set("at")).alias("hits"))
    hits = hits.select("*", (F.col("n") - (size - 1)).alias("m"))
    # A text with fewer shingles than an item shares at most all of its own, so it needs this many.
    fewest = f"cast(ceil({SIMILARITY!r} * m - 1e-6) AS int)"
    hits = hits.where(f"size({_dense('hits', fewest, 'm')}) > 0")
    by_text = stage(hits, "hits").groupBy(*_KEY).agg(F.collect_list(F.struct("n", "m", "hits")).alias("sizes"))
    found = rows.dropDuplicates(_KEY).join(by_text, _KEY).select(*_KEY, "sizes", shingles(words_of(F.col("text")), size).alias("h"))
    found = found.select(*_KEY, "h", F.size("h").alias("total"), F.explode("sizes").alias("s")).select(*_KEY, "h", "total", "s.*")
    runs = _dense("hits", _least_shared("m", "m"), "m")
    inside = f"flatten(transform({runs}, x -> sequence(greatest(0, x.last - m + 1), least(total - m, x.first))))"
    whole = f"if(size(hits) >= {_least_shared('total', 'm')}, array(0), cast(array() AS array<int>))"
    starts = f"if(total >= m, array_distinct({inside}), {whole})"
    cut = F.expr(f"transform({starts}, s -> struct(s AS start, n, slice(h, s + 1, m) AS hashes))")
    return found.select(*_KEY, F.explode(cut).alias("w")).select(*_KEY, "w.*")


def matches(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", radius: int = RADIUS) -> DataFrame:
    """``id, row, start, item_id, similarity`` of every window that holds an item."""
    rows = keyed(docs, text)
    items = stage(benchmark_items(benchmark), "items")
    sizes = sorted(r["k"] for r in items.select("k").distinct().collect())
    if not sizes:
        none = rows.where("false").select(*_KEY, F.lit(0).alias("start"))
        return none.join(items.select("item_id"), F.lit(False)).withColumn("similarity", F.lit(0.0))
    laid = reduce(DataFrame.unionByName, [_windows(rows, items, size) for size in sizes])
    printed = stage(laid.select("*", simhash("hashes").alias("print")), "printed")
    left = printed.select("*", F.explode(blocks("print", radius)).alias("b")).select(*_KEY, "start", "n", "hashes", "print", "b.*")
    right = items.select(
        "item_id", "n", F.col("hashes").alias("item_hashes"), F.col("print").alias("item_print"), F.explode(blocks("print", radius)).alias("b")
    ).select("item_id", "n", "item_hashes", "item_print", "b.*")
    near = left.join(right, ["n", "block", "bits"]).where(F.bit_count(F.expr("print ^ item_print")) <= radius)
    judged = near.dropDuplicates([*_KEY, "start", "item_id"]).select(
        *_KEY, "start", "item_id", weighted_similarity("hashes", "item_hashes").alias("similarity")
    )
    return judged.where(F.col("similarity") >= SIMILARITY)


def _flagged(docs: DataFrame, benchmark: DataFrame, text: str, radius: int) -> DataFrame:
    found = matches(docs, benchmark, text=text, radius=radius)
    return found.groupBy(*_KEY).agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"),
        F.count_distinct("start").alias("n_windows"),
        F.max("similarity").alias("similarity"),
    )


def contamination(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", radius: int = RADIUS) -> DataFrame:
    """``doc_id, kept, n_windows, similarity, item_ids`` for every row of ``docs``.

    ``kept`` is false where a window of the whole text matches an item; ``item_ids`` lists those
    items, ``similarity`` is the highest, ``n_windows`` counts the starts of all windows that match.
    Words are compared in lower case. A document with fewer words than an item is one window of all
    its words; null and empty texts, and items without words, match nothing. Repeated rows get equal results; rows with one id and other texts are judged apart.
    Empty tables are fine on both sides. Other columns are not read.
    """
    flagged = stage(_flagged(docs, benchmark, text, radius), "flagged")
    return (
        keyed(docs, text)
        .drop("text")
        .join(flagged, _KEY, "left")
        .select(
            id_back().alias("doc_id"),
            F.col("n_windows").isNull().alias("kept"),
            F.coalesce("n_windows", F.lit(0)).alias("n_windows"),
            "similarity",
            "item_ids",
        )
    )


def without_items(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with their columns."""
    flagged = stage(_flagged(docs, benchmark, text, radius).select(*_KEY), "flagged")
    i, r = fresh(docs, "_id"), fresh(docs, "_row")
    marked = flagged.select(F.col("id").alias(i), F.col("row").alias(r))
    same = (id_key(docs["doc_id"]) == marked[i]) & (F.xxhash64(text_or_empty(docs[text])) == marked[r])
    return docs.join(marked, same, "left_anti")
