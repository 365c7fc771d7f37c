"""Find windows that repeat elsewhere: anchors first, single windows only where they must differ.

Both substring operators use this. Documents are sequences of 64-bit symbols. Runs of windows
(``tidemark.llm.windows``) are summed in Spark by (gram, hash of the whole run). A run that is
equal as a whole to an earlier one repeats with all its windows. The first of each kind of run
needs a closer look only where other runs share its gram: the windows of these runs alone are
hashed one by one and summed in Spark again. All sums are combined before their shuffles, and
the joins back are equi-joins that AQE splits where a key is hot, so a passage that a third of
all documents hold stays spread out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import windows
from tidemark.llm.common import stage, text_or_empty

#: Symbols of each text of a list.
Symbols = Callable[[list[str]], list[np.ndarray]]

#: Bits of the filter that spares the shuffle of untouched texts; fixed, so its broadcast is 4 MB
#: at any size. A full filter spares nothing and changes nothing.
FILTER_BITS = 1 << 25
_BITS_IN_BUCKET = 32_768
#: A null id stands before all others while repeats are sought.
_NULL_ID = -(1 << 63)


def id_key(column: str | Column = "doc_id") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(_NULL_ID))


def id_back(column: str = "id") -> Column:
    return F.when(F.col(column) != _NULL_ID, F.col(column))


def keyed(docs: DataFrame, text: str = "text", *, sparse: bool = False) -> DataFrame:
    """``id, row, text``: ``row`` tells apart texts under one id; equal rows share it.

    With ``sparse`` it is 0 for ids with one text, so that it costs nothing where it is stored.
    """
    body = text_or_empty(text)
    rows = docs.select(id_key().alias("id"), F.xxhash64(body).alias("row"), body.alias("text"))
    if not sparse:
        return rows
    several = rows.groupBy("id").agg((F.min("row") < F.max("row")).alias("several")).where("several")
    marked = rows.join(stage(several, "several"), "id", "left")
    return marked.select("id", F.when(F.col("several"), F.col("row")).otherwise(F.lit(0)).alias("row"), "text")


def _numbers(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values).cast(kind)


def run_rows(rows: DataFrame, symbols: Callable[[], Symbols], width: int, gram: int) -> DataFrame:
    """``id, row, start, count, gram, whole`` of every run of windows."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = symbols()
        for batch in batches:
            runs = windows.find_runs(read(batch.column(2).to_pylist()), width, gram)
            at = pa.array(runs.doc)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(at),
                    batch.column(1).take(at),
                    _numbers(runs.start, pa.int32()),
                    _numbers(runs.count, pa.int32()),
                    _numbers(runs.gram, pa.int64()),
                    _numbers(runs.whole, pa.int64()),
                ],
                names=["id", "row", "start", "count", "gram", "whole"],
            )

    return rows.mapInArrow(scan, "id long, row long, start int, count int, gram long, whole long")


def place(same_document: bool) -> Column:
    """What orders equal strings: the id alone, or also where in the document they start."""
    return F.struct("id", "row", "start") if same_document else F.struct("id")


def firsts(runs: DataFrame, same_document: bool) -> DataFrame:
    """``gram, whole, first, times``: the first place of every kind of run."""
    return runs.groupBy("gram", "whole").agg(F.min(place(same_document)).alias("first"), F.count(F.lit(1)).alias("times"))


def unsure(kinds: DataFrame) -> DataFrame:
    """Kinds of runs that matter further: that repeat, or whose gram other kinds share."""
    shared = kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("gram", F.lit(True).alias("shared"))
    return (
        kinds.join(shared, "gram", "left")
        .where("shared OR times > 1")
        .select("gram", "whole", "first", F.coalesce("shared", F.lit(False)).alias("shared"))
    )


def touched_filter(ids: DataFrame) -> bytes:
    """A bit per hashed id, as one array of ``FILTER_BITS`` bits."""
    spot = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))
    parts = (
        ids.select(spot.alias("bit"))
        .groupBy(F.expr(f"cast(bit div {_BITS_IN_BUCKET} as int)").alias("part"))
        .agg(F.bitmap_construct_agg(F.expr(f"bit % {_BITS_IN_BUCKET}")).alias("bits"))
        .collect()
    )
    size = _BITS_IN_BUCKET // 8
    whole = bytearray(FILTER_BITS // 8)
    for part in parts:
        whole[part["part"] * size : (part["part"] + 1) * size] = part["bits"]
    return bytes(whole)


def maybe_touched(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` without most of those whose id is not among ``ids``; never without one that is."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(touched_filter(ids))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(shared.value, np.uint8), bitorder="little")
        for batch in batches:
            spot = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(bits[spot] > 0)).select(batch.schema.names[:-1])

    spotted = rows.withColumn("_spot", F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS)))
    return spotted.mapInArrow(keep, rows.schema)


def packed(start: Column, end: Column) -> Column:
    """Two positions below 2**31 as one long."""
    return F.shiftleft(start.cast("long"), 32).bitwiseOR(end.cast("long"))


def unpacked(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return values >> 32, values & 0xFFFFFFFF


def texts_of_runs(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """``id, row, text, p, grams``: texts with their ``runs`` (id, row, start, count, gram), as lists."""
    wanted = runs.groupBy("id", "row").agg(
        F.collect_list(F.struct(packed(F.col("start"), F.col("count")).alias("p"), "gram")).alias("runs")
    )
    wanted = wanted.select("id", "row", F.col("runs.p").alias("p"), F.col("runs.gram").alias("grams"))
    texts = maybe_touched(rows, wanted.select("id")).dropDuplicates(["id", "row"])
    return wanted.join(texts, ["id", "row"]).select("id", "row", "text", "p", "grams")


def single_windows(rows: DataFrame, runs: DataFrame, symbols: Callable[[], Symbols], width: int) -> DataFrame:
    """``id, row, start, window, gram`` of each window of ``runs`` (id, row, start, count, gram)."""
    joined = texts_of_runs(rows, runs)

    def hash_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = symbols()
        for batch in batches:
            texts, lists, grams = (batch.column(i) for i in (2, 3, 4))
            for i, sequence in enumerate(read(texts.to_pylist())):
                starts, counts = unpacked(np.array(lists[i].values))
                at, hashes = windows.window_hashes(sequence, starts, counts, width)
                gram = np.repeat(np.array(grams[i].values), counts)
                n = len(at)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.repeat(batch.column(0)[i], n),
                        pa.repeat(batch.column(1)[i], n),
                        _numbers(at, pa.int32()),
                        _numbers(hashes, pa.int64()),
                        pa.array(gram),
                    ],
                    names=["id", "row", "start", "window", "gram"],
                )

    return joined.mapInArrow(hash_windows, "id long, row long, start int, window long, gram long")


def repeated_intervals(
    rows: DataFrame, runs: DataFrame, kinds: DataFrame, symbols: Callable[[], Symbols], width: int, same_document: bool
) -> DataFrame:
    """``id, row, intervals``: symbols covered by windows that an earlier place has too.

    ``kinds`` is :func:`unsure` of the runs. An interval is ``start`` and ``end`` in one long.
    """
    own = place(same_document)
    judged = stage(
        runs.join(kinds, ["gram", "whole"]).withColumn("again", F.col("first") < own).where("again OR shared"), "judged"
    )
    single = stage(
        single_windows(rows, judged.where("NOT again").select("id", "row", "start", "count", "gram"), symbols, width),
        "single",
    )
    whole = judged.where("again").select("id", "row", packed(F.col("start"), F.col("start") + F.col("count") + (width - 1)).alias("i"))
    return gathered(whole, later_windows(single, width, same_document))


def later_windows(single: DataFrame, width: int, same_document: bool) -> DataFrame:
    """``id, row, i`` of the single windows that an earlier place has too."""
    own = place(same_document)
    first = single.groupBy("window", "gram").agg(F.min(own).alias("first"), F.max(own).alias("last")).where("first < last")
    later = single.join(first.drop("last"), ["window", "gram"]).where(F.col("first") < own)
    return later.select("id", "row", packed(F.col("start"), F.col("start") + width).alias("i"))


def gathered(*parts: DataFrame) -> DataFrame:
    """``id, row, intervals`` from rows of single intervals ``i``; at most one per position."""
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy("id", "row").agg(F.collect_set("i").alias("intervals"))
