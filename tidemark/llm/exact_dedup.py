"""Exact deduplication as a stream with keyed state that never expires.

Arrivals (digest of the normalised text, document id, locator) flow through a streaming
aggregation whose state lives in RocksDB on the executors' disks and is committed to the shared
checkpoint folder. The state keeps, per digest, the stable identifier of the row that stays, how
many rows had the digest, and where that row's content lies. Hits, rows whose digest another row
has too, are then checked byte by byte against the content at the locator; a row that only shares
the digest goes to an exact grouping of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import fold_ascii, fresh, new_folder, stage, text_or_empty
from tidemark.llm.repeats import id_key, maybe_touched

#: Arrival files in one micro-batch; all files are read.
FILES_PER_BATCH = 10_000

_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Files are not preallocated: many small stores would take megabytes of disk each.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def sha256_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _latest(rows: DataFrame) -> DataFrame:
    """State per digest: its number of rows, and id and locator of the row that stays."""
    return rows.groupBy("digest").agg(F.sum("rows").alias("rows"), F.max("place").alias("place"))


def stream_state(arrivals: DataFrame, sink: str, checkpoint: str) -> None:
    """Run all arrivals through the keyed state; each micro-batch's changed keys go to ``sink``.

    A micro-batch that runs again after a failure overwrites its own folder. With the same
    ``checkpoint`` a later call goes on from the state that the earlier one left.
    """

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{sink}/batch={batch}")

    spark = arrivals.sparkSession
    with _settings(spark, _STATE_CONF):
        query = (
            _latest(arrivals)
            .writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .foreachBatch(write)
            .start()
        )
        query.awaitTermination()


def exact_groups(
    docs: DataFrame, *, text: str = "text", digest: Callable[[Column], Column] = sha256_digest
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty, so all nulls
    and empty texts are one group. The largest doc_id of a group stays. Repeated rows (same id,
    same text) each count in ``group_size`` and share their ``kept``; the same id with other
    texts stands in several groups; a null id is smaller than any other. An empty table gives an empty result. Only ``doc_id`` and
    the text are read.
    """
    spark = docs.sparkSession
    norm = fold_ascii(text_or_empty(text))
    read = docs.select("doc_id", norm.alias("norm"))
    folder = new_folder(spark, "arrivals")
    arrivals = read.select(
        "doc_id", digest(F.col("norm")).alias("digest"), F.sha2("norm", 256).alias("text_sha256")
    )
    arrivals.write.parquet(f"{folder}/rows")
    kept_rows = spark.read.schema(arrivals.schema).parquet(f"{folder}/rows")
    # Documents are looked up by id, so the id is the locator too. Copies in one task are summed
    # before they are shuffled to the state.
    stream = (
        spark.readStream.schema(arrivals.schema)
        .option("maxFilesPerTrigger", FILES_PER_BATCH)
        .parquet(f"{folder}/rows")
        .select(
            "digest", F.lit(1).cast("long").alias("rows"), F.struct("doc_id", F.col("doc_id").alias("locator")).alias("place")
        )
    )
    stream_state(stream, f"{folder}/state", f"{folder}/stream")
    changes = spark.read.option("basePath", f"{folder}/state").schema(
        "digest binary, rows long, place struct<doc_id: bigint, locator: bigint>, batch int"
    )
    state = (
        changes.parquet(f"{folder}/state")
        .groupBy("digest")
        .agg(F.max_by(F.struct("rows", "place"), "batch").alias("last"))
        .select("digest", "last.rows", F.col("last.place.doc_id").alias("keep_id"), F.col("last.place.locator").alias("locator"))
    )
    state = stage(state, "state")
    # Bytes are compared on hits alone: a fixed-size filter drops most other texts before the
    # shuffle. Hits and kept texts are staged, so AQE can split a digest with very many hits.
    repeated = state.where("rows > 1").select("digest", "locator")
    ids = kept_rows.join(repeated, "digest", "left_semi").select(id_key().alias("id"))
    texts = maybe_touched(read.select(id_key().alias("id"), "doc_id", "norm"), stage(ids, "ids"))
    hits = stage(texts.select("doc_id", "norm", digest(F.col("norm")).alias("digest")).join(repeated, "digest"), "hits")
    keepers = stage(
        hits.where("doc_id <=> locator")
        .groupBy(F.col("digest").alias("k_digest"))
        .agg(F.max("norm").alias("k_norm")),
        "keepers",
    )
    other = stage(
        hits.join(keepers, F.col("digest") == F.col("k_digest"))
        .where(F.col("norm") != F.col("k_norm"))
        .select("doc_id", "digest", F.sha2("norm", 256).alias("text_sha256"), "norm"),
        "collisions",
    )
    apart = other.groupBy("digest", "norm").agg(F.count(F.lit(1)).alias("size"), F.max("doc_id").alias("id"))
    lost = other.groupBy("digest").agg(F.count(F.lit(1)).alias("lost"))
    regrouped = other.join(apart, ["digest", "norm"]).select("doc_id", "digest", "text_sha256", "size", "id")
    return _judge(kept_rows, state, regrouped, lost)


def _judge(rows: DataFrame, state: DataFrame, regrouped: DataFrame, lost: DataFrame) -> DataFrame:
    """Each row with its group: by digest, but for the rows that only shared a digest."""
    apart = regrouped.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), F.col("text_sha256").alias("_sha"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")) & (F.col("text_sha256") == F.col("_sha"))
    sure = rows.join(apart, same, "left_anti")
    grouped = sure.join(state, "digest").join(lost, "digest", "left")
    matched = grouped.select(
        "doc_id",
        "keep_id",
        (F.col("rows") - F.coalesce("lost", F.lit(0))).alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
    others = regrouped.select(
        "doc_id", F.col("id").alias("keep_id"), F.col("size").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("id")).alias("kept"), "text_sha256"
    )
    return reduce(DataFrame.unionByName, [matched, others])


def keep_one(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns: of equal texts the one with the largest id.

    A row that is there several times, with the same id and an equal text, stays once.
    """
    groups = stage(exact_groups(docs, text=text).where("kept"), "kept")
    # Helper columns take names that no column of docs has.
    i, sha, n = fresh(docs, "_id"), fresh(docs, "_sha"), fresh(docs, "_n")
    kept = groups.groupBy(F.col("doc_id").alias(i), F.col("text_sha256").alias(sha)).agg(F.count(F.lit(1)).alias(n))
    own = F.sha2(fold_ascii(text_or_empty(docs[text])), 256)
    rows = docs.join(kept, docs["doc_id"].eqNullSafe(kept[i]) & (own == kept[sha])).drop(kept[i])
    if kept.where(F.col(n) > 1).isEmpty():  # no row is repeated, so the texts are read once
        return rows.drop(kept[sha], kept[n])
    once = rows.where(kept[n] == 1).drop(kept[sha], kept[n])
    return once.unionByName(rows.where(kept[n] > 1).dropDuplicates(["doc_id", sha]).drop(kept[sha], kept[n]))


#: The same rows of :func:`exact_groups` in DuckDB.
SQL = """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
 sha256(norm) AS text_sha256 FROM n WINDOW w AS (PARTITION BY norm)
"""
