"""Landing folder to bronze and silver as a stream of new datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.constants import LANDING_PREFIX
from tidemark.functions.vectors import Embedder, HashedEmbedder
from tidemark.plans.bronze import ingest_datasets
from tidemark.plans.silver import build_silver
from tidemark.sources.lake import Lake, days_of
from tidemark.sources.landing import read_datasets

#: Files of one micro-batch; bounds both the batch and the paths the driver hands on.
FILES_PER_BATCH = 1000

_FILE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def new_landing_files(
    spark: SparkSession, input_dir: str, *, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """A stream of the paths of landing files not seen before; no content is read.

    Streaming paths rather than rows keeps datasets of differing types readable: each
    micro-batch is read by its own footers, as in the batch job.
    """
    return (
        spark.readStream.format("binaryFile")
        .schema(_FILE)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(f"{input_dir}/{LANDING_PREFIX}*.parquet")
        .select("path")
    )


def stream_to_lake(
    spark: SparkSession,
    input_dir: str,
    lake: Lake,
    *,
    checkpoint: str,
    embedder: Embedder | None = None,
    promote: bool = True,
    files_per_batch: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Ingest every landing file that appeared since the last run, then stop.

    ``foreachBatch`` may see a batch twice after a failure. That is harmless: bronze only takes
    ids it lacks, and silver only promotes rows it lacks.
    """
    embedder = embedder or HashedEmbedder()

    def ingest(batch: DataFrame, _: int) -> None:
        paths = [row["path"] for row in batch.select("path").orderBy("path").collect()]
        if not paths:
            return
        ingest_datasets(spark, paths, lake, mode="append", embedder=embedder)
        if promote:
            rows = read_datasets(spark, paths, "")  # only their crawl days are looked up
            build_silver(lake, embedder=embedder, days=days_of(rows))

    return (
        new_landing_files(spark, input_dir, files_per_batch=files_per_batch)
        .writeStream.foreachBatch(ingest)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
