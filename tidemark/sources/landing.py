"""Landing datasets: ``market_data_<UTC stamp>.parquet`` files or folders."""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.constants import LANDING_PREFIX
from tidemark.functions.ids import bronze_id
from tidemark.operators.shaping import align_frame, keep_first, union_aligned
from tidemark.schemas import BRONZE, LANDING
from tidemark.sources.storage import list_paths

#: Where a row stood: dataset path, then file within the dataset, then row within the file.
POSITION = ("_file", "_row")
_POSITIONS = [T.StructField("_file", T.StringType()), T.StructField("_row", T.LongType())]
_DATASET = rf"^(.*/{LANDING_PREFIX}[^/]*\.parquet)"


def landing_paths(spark: SparkSession, input_dir: str) -> list[str]:
    """All landing datasets of a folder, in name order."""
    return list_paths(spark, f"{input_dir}/{LANDING_PREFIX}*.parquet")


def write_landing(records: DataFrame, data_dir: str, stamp: str) -> str:
    """Write records as one new landing dataset; no records give a typed, empty one."""
    path = f"{data_dir}/{LANDING_PREFIX}{stamp}.parquet"
    align_frame(records, LANDING).write.mode("errorifexists").parquet(path)
    return path


def read_landing_file(spark: SparkSession, path: str) -> DataFrame:
    """One landing dataset as it was written."""
    return spark.read.parquet(path)


def latest_landing(spark: SparkSession, data_dir: str) -> str | None:
    """The newest landing dataset by name."""
    paths = landing_paths(spark, data_dir)
    return paths[-1] if paths else None


def _relevant(schema: T.StructType) -> T.StructType:
    wanted = set(LANDING.fieldNames())
    return T.StructType([f for f in schema.fields if f.name in wanted])


def _by_schema(spark: SparkSession, paths: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """Datasets grouped by the types their footers declare for the landing columns.

    Records are typed per crawl, so types drift between datasets. One distributed pass over
    the footers settles the usual case, where they agree; otherwise each dataset's schema is
    asked for by itself. Only schemas reach the driver.
    """
    try:
        merged = spark.read.option("mergeSchema", "true").parquet(*paths).schema
        return [(_relevant(merged), list(paths))]
    except (PySparkException, Py4JJavaError):
        pass  # types differ: an unreadable dataset fails again below
    with ThreadPoolExecutor(max_workers=16) as pool:
        schemas = list(pool.map(lambda p: _relevant(spark.read.parquet(p).schema), paths))
    groups: dict[str, list[str]] = defaultdict(list)
    for path, schema in zip(paths, schemas, strict=True):
        groups[schema.json()].append(path)
    return [
        (T.StructType.fromJson(json.loads(text)), members) for text, members in groups.items()
    ]


def read_datasets(spark: SparkSession, paths: Sequence[str], ingested_at: str) -> DataFrame:
    """Bronze-typed rows of the given landing datasets, with their position."""
    target = T.StructType(BRONZE.fields + _POSITIONS)
    if not paths:
        return spark.createDataFrame([], target)

    def positioned(schema: T.StructType, members: list[str]) -> DataFrame:
        rows = spark.read.schema(schema).parquet(*members)
        return rows.select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.row_index").alias("_row"),
        )

    groups = _by_schema(spark, paths)
    landing = T.StructType(LANDING.fields + _POSITIONS)
    return align_frame(
        union_aligned([positioned(*g) for g in groups], landing)
        .withColumn("source_file", F.regexp_extract("_file", _DATASET, 1))
        .withColumn("ingested_at", F.lit(ingested_at))
        .withColumn(
            "bronze_id", bronze_id(F.col("crawled_at"), F.col("source_url"), F.col("title"))
        ),
        target,
    )


def dedup_landing(rows: DataFrame, order: Sequence[str] = POSITION) -> DataFrame:
    """The first row per bronze id, by dataset name and row position."""
    return keep_first(rows, ["bronze_id"], order)


def read_landing(spark: SparkSession, input_dir: str, ingested_at: str) -> DataFrame:
    """All landing datasets of a folder as deduplicated bronze rows; empty folder, empty frame."""
    rows = read_datasets(spark, landing_paths(spark, input_dir), ingested_at)
    return dedup_landing(rows).select(*BRONZE.fieldNames())
