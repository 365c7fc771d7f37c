"""Lake tables as parquet folders (or another table format the session supports).

A parquet table keeps its rows in ``snapshot-NNNNNN`` folders. The current one is the newest
that Spark finished writing, so an overwrite becomes visible at once and a crash half way
leaves the old rows in place. Appends go into the current snapshot.

Tables holding crawl rows are partitioned by ``crawl_day``. Content ids include the day, so a
lookup of a batch's ids only reads the days of that batch.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.constants import LAYERS
from tidemark.functions.ids import day_of
from tidemark.operators.shaping import align_frame
from tidemark.sources.storage import list_paths, make_folder

DAY = "crawl_day"


@dataclass(frozen=True)
class Table:
    """Where a table lives, what it holds, and whether it is split by crawl day."""

    layer: str
    name: str
    schema: T.StructType
    by_day: bool = False

    @property
    def stored(self) -> T.StructType:
        day = [T.StructField(DAY, T.StringType())] if self.by_day else []
        return T.StructType(self.schema.fields + day)


BRONZE = Table("bronze", "scrapes", schemas.BRONZE, by_day=True)
QUARANTINE = Table("bronze", "scrapes_quarantine", schemas.QUARANTINE, by_day=True)
PAGES = Table("silver", "pages", schemas.PAGES, by_day=True)
CHUNKS = Table("silver", "chunks", schemas.CHUNKS, by_day=True)
QUALITY_RUNS = Table("_quality", "runs", schemas.QUALITY_RUNS)
PIPELINE_RUNS = Table("_pipeline", "runs", schemas.PIPELINE_RUNS)
#: Which rows each quality run found failing; the rows themselves are quarantined once.
QUARANTINE_RUNS = Table(
    "_quality",
    "quarantine_runs",
    T.StructType([T.StructField("run_id", T.StringType()), T.StructField("bronze_id", T.StringType())]),
)
SITE_STATS = Table(
    "_pipeline",
    "site_stats",
    T.StructType(
        [
            T.StructField("run_id", T.StringType()),
            T.StructField("site", T.StringType()),
            T.StructField("start_url", T.StringType()),
            T.StructField("pages_fetched", T.LongType()),
            T.StructField("pages_kept", T.LongType()),
            T.StructField("pages_dropped", T.LongType()),
            T.StructField("error", T.StringType()),
        ]
    ),
)
DRIFT_FINDINGS = Table(
    "_quality",
    "drift_findings",
    T.StructType([T.StructField("run_id", T.StringType())] + schemas.DRIFT.fields),
)
DOMAIN_RUNS = Table(
    "_quality",
    "domain_runs",
    T.StructType(
        [
            T.StructField("source_domain", T.StringType()),
            T.StructField("ingested_at", T.StringType()),
            T.StructField("rows", T.LongType()),
            T.StructField("mean_text_len", T.DoubleType()),
            T.StructField("n_unique_url", T.LongType()),
        ]
    ),
)
DUPLICATE_MEMBERS = Table(
    "_quality",
    "duplicate_members",
    T.StructType(
        [
            T.StructField("run_id", T.StringType()),
            T.StructField("cluster_id", T.StringType()),
            T.StructField("bronze_id", T.StringType()),
            T.StructField("title", T.StringType()),
            T.StructField("size", T.LongType()),
            T.StructField("max_similarity", T.DoubleType()),
        ]
    ),
)


def crawl_day(crawled_at: Column) -> Column:
    """The partition a row belongs to: its ISO day, or ``unknown``."""
    day = day_of(crawled_at)
    return F.when(day.rlike(r"^\d{4}-\d{2}-\d{2}$"), day).otherwise("unknown")


def days_of(df: DataFrame) -> DataFrame:
    """The crawl days of a frame, one row each."""
    return df.select(crawl_day(F.col("crawled_at")).alias(DAY)).distinct()


class Lake:
    """The tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, str(root).rstrip("/"), fmt

    @property
    def staging(self) -> str:
        """Where jobs on this lake stage intermediate tables while they run."""
        return f"{self.root}/_staging"

    def path(self, table: Table) -> str:
        return f"{self.root}/{table.layer}/{table.name}"

    def ensure_layers(self) -> None:
        for layer in LAYERS:
            make_folder(self.spark, f"{self.root}/{layer}")

    def _snapshots(self, table: Table) -> list[str]:
        done = list_paths(self.spark, f"{self.path(table)}/snapshot-*/_SUCCESS")
        return [path.rsplit("/", 1)[0] for path in done]

    def location(self, table: Table) -> str | None:
        """Where the current rows are; None when the table does not exist."""
        if self.fmt != "parquet":
            return self.path(table) if list_paths(self.spark, self.path(table)) else None
        snapshots = self._snapshots(table)
        return snapshots[-1] if snapshots else None

    def exists(self, table: Table) -> bool:
        return self.location(table) is not None

    def read(
        self,
        table: Table,
        columns: Sequence[str] | None = None,
        *,
        days: Sequence[str] | DataFrame | None = None,
    ) -> DataFrame:
        """The table, or a typed empty frame. ``days`` limits the partitions read.

        A frame of days is joined, and Spark prunes the partitions when it runs.

        Columns a file lacks read as null. ``crawl_day`` can be asked for by name.
        """
        where = self.location(table)
        names = list(columns or table.schema.fieldNames())
        rows = self.spark.createDataFrame([], table.stored)
        if where is not None:
            try:
                reader = self.spark.read.format(self.fmt)
                if self.fmt == "parquet":
                    reader = reader.schema(table.stored)
                rows = reader.load(where)
            except AnalysisException:
                pass  # an unreadable table counts as absent
        if days is not None and table.by_day:
            if isinstance(days, DataFrame):
                rows = rows.join(days.select(DAY), DAY, "left_semi")
            else:
                rows = rows.where(F.col(DAY).isin(list(days)))
        return rows.select(*names)

    def append(self, table: Table, df: DataFrame) -> str:
        """Add rows in the table's own schema."""
        target = self.location(table) or self._next(table)
        self._write(table, df, target, "append")
        return target

    def overwrite(self, table: Table, df: DataFrame) -> str:
        """Replace all rows. The plan may read the table it replaces."""
        target = self._next(table)
        mode = "overwrite" if self.fmt != "parquet" else "errorifexists"
        self._write(table, df, target, mode)
        return target

    def _next(self, table: Table) -> str:
        if self.fmt != "parquet":
            return self.path(table)
        started = list_paths(self.spark, f"{self.path(table)}/snapshot-*")
        number = int(started[-1].rsplit("-", 1)[1]) + 1 if started else 1
        return f"{self.path(table)}/snapshot-{number:06d}"

    def _write(self, table: Table, df: DataFrame, target: str, mode: str) -> None:
        self.ensure_layers()
        rows = align_frame(df, table.schema)
        if not table.by_day:
            rows.write.format(self.fmt).mode(mode).save(target)
            return
        rows = rows.withColumn(DAY, crawl_day(F.col("crawled_at")))
        # Groups rows by day for well-sized files; AQE splits a day too big for one task.
        rows = rows.hint("rebalance", DAY)
        rows.write.format(self.fmt).mode(mode).partitionBy(DAY).save(target)

    def drop_old_snapshots(self, table: Table) -> int:
        """Delete all snapshots but the current one; for use when no reader needs them."""
        old = self._snapshots(table)[:-1] if self.fmt == "parquet" else []
        for path in old:
            target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)
        return len(old)
