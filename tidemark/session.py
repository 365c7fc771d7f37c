"""Where intermediate tables go."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_JOB_FOLDER: ContextVar[str | None] = ContextVar("job_folder", default=None)
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of a batch that a job hands to a Python worker, one row at least. Spark's own limit is
#: 64 MB, and a stage may keep several workers busy per core.
BATCH_BYTES = 8 << 20


def delete_folder(spark: SparkSession, folder: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names.

    In local mode, where all tasks share one disk, a session without the setting gets a folder
    in its warehouse, deleted when Python exits. On a cluster the setting is needed.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/staging-{uuid.uuid4().hex}"
        atexit.register(_leave, spark, root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def _leave(spark: SparkSession, root: str) -> None:
    if spark.sparkContext._jsc is not None:
        delete_folder(spark, root)


@contextmanager
def bounded_batches(spark: SparkSession) -> Iterator[None]:
    """Hand Python workers batches of at most ``BATCH_BYTES``, unless the session sets a limit itself."""
    if spark.conf.get(_BATCH_LIMIT, None) is not None:
        yield
        return
    spark.conf.set(_BATCH_LIMIT, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(_BATCH_LIMIT)


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of every query when it ends, not when the driver collects garbage.

    For steps that stage what they make: their shuffles are not read again.
    """
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_SHUFFLE_CLEANUP) if before is None else spark.conf.set(_SHUFFLE_CLEANUP, before)


@contextmanager
def staging(spark: SparkSession, root: str | None = None) -> Iterator[None]:
    """Keep what a job stages in one folder, deleted when the job ends, however it ends.

    Jobs on a lake pass a folder of the lake, so what they stage is where their tables are. While
    a job runs, its batches for Python are bounded in bytes.
    """
    if _JOB_FOLDER.get() is not None:
        yield
        return
    folder = f"{root or checkpoint_root(spark)}/job-{uuid.uuid4().hex}"
    token = _JOB_FOLDER.set(folder)
    try:
        with bounded_batches(spark):
            yield
    finally:
        _JOB_FOLDER.reset(token)
        delete_folder(spark, folder)


def stage_to(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """:func:`stage`, and the folder of the copy."""
    spark = df.sparkSession
    path = f"{_JOB_FOLDER.get() or checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that several jobs read to the shared folder, and read it back.

    This cuts the lineage like a checkpoint: the rows survive the loss of any executor. Unlike
    one the copy is columnar, so each later pass reads only its own columns. Outside
    :func:`staging` it stays until the folder is cleaned, as checkpoint files do.
    """
    return stage_to(df, name)[0]
