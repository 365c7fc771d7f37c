"""Listing paths on whatever file system the cluster uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a glob, by name; names only, nothing is opened."""
    target, fs = _hadoop(spark, pattern)
    found = fs.globStatus(target)
    return sorted(status.getPath().toString() for status in found) if found else []


def make_folder(spark: SparkSession, path: str) -> None:
    target, fs = _hadoop(spark, path)
    fs.mkdirs(target)
