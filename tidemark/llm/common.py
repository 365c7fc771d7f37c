"""What the training-data operators share: word rules, normalised texts, staged tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import checkpoint_root, stage

__all__ = ["WORD", "documents", "fold_ascii", "fresh", "new_folder", "stage", "text_or_empty", "word_count"]

#: A word: a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def fresh(docs: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``docs`` has it (case ignored)."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own in the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def text_or_empty(text: str | Column = "text") -> Column:
    """Null texts count as empty."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column.cast("string"), F.lit(""))


def fold_ascii(text: Column) -> Column:
    """A-Z to lower case; every other character stays as it is."""
    return F.translate(text, _UPPER, _UPPER.lower())


def word_count(text: Column) -> Column:
    """Number of words; 0 for null and for white space alone."""
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")
