"""Table schemas, in their declared column order."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


_VECTOR = [
    T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("embedding_model", T.StringType()),
    T.StructField("embedding_dim", T.IntegerType()),
    T.StructField("embedded_at", T.StringType()),
]

LANDING = T.StructType(
    _strings("title", "date_published", "text", "source_url", "source_domain")
    + [T.StructField("relevance_score", T.DoubleType())]
    + _strings("query", "crawled_at")
)

BRONZE = T.StructType(
    _strings("bronze_id") + LANDING.fields + _strings("source_file", "ingested_at")
)

QUARANTINE = T.StructType(
    BRONZE.fields
    + [
        T.StructField("_failure_reasons", T.ArrayType(T.StringType())),
        T.StructField("_quality_run_id", T.StringType()),
    ]
)

PAGES = T.StructType(
    _strings(
        "page_id", "bronze_id", "title", "date_published", "text", "text_hash",
        "source_url", "source_domain", "query", "crawled_at",
    )
    + _VECTOR
)

CHUNKS = T.StructType(
    _strings("chunk_id", "page_id", "bronze_id")
    + [
        T.StructField("chunk_index", T.IntegerType()),
        T.StructField("chunk_text", T.StringType()),
        T.StructField("chunk_char_count", T.IntegerType()),
    ]
    + _strings("source_url", "source_domain", "query", "crawled_at")
    + _VECTOR
)

QUALITY_RUNS = T.StructType(
    _strings("run_id", "layer", "started_at", "finished_at")
    + [T.StructField(n, T.LongType()) for n in ("rows_in", "rows_passed", "rows_failed")]
    + _strings(
        "status", "check_summary", "drift_report", "null_counts", "duplicate_clusters", "lake_dir"
    )
)

PIPELINE_RUNS = T.StructType(
    _strings("run_id", "stage", "started_at", "finished_at")
    + [T.StructField("duration_ms", T.LongType())]
    + _strings("status")
    + [T.StructField("rows_in", T.LongType()), T.StructField("rows_out", T.LongType())]
    + _strings("query", "details", "error", "lake_dir")
)

DRIFT = T.StructType(
    _strings("domain", "metric")
    + [T.StructField(n, T.DoubleType()) for n in ("current", "baseline", "ratio")]
    + _strings("severity", "note")
)

HITS = T.StructType(
    _strings("row_id")
    + [T.StructField("similarity", T.FloatType())]
    + _strings("title", "source_url", "crawled_at", "text")
)
