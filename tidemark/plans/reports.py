"""Readable views of the audit tables and of the latest landing dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.reports import (
    drift_line,
    summarize_checks,
    summarize_drift,
    summarize_duplicates,
    summarize_nulls,
)
from tidemark.operators.shaping import align_frame, preview
from tidemark.schemas import QUALITY_RUNS
from tidemark.sources import lake as tables
from tidemark.sources.lake import Lake
from tidemark.sources.landing import latest_landing, read_landing_file

RAW_COLUMNS = (
    "Raw Check Summary", "Raw Drift Report", "Raw Null Counts", "Raw Duplicate Clusters",
)


def newest_runs(runs: DataFrame, n: int) -> DataFrame:
    """The newest ``n`` audit rows; run ids break ties."""
    return runs.orderBy(F.desc("started_at"), "run_id").limit(n)


def quality_history(runs: DataFrame, n: int = 25, *, raw: bool = True) -> DataFrame:
    """Quality runs as readable rows, newest first. JSON is parsed for the shown rows only."""
    rows = newest_runs(align_frame(runs, QUALITY_RUNS), n)
    shown = rows.select(
        F.col("started_at").alias("Run Started"),
        F.col("finished_at").alias("Run Finished"),
        F.col("layer").alias("Layer"),
        F.col("rows_in").alias("Rows In"),
        F.col("rows_passed").alias("Rows Passed"),
        F.col("rows_failed").alias("Rows Failed"),
        summarize_checks(F.col("check_summary")).alias("Checks Failed"),
        summarize_drift(F.col("drift_report")).alias("Drift Findings"),
        summarize_nulls(F.col("null_counts")).alias("Null Columns"),
        summarize_duplicates(F.col("duplicate_clusters")).alias("Duplicate Clusters"),
        F.col("run_id").alias("Run ID"),
        F.col("lake_dir").alias("Lake Dir"),
        F.col("check_summary").alias("Raw Check Summary"),
        F.col("drift_report").alias("Raw Drift Report"),
        F.col("null_counts").alias("Raw Null Counts"),
        F.col("duplicate_clusters").alias("Raw Duplicate Clusters"),
    )
    return shown if raw else shown.drop(*RAW_COLUMNS)


def lake_quality_history(lake: Lake, n: int = 25, *, raw: bool = True) -> DataFrame:
    """The quality runs of a lake; a typed empty frame when there are none.

    Audit rows only count drift findings. The first three of each shown run, by domain and
    metric, come from the findings table.
    """
    shown = quality_history(lake.read(tables.QUALITY_RUNS), n, raw=raw)
    found = lake.read(tables.DRIFT_FINDINGS).join(shown.select(F.col("Run ID").alias("run_id")), "run_id", "left_semi")
    order = Window.partitionBy("run_id").orderBy("domain", "metric")
    first = (
        found.withColumn("place", F.row_number().over(order))
        .where("place <= 3")
        .groupBy(F.col("run_id").alias("Run ID"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "domain", "metric", "note"))).alias("items"))
    )
    totals = found.groupBy(F.col("run_id").alias("Run ID")).agg(F.count("*").alias("total"))
    line = drift_line(F.col("items"), F.col("total"))
    names = shown.columns
    joined = shown.join(first, "Run ID", "left").join(totals, "Run ID", "left")
    return (
        joined.withColumn("Drift Findings", F.coalesce(line, F.col("Drift Findings")))
        .select(names)
        .orderBy(F.desc("Run Started"), "Run ID")
    )


def run_history(runs: DataFrame, columns: list[str], n: int) -> DataFrame:
    """Chosen columns of the newest stage runs."""
    return newest_runs(runs, n).select(*columns)


def rows_by_domain(df: DataFrame) -> DataFrame:
    """Row count per domain."""
    return df.groupBy("source_domain").agg(F.count("*").alias("rows"))


def latest_report(lake: Lake, data_dir: str, *, n: int = 10, full_text: bool = False) -> dict | None:
    """The newest landing dataset: path, row count, columns, rows per domain, sample, preview.

    None when there is no dataset. ``sample_text`` is the text of the first stored row.
    """
    path = latest_landing(lake.spark, data_dir)
    if path is None:
        return None
    stored = read_landing_file(lake.spark, path)
    rows = stored.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    first = rows.orderBy("_file", "_row").select("text").first() if "text" in stored.columns else None
    shown = preview(rows, order=["_file", "_row"], n=n, full_text=full_text or first is None)
    return {
        "path": path,
        "rows": stored.count(),
        "columns": stored.columns,
        "by_domain": rows_by_domain(stored),
        "sample_text": first["text"] if first else None,
        "preview": shown.drop("_file", "_row"),
    }
