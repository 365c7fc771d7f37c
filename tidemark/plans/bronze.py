"""Landing to bronze, and quality runs over bronze rows."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from typing import Literal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.constants import TITLE_SIMILARITY
from tidemark.functions.vectors import Embedder, HashedEmbedder
from tidemark.operators.clusters import title_duplicate_members
from tidemark.operators.drift import domain_run_stats, domain_stats, drift_findings
from tidemark.operators.rules import (
    REASONS,
    Rule,
    apply_rules,
    bronze_rules,
    failed_rows,
    quality_profile,
    schema_findings,
)
from tidemark.operators.shaping import rows_not_in
from tidemark.schemas import BRONZE
from tidemark.session import stage, staging
from tidemark.sources import lake as tables
from tidemark.sources.audit import (
    QualityResult,
    append_quality_run,
    record_run,
    run_id,
    utc_now_iso,
)
from tidemark.sources.lake import Lake, days_of
from tidemark.sources.landing import dedup_landing, landing_paths, read_datasets

log = logging.getLogger(__name__)

Mode = Literal["append", "overwrite"]
#: An embedder, or what makes one; a maker that fails leaves titles uncompared.
Embedding = Embedder | Callable[[], Embedder] | None
_KNOWN = "_known"


def _made(embedder: Embedding) -> Embedder | None:
    """The embedder itself. Only making it may fail; errors of the check itself go on."""
    if embedder is None or hasattr(embedder, "embed"):
        return embedder
    try:
        return embedder()
    except Exception:
        log.warning("no embedder; duplicate titles not checked", exc_info=True)
        return None


def run_bronze_checks(
    checked: DataFrame,
    *,
    drift: DataFrame,
    rules: Sequence[Rule] | None = None,
    embedder: Embedding = None,
    duplicate_threshold: float = TITLE_SIMILARITY,
) -> QualityResult:
    """All quality checks over rows that carry their failure reasons.

    ``drift`` are the batch's drift findings. Without an embedder, or when it can't be made,
    titles are not compared.
    """
    started_at = utc_now_iso()
    this_run = run_id("qrun", "bronze", started_at)
    counts, summary, nulls = quality_profile(
        checked, rules or bronze_rules(), BRONZE.fieldNames()
    )
    summary = schema_findings(checked, BRONZE) + summary
    drift = stage(drift, "drift")
    clusters, n_clusters = None, 0
    model = _made(embedder)
    if model is not None:
        members = title_duplicate_members(checked, model, threshold=duplicate_threshold)
        clusters = stage(members, "duplicate-titles")
        n_clusters = clusters.select("cluster_id").distinct().count()
    return QualityResult(
        run_id=this_run,
        layer="bronze",
        started_at=started_at,
        finished_at=utc_now_iso(),
        **counts,
        failures=failed_rows(checked, this_run),
        check_summary=summary,
        drift=drift,
        null_counts=nulls,
        clusters=clusters,
        n_drift=drift.count(),
        n_clusters=n_clusters,
    )


def domain_runs(lake: Lake) -> DataFrame | None:
    """Statistics per domain and run of everything in bronze; None without a bronze table.

    Each ingest keeps its own statistics, so bronze text is not read again for them. Runs that
    have none, after a crash between the two writes, are worked out from bronze.
    """
    if not lake.exists(tables.BRONZE):
        return None
    kept = lake.read(tables.DOMAIN_RUNS)
    stamps = lake.read(tables.BRONZE, ["ingested_at"]).distinct()  # one dictionary-coded column
    lacking = stage(rows_not_in(stamps, kept, ["ingested_at"]), "runs-lacking")
    if lacking.isEmpty():
        return kept
    columns = ["source_domain", "ingested_at", "text", "source_url"]
    rows = lake.read(tables.BRONZE, columns).join(lacking, "ingested_at", "left_semi")
    return kept.unionByName(domain_run_stats(rows))


def write_quarantine(failures: DataFrame, lake: Lake) -> bool:
    """Append failed rows with their reasons, unless quarantined before for the same reasons.

    Every run's failing ids are kept beside them, so a run finds its rows in any case. The
    lookup moves ids and a hash of the reasons, of the failing rows' own days.
    """
    if failures.isEmpty():
        return False
    runs = failures.select(F.col("_quality_run_id").alias("run_id"), "bronze_id")
    lake.append(tables.QUARANTINE_RUNS, runs)
    why = F.xxhash64(F.array_join(REASONS, "\n")).alias("_why")
    rows = failures
    if lake.exists(tables.QUARANTINE):
        old = lake.read(tables.QUARANTINE, ["bronze_id", REASONS], days=days_of(failures))
        rows = rows_not_in(failures.withColumn("_why", why), old.select("bronze_id", why), ["bronze_id", "_why"]).drop("_why")
        if rows.isEmpty():
            return False
    lake.append(tables.QUARANTINE, rows)
    return True


def _with_known_flag(rows: DataFrame, lake: Lake, days: DataFrame) -> DataFrame:
    """Flag rows whose id is in bronze; reads the ids of the batch's own days only.

    The rows come out of the deduplication hashed by the same id, so only the ids move.
    """
    known = (
        lake.read(tables.BRONZE, ["bronze_id"], days=days)
        .distinct()
        .withColumn(_KNOWN, F.lit(True))
    )
    return rows.join(known, "bronze_id", "left").withColumn(
        _KNOWN, F.coalesce(_KNOWN, F.lit(False))
    )


def ingest_datasets(
    spark: SparkSession,
    paths: Sequence[str],
    lake: Lake,
    *,
    mode: Mode = "overwrite",
    validate: bool = True,
    embedder: Embedding = None,
    ingested_at: str | None = None,
    rules: Sequence[Rule] | None = None,
) -> int:
    """Ingest the given landing datasets into bronze; returns the rows written.

    The batch is deduplicated, checked and marked in one pass and staged as a columnar copy;
    every later step reads only the columns it needs from there. ``rules`` take the place of the
    built-in ones.
    """
    with staging(spark, lake.staging):
        return _ingest(spark, paths, lake, mode, validate, embedder, ingested_at or utc_now_iso(), rules)


def _ingest(
    spark: SparkSession,
    paths: Sequence[str],
    lake: Lake,
    mode: Mode,
    validate: bool,
    embedder: Embedding,
    stamp: str,
    own_rules: Sequence[Rule] | None,
) -> int:
    rows = read_datasets(spark, paths, stamp)
    batch = dedup_landing(rows).select(*BRONZE.fieldNames())
    if mode == "append":
        batch = _with_known_flag(batch, lake, stage(days_of(rows), "days"))
    else:
        batch = batch.withColumn(_KNOWN, F.lit(False))
    # Ids are unique after the deduplication, so that rule needs no look at other rows.
    rules = (bronze_rules(unique_id=False) if own_rules is None else list(own_rules)) if validate else []
    batch = apply_rules(batch, rules) if rules else batch.withColumn(
        REASONS, F.array().cast("array<string>")
    )
    batch = stage(batch, "bronze-batch")
    failed = F.size(REASONS) > 0
    totals = batch.agg(
        F.count("*").alias("loaded"),
        F.count_if(failed).alias("quarantined"),
        F.count_if(~failed & F.col(_KNOWN)).alias("skipped"),
        F.count_if(~failed & ~F.col(_KNOWN)).alias("written"),
    ).first()

    with record_run("bronze", lake, rows_in=totals["loaded"]) as handle:
        quality_run = None
        if validate and totals["loaded"]:
            past = domain_runs(lake)
            past = None if past is None else stage(past, "domain-runs")
            now = stage(domain_stats(batch.where(~F.col(_KNOWN))), "domains")
            found = drift_findings(now, past)
            result = run_bronze_checks(batch, drift=found, rules=rules, embedder=embedder)
            write_quarantine(result.failures, lake)
            append_quality_run(result, lake)
            quality_run = result.run_id
        fresh = batch.where(~failed & ~F.col(_KNOWN)).select(*BRONZE.fieldNames())
        if mode == "overwrite":
            if not totals["written"]:
                log.warning("bronze is overwritten with no rows")
            lake.overwrite(tables.BRONZE, fresh)
            lake.overwrite(tables.DOMAIN_RUNS, domain_run_stats(fresh))
        elif totals["written"] or not lake.exists(tables.BRONZE):
            lake.append(tables.BRONZE, fresh)
            lake.append(tables.DOMAIN_RUNS, domain_run_stats(fresh))
        if totals["quarantined"]:
            handle.set_status("partial")
        handle.rows_out = totals["written"]
        handle.details.update(
            source_files=len(paths),
            rows_quarantined=totals["quarantined"],
            rows_skipped_duplicate=totals["skipped"],
            validate=validate,
            mode=mode,
            quality_run_id=quality_run,
        )
    return totals["written"]


def ingest_bronze(
    spark: SparkSession,
    input_dir: str,
    lake: Lake,
    *,
    mode: Mode = "overwrite",
    validate: bool = True,
    embedder: Embedding = HashedEmbedder(),
    ingested_at: str | None = None,
    rules: Sequence[Rule] | None = None,
) -> int:
    """Ingest every landing dataset of a folder; returns the rows written."""
    return ingest_datasets(
        spark,
        landing_paths(spark, input_dir),
        lake,
        mode=mode,
        validate=validate,
        embedder=embedder,
        ingested_at=ingested_at,
        rules=rules,
    )


def check_quality(lake: Lake, *, rules: Sequence[Rule] | None = None) -> QualityResult:
    """Run all checks over the stored bronze table; quarantine and audit the outcome.

    Drift compares the newest ingest with the older ones. The caller turns a ``fail`` status
    into its exit code. Rules are evaluated once; the failures and findings of the result are
    read from the lake's tables.
    """
    if not lake.exists(tables.BRONZE):
        raise FileNotFoundError(f"no bronze table under {lake.root}")
    with staging(lake.spark, lake.staging):
        bronze = lake.read(tables.BRONZE)
        checked = stage(apply_rules(bronze, rules), "checked")
        newest = bronze.agg(F.max("ingested_at")).first()[0]
        runs = stage(domain_runs(lake), "domain-runs")
        now = runs.where(F.col("ingested_at") == newest).drop("ingested_at")
        found = drift_findings(now, runs.where(F.col("ingested_at") < newest))
        result = run_bronze_checks(checked, drift=found, rules=rules)
        write_quarantine(result.failures, lake)
        append_quality_run(result, lake)
    of_run = F.col("run_id") == result.run_id
    result.failures = lake.read(tables.QUARANTINE).join(
        lake.read(tables.QUARANTINE_RUNS).where(of_run).select("bronze_id").distinct(), "bronze_id", "left_semi"
    )
    result.drift = lake.read(tables.DRIFT_FINDINGS).where(of_run).drop("run_id")
    return result


def quality_report(result: QualityResult, *, n_checks: int = 10, n_findings: int = 100) -> list[str]:
    """The run as printable lines: status, counts, the top failing checks, the first drift findings."""
    lines = [
        f"status: {result.status}",
        f"rows in/pass/fail: {result.rows_in} / {result.rows_passed} / {result.rows_failed}",
    ]
    lines += [
        f"{c['column']}: {c['check']} ({c['failed']} rows)" for c in result.check_summary[:n_checks]
    ]
    if result.n_drift:
        found = result.drift.orderBy("domain", "metric").limit(n_findings).collect()
        lines += [f"[{f['domain']}] {f['metric']}: {f['note']}" for f in found]
        if result.n_drift > len(found):
            lines.append(f"{result.n_drift - len(found)} more drift findings in the findings table")
    return lines
