"""Per-domain drift of a batch against its trailing runs.

Everything works on per-(domain, run) aggregates: after the first aggregation the data has one
row per domain and run, however large the tables are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.constants import DRIFT_DROP, DRIFT_WINDOW
from tidemark.schemas import DRIFT
from tidemark.session import stage

METRICS = ("rows", "mean_text_len", "n_unique_url")


def _metrics() -> list[Column]:
    url = F.col("source_url")
    return [
        F.count("*").alias("rows"),
        F.avg(F.length("text")).alias("mean_text_len"),
        # A null URL counts as one more distinct value.
        (F.count_distinct(url) + F.max(url.isNull().cast("int"))).alias("n_unique_url"),
    ]


def domain_stats(df: DataFrame) -> DataFrame:
    """Rows, mean text length and distinct URLs per domain.

    The distinct count is planned on (domain, URL) first, so one domain holding a third of the
    rows still spreads over all tasks.
    """
    return df.groupBy("source_domain").agg(*_metrics())


def domain_run_stats(history: DataFrame) -> DataFrame:
    """The same per domain and run stamp."""
    return history.groupBy("source_domain", "ingested_at").agg(*_metrics())


def trailing_runs(run_stats: DataFrame, window: int = DRIFT_WINDOW) -> DataFrame:
    """The newest ``window`` runs of each domain."""
    newest = Window.partitionBy("source_domain").orderBy(F.desc("ingested_at"))
    ranked = run_stats.withColumn("_rank", F.row_number().over(newest))
    return ranked.where(F.col("_rank") <= window).drop("_rank")


def trailing_baseline(run_stats: DataFrame, window: int = DRIFT_WINDOW) -> DataFrame:
    """Mean of each metric over the trailing runs of the domain."""
    return (
        trailing_runs(run_stats, window)
        .groupBy("source_domain")
        .agg(*[F.avg(m).alias(m) for m in METRICS])
    )


def recent_runs(run_stats: DataFrame, window: int = DRIFT_WINDOW) -> DataFrame:
    """The newest ``window`` run stamps overall."""
    return run_stats.select("ingested_at").distinct().orderBy(F.desc("ingested_at")).limit(window)


def always_present_domains(run_stats: DataFrame, window: int = DRIFT_WINDOW) -> DataFrame:
    """Domains seen in every one of the last ``window`` runs; none when there are fewer runs."""
    recent = F.broadcast(recent_runs(run_stats, window))  # at most `window` rows
    return (
        run_stats.join(recent, "ingested_at", "left_semi")
        .groupBy("source_domain")
        .agg(F.count_distinct("ingested_at").alias("_runs"))
        .where(F.col("_runs") == window)
        .select("source_domain")
    )


def missing_domains(always_present: DataFrame, current: DataFrame) -> DataFrame:
    """Always-present domains the current batch lacks."""
    now = current.select(F.col("source_domain").alias("_now")).distinct()
    return always_present.join(
        now, F.col("source_domain").eqNullSafe(F.col("_now")), "left_anti"
    )


def percent_note(metric: Column, ratio: Column, window: int) -> Column:
    """``rows dropped to 20% of trailing-3 mean``, halves rounding to even."""
    percent = F.bround(ratio * 100, 0).cast("long").cast("string")
    return F.concat(metric, F.lit(" dropped to "), percent, F.lit(f"% of trailing-{window} mean"))


def _finding(domain, metric, current, baseline, ratio, note) -> list[Column]:
    values = (domain, metric, current, baseline, ratio, F.lit("warn"), note)
    return [
        value.cast(field.dataType).alias(field.name)
        for value, field in zip(values, DRIFT.fields, strict=True)
    ]


def _without_history(stats: DataFrame, note: str) -> DataFrame:
    nothing = F.lit(None)
    return stats.select(
        *_finding(
            F.col("source_domain"), F.lit("baseline"), F.col("rows"), nothing, nothing, F.lit(note)
        )
    )


def run_drift(
    current: DataFrame,
    history: DataFrame | None,
    *,
    window: int = DRIFT_WINDOW,
    drop: float = DRIFT_DROP,
) -> DataFrame:
    """Findings of the current batch against the history, one row each.

    Each side is aggregated once and kept; the findings then work on those small tables.
    """
    past = None if history is None else stage(domain_run_stats(history), "domain-runs")
    return drift_findings(stage(domain_stats(current), "domains"), past, window=window, drop=drop)


def drift_findings(
    stats: DataFrame,
    run_stats: DataFrame | None,
    *,
    window: int = DRIFT_WINDOW,
    drop: float = DRIFT_DROP,
) -> DataFrame:
    """The findings, from :func:`domain_stats` and :func:`domain_run_stats`.

    ``baseline``: the domain has no earlier run. A metric name: the value fell below ``drop``
    times its trailing mean. ``presence``: the domain was in all recent runs and is absent now.
    An empty batch has no findings.
    """
    if run_stats is None or run_stats.isEmpty():
        return _without_history(stats, "no prior runs to compare")
    if stats.isEmpty():
        return stats.limit(0).select(*_finding(*[F.lit(None)] * 6))

    base = trailing_baseline(run_stats, window).select(
        "source_domain",
        F.lit(True).alias("_seen"),
        *[F.col(m).alias(f"base_{m}") for m in METRICS],
    )
    compared = stats.join(base, "source_domain", "left")

    fresh = _without_history(
        compared.where(F.col("_seen").isNull()), "no prior runs for this domain"
    )
    metrics = F.array(
        *[
            F.struct(
                F.lit(m).alias("metric"),
                F.col(m).cast("double").alias("now"),
                F.col(f"base_{m}").alias("base"),
            )
            for m in METRICS
        ]
    )
    dropped = (
        compared.where("_seen")
        .select("source_domain", F.inline(metrics))
        .where("now IS NOT NULL AND base IS NOT NULL AND base <> 0")
        .withColumn("ratio", F.col("now") / F.col("base"))
        .where(F.col("ratio") < drop)
        .select(
            *_finding(
                F.col("source_domain"), F.col("metric"), F.col("now"), F.col("base"),
                F.col("ratio"), percent_note(F.col("metric"), F.col("ratio"), window),
            )
        )
    )
    absent = missing_domains(always_present_domains(run_stats, window), stats).select(
        *_finding(
            F.col("source_domain"), F.lit("presence"), F.lit(0.0), F.lit(None), F.lit(0.0),
            F.lit(f"absent from current run; present in last {window} runs"),
        )
    )
    return fresh.unionByName(dropped).unionByName(absent)
