"""Incremental filters, rules, drift and audit reports, on V1, V2, V4 and V5."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sqltext as S
from checks.registry import check
from checks.views import view
from tidemark.functions import reports as R
from tidemark.functions.ids import bronze_id
from tidemark.operators import crawl, drift, rules, shaping
from tidemark.plans import reports as plans
from tidemark.schemas import BRONZE

_COLUMNS = ["doc_id", *BRONZE.fieldNames()]
_LIST = ", ".join(_COLUMNS)
#: Landing files that count as ingested before, for the incremental filters.
_EARLIER = ["market_data_0.parquet", "market_data_1.parquet"]
_EARLIER_SQL = "('market_data_0.parquet', 'market_data_1.parquet')"


def bronze_rows(spark, sf):
    """V1 with bronze ids, duplicates included."""
    return view(spark, sf, "v1").withColumn(
        "bronze_id", bronze_id(F.col("crawled_at"), F.col("source_url"), F.col("title"))
    ).select(*_COLUMNS)


def first_rows(spark, sf):
    """The first row per bronze id."""
    return shaping.keep_first(bronze_rows(spark, sf), ["bronze_id"], ["source_file", "doc_id"])


@check("dedup_landing", S.D1 + f" SELECT {_LIST} FROM d1", ("v1",))
def _(spark, sf):
    return first_rows(spark, sf)


@check("dedup_pages", S.P1 + " SELECT bronze_id, page_id, text_hash FROM p1", ("v1",))
def _(spark, sf):
    pages = shaping.with_page_ids(shaping.nonblank_pages(first_rows(spark, sf)))
    return shaping.dedup_pages(pages).select("bronze_id", "page_id", "text_hash")


@check(
    "new_bronze_rows",
    S.D1 + f" SELECT {_LIST} FROM d1 WHERE bronze_id NOT IN (SELECT bronze_id FROM b1 WHERE source_file IN {_EARLIER_SQL})",
    ("v1",),
)
def _(spark, sf):
    known = bronze_rows(spark, sf).where(F.col("source_file").isin(_EARLIER))
    return shaping.new_bronze_rows(first_rows(spark, sf), known).select(*_COLUMNS)


@check(
    "new_silver_rows",
    S.P1 + f" SELECT {_LIST} FROM d1 WHERE bronze_id NOT IN (SELECT bronze_id FROM p1 WHERE source_file IN {_EARLIER_SQL})",
    ("v1",),
)
def _(spark, sf):
    rows = first_rows(spark, sf)
    pages = shaping.nonblank_pages(rows.where(F.col("source_file").isin(_EARLIER)))
    return shaping.new_silver_rows(rows, pages).select(*_COLUMNS)


def _checked(spark, sf):
    return rules.apply_rules(bronze_rows(spark, sf))


def _joined_reasons(df):
    return df.withColumn("reasons", F.array_join(rules.REASONS, "; ")).drop(rules.REASONS)


@check(
    "bronze_rules", S.C1 + " SELECT doc_id, bronze_id, array_to_string(why, '; ') AS reasons FROM c1", ("v1",)
)
def _(spark, sf):
    return _joined_reasons(_checked(spark, sf)).select("doc_id", "bronze_id", "reasons")


@check("rule_unique_id", S.C1 + " SELECT doc_id, id_copies > 1 AS duplicated FROM c1", ("v1",))
def _(spark, sf):
    flagged = rules.with_duplicate_flag(bronze_rows(spark, sf))
    return flagged.select("doc_id", F.col("_id_duplicated").alias("duplicated"))


@check(
    "failed_rows",
    S.C1 + f" SELECT {_LIST}, array_to_string(why, '; ') AS reasons, 'qrun' AS _quality_run_id FROM c1 WHERE len(why) > 0",
    ("v1",),
)
def _(spark, sf):
    failures = _joined_reasons(rules.failed_rows(_checked(spark, sf), "qrun"))
    return failures.select(*_COLUMNS, "reasons", "_quality_run_id")


@check(
    "passing_rows",
    S.C1 + f" SELECT {_LIST} FROM c1 WHERE bronze_id NOT IN (SELECT bronze_id FROM c1 WHERE len(why) > 0)",
    ("v1",),
)
def _(spark, sf):
    failures = rules.failed_rows(_checked(spark, sf), "qrun")
    return shaping.passing_rows(bronze_rows(spark, sf), failures).select(*_COLUMNS)


@check(
    "check_summary",
    S.C1 + """, r AS (SELECT unnest(why) AS reason FROM c1)
SELECT split_part(reason, ': ', 1) AS "column", split_part(reason, ': ', 2) AS "check", count(*) AS failed FROM r GROUP BY ALL""",
    ("v1",),
)
def _(spark, sf):
    return rules.check_summary(_checked(spark, sf))


@check(
    "failing_checks_top",
    S.C1 + """, r AS (SELECT unnest(why) AS reason FROM c1),
s AS (SELECT split_part(reason, ': ', 1) AS "column", split_part(reason, ': ', 2) AS "check", count(*) AS failed FROM r GROUP BY ALL)
SELECT * FROM s ORDER BY failed DESC, "column", "check" LIMIT 3""",
    ("v1",),
)
def _(spark, sf):
    """The report's top failing checks: the three most failed, ties by column and check."""
    return rules.check_summary(_checked(spark, sf)).limit(3)


@check(
    "null_counts",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM v1"
        for c in BRONZE.fieldNames()[1:]
    ),
    ("v1",),
)
def _(spark, sf):
    return rules.null_counts(view(spark, sf, "v1"), BRONZE.fieldNames()[1:])


_COUNTS = """ SELECT count(*) AS rows_in, count(*) FILTER (WHERE len(why) = 0) AS rows_passed,
 count(*) FILTER (WHERE len(why) > 0) AS rows_failed FROM c1"""


@check("quality_counts", S.C1 + _COUNTS, ("v1",))
def _(spark, sf):
    return rules.quality_counts(_checked(spark, sf))


@check(
    "quality_status",
    S.C1 + """ SELECT source_domain, CASE WHEN count(*) FILTER (WHERE len(why) > 0) > 0 THEN 'fail'
 WHEN count(*) FILTER (WHERE id_copies > 1) > 0 THEN 'warn' ELSE 'pass' END AS status FROM c1 GROUP BY source_domain""",
    ("v1",),
)
def _(spark, sf):
    checked = _checked(spark, sf)
    unique = f"array_contains({rules.REASONS}, 'bronze_id: unique')"
    counts = checked.groupBy("source_domain").agg(
        F.count_if(F.size(rules.REASONS) > 0).alias("failed"), F.count_if(F.expr(unique)).alias("found")
    )
    return counts.select("source_domain", rules.status_of(F.col("failed"), F.col("found")).alias("status"))


_GATED = """, gated AS (SELECT *, length(raw_markdown) >= 800 OR length(fit_markdown) >= 200 AS keep
 FROM v2 WHERE success AND rtrim(url, '/') <> rtrim(start_url, '/'))"""
_SITES = _GATED + """, stats AS (SELECT regexp_extract(start_url, '://([^/?#]*)', 1) AS site, start_url, count(*) AS pages_fetched,
 count(*) FILTER (WHERE keep) AS pages_kept, count(*) FILTER (WHERE NOT keep) AS pages_dropped,
 min(CASE WHEN score = 'n/a' AND NOT keep THEN 'bad score' END) AS error FROM gated GROUP BY ALL)"""


def _gated(spark, sf):
    error = F.when((F.col("score") == "n/a") & ~F.col("keep"), "bad score")
    return crawl.page_gate(view(spark, sf, "v2")).withColumn("error", error)


@check("page_gate", _GATED + " SELECT page_id, keep FROM gated", ("v2",))
def _(spark, sf):
    return crawl.page_gate(view(spark, sf, "v2")).select("page_id", "keep")


@check("site_stats", _SITES + " SELECT * FROM stats", ("v2",))
def _(spark, sf):
    return crawl.site_stats(_gated(spark, sf))


@check(
    "crawl_status",
    _SITES + """, t AS (SELECT coalesce(sum(pages_kept), 0)::BIGINT AS records, count(*) AS n_sites, count(error) AS n_errors FROM stats)
SELECT *, CASE WHEN records = 0 THEN 'fail' WHEN n_errors > 0 THEN 'partial' ELSE 'success' END AS status FROM t""",
    ("v2",),
)
def _(spark, sf):
    return crawl.crawl_status(crawl.site_stats(_gated(spark, sf)))


def _metrics(text_len: str = "avg(length(text))") -> str:
    return (
        f"count(*) AS rows, {text_len} AS mean_text_len, "
        "count(DISTINCT source_url) + max(CASE WHEN source_url IS NULL THEN 1 ELSE 0 END) AS n_unique_url"
    )


_ROUNDED = "rows, round(mean_text_len, 6) AS mean_text_len, n_unique_url::BIGINT AS n_unique_url"
_STATS = (
    f", cur AS (SELECT source_domain, {_metrics()} FROM v5c GROUP BY source_domain)"
    f", hist AS (SELECT source_domain, ingested_at, {_metrics()} FROM v5h GROUP BY ALL)"
    ", trail AS (SELECT * FROM hist QUALIFY row_number() OVER (PARTITION BY source_domain ORDER BY ingested_at DESC) <= 3)"
    ", base AS (SELECT source_domain, avg(rows) AS rows, avg(mean_text_len) AS mean_text_len, avg(n_unique_url) AS n_unique_url FROM trail GROUP BY source_domain)"
    ", recent AS (SELECT DISTINCT ingested_at FROM v5h ORDER BY ingested_at DESC LIMIT 3)"
    ", always AS (SELECT source_domain FROM hist WHERE ingested_at IN (SELECT ingested_at FROM recent) GROUP BY source_domain HAVING count(DISTINCT ingested_at) = 3)"
    ", missing AS (SELECT source_domain FROM always WHERE source_domain NOT IN (SELECT source_domain FROM cur))"
)
_V5, _PAST = ("v5h", "v5c"), ("v5p", "v5c")
_PAST_STATS = _STATS.replace("v5h", "v5p")


def _rounded(df):
    return df.withColumn("mean_text_len", F.round("mean_text_len", 6))


@check("domain_stats", f", s AS (SELECT source_domain, {_metrics()} FROM v1 GROUP BY source_domain) SELECT source_domain, {_ROUNDED} FROM s", ("v1",))
def _(spark, sf):
    return _rounded(drift.domain_stats(view(spark, sf, "v1")))


@check("domain_run_stats", _STATS + f" SELECT source_domain, ingested_at, {_ROUNDED} FROM hist", _V5)
def _(spark, sf):
    return _rounded(drift.domain_run_stats(view(spark, sf, "v5h")))


@check("trailing_runs", _STATS + f" SELECT source_domain, ingested_at, {_ROUNDED} FROM trail", _V5)
def _(spark, sf):
    return _rounded(drift.trailing_runs(drift.domain_run_stats(view(spark, sf, "v5h"))))


@check(
    "trailing_baseline",
    _STATS + " SELECT source_domain, round(rows, 6) AS rows, round(mean_text_len, 6) AS mean_text_len, round(n_unique_url, 6) AS n_unique_url FROM base",
    _V5,
)
def _(spark, sf):
    base = drift.trailing_baseline(drift.domain_run_stats(view(spark, sf, "v5h")))
    return base.select("source_domain", *[F.round(m, 6).alias(m) for m in drift.METRICS])


@check("recent_runs", _STATS + " SELECT ingested_at FROM recent", _V5)
def _(spark, sf):
    return drift.recent_runs(drift.domain_run_stats(view(spark, sf, "v5h")))


@check("always_present_domains", _STATS + " SELECT source_domain FROM always", _V5)
def _(spark, sf):
    return drift.always_present_domains(drift.domain_run_stats(view(spark, sf, "v5h")))


@check("missing_domains", _PAST_STATS + " SELECT source_domain FROM missing", _PAST)
def _(spark, sf):
    always = drift.always_present_domains(drift.domain_run_stats(view(spark, sf, "v5p")))
    return drift.missing_domains(always, view(spark, sf, "v5c"))


def _drop(metric: str) -> str:
    return f"""SELECT cur.source_domain, '{metric}', cur.{metric}::DOUBLE, base.{metric}::DOUBLE, cur.{metric} / base.{metric},
 '{metric} dropped to ' || round_even(cur.{metric} / base.{metric} * 100, 0)::BIGINT || '% of trailing-3 mean'
 FROM cur JOIN base USING (source_domain) WHERE base.{metric} <> 0 AND cur.{metric} / base.{metric} < 0.5"""


_DRIFT = (
    _PAST_STATS
    + """, found(domain, metric, current, baseline, ratio, note) AS (
SELECT source_domain, 'baseline', rows::DOUBLE, NULL, NULL, 'no prior runs for this domain' FROM cur WHERE source_domain NOT IN (SELECT source_domain FROM base)
UNION ALL """
    + " UNION ALL ".join(_drop(m) for m in drift.METRICS)
    + """ UNION ALL SELECT source_domain, 'presence', 0.0, NULL, 0.0, 'absent from current run; present in last 3 runs' FROM missing)
SELECT domain, metric, round(current, 6) AS current, round(baseline, 6) AS baseline, round(ratio, 6) AS ratio, 'warn' AS severity, note FROM found"""
)


@check("run_drift", _DRIFT, _PAST)
def _(spark, sf):
    found = drift.run_drift(view(spark, sf, "v5c"), view(spark, sf, "v5p"))
    return found.select(
        "domain", "metric",
        *[F.round(c, 6).alias(c) for c in ("current", "baseline", "ratio")],
        "severity", "note",
    )


# --- audit reports ------------------------------------------------------------------------
_ITEMS = "CASE WHEN json_valid({c}) AND json_type({c}) = 'ARRAY' THEN {c}::JSON[] END"


def _items(col: str) -> str:
    return _ITEMS.format(c=col)


def _first_three(items: str, render: str) -> str:
    return (
        f"CASE WHEN coalesce(len({items}), 0) = 0 THEN 'None' ELSE "
        f"array_to_string(list_transform(list_slice({items}, 1, 3), lambda i: {render}), '; ') || "
        f"CASE WHEN len({items}) > 3 THEN '; +' || (len({items}) - 3) || ' more' ELSE '' END END"
    )


_CHECKS = _first_three(
    _items("check_summary"),
    "coalesce(nullif(i->>'column', ''), 'row') || ': ' || coalesce((i->>'failed') || ' failed', 'failed')"
    " || ' (' || coalesce(nullif(i->>'check', ''), 'check') || ')'",
)
_DRIFTS = _first_three(
    _items("drift_report"),
    "coalesce(nullif(i->>'domain', ''), 'domain') || ': ' || coalesce(nullif(i->>'metric', ''), 'metric')"
    " || coalesce(' (' || nullif(i->>'note', '') || ')', '')",
)
_NULLS = """(SELECT coalesce(string_agg(k || ': ' || n, '; ' ORDER BY k), 'None') FROM (
 SELECT unnest(json_keys(null_counts)) AS k, null_counts ->> k AS n) WHERE n::DOUBLE > 0)"""
_DUPES = """CASE WHEN json_array_length(duplicate_clusters) = 0 THEN 'None' ELSE
 json_array_length(duplicate_clusters) || ' cluster(s); max size ' ||
 list_max(list_transform(duplicate_clusters::JSON[], lambda i: (i->>'size')::INT)) || '; max similarity ' ||
 printf('%.3f', list_max(list_transform(duplicate_clusters::JSON[], lambda i: (i->>'max_similarity')::DOUBLE))) END"""


@check(
    "parse_json_or_default",
    f"SELECT run_id, coalesce(len({_items('check_summary')}), 0)::INTEGER AS n_checks, coalesce(len({_items('drift_report')}), 0)::INTEGER AS n_drift FROM v4",
    ("v4",),
)
def _(spark, sf):
    return view(spark, sf, "v4").select(
        "run_id",
        F.size(R.parse_json_or_default(F.col("check_summary"), f"array<{R.CHECKS}>", F.array())).alias("n_checks"),
        F.size(R.parse_json_or_default(F.col("drift_report"), f"array<{R.DRIFT_ITEMS}>", F.array())).alias("n_drift"),
    )


def _summary(spark, sf, function, column):
    return view(spark, sf, "v4").select("run_id", function(F.col(column)).alias("summary"))


@check("summarize_checks", f"SELECT run_id, {_CHECKS} AS summary FROM v4", ("v4",))
def _(spark, sf):
    return _summary(spark, sf, R.summarize_checks, "check_summary")


@check("summarize_drift", f"SELECT run_id, {_DRIFTS} AS summary FROM v4", ("v4",))
def _(spark, sf):
    return _summary(spark, sf, R.summarize_drift, "drift_report")


@check("summarize_nulls", f"SELECT run_id, {_NULLS} AS summary FROM v4", ("v4",))
def _(spark, sf):
    return _summary(spark, sf, R.summarize_nulls, "null_counts")


@check("summarize_duplicates", f"SELECT run_id, {_DUPES} AS summary FROM v4", ("v4",))
def _(spark, sf):
    return _summary(spark, sf, R.summarize_duplicates, "duplicate_clusters")


_NEWEST = "SELECT * FROM v4 ORDER BY started_at DESC, run_id LIMIT"


@check("newest_runs", f"{_NEWEST} 25", ("v4",))
def _(spark, sf):
    return plans.newest_runs(view(spark, sf, "v4"), 25)


@check("run_history", f"SELECT run_id, started_at, rows_in, rows_failed FROM ({_NEWEST} 20)", ("v4",))
def _(spark, sf):
    return plans.run_history(
        view(spark, sf, "v4"), ["run_id", "started_at", "rows_in", "rows_failed"], 20
    )


@check(
    "quality_history",
    f"""SELECT started_at AS "Run Started", NULL::VARCHAR AS "Run Finished", layer AS "Layer", rows_in AS "Rows In",
 NULL::BIGINT AS "Rows Passed", rows_failed AS "Rows Failed", {_CHECKS} AS "Checks Failed", {_DRIFTS} AS "Drift Findings",
 {_NULLS} AS "Null Columns", {_DUPES} AS "Duplicate Clusters", run_id AS "Run ID", NULL::VARCHAR AS "Lake Dir",
 check_summary AS "Raw Check Summary", drift_report AS "Raw Drift Report", null_counts AS "Raw Null Counts",
 duplicate_clusters AS "Raw Duplicate Clusters" FROM ({_NEWEST} 100) v4""",
    ("v4",),
)
def _(spark, sf):
    return plans.quality_history(view(spark, sf, "v4"), 100)
