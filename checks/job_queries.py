"""Sources and whole jobs. Each run works in a lake folder of its own."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks import sqltext as S
from checks.registry import check
from checks.views import view
from tidemark.operators.rules import REASONS
from tidemark.plans import bronze, crawl, reports, search, silver
from tidemark.schemas import BRONZE, LANDING
from tidemark.session import checkpoint_root
from tidemark.sources import lake as tables
from tidemark.sources import landing
from tidemark.sources.lake import Lake
from tidemark.sources.pages import read_pages
from tidemark.streaming.ingest import stream_to_lake

STAMP = "2024-01-31T00:00:00+00:00"
_COLUMNS = ", ".join(c for c in BRONZE.fieldNames())


def _folder(spark, name: str) -> str:
    return f"{checkpoint_root(spark)}/check-{name}-{uuid.uuid4().hex}"


def land(spark, sf, folder: str) -> str:
    """V1 as four landing datasets, rows in document order."""
    rows = view(spark, sf, "v1")
    for n in range(4):
        part = rows.where(F.col("source_file") == f"market_data_{n}.parquet")
        landing.write_landing(part.repartitionByRange("doc_id").sortWithinPartitions("doc_id"), folder, str(n))
    return folder


def _named(df):
    """Dataset names instead of full paths."""
    return df.withColumn("source_file", F.substring_index("source_file", "/", -1))


@check("read_landing", S.D1 + f" SELECT {_COLUMNS} FROM d1", ("v1",))
def _(spark, sf):
    folder = land(spark, sf, _folder(spark, "landing"))
    return _named(landing.read_landing(spark, folder, STAMP))


_LANDED = ", ".join(LANDING.fieldNames())


@check("read_landing_file", f"SELECT {_LANDED} FROM v1", ("v1",))
def _(spark, sf):
    path = landing.write_landing(view(spark, sf, "v1"), _folder(spark, "file"), "20240131T000000Z")
    return landing.read_landing_file(spark, path)


@check("latest_landing", f"SELECT {_LANDED} FROM v1 WHERE source_file = 'market_data_3.parquet'", ("v1",))
def _(spark, sf):
    folder = land(spark, sf, _folder(spark, "latest"))
    return landing.read_landing_file(spark, landing.latest_landing(spark, folder))


_HIDDEN = r"'(?is)<script\b.*?</script>|<style\b.*?</style>|<title\b.*?</title>|<!--.*?-->|<!doctype[^>]*>'"
_BREAKS = r"'(?i)</?(?:p|br|div|h[1-6]|li|ul|ol|tr|table|article|section|header|footer|nav|body|html)\b[^>]*>'"


def _entities(sql: str) -> str:
    for name, char in (("middot", "·"), ("copy", "©"), ("quot", '"'), ("amp", "&")):
        sql = f"regexp_replace({sql}, '&{name};?', '{char}', 'g')"
    return sql


_LINES = (
    f"regexp_replace(regexp_replace(regexp_replace(html, {_HIDDEN}, '', 'g'), {_BREAKS}, chr(10), 'g'), '<[^>]*>', '', 'g')"
)
_LINES = rf"trim(regexp_replace(regexp_replace({_LINES}, '[ \t\r]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'), ' ' || chr(10))"
_TITLE = "trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1))"


@check(
    "read_pages",
    f"""SELECT page_id, url, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || '/' AS start_url, true AS success,
 {_entities(_LINES)} AS raw_markdown, nullif({_entities(_TITLE)}, '') AS title FROM pages""",
)
def _(spark, sf):
    pages = read_pages(spark, f"{sf}/pages.parquet")
    return pages.select(
        "page_id", "url", "start_url", "success", "raw_markdown", F.col("metadata")["title"].alias("title")
    )


@check("extract_pages")
def _(spark, sf):
    lake = Lake(spark, _folder(spark, "lake"))
    path = crawl.extract_pages(
        lake, f"{sf}/pages.parquet", query="the market que", data_dir=_folder(spark, "data"), crawled_at=STAMP
    )
    return landing.read_landing_file(spark, path)


def _ingested(spark, sf) -> Lake:
    lake = Lake(spark, _folder(spark, "lake"))
    folder = land(spark, sf, _folder(spark, "landing"))
    bronze.ingest_bronze(spark, folder, lake, mode="append", ingested_at=STAMP)
    return lake


@check("ingest_bronze", S.K1 + f" SELECT {_COLUMNS} FROM k1 WHERE len(why) = 0", ("v1",))
def _(spark, sf):
    return _named(_ingested(spark, sf).read(tables.BRONZE))


@check(
    "write_quarantine",
    S.K1 + f" SELECT {_COLUMNS}, array_to_string(why, '; ') AS reasons FROM k1 WHERE len(why) > 0",
    ("v1",),
)
def _(spark, sf):
    rows = _named(_ingested(spark, sf).read(tables.QUARANTINE))
    return rows.withColumn("reasons", F.array_join(REASONS, "; ")).drop(REASONS, "_quality_run_id")


@check(
    "append_quality_run",
    S.K1 + """ SELECT 'bronze' AS layer, 'fail' AS status, count(*) AS rows_in, count(*) FILTER (WHERE len(why) = 0) AS rows_passed,
 count(*) FILTER (WHERE len(why) > 0) AS rows_failed FROM k1""",
    ("v1",),
)
def _(spark, sf):
    runs = _ingested(spark, sf).read(tables.QUALITY_RUNS)
    return runs.select("layer", "status", "rows_in", "rows_passed", "rows_failed")


@check(
    "check_quality",
    S.K1 + """ SELECT count(*) AS "Rows In", count(*) FILTER (WHERE len(why) = 0) AS "Rows Passed", count(*) FILTER (WHERE len(why) > 0) AS "Rows Failed" FROM k1
UNION ALL SELECT count(*), count(*), 0 FROM k1 WHERE len(why) = 0""",
    ("v1",),
)
def _(spark, sf):
    lake = _ingested(spark, sf)
    bronze.check_quality(lake)
    return reports.lake_quality_history(lake).select("Rows In", "Rows Passed", "Rows Failed")


@check(
    "append_pipeline_run",
    S.K1 + " SELECT 'bronze' AS stage, 'partial' AS status, count(*) AS rows_in, count(*) FILTER (WHERE len(why) = 0) AS rows_out FROM k1",
    ("v1",),
)
def _(spark, sf):
    runs = _ingested(spark, sf).read(tables.PIPELINE_RUNS)
    return reports.run_history(runs, ["stage", "status", "rows_in", "rows_out"], 10)


_GOOD = S.K1 + f""", g1 AS (SELECT * EXCLUDE (text), {S.clean('text')} AS text FROM k1 WHERE len(why) = 0),
gh AS (SELECT *, sha256(text) AS text_hash FROM g1 WHERE text <> ''),
gp AS (SELECT *, {S.sha_id('bronze_id', 'source_url', 'query', 'text_hash', prefix='page')} AS page_id FROM gh)"""


@check("build_silver", _GOOD + " SELECT page_id, bronze_id, title, text_hash, text FROM gp", ("v1",))
def _(spark, sf):
    lake = _ingested(spark, sf)
    silver.build_silver(lake)
    return lake.read(tables.PAGES, ["page_id", "bronze_id", "title", "text_hash", "text"])


@check(
    "write_silver",
    _GOOD + """, toks AS (SELECT page_id, string_split(text, ' ') AS ts FROM gp),
wins AS (SELECT page_id, ts, unnest(generate_series(0, greatest(0, ceil((len(ts) - 512) / 448.0))::BIGINT)) AS i FROM toks)
SELECT page_id, i::INTEGER AS chunk_index, array_to_string(list_slice(ts, i * 448 + 1, i * 448 + 512), ' ') AS chunk_text FROM wins""",
    ("v1",),
)
def _(spark, sf):
    lake = _ingested(spark, sf)
    silver.build_silver(lake)
    other = Lake(spark, _folder(spark, "other"))
    silver.write_silver(lake.read(tables.PAGES), lake.read(tables.CHUNKS), other)
    silver.write_silver(lake.read(tables.PAGES), lake.read(tables.CHUNKS), other)  # adds nothing
    return other.read(tables.CHUNKS, ["page_id", "chunk_index", "chunk_text"])


@check("search_or_refresh")
def _(spark, sf):
    lake = Lake(spark, _folder(spark, "lake"))
    data = _folder(spark, "data")

    def refresher(query):
        search.refresh(lake, query, pages_path=f"{sf}/pages.parquet", data_dir=data, crawled_at=STAMP)

    return search.search_or_refresh(lake, "the market que", refresher, threshold=0.05).hits


@check(
    "latest_report",
    "SELECT source_domain, count(*) AS rows FROM v1 WHERE source_file = 'market_data_3.parquet' GROUP BY source_domain",
    ("v1",),
)
def _(spark, sf):
    folder = land(spark, sf, _folder(spark, "report"))
    return reports.latest_report(Lake(spark, _folder(spark, "lake")), folder)["by_domain"]


@check("stream_to_lake", S.K1 + f" SELECT {_COLUMNS} FROM k1 WHERE len(why) = 0", ("v1",))
def _(spark, sf):
    lake = Lake(spark, _folder(spark, "lake"))
    folder = land(spark, sf, _folder(spark, "landing"))
    stream_to_lake(
        spark, folder, lake, checkpoint=_folder(spark, "stream")
    ).awaitTermination()
    return _named(lake.read(tables.BRONZE)).withColumn("ingested_at", F.lit(STAMP))
