"""Lake tables and whole jobs in fresh folders."""

import json
import logging

import pytest
from pyspark.sql import functions as F

from tidemark import session
from tidemark.functions.vectors import HashedEmbedder
from tidemark.operators.drift import domain_run_stats, run_drift
from tidemark.operators.rules import Rule, apply_rules
from tidemark.plans import reports, silver
from tidemark.plans.bronze import (
    check_quality,
    domain_runs,
    ingest_bronze,
    quality_report,
    run_bronze_checks,
)
from tidemark.plans.crawl import extract_pages
from tidemark.plans.search import refresh, scan_stats, search, search_or_refresh
from tidemark.plans.silver import build_silver, write_silver
from tidemark.schemas import BRONZE, LANDING
from tidemark.sources import audit, landing
from tidemark.sources import lake as tables
from tidemark.sources.lake import Lake
from tidemark.streaming.ingest import stream_to_lake

TEXT = "A reef survey found more coral this spring than in the ten years before it."


def article(**changes):
    row = {
        "title": "Coral survey", "date_published": "2026-03-17", "text": TEXT, "source_url": "https://reef.example/survey",
        "source_domain": "reef.example", "relevance_score": 0.9, "query": "coral", "crawled_at": "2026-03-18T00:00:00+00:00",
    }
    return {**row, **changes}


def land(spark, folder, stamp, rows):
    df = spark.createDataFrame([tuple(r[c] for c in LANDING.fieldNames()) for r in rows], LANDING)
    return landing.write_landing(df.coalesce(1), str(folder), stamp)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, tmp_path / "lake")


def runs(lake, stage):
    rows = lake.read(tables.PIPELINE_RUNS).where(F.col("stage") == stage).orderBy("started_at")
    return [(r, json.loads(r.details)) for r in rows.collect()]


def test_landing_with_drifting_types(spark, tmp_path):
    folder = str(tmp_path / "in")
    def write(n, df):
        df.coalesce(1).write.parquet(f"{folder}/market_data_{n}.parquet")
    write(1, spark.createDataFrame([("a", 0.5)], "title string, relevance_score double"))
    write(2, spark.createDataFrame([("b", None)], "title string, relevance_score string"))
    write(3, spark.createDataFrame([("c", 3)], "title string, relevance_score bigint"))
    write(4, spark.createDataFrame([("d", 1)], "title string, extra int"))
    write(5, spark.createDataFrame([(5, "bad")], "title int, relevance_score string"))
    rows = landing.read_landing(spark, folder, "now")
    assert rows.dtypes == spark.createDataFrame([], BRONZE).dtypes
    assert {r.title: r.relevance_score for r in rows.collect()} == {"a": 0.5, "b": None, "c": 3.0, "d": None, "5": None}
    assert all(r.source_file.endswith(f"market_data_{n}.parquet") for n, r in zip("12345", rows.orderBy("source_file").collect(), strict=True))


def test_landing_edge_cases(spark, tmp_path):
    assert landing.read_landing(spark, str(tmp_path), "now").schema == BRONZE
    assert landing.latest_landing(spark, str(tmp_path)) is None
    path = land(spark, tmp_path, "20260101T000000Z", [])
    assert landing.read_landing_file(spark, path).schema.fieldNames() == LANDING.fieldNames()
    newer = land(spark, tmp_path, "20260102T000000Z", [article()])
    assert landing.latest_landing(spark, str(tmp_path)) == newer or newer in landing.latest_landing(spark, str(tmp_path))
    with pytest.raises(Exception, match="(?i)exists"):
        land(spark, tmp_path, "20260102T000000Z", [article()])


def test_first_row_wins_over_url_variants_and_text_drift(spark, tmp_path, lake):
    land(spark, tmp_path / "in", "1", [article(source_url="https://REEF.example/survey?utm=x", text=TEXT + " one")])
    land(spark, tmp_path / "in", "2", [article(source_url="https://reef.example/survey#s", crawled_at="2026-03-18T15:30:00+00:00", text=TEXT + " two")])
    assert ingest_bronze(spark, str(tmp_path / "in"), lake) == 1
    (row,) = lake.read(tables.BRONZE).collect()
    assert row.text == TEXT + " one" and row.bronze_id.startswith("bronze_")


def test_append_is_idempotent_and_audited(spark, tmp_path, lake):
    folder = str(tmp_path / "in")
    land(spark, folder, "1", [article(), article(), article(title="Bad", text="Short.")])
    assert ingest_bronze(spark, folder, lake, mode="append") == 1
    assert ingest_bronze(spark, folder, lake, mode="append") == 0
    assert lake.read(tables.BRONZE).count() == 1
    (first, first_details), (second, second_details) = runs(lake, "bronze")
    assert (first.status, first.rows_in, first.rows_out) == ("partial", 2, 1)
    assert second_details["rows_skipped_duplicate"] == 1 and second.rows_out == 0
    assert first_details["rows_quarantined"] == 1 and first_details["quality_run_id"].startswith("qrun_")
    found = {r.run_id for r in lake.read(tables.QUARANTINE_RUNS).collect()}  # each run finds its rows
    assert found == {first_details["quality_run_id"], second_details["quality_run_id"]}
    (bad,) = lake.read(tables.QUARANTINE).collect()  # not quarantined a second time
    assert bad["_failure_reasons"] == ["text: length_50_to_8000"] and bad["_quality_run_id"] == first_details["quality_run_id"]
    shown = reports.lake_quality_history(lake).orderBy("Run Started").collect()
    assert [r["Rows Failed"] for r in shown] == [1, 1]
    assert shown[0]["Checks Failed"] == "text: 1 failed (length_50_to_8000)"
    assert shown[0]["Drift Findings"] == "reef.example: baseline (no prior runs to compare)"


def test_overwrite_replaces_rows(spark, tmp_path, lake, caplog):
    land(spark, tmp_path / "a", "1", [article(), article(title="Second")])
    land(spark, tmp_path / "b", "1", [article(title="Third", crawled_at="2026-05-01T00:00:00+00:00")])
    assert ingest_bronze(spark, str(tmp_path / "a"), lake, embedder=None) == 2
    old = lake.read(tables.BRONZE)
    assert ingest_bronze(spark, str(tmp_path / "b"), lake, embedder=None) == 1
    assert [r.title for r in lake.read(tables.BRONZE).collect()] == ["Third"]
    assert old.count() == 2  # a running reader keeps its snapshot
    with caplog.at_level(logging.WARNING):
        assert ingest_bronze(spark, str(tmp_path / "none"), lake) == 0
    assert lake.read(tables.BRONZE).isEmpty() and "no rows" in caplog.text
    assert lake.drop_old_snapshots(tables.BRONZE) == 2
    assert lake.read(tables.BRONZE, days=["2026-05-01"]).isEmpty()


def test_overwrite_may_read_the_table_it_replaces(spark, lake):
    row = spark.createDataFrame([("a", 0.1)], "title string, relevance_score double")
    lake.overwrite(tables.BRONZE, row)
    lake.overwrite(tables.BRONZE, lake.read(tables.BRONZE).union(lake.read(tables.BRONZE)))
    assert lake.read(tables.BRONZE).count() == 2


def test_without_validation_everything_is_kept(spark, tmp_path, lake):
    land(spark, tmp_path / "in", "1", [article(text="Short.")])
    assert ingest_bronze(spark, str(tmp_path / "in"), lake, validate=False) == 1
    assert not lake.exists(tables.QUARANTINE) and not lake.exists(tables.QUALITY_RUNS)


def test_only_a_missing_embedder_skips_the_title_check(spark, tmp_path, lake):
    class Broken(HashedEmbedder):
        def embed(self, text):
            raise RuntimeError("no model")

    def no_model():
        raise RuntimeError("no model")

    land(spark, tmp_path / "in", "1", [article()])
    assert ingest_bronze(spark, str(tmp_path / "in"), lake, embedder=no_model) == 1
    with pytest.raises(RuntimeError, match="no model"):  # an error of the check itself is no success
        ingest_bronze(spark, str(tmp_path / "in"), lake, embedder=Broken())


def test_check_quality_compares_newest_ingest_with_older_ones(spark, tmp_path, lake):
    with pytest.raises(FileNotFoundError):
        check_quality(lake)
    for day, n in ((1, 4), (2, 4), (3, 4), (4, 1)):
        folder = str(tmp_path / f"in{day}")
        rows = [article(title=f"Story {day} {i}", source_url=f"https://reef.example/{day}/{i}", crawled_at=f"2026-04-0{day}T00:00:00+00:00") for i in range(n)]
        land(spark, folder, "1", rows)
        ingest_bronze(spark, folder, lake, mode="append", embedder=None, ingested_at=f"2026-04-0{day}T01:00:00+00:00")
    result = check_quality(lake)
    assert (result.status, result.rows_in) == ("warn", 13)
    lines = quality_report(result)
    assert lines[0] == "status: warn" and "[reef.example] rows: rows dropped to 25% of trailing-3 mean" in lines
    assert lake.read(tables.DRIFT_FINDINGS).where(F.col("run_id") == result.run_id).count() == result.n_drift == 2


def test_kept_run_statistics_equal_those_of_bronze(spark, tmp_path, lake):
    def rows(df):
        return sorted(tuple(r) for r in df.select("source_domain", "ingested_at", "rows", "mean_text_len", "n_unique_url").collect())

    assert domain_runs(lake) is None
    for n in (1, 2):
        articles = [article(title=f"T{n}{i}", source_domain=f"d{i % 2}.com", text=TEXT + "x" * i) for i in range(5)]
        fill(spark, tmp_path, lake, articles, name=f"in{n}", ingested_at=f"2026-04-0{n}")
    want = rows(domain_run_stats(lake.read(tables.BRONZE)))
    assert len(want) == 4 and rows(domain_runs(lake)) == want
    # A run whose statistics were never written is worked out from bronze.
    lake.overwrite(tables.DOMAIN_RUNS, lake.read(tables.DOMAIN_RUNS).where(F.col("ingested_at") == "2026-04-01"))
    assert rows(domain_runs(lake)) == want


def fill(spark, tmp_path, lake, rows, name="in", **how):
    land(spark, tmp_path / name, "1", rows)
    ingest_bronze(spark, str(tmp_path / name), lake, mode="append", embedder=None, validate=False, **how)


def test_silver_incremental_equals_rebuild(spark, tmp_path, lake):
    def snapshot():
        return [
            sorted(tuple(r) for r in lake.read(t, cols).collect())
            for t, cols in ((tables.PAGES, ["page_id", "text"]), (tables.CHUNKS, ["chunk_id", "page_id", "chunk_text"]))
        ]

    assert build_silver(lake) == (0, 0)
    fill(spark, tmp_path, lake, [article(text="one two  three four five"), article(title="Blank", text="   ")])
    assert build_silver(lake, chunk_tokens=3, chunk_overlap=1) == (1, 2)
    assert build_silver(lake, chunk_tokens=3, chunk_overlap=1) == (0, 0)
    fill(spark, tmp_path, lake, [article(title="New", text="six &amp; seven", crawled_at="2026-04-29T00:00:00+00:00")], name="in2")
    assert build_silver(lake, chunk_tokens=3, chunk_overlap=1, since_day="2026-04-29") == (1, 1)
    incremental = snapshot()
    assert build_silver(lake, chunk_tokens=3, chunk_overlap=1, rebuild=True) == (2, 3)
    assert snapshot() == incremental
    assert [c[2] for c in sorted(incremental[1], key=lambda c: c[2])] == ["one two three", "six & seven", "three four five"]
    (page, details), *_ = runs(lake, "silver_pages")
    assert (page.rows_in, page.rows_out, details["model"]) == (1, 1, "hashed-bag-of-words")
    assert runs(lake, "silver_chunks")[0][1]["chunk_tokens"] == 3


def test_lost_pages_are_made_good(spark, tmp_path, lake):
    """A crash after the chunks were written: the next run adds the pages and no chunk twice."""
    fill(spark, tmp_path, lake, [article()])
    other = Lake(spark, tmp_path / "other")
    fill(spark, tmp_path, other, [article()], name="in2")
    build_silver(other)
    lake.append(tables.CHUNKS, other.read(tables.CHUNKS))
    build_silver(lake)
    assert lake.read(tables.CHUNKS).count() == 1 and lake.read(tables.PAGES).count() == 1
    write_silver(other.read(tables.PAGES), other.read(tables.CHUNKS), lake)
    assert lake.read(tables.CHUNKS).count() == 1 and lake.read(tables.PAGES).count() == 1


def test_write_silver_moves_rows_only_when_some_are_new(spark, tmp_path, lake, monkeypatch):
    """Nothing is appended when all ids are known; a new page and a page without id are."""
    fill(spark, tmp_path, lake, [article()])
    build_silver(lake)
    pages, chunks = lake.read(tables.PAGES), lake.read(tables.CHUNKS)
    other = Lake(spark, tmp_path / "other")
    write_silver(pages, chunks, other)
    appended, append = [], Lake.append
    monkeypatch.setattr(Lake, "append", lambda self, table, df: (appended.append(table.name), append(self, table, df))[1])
    write_silver(pages, chunks, other)
    assert appended == []
    more = pages.unionByName(pages.withColumn("page_id", F.lit("new"))).unionByName(pages.withColumn("page_id", F.lit(None).cast("string")))
    write_silver(more, chunks, other)
    assert appended == ["pages"]
    assert sorted(str(r.page_id) for r in other.read(tables.PAGES).collect()) == sorted(["None", "new", pages.first().page_id])


def test_first_promotion_looks_up_no_ids(spark, tmp_path, lake, monkeypatch):
    """Without a page table all rows are new; their texts are not shuffled to meet their own ids."""
    plans, build_pages = [], silver.build_pages
    def seen(bronze, embedder, **kwargs):
        plans.append(bronze._jdf.queryExecution().optimizedPlan().toString())
        return build_pages(bronze, embedder, **kwargs)
    monkeypatch.setattr(silver, "build_pages", seen)
    fill(spark, tmp_path, lake, [article()])
    assert build_silver(lake) == (1, 1)
    fill(spark, tmp_path, lake, [article(source_url="https://reef.example/more")], name="in2")
    assert build_silver(lake) == (1, 1)
    assert ["LeftSemi, ((bronze_id" in p for p in plans] == [False, True]


def test_record_run(lake):
    with pytest.raises(ValueError, match="boom"), audit.record_run("bad", lake, query="q"):
        raise ValueError("boom" + "x" * 900)
    with pytest.raises(ValueError, match="unknown run status"), audit.record_run("worse", lake) as handle:
        handle.set_status("great")
    (row, _), = runs(lake, "bad")
    assert row.status == "fail" and len(row.error) == 500 and row.query == "q" and row.duration_ms >= 0


def test_audit_failure_is_only_logged(lake, monkeypatch, caplog):
    monkeypatch.setattr(audit, "append_pipeline_run", lambda *_: 1 / 0)
    with audit.record_run("s", lake):
        pass
    assert "not written" in caplog.text


def test_search_and_refresh(spark, tmp_path, lake):
    html = "<html><head><title>{t}</title></head><body><p>{b}</p><a href='/x'>x</a></body></html>"
    body = "semiconductor supply chain news &amp; analysis. " * 30
    pages = [
        (1, "https://a.example.com/chips", html.format(t="Chips", b=body)),
        (2, "https://a.example.com/semiconductor", html.format(t="Other", b="weather report sunny day. " * 40)),
        (3, "https://a.example.com/short", html.format(t="Short", b="too short")),
        (4, "https://a.example.com/", html.format(t="Hub", b=body)),
    ]
    path = str(tmp_path / "pages")
    spark.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(path)
    query = "semiconductor supply chain"
    assert search(lake, query).isEmpty()

    def refresher(q):
        refresh(lake, q, pages_path=path, data_dir=str(tmp_path / "data"), crawled_at="2026-03-18T00:00:00+00:00")

    stale = search_or_refresh(lake, query, refresher, no_refresh=True)
    assert (stale.refreshed, stale.final_matches) == (False, 0) and "not allowed" in stale.status_message
    result = search_or_refresh(lake, query, refresher, threshold=0.3, min_articles=1)
    assert (result.refreshed, result.initial_matches, result.final_matches) == (True, 0, 1)
    (hit,) = result.hits.collect()
    assert hit.title == "Chips" and "news & analysis" in hit.text and 0.3 < hit.similarity <= 1.0
    again = search_or_refresh(lake, query, lambda q: 1 / 0, threshold=0.3, min_articles=1)
    assert not again.refreshed and again.status_message.startswith("enough matches")
    with pytest.raises(ValueError):
        search_or_refresh(lake, query, refresher, force=True, no_refresh=True)
    stats = scan_stats(lake, query, threshold=0.3).first()
    assert stats.n_above >= 1 and stats.n_pages == lake.read(tables.PAGES).count()
    (crawl, details), = runs(lake, "crawl")
    assert (crawl.status, crawl.rows_out, details["n_sites"]) == ("success", 2, 1)
    (site,) = lake.read(tables.SITE_STATS).where(F.col("run_id") == crawl.run_id).collect()
    assert (site.pages_fetched, site.pages_kept, site.pages_dropped, site.error) == (3, 2, 1, None)
    report = reports.latest_report(lake, str(tmp_path / "data"), n=1)
    assert report["rows"] == 2 and report["preview"].count() == 1 and len(report["preview"].first().text) <= 200


def test_latest_report_without_data(lake, tmp_path):
    assert reports.latest_report(lake, str(tmp_path)) is None


def test_stream_takes_each_file_once(spark, tmp_path, lake):
    folder = str(tmp_path / "in")

    def step():
        stream_to_lake(spark, folder, lake, checkpoint=str(tmp_path / "cp")).awaitTermination()
        return lake.read(tables.BRONZE).count(), lake.read(tables.PAGES).count(), len(runs(lake, "bronze"))

    land(spark, folder, "1", [article()])
    assert step() == (1, 1, 1)
    assert step() == (1, 1, 1)
    land(spark, folder, "2", [article(), article(title="Next")])
    assert step() == (2, 2, 2)


def test_findings_stay_whole_in_their_tables(spark, lake):
    rows = [
        (f"bronze_{i:064x}", f"Same title {i // 3} {i // 3}", None, TEXT, f"https://c.com/{i}", f"d{i}", 1.0, "q", "2026-03-18", "f", "2026-03-18")
        for i in range(9)
    ]
    df = spark.createDataFrame(rows, BRONZE)
    result = run_bronze_checks(apply_rules(df), drift=run_drift(df, None), embedder=HashedEmbedder())
    assert result.n_drift == 9 and result.n_clusters == 3
    audit.append_quality_run(result, lake)
    assert lake.read(tables.DRIFT_FINDINGS).count() == 9
    assert lake.read(tables.DUPLICATE_MEMBERS).count() == 9
    shown = reports.lake_quality_history(lake).first()
    note = "(no prior runs to compare)"
    assert shown["Drift Findings"] == f"d0: baseline {note}; d1: baseline {note}; d2: baseline {note}; +6 more"
    assert shown["Duplicate Clusters"].startswith("3 cluster(s); max size 3")


def test_user_rules_take_the_place_of_the_own_ones(spark, tmp_path, lake):
    land(spark, tmp_path / "in", "1", [article(text="Short."), article(title="Draft")])
    rule = Rule("title", "no_draft", F.col("title") == "Draft")
    assert ingest_bronze(spark, str(tmp_path / "in"), lake, embedder=None, rules=[rule]) == 1
    (bad,) = lake.read(tables.QUARANTINE).collect()
    assert bad["_failure_reasons"] == ["title: no_draft"]
    assert check_quality(lake, rules=[Rule("text", "long", F.length("text") < 50)]).rows_failed == 1


def test_site_filters_errors_and_whole_bodies(spark, tmp_path, lake):
    body = "<html><body><p>" + "coral reef survey results. " * 600 + "</p></body></html>"
    pages = [
        (1, "https://a.example.com/2026/x", body),
        (2, "https://a.example.com/about", body),
        (3, "https://b.example.com/2026/y", body),
        (4, "https://a.example.com/2026/z", None),
        (5, "https://a.example.com/2026/pdf", "%PDF-1.7 " + "x" * 2000),
        (6, None, body),
    ]
    path = str(tmp_path / "pages")
    spark.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(path)
    sites = [{"url": "https://a.example.com/", "url_patterns": ("*/2026/*",), "include_external": False}]
    how = {"query": "coral", "data_dir": str(tmp_path / "data")}
    out = extract_pages(lake, path, crawled_at="2026-03-18T00:00:00+00:00", sites=sites, text_cap=None, **how)
    (row,) = landing.read_landing_file(spark, out).collect()
    assert row.source_url.endswith("/2026/x") and len(row.text) > 8000
    (run, details), = runs(lake, "crawl")
    assert (run.status, details["n_errors"]) == ("partial", 1)
    (site,) = lake.read(tables.SITE_STATS).collect()
    assert (site.pages_fetched, site.error) == (1, "no content stored")
    cut = extract_pages(lake, path, crawled_at="2026-04-29T00:00:00+00:00", **how)
    rows = landing.read_landing_file(spark, cut).collect()
    assert len(rows) == 5 and max(len(r.text) for r in rows) == 8000  # the page without a URL is kept


def test_jobs_leave_no_staged_folder(spark, tmp_path, lake):
    land(spark, tmp_path / "in", "1", [article(), article(title="Bad", text="Short.")])
    ingest_bronze(spark, str(tmp_path / "in"), lake)
    build_silver(lake)
    check_quality(lake)
    staged = tmp_path / "lake" / "_staging"
    assert not staged.exists() or not list(staged.iterdir())


def test_batches_for_python_are_bounded_in_a_job(spark, tmp_path):
    """Rows of 20,000 bytes: a job's workers get at most BATCH_BYTES at a time, not 10,000 rows."""
    import pyarrow as pa

    limit, rows = session._BATCH_LIMIT, spark.range(0, 2000, 1, 1).select(F.repeat(F.lit("word "), 4000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "bytes": [batch.nbytes]})

    def handed():
        return rows.mapInArrow(sizes, "rows long, bytes long").collect()

    before = spark.conf.get(limit, None)
    with session.staging(spark, str(tmp_path)):
        batches = handed()
    assert sum(b["rows"] for b in batches) == 2000 and len(batches) > 2
    assert all(b["bytes"] < session.BATCH_BYTES + 100_000 for b in batches)
    assert spark.conf.get(limit, None) == before is None
    spark.conf.set(limit, "1m")
    try:  # a limit of the session's own holds
        with session.staging(spark, str(tmp_path)):
            assert all(b["bytes"] < (1 << 20) + 100_000 for b in handed())
        assert spark.conf.get(limit) == "1m"
    finally:
        spark.conf.unset(limit)
