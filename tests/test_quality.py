"""Rules, drift, reports."""

from pyspark.sql import functions as F

from tidemark.functions import reports
from tidemark.functions.vectors import HashedEmbedder
from tidemark.operators import crawl, rules
from tidemark.operators.drift import run_drift
from tidemark.plans.bronze import run_bronze_checks
from tidemark.plans.reports import quality_history
from tidemark.schemas import BRONZE, QUALITY_RUNS


STAMP = "2031-07-09T06:30:00+00:00"


def good_row(**changes):
    """A bronze row that no rule objects to."""
    text = "The harbour tug fleet switches to battery power over the next two winters."
    row = dict.fromkeys(BRONZE.fieldNames()) | {
        "bronze_id": f"bronze_{7:064x}", "title": "Tugs go electric", "text": text, "query": "harbour power",
        "source_url": "http://port.example/tugs", "source_domain": "port.example", "relevance_score": 0.55,
        "crawled_at": STAMP, "ingested_at": STAMP, "source_file": "market_data_9.parquet", "date_published": "9 July 2031",
    }
    return row | changes


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in BRONZE.fieldNames()) for r in rows], BRONZE)


def reasons(spark, **changes):
    return rules.apply_rules(frame(spark, [good_row(**changes)])).first()[rules.REASONS]


def test_each_rule(spark):
    assert reasons(spark) == []
    assert reasons(spark, text="Short.") == ["text: length_50_to_8000"]
    assert reasons(spark, text="Oops, something went wrong " + "padding " * 10) == ["text: no_error_page_sentinel"]
    assert reasons(spark, text=None) == ["text: not_null"]
    assert reasons(spark, text="https://a.com/" + "x" * 80) == ["text: junk_ratio_le_0.5"]
    assert reasons(spark, title="t" * 201) == ["title: length_le_200"]
    assert reasons(spark, title=None, relevance_score=None, date_published=None) == []
    assert reasons(spark, relevance_score=0.29) == ["relevance_score: ge_0.3"]
    assert reasons(spark, relevance_score=float("nan")) == []
    assert reasons(spark, query="") == ["query: length_ge_1"]
    assert reasons(spark, source_url="HTTPS://x") == ["source_url: matches_http_scheme"]
    assert reasons(spark, bronze_id="bronze_1") == ["bronze_id: matches_id_format"]
    assert reasons(spark, bronze_id=None, source_domain=None) == ["bronze_id: not_null", "source_domain: not_null"]


def test_duplicated_ids_fail_every_copy(spark):
    checked = rules.apply_rules(frame(spark, [good_row(), good_row(title="Other")]))
    assert [r[0] for r in checked.select(rules.REASONS).collect()] == [["bronze_id: unique"]] * 2
    assert [r.asDict() for r in rules.check_summary(checked).collect()] == [
        {"column": "bronze_id", "check": "unique", "failed": 2}
    ]


def test_schema_findings(spark):
    df = spark.createDataFrame([("x", 1)], "bronze_id string, relevance_score int")
    found = {(f["column"], f["check"]) for f in rules.schema_findings(df, BRONZE)}
    assert ("relevance_score", "dtype_double") in found and ("text", "column_in_dataframe") in found
    assert rules.schema_findings(frame(spark, [good_row()]).withColumn("extra", F.lit(1)), BRONZE) == []


def test_null_counts(spark):
    counts = rules.null_counts(frame(spark, [good_row(title=None), good_row()]))
    got = {r["column"]: r["nulls"] for r in counts.collect()}
    assert got["title"] == 1 and got["text"] == 0 and len(got) == 11
    empty = {r["nulls"] for r in rules.null_counts(frame(spark, [])).collect()}
    assert empty == {0}


RUNS = [f"2031-07-0{d}T04:15:00+00:00" for d in (2, 4, 7)]


def test_drift_without_history(spark):
    (found,) = run_drift(frame(spark, [good_row()]), None).collect()
    assert (found.domain, found.metric, found.note) == ("port.example", "baseline", "no prior runs to compare")
    assert run_drift(frame(spark, [good_row()]), frame(spark, [])).count() == 1
    assert run_drift(frame(spark, []), frame(spark, [good_row()])).count() == 0


def test_drift_drop_and_presence(spark):
    """One domain falls from ten rows to three, one vanishes, one is new, one has no name."""
    history = [good_row(ingested_at=t, source_url=f"http://port.example/{t}/{i}") for t in RUNS for i in range(10)]
    history += [good_row(ingested_at=t, source_domain="quay.example") for t in RUNS]
    current = [good_row(source_url=f"http://port.example/{i}") for i in range(3)]
    current += [good_row(source_domain="dock.example"), good_row(source_domain=None)]
    found = {(r.domain, r.metric): r for r in run_drift(frame(spark, current), frame(spark, history)).collect()}
    fallen = found["port.example", "rows"]
    assert (fallen.note, fallen.ratio, fallen.baseline) == ("rows dropped to 30% of trailing-3 mean", 0.3, 10.0)
    assert found["port.example", "n_unique_url"].baseline == 10.0
    assert found["quay.example", "presence"].note == "absent from current run; present in last 3 runs"
    assert found["dock.example", "baseline"].note == "no prior runs for this domain"
    assert (None, "baseline") in found and len(found) == 5


def test_presence_needs_enough_runs(spark):
    history = [good_row(ingested_at=t, source_domain="quay.example") for t in RUNS[:2]]
    found = run_drift(frame(spark, [good_row()]), frame(spark, history)).collect()
    assert [r.metric for r in found] == ["baseline"]


def test_null_urls_count_as_one_value(spark):
    from tidemark.operators.drift import domain_stats

    rows = [good_row(source_url=u) for u in (None, None, "https://a", "https://a")]
    assert domain_stats(frame(spark, rows)).first().n_unique_url == 2


def test_run_bronze_checks_counts_nulls_and_duplicate_titles(spark):
    rows = [
        good_row(bronze_id="bronze_" + "0" * 64, title="Locks reopen after the spring flood", date_published=None),
        good_row(bronze_id="bronze_" + "1" * 64, title="locks reopen AFTER the spring flood!"),
        good_row(bronze_id="bronze_" + "2" * 64, title="Ferry fares rise"),
    ]
    df = frame(spark, rows)
    result = run_bronze_checks(rules.apply_rules(df), drift=run_drift(df, None), embedder=HashedEmbedder())
    assert (result.rows_in, result.rows_passed, result.rows_failed, result.status) == (3, 3, 0, "warn")
    assert result.null_counts["date_published"] == 1 and result.n_clusters == 1
    members = {r.bronze_id[-1]: r["size"] for r in result.clusters.collect()}
    assert members == {"0": 2, "1": 2}
    assert result.run_id.startswith("qrun_")


def test_site_stats_and_status(spark):
    rows = [
        ("https://s.com/", "https://s.com", True, "x" * 800, ""),
        ("https://s.com/a", "https://s.com/", True, "x" * 800, None),
        ("https://s.com/b", "https://s.com/", True, "x" * 799, "y" * 200),
        ("https://s.com/c", "https://s.com/", True, "x" * 799, "y" * 199),
        ("https://s.com/d", "https://s.com/", False, "x" * 900, ""),
        ("https://s.com/e", "https://s.com/", None, "x" * 900, ""),
    ]
    df = spark.createDataFrame(rows, "url string, start_url string, success boolean, raw_markdown string, fit_markdown string")
    stats = crawl.site_stats(crawl.page_gate(df))
    row = stats.first()
    assert (row.site, row.pages_fetched, row.pages_kept, row.pages_dropped, row.error) == ("s.com", 3, 2, 1, None)
    assert crawl.crawl_status(stats).first().status == "success"
    assert crawl.crawl_status(stats.withColumn("error", F.lit("boom"))).first().status == "partial"
    assert crawl.crawl_status(stats.limit(0)).first().status == "fail"


def test_summaries(column):
    checks = '[{"column":"a","check":"c","failed":2},{"column":"","check":null,"failed":null}%s]'
    more = "".join(f',{{"column":"x{i}","check":"c","failed":1}}' for i in range(3))
    values = [None, "", "junk", "{}", "[]", checks % "", checks % more, checks % ',{"more": 40}']
    assert column(reports.summarize_checks, values) == ["None"] * 5 + [
        "a: 2 failed (c); row: failed (check)",
        "a: 2 failed (c); row: failed (check); x0: 1 failed (c); +2 more",
        "a: 2 failed (c); row: failed (check); +40 more",
    ]
    assert column(reports.summarize_drift, ['[{"domain":"d","metric":"rows","note":"n"},{"metric":""}]']) == [
        "d: rows (n); domain: metric"
    ]
    nulls = "{" + ",".join(f'"c{i}":{i}' for i in range(8)) + "}"
    assert column(reports.summarize_nulls, [nulls, "{}", '{"a":0}', "[1]"]) == [
        "c1: 1; c2: 2; c3: 3; c4: 4; c5: 5; +2 more", "None", "None", "None"
    ]
    mixed = ['[1,2]', '[{"column":"a","check":"c","failed":1},5]', '["x",null,7,{"column":"late"}]', '[{"more":4}]']
    assert column(reports.summarize_checks, mixed) == ["2 finding(s)", "a: 1 failed (c); +1 more", "4 finding(s)", "4 finding(s)"]
    assert column(reports.summarize_drift, ['[1,{"domain":"d"}]', "[true]"]) == ["d: metric; +1 more", "1 finding(s)"]
    assert column(reports.summarize_nulls, ['{"a":"5","b":2,"c":1.5,"d":null,"e":[9],"f":-1}']) == ["b: 2; c: 1.5"]
    assert column(reports.summarize_duplicates, ["[1,2]", '[4,{"size":6},{"max_similarity":0.5}]']) == [
        "2 cluster(s); max size 0; max similarity 0.000", "3 cluster(s); max size 6; max similarity 0.500"
    ]
    clusters = '[{"size":3,"max_similarity":0.987},{"size":2,"max_similarity":0.96}]'
    assert column(reports.summarize_duplicates, [clusters, "[]"]) == ["2 cluster(s); max size 3; max similarity 0.987", "None"]


def test_quality_history_of_no_runs(spark):
    empty = quality_history(spark.createDataFrame([], QUALITY_RUNS))
    assert len(empty.columns) == 16 and empty.isEmpty()
    assert len(quality_history(spark.createDataFrame([], QUALITY_RUNS), raw=False).columns) == 12
