"""Input views over the given tables.

The raw tables hold few of the cases the operators look for, so these views add them by key:
deterministic at every scale, over all rows. Spark and DuckDB run the same text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

V1 = """
SELECT doc_id, concat('market_data_', cast(doc_id % 4 AS string), '.parquet') AS source_file,
 CASE WHEN doc_id % 29 = 0 THEN NULL WHEN doc_id % 31 = 0 THEN repeat('long title ', 25)
      ELSE concat('Article ', cast(akey AS string)) END AS title,
 CASE WHEN doc_id % 5 = 0 THEN '2024-01-05' END AS date_published,
 CASE WHEN added = 1 THEN '   ' WHEN added = 2 THEN NULL
      WHEN doc_id % 17 = 0 THEN concat(text, ' [nav](https://b.example.com/y) www.c.example.com', repeat(' https://a.example.com/x', cast(floor(length(text) / 20) AS int) + 2))
      WHEN doc_id % 19 = 0 THEN concat('Oops, something went wrong. ', text)
      WHEN doc_id % 13 = 0 THEN concat('Published 2024-03-0', cast(doc_id % 9 + 1 AS string), ' sign in now. ', text)
      ELSE text END AS text,
 concat(CASE WHEN doc_id % 2 = 0 THEN 'https://' ELSE 'HTTPS://' END, 'Src', cast(akey % 20 AS string), '.Example.com/a/', cast(akey AS string),
        CASE WHEN doc_id % 3 = 0 THEN '/' WHEN doc_id % 3 = 1 THEN '?utm=x' ELSE '#s' END) AS source_url,
 CASE WHEN doc_id % 23 = 0 THEN NULL ELSE concat('src', cast(akey % 20 AS string), '.example.com') END AS source_domain,
 CASE WHEN doc_id % 10 = 0 THEN NULL ELSE cast(doc_id % 10 AS double) / 10 END AS relevance_score,
 'markets' AS query,
 concat('2024-01-0', cast(akey % 7 + 1 AS string), 'T00:00:00+00:00') AS crawled_at,
 '2024-01-31T00:00:00+00:00' AS ingested_at
FROM (SELECT doc_id, text, added, CASE WHEN doc_id % 10 = 9 THEN doc_id - 9 ELSE doc_id END AS akey
 FROM (SELECT doc_id, text, 0 AS added FROM documents
  UNION ALL SELECT doc_id + 100000000, text, 1 FROM documents WHERE doc_id % 37 = 0
  UNION ALL SELECT doc_id + 200000000, text, 2 FROM documents WHERE doc_id % 41 = 0) a) d
"""

V2 = """
SELECT page_id, url, concat('https://', split_part(split_part(url, '://', 2), '/', 1), '/') AS start_url,
 page_id % 11 <> 0 AS success,
 CASE WHEN added THEN concat('Short page at ', url) ELSE concat(CASE WHEN page_id % 9 = 0 THEN 'Access denied. ' ELSE '' END, html,
        CASE WHEN page_id % 2 = 0 THEN '<a href="https://ext.example.com/news/stock-news/1">n</a>' ELSE '' END) END AS raw_markdown,
 CASE WHEN page_id % 3 = 0 THEN '' WHEN added THEN concat('Short page at ', url) ELSE concat('Page ', html) END AS fit_markdown,
 CASE WHEN page_id % 4 = 0 THEN concat('OG ', cast(page_id AS string)) END AS og_title,
 CASE WHEN page_id % 5 = 0 THEN '2024-02-01' END AS meta_date,
 CASE WHEN page_id % 6 = 0 THEN 'n/a' WHEN page_id % 6 = 1 THEN '' ELSE concat('0.', cast(page_id % 10 AS string)) END AS score
FROM (SELECT page_id, url, html, false AS added FROM pages
 UNION ALL SELECT page_id + 100000000, concat(url, '/short'), html, true FROM pages WHERE page_id % 7 = 0) p
"""

V3 = "SELECT vec_id AS chunk_id, vec_id % 300 AS page_id, embedding, label FROM embeddings"

V4 = """
SELECT lpad(cast(event_id AS string), 8, '0') AS run_id, 'bronze' AS layer,
 concat('2024-01-01T', lpad(cast(event_id AS string), 8, '0')) AS started_at,
 event_id % 100 AS rows_in, event_id % 7 AS rows_failed,
 CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 5 = 1 THEN 'not-json' WHEN event_id % 5 = 2 THEN '[]'
      WHEN event_id % 5 = 3 THEN concat('[{"column":"text","check":"min","failed":', cast(event_id % 9 AS string), '}]')
      ELSE '[{"column":"a","check":"c1","failed":4},{"column":"b","check":"c2","failed":3},{"column":null,"check":"c3","failed":2},{"column":"d","check":"c4","failed":1}]' END AS check_summary,
 CASE WHEN event_id % 4 = 0 THEN '[]' WHEN event_id % 4 = 1 THEN '{"domain":"lone"}'
      ELSE concat('[{"domain":"d', cast(event_id % 6 AS string), '","metric":"rows","note":"rows dropped"},{"domain":"","metric":null,"note":null}]') END AS drift_report,
 CASE WHEN event_id % 3 = 0 THEN '{}' ELSE concat('{"title":', cast(event_id % 4 AS string), ',"date_published":2,"text":0}') END AS null_counts,
 CASE WHEN event_id % 2 = 0 THEN '[]' ELSE '[{"size":3,"max_similarity":0.987},{"size":2,"max_similarity":0.96}]' END AS duplicate_clusters
FROM events
"""

#: All events, one run per day.
V5H = """
SELECT event_type AS source_domain, substr(cast(ts AS string), 1, 10) AS ingested_at, props AS text, cast(user_id AS string) AS source_url
FROM events
"""

#: The runs before the day that is compared with them; purchases had longer texts then.
V5P = """
SELECT event_type AS source_domain, substr(cast(ts AS string), 1, 10) AS ingested_at,
 CASE WHEN event_type = 'purchase' THEN repeat(props, 3) ELSE props END AS text, cast(user_id AS string) AS source_url
FROM events WHERE substr(cast(ts AS string), 1, 10) < '2024-01-30'
"""

V5C = """
SELECT CASE WHEN event_type = 'signup' OR event_type = 'view' AND event_id % 2 = 0 OR event_type = 'error' AND event_id % 4 <> 0 THEN 'fresh' ELSE event_type END AS source_domain,
 '2024-01-30' AS ingested_at, props AS text, CASE WHEN event_id % 8 = 0 THEN NULL ELSE cast(user_id AS string) END AS source_url
FROM events WHERE substr(cast(ts AS string), 1, 10) = '2024-01-30'
"""

TABLES = {"v1": "documents", "v2": "pages", "v3": "embeddings", "v4": "events", "v5h": "events", "v5p": "events", "v5c": "events"}
TEXTS = {"v1": V1, "v2": V2, "v3": V3, "v4": V4, "v5h": V5H, "v5p": V5P, "v5c": V5C}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame over the given scale's table."""
    spark.read.parquet(f"{sf_dir}/{TABLES[name]}.parquet").createOrReplaceTempView(TABLES[name])
    return spark.sql(TEXTS[name])


def with_views(*names: str) -> str:
    """The same views as the start of a WITH clause, for DuckDB."""
    return "WITH RECURSIVE " + ",\n".join(f"{name} AS ({TEXTS[name]})" for name in names)
