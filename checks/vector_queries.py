"""Vectors, chunks, search and clusters, on V1 and V3."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sqltext as S
from checks.quality_queries import first_rows
from checks.registry import check
from checks.views import view
from tidemark.functions.vectors import HashedEmbedder, dot_similarity, l2_normalize
from tidemark.operators import chunking, clusters, retrieval, similarity
from tidemark.plans import silver
from tidemark.session import stage

DIM = 64  # of the given embeddings
THRESHOLD = 0.1
TOP_K = 20
CLOSE = 0.4


def chunks(spark, sf):
    return view(spark, sf, "v3")


def query_vector(spark, sf):
    """The vector of chunk 0."""
    return chunks(spark, sf).where(F.col("chunk_id") == 0).first()["embedding"]


def titled_pages(spark, sf):
    """The stored pages in the columns a hit is joined to."""
    return spark.read.parquet(f"{sf}/pages.parquet").select(
        "page_id",
        F.concat(F.lit("page "), F.col("page_id")).alias("title"),
        F.col("url").alias("source_url"),
        F.lit("2024-01-31").alias("crawled_at"),
        F.col("html").alias("text"),
    )


def _scored(spark, sf):
    return retrieval.score_chunks(chunks(spark, sf), query_vector(spark, sf), ("chunk_id", "page_id"))


def _out(df):
    return df.withColumn("similarity", F.round(F.col("similarity").cast("double"), 5))


_SIM = "round(similarity::DOUBLE, 5) AS similarity"


@check("dot_similarity", S.SCORED + f" SELECT chunk_id, {_SIM} FROM scored", ("v3",))
def _(spark, sf):
    score = dot_similarity(F.col("embedding"), query_vector(spark, sf))
    return _out(chunks(spark, sf).select("chunk_id", score.alias("similarity")))


@check("similarity_filter", S.SCORED + f" SELECT chunk_id, page_id, {_SIM} FROM scored WHERE similarity > 0.1::FLOAT", ("v3",))
def _(spark, sf):
    return _out(retrieval.similarity_filter(_scored(spark, sf), THRESHOLD))


@check(
    "search_stats",
    S.SCORED + """ SELECT count(*) AS n_chunks, count(DISTINCT page_id) AS n_pages,
 count(*) FILTER (WHERE similarity > 0.1::FLOAT) AS n_above, round(max(similarity)::DOUBLE, 5) AS max_similarity FROM scored""",
    ("v3",),
)
def _(spark, sf):
    stats = retrieval.search_stats(_scored(spark, sf), THRESHOLD)
    return stats.withColumn("max_similarity", F.round(F.col("max_similarity").cast("double"), 5))


def _best(spark, sf):
    return retrieval.best_chunk_per_page(retrieval.similarity_filter(_scored(spark, sf), THRESHOLD))


@check("best_chunk_per_page", S.BEST + f" SELECT page_id, {_SIM} FROM best", ("v3",))
def _(spark, sf):
    return _out(_best(spark, sf))


@check("top_k_pages", S.BEST + f" SELECT page_id, {_SIM} FROM top", ("v3",))
def _(spark, sf):
    return _out(retrieval.top_k_pages(_best(spark, sf), TOP_K))


_HIT = f"{_SIM}, 'page ' || page_id AS title, url AS source_url, '2024-01-31' AS crawled_at, html AS text FROM top JOIN pages USING (page_id)"


@check("hits_with_pages", S.BEST + f" SELECT page_id, {_HIT}", ("v3",))
def _(spark, sf):
    top = retrieval.top_k_pages(_best(spark, sf), TOP_K)
    return _out(retrieval.hits_with_pages(top, titled_pages(spark, sf)))


@check("search", S.BEST + f" SELECT page_id AS row_id, {_HIT}", ("v3",))
def search(spark, sf):
    hits = retrieval.search_pages(
        chunks(spark, sf), titled_pages(spark, sf), query_vector(spark, sf),
        threshold=THRESHOLD, top_k=TOP_K,
    )
    return _out(hits)


_LONG = "unnest({v}) AS value, generate_subscripts({v}, 1)::INTEGER - 1 AS pos"


def _elements(df, key):
    """(key, pos, value) rows of the nonzero vector elements."""
    entries = F.transform("embedding", lambda x, i: F.struct(i.alias("pos"), x.alias("value")))
    nonzero = F.filter(entries, lambda e: e["value"] != 0)
    return df.select(key, F.inline(nonzero)).withColumn(
        "value", F.round(F.col("value").cast("double"), 5) + F.lit(0.0)  # no negative zero
    )


@check(
    "l2_normalize",
    """, twice AS (SELECT chunk_id, list_transform(embedding, lambda x: (x * 3)::FLOAT::DOUBLE) AS v FROM v3),
unit AS (SELECT chunk_id, list_transform(v, lambda x: (x / sqrt(list_dot_product(v, v)))::FLOAT) AS u FROM twice),
long AS (SELECT chunk_id, unnest(u) AS value, generate_subscripts(u, 1) AS pos FROM unit)
SELECT chunk_id, (pos - 1)::INTEGER AS pos, round(value::DOUBLE, 5) + 0.0::DOUBLE AS value FROM long WHERE value <> 0""",
    ("v3",),
)
def _(spark, sf):
    scaled = F.transform("embedding", lambda x: (x * 3).cast("float"))
    return _elements(
        chunks(spark, sf).select("chunk_id", l2_normalize(scaled).alias("embedding")), "chunk_id"
    )


@check(
    "mean_pool",
    """, long AS (SELECT page_id, unnest(embedding)::DOUBLE AS value, generate_subscripts(embedding, 1) AS pos FROM v3)
SELECT page_id, (pos - 1)::INTEGER AS pos, round((sum(value) / count(*))::FLOAT::DOUBLE, 5) + 0.0::DOUBLE AS value FROM long GROUP BY page_id, pos""",
    ("v3",),
)
def _(spark, sf):
    pooled = retrieval.mean_pool(chunks(spark, sf), key="page_id", vector="embedding", dim=DIM)
    return _elements(pooled, "page_id")


@check(
    "validate_vectors",
    "SELECT chunk_id, len(embedding)::INTEGER AS length FROM v3 WHERE len(embedding) <> 384 ORDER BY chunk_id LIMIT 5",
    ("v3",),
)
def _(spark, sf):
    return retrieval.bad_vectors(chunks(spark, sf), row_id="chunk_id", vector="embedding", dim=384)


def _pairs(spark, sf):
    return similarity.similar_pairs(
        chunks(spark, sf), id_col="chunk_id", vector="embedding", threshold=CLOSE, every_copy=True
    )


def _links(spark, sf):
    """The links, staged: the groups and the summary both read them."""
    links = similarity.similarity_links(
        chunks(spark, sf), id_col="chunk_id", vector="embedding", threshold=CLOSE
    )
    return stage(links, "links")


@check("similar_pairs", S.PAIRS + f" SELECT left_id, right_id, {_SIM} FROM pairs", ("v3",))
def similar_pairs(spark, sf):
    return _out(_pairs(spark, sf))


@check("connected_labels", S.LABELS + " SELECT id, label FROM labels", ("v3",))
def _(spark, sf):
    return clusters.connected_labels(_links(spark, sf).where("connects"), left="left_id", right="right_id")


_SUMMARY = S.LABELS + """, sizes AS (SELECT label AS cluster_id, count(*) AS size FROM labels GROUP BY label),
best AS (SELECT label AS cluster_id, max(similarity) AS s FROM pairs JOIN labels ON left_id = id GROUP BY label)
, summary AS (SELECT cluster_id, size, round(s, 5) AS max_similarity FROM sizes JOIN best USING (cluster_id))"""


def _chunk_titles(spark, sf):
    """(id, title) of the chunks: the title of their page, null where it is not stored."""
    rows = chunks(spark, sf).select(F.col("chunk_id").alias("id"), "page_id")
    return rows.join(titled_pages(spark, sf).select("page_id", "title"), "page_id", "left").select("id", "title").distinct()


@check(
    "cluster_summary",
    _SUMMARY + """, titled AS (SELECT DISTINCT chunk_id, title FROM v3 LEFT JOIN (SELECT page_id, 'page ' || page_id AS title FROM pages) p USING (page_id))
SELECT cluster_id, size, max_similarity, id AS member_id, title FROM labels JOIN summary ON label = cluster_id JOIN titled ON id = chunk_id""",
    ("v3",),
)
def _(spark, sf):
    links = _links(spark, sf)
    labels = clusters.connected_labels(links.where("connects"), left="left_id", right="right_id")
    summary = clusters.cluster_summary(labels, links, _chunk_titles(spark, sf))
    return summary.withColumn("max_similarity", F.round("max_similarity", 5))


@check(
    "cluster_members",
    _SUMMARY + " SELECT cluster_id, id AS member_id, size, max_similarity FROM labels JOIN summary ON label = cluster_id",
    ("v3",),
)
def _(spark, sf):
    links = _links(spark, sf)
    labels = clusters.connected_labels(links.where("connects"), left="left_id", right="right_id")
    members = clusters.cluster_members(labels, links)
    return members.withColumn("max_similarity", F.round("max_similarity", 5))


_TITLES = (
    S.D1
    + ", titles AS (SELECT title, min(bronze_id) AS id, count(*) AS copies FROM d1 WHERE length(title) >= 8 GROUP BY title)"
    + S.term_counts("titles", "id", "title")
    + """, tp AS (SELECT a.key AS l, b.key AS r, sum(a.w * b.w) AS s FROM unit a JOIN unit b ON a.code = b.code AND a.key < b.key
 GROUP BY a.key, b.key HAVING sum(a.w * b.w) >= 0.95),
near AS (SELECT l AS a, r AS b FROM tp UNION ALL SELECT r, l FROM tp),
reach AS (SELECT a AS id, a AS other FROM near UNION SELECT r.id, e.b FROM reach r JOIN near e ON r.other = e.a),
lab AS (SELECT id, min(other) AS label FROM reach GROUP BY id),
tl AS (SELECT t.*, coalesce(label, t.id) AS cluster_id FROM titles t LEFT JOIN lab USING (id) WHERE label IS NOT NULL OR copies > 1),
own AS (SELECT key AS id, sum(w * w) AS s FROM unit GROUP BY key),
sims AS (SELECT label AS cluster_id, s FROM tp JOIN lab ON l = lab.id UNION ALL SELECT cluster_id, s FROM tl JOIN own USING (id) WHERE copies > 1),
found AS (SELECT cluster_id, sum(copies)::BIGINT AS size, round((SELECT max(s) FROM sims WHERE sims.cluster_id = tl.cluster_id), 4) AS max_similarity FROM tl GROUP BY cluster_id)"""
)


@check("title_duplicate_clusters", _TITLES + " SELECT * FROM found", ("v1",))
def _(spark, sf):
    found = clusters.title_duplicate_clusters(first_rows(spark, sf), HashedEmbedder())
    return found.withColumn("max_similarity", F.round("max_similarity", 4))


@check(
    "title_duplicate_members",
    _TITLES + " SELECT cluster_id, bronze_id, title, size, max_similarity FROM d1 JOIN tl USING (title) JOIN found USING (cluster_id)",
    ("v1",),
)
def _(spark, sf):
    members = clusters.title_duplicate_members(first_rows(spark, sf), HashedEmbedder())
    return members.withColumn("max_similarity", F.round("max_similarity", 4))


@check("title_candidates", S.D1 + " SELECT bronze_id, title FROM d1 WHERE length(title) >= 8", ("v1",))
def _(spark, sf):
    return clusters.title_candidates(first_rows(spark, sf))


@check(
    "embed_texts",
    S.hashed_terms("documents", "doc_id", "text").replace(", words AS", "WITH words AS", 1)
    + " SELECT key AS doc_id, slot::INTEGER - 1 AS pos, round(w, 5) AS value FROM unit",
)
def _(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet")
    vectors = rows.select("doc_id", HashedEmbedder().embed(F.col("text")).alias("embedding"))
    return _elements(vectors, "doc_id")


SIZE, OVERLAP = 128, 16


def _windows(source: str, keep: str) -> str:
    return f""", toks AS (SELECT {keep}, string_split(text, ' ') AS ts FROM {source}),
wins AS (SELECT {keep}, ts, unnest(generate_series(0, greatest(0, ceil((len(ts) - {SIZE}) / {SIZE - OVERLAP}.0))::BIGINT)) AS i FROM toks),
chunks AS (SELECT {keep}, i::INTEGER AS chunk_index,
 array_to_string(list_slice(ts, i * {SIZE - OVERLAP} + 1, i * {SIZE - OVERLAP} + {SIZE}), ' ') AS chunk_text FROM wins)"""


@check(
    "chunk_windows",
    S.P1 + _windows("p1", "page_id") + " SELECT page_id, chunk_index, chunk_text FROM chunks",
    ("v1",),
)
def _(spark, sf):
    pages = silver.page_rows(first_rows(spark, sf)).select("page_id", "text")
    return chunking.chunk_windows(
        pages, HashedEmbedder(), chunk_tokens=SIZE, chunk_overlap=OVERLAP
    )


_PAGE = "page_id, bronze_id, title, date_published, text, text_hash, source_url, source_domain, query, crawled_at"


@check("build_pages", S.P1 + f" SELECT {_PAGE}, 'hashed-bag-of-words' AS embedding_model, 384 AS embedding_dim, 'now' AS embedded_at FROM p1", ("v1",))
def _(spark, sf):
    pages = silver.build_pages(first_rows(spark, sf), HashedEmbedder(), embedded_at="now")
    return pages.drop("embedding")


_CHUNK = "page_id, bronze_id, source_url, source_domain, query, crawled_at"


@check(
    "build_chunks",
    S.P1 + _windows("p1", _CHUNK)
    + f""" SELECT {S.sha_id('page_id', 'chunk_index', 'chunk_text', prefix='chunk')} AS chunk_id, {_CHUNK}, chunk_index, chunk_text,
 length(chunk_text)::INTEGER AS chunk_char_count, 'hashed-bag-of-words' AS embedding_model, 384 AS embedding_dim, 'now' AS embedded_at FROM chunks""",
    ("v1",),
)
def build_chunks(spark, sf):
    pages = silver.page_rows(first_rows(spark, sf))
    rows = silver.build_chunks(
        pages, HashedEmbedder(), embedded_at="now", chunk_tokens=SIZE, chunk_overlap=OVERLAP
    )
    return rows.drop("embedding")
