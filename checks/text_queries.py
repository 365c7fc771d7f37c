"""Ids, text functions, extraction and landing shapes, on V1 and V2."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sqltext as S
from checks.registry import check
from checks.views import view
from tidemark.functions import bm25, extraction, ids, links, text
from tidemark.operators import shaping
from tidemark.schemas import BRONZE, LANDING


def _page_frame(spark, sf):
    """V2 in the raw-page layout."""
    return view(spark, sf, "v2").select(
        "page_id", "url", "fit_markdown", "raw_markdown", "score",
        F.create_map(
            F.lit("og:title"), F.col("og_title"), F.lit("date"), F.col("meta_date")
        ).alias("metadata"),
        F.col("start_url").alias("_source_start_url"),
        ids.url_domain(F.col("start_url")).alias("_source_domain"),
    )


@check("sha256_id", f"SELECT doc_id, {S.sha_id('source_url', 'title')} AS plain_id, {S.BRONZE_ID} AS bronze_id FROM v1", ("v1",))
def _(spark, sf):
    return view(spark, sf, "v1").select(
        "doc_id",
        ids.sha256_id(F.col("source_url"), F.col("title")).alias("plain_id"),
        ids.bronze_id(F.col("crawled_at"), F.col("source_url"), F.col("title")).alias("bronze_id"),
    )


@check("normalize_url", f"SELECT page_id, {S.url('url')} AS url FROM v2", ("v2",))
def _(spark, sf):
    return view(spark, sf, "v2").select("page_id", ids.normalize_url(F.col("url")).alias("url"))


@check("url_domain", "SELECT page_id, regexp_extract(url, '://([^/?#]*)', 1) AS domain FROM v2", ("v2",))
def _(spark, sf):
    return view(spark, sf, "v2").select("page_id", ids.url_domain(F.col("url")).alias("domain"))


@check("clean_text", f"SELECT page_id, {S.clean('raw_markdown')} AS text FROM v2", ("v2",))
def _(spark, sf):
    return view(spark, sf, "v2").select("page_id", text.clean_text(F.col("raw_markdown")).alias("text"))


@check("url_junk_ratio", f"SELECT doc_id, round({S.junk('text')}, 6) AS ratio FROM v1", ("v1",))
def _(spark, sf):
    return view(spark, sf, "v1").select(
        "doc_id", F.round(text.url_junk_ratio(F.col("text")), 6).alias("ratio")
    )


@check("junk_text", f"SELECT doc_id, {S.junk('text')} <= 0.5 AS passes FROM v1", ("v1",))
def _(spark, sf):
    return view(spark, sf, "v1").select("doc_id", text.passes_junk(F.col("text")).alias("passes"))


@check("error_page", f"SELECT doc_id, {S.error('text')} AS is_error FROM v1", ("v1",))
def _(spark, sf):
    return view(spark, sf, "v1").select("doc_id", text.is_error_page(F.col("text")).alias("is_error"))


@check(
    "nav_junk_ratio",
    r"""SELECT doc_id, round(CASE WHEN length(text) > 0 THEN
 len(regexp_extract_all(text, '(?i)skip to (?:navigation|main content|right column)|sign in|subscribe|shopping\.|newsletters|horoscope|games'))
 / (greatest(len(regexp_extract_all(text, '\S+')), 1) / 200.0) ELSE 1.0 END, 6) AS ratio FROM v1""",
    ("v1",),
)
def _(spark, sf):
    return view(spark, sf, "v1").select(
        "doc_id", F.round(text.nav_junk_ratio(F.col("text")), 6).alias("ratio")
    )


@check("char_count", "SELECT doc_id, length(text)::INTEGER AS chars FROM v1", ("v1",))
def _(spark, sf):
    return view(spark, sf, "v1").select("doc_id", text.char_count(F.col("text")).alias("chars"))


@check(
    "first_truthy",
    """SELECT page_id, coalesce(nullif(fit_markdown, ''), nullif(raw_markdown, '')) AS body,
 coalesce(nullif(page_id % 3, 0), nullif(page_id % 5, 0))::DOUBLE AS number FROM v2""",
    ("v2",),
)
def _(spark, sf):
    number = [(F.col("page_id") % n).cast("double") for n in (3, 5)]
    return view(spark, sf, "v2").select(
        "page_id",
        text.first_truthy(F.col("fit_markdown"), F.col("raw_markdown")).alias("body"),
        text.first_nonzero(*number).alias("number"),
    )


_BODY = "left(coalesce(nullif(fit_markdown, ''), nullif(raw_markdown, ''), ''), 8000)"
_TITLE = (
    f"coalesce(trim(og_title), nullif(left(trim(regexp_extract({_BODY}, "
    r"'(?:^|[\n\r])[ \t]*#*[ \t]*([^\s#][^\n\r]*)', 1)), 200), ''))"
)
_DATES = (
    r"'\b(\d{4}-\d{2}-\d{2})\b'",
    r"'\b((?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\s+\d{1,2},?\s+\d{4})\b'",
    r"'\b(\d{1,2}/\d{1,2}/\d{4})\b'",
)


def _date(explicit: str, body: str) -> str:
    found = ", ".join(f"nullif(regexp_extract({body}, {p}, 1), '')" for p in _DATES)
    return f"coalesce({explicit}, {found})"


@check("extract_body", f"SELECT page_id, {_BODY} AS body FROM v2", ("v2",))
def _(spark, sf):
    body = extraction.extract_body([F.col("fit_markdown"), F.col("raw_markdown")])
    return view(spark, sf, "v2").select("page_id", body.alias("body"))


@check("extract_title", f"SELECT page_id, {_TITLE} AS title FROM v2", ("v2",))
def _(spark, sf):
    body = extraction.extract_body([F.col("fit_markdown"), F.col("raw_markdown")])
    return view(spark, sf, "v2").select(
        "page_id", extraction.extract_title([F.col("og_title")], body).alias("title")
    )


@check("extract_date", f"SELECT doc_id, {_date('date_published', 'text')} AS date FROM v1", ("v1",))
def _(spark, sf):
    return view(spark, sf, "v1").select(
        "doc_id", extraction.extract_date([F.col("date_published")], F.col("text")).alias("date")
    )


@check("extract_url", "SELECT page_id, coalesce(nullif(og_title, ''), url, start_url) AS url FROM v2", ("v2",))
def _(spark, sf):
    return view(spark, sf, "v2").select(
        "page_id",
        extraction.extract_url(F.col("og_title"), F.col("url"), F.col("start_url")).alias("url"),
    )


@check("extract_score", "SELECT page_id, try_cast(nullif(score, '') AS DOUBLE) AS score FROM v2", ("v2",))
def _(spark, sf):
    return view(spark, sf, "v2").select("page_id", extraction.extract_score(F.col("score")).alias("score"))


@check(
    "normalize_records",
    f"""SELECT {_TITLE} AS title, {_date('meta_date', _BODY)} AS date_published, {_BODY} AS text,
 url AS source_url, regexp_extract(start_url, '://([^/?#]*)', 1) AS source_domain,
 try_cast(nullif(score, '') AS DOUBLE) AS relevance_score, 'markets' AS query,
 '2024-01-31T00:00:00+00:00' AS crawled_at FROM v2""",
    ("v2",),
)
def _(spark, sf):
    return extraction.normalize_records(
        _page_frame(spark, sf), query="markets", crawled_at="2024-01-31T00:00:00+00:00"
    )


@check(
    "preview",
    r"""SELECT doc_id, title, regexp_replace(left(text, 200), '\s+', ' ', 'g') AS text FROM v1 ORDER BY doc_id LIMIT 50""",
    ("v1",),
)
def _(spark, sf):
    rows = view(spark, sf, "v1").select("doc_id", "title", "text")
    return shaping.preview(rows, order=["doc_id"], n=50)


_BRONZE = ", ".join(BRONZE.fieldNames())


@check("align_frame", f"""SELECT doc_id::VARCHAR AS title, NULL::VARCHAR AS date_published, text, source_url,
 source_domain, try_cast(title AS DOUBLE) AS relevance_score, query, crawled_at FROM v1""", ("v1",))
def _(spark, sf):
    drifted = view(spark, sf, "v1").select(
        F.col("doc_id").alias("title"), "text", "source_url", "source_domain",
        F.col("title").alias("relevance_score"), "query", "crawled_at", "ingested_at",
    )
    return shaping.align_frame(drifted, LANDING)


@check("union_landing", """SELECT title, date_published, text, source_url, source_domain, relevance_score, query, crawled_at FROM v1
UNION ALL SELECT og_title, meta_date, raw_markdown, url, NULL, try_cast(score AS DOUBLE), NULL, NULL FROM v2""", ("v1", "v2"))
def _(spark, sf):
    pages = view(spark, sf, "v2").select(
        F.col("og_title").alias("title"), F.col("meta_date").alias("date_published"),
        F.col("raw_markdown").alias("text"), F.col("url").alias("source_url"),
        F.col("score").alias("relevance_score"),
    )
    return shaping.union_aligned([view(spark, sf, "v1"), pages], LANDING)


@check("rows_by_domain", "SELECT source_domain, count(*) AS rows FROM v1 GROUP BY source_domain", ("v1",))
def _(spark, sf):
    from tidemark.plans.reports import rows_by_domain

    return rows_by_domain(view(spark, sf, "v1"))


_BM25 = r""", blocks AS (SELECT doc_id, unnest(b) AS block, generate_subscripts(b, 1) AS block_no FROM
 (SELECT doc_id, list_filter(regexp_split_to_array(text, '[\n\r\x0b\x0c]'), lambda x: trim(x) <> '') AS b FROM v1)),
toks AS (SELECT *, regexp_extract_all(lower(block), '[\p{L}\p{N}]+') AS ts FROM blocks),
tf AS (SELECT doc_id, block, block_no, len(ts) AS dl,
 len(list_filter(ts, lambda t: t = 'the')) AS tf1, len(list_filter(ts, lambda t: t = 'que')) AS tf2 FROM toks),
st AS (SELECT *, count(*) OVER p AS n, avg(dl) OVER p AS avgdl,
 count(*) FILTER (WHERE tf1 > 0) OVER p AS df1, count(*) FILTER (WHERE tf2 > 0) OVER p AS df2
 FROM tf WINDOW p AS (PARTITION BY doc_id)),
sc AS (SELECT doc_id, block_no, block,
 ln(1 + (n - df1 + 0.5::DOUBLE) / (df1 + 0.5::DOUBLE)) * tf1 * 2.2::DOUBLE / (tf1 + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avgdl)) AS s1,
 ln(1 + (n - df2 + 0.5::DOUBLE) / (df2 + 0.5::DOUBLE)) * tf2 * 2.2::DOUBLE / (tf2 + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avgdl)) AS s2 FROM st)
SELECT doc_id, block_no::INTEGER AS block_no, block,
 round((CASE WHEN s1 > 0 THEN s1 ELSE 0 END) + (CASE WHEN s2 > 0 THEN s2 ELSE 0 END), 5) AS score
FROM sc WHERE (CASE WHEN s1 > 0 THEN s1 ELSE 0 END) + (CASE WHEN s2 > 0 THEN s2 ELSE 0 END) >= 0.3"""


@check("bm25_score", _BM25, ("v1",))
def _(spark, sf):
    blocks = bm25.bm25_blocks(F.col("text"), "the que")
    return (
        view(spark, sf, "v1")
        .select("doc_id", F.posexplode(blocks).alias("pos", "b"))
        .where(F.col("b.score") >= bm25.RELEVANCE_FLOOR)
        .select(
            "doc_id", (F.col("pos") + 1).alias("block_no"), "b.block",
            F.round("b.score", 5).alias("score"),
        )
    )


def _links(spark, sf):
    return links.extract_links(
        view(spark, sf, "v2"), html="raw_markdown", base="start_url", keep=["page_id", "start_url"]
    )


_LINKS = r""", hrefs AS (SELECT page_id, start_url, unnest(regexp_extract_all(raw_markdown, 'href="([^"]*)"', 1)) AS href FROM v2),
resolved AS (SELECT page_id, start_url, CASE WHEN regexp_matches(href, '(?i)^https?://') THEN href
 WHEN href = '' OR href LIKE '#%' OR regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.\-]*:') THEN NULL
 WHEN href LIKE '//%' THEN 'https:' || href
 WHEN href LIKE '/%' THEN rtrim(start_url, '/') || href ELSE start_url || href END AS link FROM hrefs),
links AS (SELECT page_id, start_url, link, regexp_extract(link, '://([^/?#]*)', 1) = regexp_extract(start_url, '://([^/?#]*)', 1) AS is_internal,
 (count(*) OVER (PARTITION BY page_id))::INTEGER AS n_links FROM resolved WHERE link IS NOT NULL)"""


@check("extract_links", _LINKS + " SELECT * FROM links", ("v2",))
def _(spark, sf):
    return _links(spark, sf)


@check(
    "domain_filter",
    _LINKS + " SELECT page_id, link FROM links WHERE is_internal OR page_id % 4 = 0",
    ("v2",),
)
def _(spark, sf):
    keep = links.on_site(F.col("link"), F.col("start_url"), F.col("page_id") % 4 == 0)
    return _links(spark, sf).where(keep).select("page_id", "link")


@check(
    "url_pattern_filter",
    _LINKS + " SELECT page_id, link FROM links WHERE link LIKE '%/news/%-news/%' OR link LIKE '%/th%'",
    ("v2",),
)
def _(spark, sf):
    keep = links.matches_any_pattern(F.col("link"), ["*/news/*-news/*", "*/th*"])
    return _links(spark, sf).where(keep).select("page_id", "link")


#: Sites over the hosts of the pages view; the second entry for one host replaces the first.
_SITES = (
    {"url": "https://blog.tionsh.example.net/", "url_patterns": ("*/de/*", "*/fr/*"), "include_external": False},
    {"url": "http://thther.example.org/start", "url_patterns": ("*?page=2*",), "include_external": True},
    {"url": "https://m.ththth.example.net/", "url_patterns": ("*/en/1??/", "*/fr/*"), "include_external": False},
    {"url": "https://blog.tionsh.example.net/other", "url_patterns": ("*#top", "*/es/*"), "include_external": False},
)
_SITE_ROWS = ", ".join(
    f"({k}, '{site['url']}', '{links.glob_to_regex(p)}', {str(site['include_external']).lower()})"
    for k, site in enumerate(_SITES)
    for p in site["url_patterns"]
)
_HTML = r"regexp_matches(raw_markdown, '(?i)^\s*<(!doctype\s+html|html)\b')"


@check(
    "url_pattern_filter_sites",
    f""", sites(ord, site_url, pattern, external) AS (VALUES {_SITE_ROWS}),
hosts AS (SELECT ord, regexp_extract(site_url, '://([^/?#]*)', 1) AS host, pattern, external FROM sites),
owner AS (SELECT host, max(ord) AS ord FROM hosts GROUP BY host),
rules AS (SELECT h.* FROM hosts h JOIN owner USING (host, ord))
SELECT page_id, url FROM v2 WHERE EXISTS (
    SELECT 1 FROM rules r WHERE r.host = regexp_extract(v2.start_url, '://([^/?#]*)', 1)
      AND regexp_matches(v2.url, r.pattern)
      AND (r.external OR regexp_extract(v2.url, '://([^/?#]*)', 1) = r.host))
  AND (raw_markdown IS NULL OR {_HTML})""",
    ("v2",),
)
def _(spark, sf):
    pages = view(spark, sf, "v2").select("page_id", "url", "start_url", F.col("raw_markdown").alias("html"))
    return links.passing_pages(pages, _SITES).select("page_id", "url")


@check(
    "content_type_filter",
    r"SELECT page_id, url FROM v2 WHERE regexp_matches(raw_markdown, '(?i)^\s*<(!doctype\s+html|html)\b')",
    ("v2",),
)
def _(spark, sf):
    return view(spark, sf, "v2").where(links.is_html(F.col("raw_markdown"))).select("page_id", "url")


@check(
    "keyword_relevance",
    """SELECT page_id, ((CASE WHEN contains(lower(url), 'th') THEN 1 ELSE 0 END) + (CASE WHEN contains(lower(url), 'blog') THEN 1 ELSE 0 END)
 + (CASE WHEN contains(lower(url), 'com') THEN 1 ELSE 0 END)) / 3.0::DOUBLE AS score FROM v2""",
    ("v2",),
)
def _(spark, sf):
    return view(spark, sf, "v2").select(
        "page_id", links.keyword_relevance(F.col("url"), "TH blog com").alias("score")
    )


@check(
    "rank_links",
    _LINKS
    + """, scored AS (SELECT DISTINCT start_url, link, ((CASE WHEN contains(lower(link), 'the') THEN 1 ELSE 0 END)
 + (CASE WHEN contains(lower(link), 'news') THEN 1 ELSE 0 END)) / 2.0::DOUBLE AS score FROM links),
ranked AS (SELECT *, row_number() OVER (PARTITION BY start_url ORDER BY score DESC, link) AS rank FROM scored)
SELECT start_url, link, score, rank::INTEGER AS rank FROM ranked WHERE rank <= 100""",
    ("v2",),
)
def _(spark, sf):
    scored = _links(spark, sf).select(
        "start_url", "link", links.keyword_relevance(F.col("link"), "the news").alias("score")
    )
    return links.rank_links(scored, site="start_url", score="score")


_BLOCKS = (
    "are you a (?:human|robot)", "verifying you are human", "access denied",
    "oops, something went wrong", "please enable (?:js|javascript)", "unsupported browser",
    "captcha", "cloudflare",
)
_BLOCK_SQL = "coalesce(" + ", ".join(
    f"nullif(regexp_extract(left(raw_markdown, 4000), '(?i){p}', 0), '')" for p in _BLOCKS
) + ")"


@check("detect_block", f"SELECT page_id, {_BLOCK_SQL} AS block FROM v2", ("v2",))
def _(spark, sf):
    return view(spark, sf, "v2").select("page_id", text.detect_block(F.col("raw_markdown")).alias("block"))


@check(
    "probe_verdict",
    _LINKS
    + f""", counted AS (SELECT v2.page_id, length(raw_markdown) AS chars, {_BLOCK_SQL} AS block,
 (SELECT count(*) FROM links WHERE links.page_id = v2.page_id AND is_internal) AS n FROM v2)
SELECT page_id, CASE WHEN chars > 1500 AND n > 10 AND block IS NULL THEN 'GOOD' WHEN block IS NOT NULL THEN 'BLOCKED'
 WHEN chars > 0 THEN 'WEAK' ELSE 'FAIL' END AS verdict FROM counted""",
    ("v2",),
)
def _(spark, sf):
    raw = F.col("raw_markdown")
    internal = links.count_internal_links(raw, F.col("start_url"))
    return view(spark, sf, "v2").select(
        "page_id", text.probe_verdict(F.length(raw), internal, text.detect_block(raw)).alias("verdict")
    )
