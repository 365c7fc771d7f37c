"""Pieces of oracle SQL used by several queries."""

from __future__ import annotations

_URL = r"'^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+)([^?#]*)'"


def url(col: str) -> str:
    head = f"regexp_extract(trim({col}), {_URL}, 1)"
    path = f"regexp_extract(trim({col}), {_URL}, 2)"
    return f"(CASE WHEN {head} = '' THEN NULL ELSE lower({head}) || rtrim({path}, '/') END)"


def sha_id(*parts: str, prefix: str | None = None) -> str:
    joined = " || chr(31) || ".join(f"coalesce(cast({p} AS VARCHAR), '')" for p in parts)
    digest = f"sha256({joined})"
    return f"('{prefix}_' || {digest})" if prefix else digest


BRONZE_ID = sha_id("left(crawled_at, 10)", url("source_url"), "title", prefix="bronze")


def clean(col: str) -> str:
    """The entities the pages hold, then whitespace."""
    text = f"coalesce({col}, '')"
    for name, char in (("middot", "·"), ("copy", "©"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        text = f"regexp_replace({text}, '&{name};?', '{char}', 'g')"
    return f"trim(regexp_replace({text}, '\\s+', ' ', 'g'))"


URLS = r"'\[[^\]]*\]\([^)]+\)|https?://\S+|www\.\S+'"


def junk(col: str) -> str:
    covered = (
        f"coalesce(list_sum(list_transform(regexp_extract_all({col}, {URLS}), lambda m: length(m))), 0)"
    )
    return f"(CASE WHEN length({col}) > 0 THEN {covered} / length({col}) ELSE 0.0 END)"


ERROR = (
    r"'(?i)(oops[,!]?\s*something\s+went\s+wrong|temporarily\s+down\s+for\s+maintenance|access\s+denied"
    r"|page\s+not\s+found|\b404\s+not\s+found\b|sign\s+in\s+to\s+(?:read|continue)"
    r"|subscribe\s+to\s+(?:read|continue))'"
)


def error(col: str) -> str:
    return f"coalesce(regexp_matches({col}, {ERROR}), false)"


_REASONS = [
    ("bronze_id IS NULL", "bronze_id: not_null"),
    ("NOT regexp_matches(bronze_id, '^bronze_[0-9a-f]{64}$')", "bronze_id: matches_id_format"),
    ("id_copies > 1", "bronze_id: unique"),
    ("source_url IS NULL", "source_url: not_null"),
    ("NOT regexp_matches(source_url, '^https?://')", "source_url: matches_http_scheme"),
    ("source_domain IS NULL", "source_domain: not_null"),
    ("length(title) > 200", "title: length_le_200"),
    ("text IS NULL", "text: not_null"),
    ("length(text) NOT BETWEEN 50 AND 8000", "text: length_50_to_8000"),
    (f"{junk('text')} > 0.5", "text: junk_ratio_le_0.5"),
    (error("text"), "text: no_error_page_sentinel"),
    ("relevance_score < 0.3", "relevance_score: ge_0.3"),
    ("query IS NULL", "query: not_null"),
    ("length(query) < 1", "query: length_ge_1"),
    ("crawled_at IS NULL", "crawled_at: not_null"),
    ("ingested_at IS NULL", "ingested_at: not_null"),
    ("source_file IS NULL", "source_file: not_null"),
]


def reasons() -> str:
    cases = ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for cond, name in _REASONS)
    return f"list_filter([{cases}], lambda r: r IS NOT NULL)"


#: b1: V1 with bronze ids; d1: the first row per id; c1/k1: rows of b1/d1 with their reasons.
B1 = f", b1 AS (SELECT {BRONZE_ID} AS bronze_id, v1.* FROM v1)"
D1 = B1 + (
    ", d1 AS (SELECT * FROM b1 QUALIFY row_number() OVER "
    "(PARTITION BY bronze_id ORDER BY source_file, doc_id) = 1)"
)
C1 = B1 + (
    f", c1 AS (SELECT *, {reasons()} AS why FROM "
    "(SELECT *, count(*) OVER (PARTITION BY bronze_id) AS id_copies FROM b1))"
)
K1 = D1 + f", k1 AS (SELECT *, {reasons()} AS why FROM (SELECT *, 1 AS id_copies FROM d1))"
#: p1: pages of d1.
P1 = D1 + f""", t1 AS (SELECT * EXCLUDE (text), {clean('text')} AS text FROM d1),
h1 AS (SELECT *, sha256(text) AS text_hash FROM t1 WHERE text <> ''),
p1 AS (SELECT *, {sha_id('bronze_id', 'source_url', 'query', 'text_hash', prefix='page')} AS page_id FROM h1)"""


def hashed_terms(source: str, key: str, text: str, dim: int = 384) -> str:
    """CTEs ``slots`` and ``unit``: the hashed bag-of-words vectors of a relation, sparse."""
    return f""", words AS (SELECT {key} AS key, unnest(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+')) AS term FROM {source}),
codes AS (SELECT key, cast('0x' || left(md5(term), 8) AS BIGINT) AS code FROM words),
slots AS (SELECT key, code % {dim} + 1 AS slot, sum(CASE WHEN (code // {dim}) % 2 = 0 THEN 1 ELSE -1 END)::DOUBLE AS n FROM codes GROUP BY ALL),
unit AS (SELECT key, slot, (n / sqrt(sum(n * n) OVER (PARTITION BY key)))::FLOAT::DOUBLE AS w FROM slots WHERE n <> 0)"""


def term_counts(source: str, key: str, text: str) -> str:
    """CTE ``unit``: sparse unit vectors of term counts, a term's bucket being the first 32 bits of its MD5."""
    return f""", words AS (SELECT {key} AS key, unnest(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+')) AS term FROM {source}),
codes AS (SELECT key, cast('0x' || left(md5(term), 8) AS BIGINT) AS code FROM words),
counts AS (SELECT key, code, count(*)::DOUBLE AS n FROM codes GROUP BY ALL),
unit AS (SELECT key, code, n / sqrt(sum(n * n) OVER (PARTITION BY key)) AS w FROM counts)"""


#: The query vector of the V3 searches, and the scored chunks.
SCORED = """, q AS (SELECT embedding::DOUBLE[] AS qv FROM v3 WHERE chunk_id = 0),
scored AS (SELECT chunk_id, page_id, list_dot_product(embedding::DOUBLE[], qv)::FLOAT AS similarity FROM v3, q)"""
BEST = SCORED + """, best AS (SELECT page_id, max(similarity) AS similarity FROM scored
 WHERE similarity > 0.1::FLOAT GROUP BY page_id),
top AS (SELECT * FROM best ORDER BY similarity DESC, page_id LIMIT 20)"""
#: All close pairs of V3.
PAIRS = """, pairs AS (SELECT a.chunk_id AS left_id, b.chunk_id AS right_id,
 list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS similarity
 FROM v3 a JOIN v3 b ON a.chunk_id < b.chunk_id
 WHERE list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.4)"""
LABELS = PAIRS + """, both_ways AS (SELECT left_id AS a, right_id AS b FROM pairs UNION ALL SELECT right_id, left_id FROM pairs),
reach AS (SELECT a AS id, a AS other FROM both_ways UNION SELECT r.id, e.b FROM reach r JOIN both_ways e ON r.other = e.a),
labels AS (SELECT id, min(other) AS label FROM reach GROUP BY id)"""
