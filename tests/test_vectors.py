"""Vectors, chunks, similarity joins and clusters against brute force."""

import math
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from checks import vector_queries
from checks.registry import QUERIES
from compare import compare
from tidemark.functions.vectors import HashedEmbedder, ModelEmbedder, _row_slices, checked_vector, l2_normalize
from tidemark.operators import retrieval, similarity
from tidemark.operators.chunking import chunk_settings, chunk_windows
from tidemark.operators.clusters import connected_labels, title_duplicate_clusters, title_duplicate_members
from tidemark.operators.similarity import similar_pairs, similarity_links


class Small(HashedEmbedder):
    """A model that takes few tokens."""

    def __init__(self, max_tokens, special):
        super().__init__(max_tokens=max_tokens, special_tokens=special)


def test_embedder_gives_unit_vectors(spark):
    df = spark.createDataFrame([("fed rate Fed",), ("",), (None,), ("Rate fed, fed!",)], "t string")
    rows = [np.array(r[0]) for r in df.select(HashedEmbedder().embed(F.col("t"))).collect()]
    assert [len(r) for r in rows] == [384] * 4
    assert np.linalg.norm(rows[0]) == pytest.approx(1.0, abs=1e-6)
    assert not rows[1].any() and not rows[2].any()
    assert np.allclose(rows[0], rows[3])


def test_embedder_works_in_bounded_slices(spark):
    """Slices hold bounded rows and terms; a batch of many slices gives what each text gives alone."""
    sizes = np.array([5, 0, 3, 40, 1, 1, 1, 1, 0])
    slices = list(_row_slices(sizes, 3, 10))
    assert [(s.start, s.stop) for s in slices] == [(0, 3), (3, 4), (4, 7), (7, 9)]
    assert list(_row_slices(np.array([], dtype=np.int64), 3, 10)) == []
    texts = [" ".join(f"w{(i * 7 + j) % 977}" for j in range(i % 300)) for i in range(2500)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    vectors = {r[0]: np.array(r[1]) for r in df.coalesce(1).select("i", HashedEmbedder().embed(F.col("t"))).collect()}
    for i in (0, 1, 299, 1023, 1024, 1799, 2499):
        alone = spark.createDataFrame([(texts[i],)], "t string").select(HashedEmbedder().embed(F.col("t"))).first()[0]
        assert np.array_equal(vectors[i], np.array(alone))


def test_model_embedder(spark):
    def load():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    model = ModelEmbedder(load, "lengths", dim=2, batch_size=2)
    df = spark.createDataFrame([(t,) for t in ("a", "bbb", None, "cc", "")], "t string").coalesce(1)
    assert [list(r[0]) for r in df.select(model.embed(F.col("t"))).collect()] == [
        [1.0, 1.0], [3.0, 1.0], [0.0, 1.0], [2.0, 1.0], [0.0, 1.0]
    ]


def test_l2_normalize_keeps_nulls_and_zeros(spark):
    df = spark.createDataFrame([([3.0, 4.0],), (None,), ([0.0, 0.0],)], "v array<float>").coalesce(1)
    got = [r[0] for r in df.select(l2_normalize(F.col("v"))).collect()]
    assert got[0] == pytest.approx([0.6, 0.8]) and got[1] is None and got[2] == [0.0, 0.0]


def test_wrong_vector_length_fails_the_job(spark):
    df = spark.createDataFrame([(7, [0.0])], "id int, v array<float>")
    with pytest.raises(Exception, match="expected 384-dimensional embeddings; bad row: 7"):
        df.select(checked_vector(F.col("v"), F.col("id"))).collect()
    (bad,) = retrieval.bad_vectors(df, row_id="id", vector="v", dim=384).collect()
    assert (bad.id, bad.length) == (7, 1)


def test_chunk_settings():
    model = Small(10, 2)
    assert chunk_settings(model, 8, 3) == (8, 3)
    assert chunk_settings(model, 100, 3) == (8, 3)
    assert chunk_settings(model, 100, 50) == (8, 1)
    for size, overlap in ((0, 0), (3, 3), (3, -1)):
        with pytest.raises(ValueError):
            chunk_settings(model, size, overlap)


@pytest.mark.parametrize("size,overlap", [(3, 1), (3, 0), (5, 4), (1, 0), (100, 10)])
def test_chunk_windows_match_a_loop(spark, size, overlap):
    texts = [" ".join(f"w{i}" for i in range(n)) for n in (0, 1, 2, 3, 4, 5, 6, 11, 12)]

    def want(text):
        tokens, out = text.split(), []
        for start in range(0, len(tokens), size - overlap):
            out.append(" ".join(tokens[start : start + size]))
            if start + size >= len(tokens):
                break
        return out

    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    chunks = chunk_windows(df, HashedEmbedder(), chunk_tokens=size, chunk_overlap=overlap)
    got = {}
    for r in chunks.orderBy("id", "chunk_index").collect():
        assert r.chunk_index == len(got.setdefault(r.id, []))
        got[r.id].append(r.chunk_text)
    assert [got.get(i, []) for i in range(len(texts))] == [want(t) for t in texts]


def unit(matrix):
    return (matrix / np.linalg.norm(matrix, axis=1, keepdims=True)).astype(np.float32)


def dense_case():
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 16))
    vectors = unit(base[rng.integers(0, 40, 300)] + rng.normal(scale=0.15, size=(300, 16)))
    vectors[50:150] = vectors[49]  # a third are copies
    return vectors


def sparse_case():
    rng = np.random.default_rng(2)
    rows = np.zeros((400, 48))
    for i in range(400):
        for d in rng.integers(0, 12 if i % 2 else 48, rng.integers(1, 9)):
            rows[i, d] += rng.choice([1, -1, 2])
    return unit(rows[np.abs(rows).sum(axis=1) > 0])


def expected(vectors, threshold):
    first = {}
    for i, v in enumerate(vectors):
        first.setdefault(v.tobytes(), i)
    reps = sorted(first.values())
    sims = vectors.astype(float) @ vectors.astype(float).T
    pairs = {(a, b) for a in reps for b in reps if a < b and sims[a, b] >= threshold}
    return pairs | {(first[v.tobytes()], i) for i, v in enumerate(vectors) if first[v.tobytes()] != i}


CASES = [
    (dense_case, 0.9, "cells", 20), (dense_case, 0.9, "cells", 5000), (dense_case, 0.97, "cells", 30),
    (sparse_case, 0.95, "keys", 4096), (sparse_case, 0.8, "keys", 5), (sparse_case, 0.8, "cells", 40),
    (dense_case, 0.99, "keys", 50),
]


@pytest.mark.parametrize("case,threshold,method,block", CASES)
def test_similarity_join_is_exact(spark, case, threshold, method, block):
    vectors = case()
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "id bigint, v array<float>")
    how = {"id_col": "id", "vector": "v", "threshold": threshold, "method": method, "block_rows": block}
    got = [(r[0], r[1]) for r in similar_pairs(df, **how).collect()]
    want = expected(vectors, threshold)
    assert len(got) == len(set(got)) and set(got) == want and want

    links = similarity_links(df, **how).where("connects")
    labels = {r[0]: r[1] for r in connected_labels(links, left="left_id", right="right_id").collect()}
    assert labels == components(want)


def components(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def odd_rows(n, dim, seed):
    """(id, vector) rows: a third hold one vector, some ids and some whole rows come twice, some lack a value."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 8, dim))
    vectors = unit(base[rng.integers(0, len(base), n)] + rng.normal(scale=0.4, size=(n, dim)))
    vectors[n // 3 : 2 * n // 3] = vectors[n // 3 - 1]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(i, rows[i + 1][1]) for i in range(0, n - 1, 9)] + rows[::11]
    return rows + [(n, None), (n + 1, [0.0] * dim), (n + 2, [math.nan] * dim), (None, rows[0][1])]


def every_pair(rows, threshold):
    rows = [(i, np.array(v)) for i, v in rows if i is not None and v is not None and np.isfinite(v).all()]
    sims = np.array([v for _, v in rows]) @ np.array([v for _, v in rows]).T
    return Counter(
        (rows[a][0], rows[b][0]) for a, b in np.argwhere(sims >= threshold) if rows[a][0] < rows[b][0]
    )


@pytest.mark.parametrize("method,block", [("cells", 20), ("cells", 5000), ("keys", 20)])
def test_every_copy_is_paired(spark, method, block):
    """A pair per pair of rows, also where the rows hold one vector or share their ids with others."""
    rows = odd_rows(240, 8, 5)
    df = spark.createDataFrame(rows, "id bigint, v array<float>")
    how = {"id_col": "id", "vector": "v", "threshold": 0.9, "method": method, "block_rows": block}
    got = similar_pairs(df, **how, every_copy=True)
    want = every_pair(rows, 0.9)
    assert Counter((r.left_id, r.right_id) for r in got.collect()) == want and max(want.values()) > 1
    assert sum(want.values()) > 80 * 79 / 2

    links = similarity_links(df, **how)
    labels = {r[0]: r[1] for r in connected_labels(links.where("connects"), left="left_id", right="right_id").collect()}
    assert labels == components(want)


def test_similar_pairs_query_leaves_no_pair_out(spark, tmp_path):
    """The query gives the rows of its SQL over a table with copies, repeated ids and missing values."""
    rows = [(i, v, 0) for i, v in odd_rows(120, 64, 6) if v is None or not np.isnan(v).any()]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    df.coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert compare(spark, con, "similar_pairs", str(tmp_path)) is None


def test_links_stay_linear_when_everything_is_close(spark):
    rng = np.random.default_rng(3)
    vectors = unit(np.ones((200, 8)) + rng.normal(scale=0.01, size=(200, 8)))
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id bigint, v array<float>")
    links = similarity_links(df, id_col="id", vector="v", threshold=0.95, block_rows=5000)
    assert links.count() == 200  # 199 spokes and the closest pair
    sims = vectors.astype(float) @ vectors.astype(float).T
    best = links.agg(F.max("similarity")).first()[0]
    assert best == pytest.approx(np.triu(sims, 1).max())


def _many_cells(spark, n=2000, dim=8):
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(n, dim))
    rows = (rows / np.linalg.norm(rows, axis=1, keepdims=True)).astype(np.float32)
    return rows, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "id long, v array<float>")


def test_vectors_are_sent_once_to_a_group_of_cells(spark):
    """Vectors without structure visit nearly all 20 lower cells; fewer copies than that are sent."""
    rows, df = _many_cells(spark)
    members, sizes = similarity._cell_members(df.select("id", df.v.alias("vector")), 0.3, 100)
    sent = similarity._block_tasks(members, sizes).count()
    assert sent < 10 * len(rows)
    got = {(r[0], r[1]) for r in similar_pairs(df, id_col="id", vector="v", threshold=0.9, block_rows=100).collect()}
    close = np.argwhere(np.triu(rows.astype(float) @ rows.T.astype(float), k=1) >= 0.9)
    assert got == {(int(a), int(b)) for a, b in close} and len(got) > 50


def test_blocks_are_compared_in_tiles(monkeypatch):
    """Every pair of a block comes once, from products of at most 16 by 32 vectors."""
    monkeypatch.setattr(similarity, "TILE_LEFT", 16)
    monkeypatch.setattr(similarity, "TILE_RIGHT", 32)
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(150, 4)).astype(np.float32)
    home = rng.integers(0, 3, 150)

    def block(kind, i, j, side, cells):
        columns = {"kind": [kind] * 150, "i": [i] * 150, "j": [j] * 150, "side": side, "vector": rows.tolist()}
        return pa.table({k: pa.array(v, pa.int32()) if k != "vector" else pa.array(v, pa.list_(pa.float32())) for k, v in columns.items()}
                        | {"cells": pa.array(cells, pa.list_(pa.int32()))})

    sims = rows.astype(float) @ rows.T.astype(float)
    found = list(similarity._close_pairs(block(0, 0, 0, [0] * 150, [[c] for c in home]), 0.5))
    assert len(found) > 10 and all(len(left) <= 16 * 32 for left, _, _ in found)
    pairs = [(int(a), int(b)) for left, right, _ in found for a, b in zip(left, right)]
    want = {(a, b) for a in range(150) for b in range(a + 1, 150) if home[a] == home[b] and sims[a, b] >= 0.5}
    assert len(pairs) == len(want) and set(pairs) == want
    side = [int(k >= 90) for k in range(150)]
    cells = [[int(home[k])] if k < 90 else [[0, 1], [2], []][k % 3] for k in range(150)]
    found = list(similarity._close_pairs(block(1, 0, 2, side, cells), 0.5))
    pairs = [(int(a), int(b)) for left, right, _ in found for a, b in zip(left, right)]
    want = {(a, b) for a in range(90) for b in range(90, 150) if home[a] in cells[b] and sims[a, b] >= 0.5}
    assert len(pairs) == len(want) and set(pairs) == want


def test_a_tile_of_copies_is_listed_in_parts(monkeypatch):
    """Every pair of 60 equal vectors comes once, at most 100 at a time."""
    monkeypatch.setattr(similarity, "HELD_PAIRS", 100)
    columns = {c: pa.array([0] * 60, pa.int32()) for c in ("kind", "i", "j", "side")}
    block = pa.table(columns | {
        "vector": pa.array([[0.6, 0.8]] * 60, pa.list_(pa.float32())), "cells": pa.array([[0]] * 60, pa.list_(pa.int32()))
    })
    found = list(similarity._close_pairs(block, 0.5))
    pairs = [(int(a), int(b)) for left, right, _ in found for a, b in zip(left, right)]
    assert all(len(left) <= 100 for left, _, _ in found)
    assert len(pairs) == len(set(pairs)) == 60 * 59 / 2 and all(a < b for a, b in pairs)


def test_cluster_queries_read_staged_links(spark, tmp_path):
    """The groups and the summary both read the links; the join itself runs once."""
    _, df = _many_cells(spark, n=60, dim=64)
    rows = df.selectExpr("id AS vec_id", "v AS embedding", "cast(id % 10 AS int) AS label")
    rows.write.parquet(str(tmp_path / "embeddings.parquet"))
    plan = vector_queries._links(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Relation") and "FlatMapGroups" not in plan


def test_cluster_summary_names_the_members(spark, tmp_path):
    """Every member of every cluster with its page's title, largest cluster first; copies count."""
    rows = [(i, v) for i, v in odd_rows(120, 64, 7) if v is None or not np.isnan(v).any()]
    vectors = [(i, v, 0) for i, v in rows]
    spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>, label int").coalesce(1).write.parquet(
        str(tmp_path / "embeddings.parquet")
    )
    pages = [(i, f"u{i}", "h") for i in range(0, 120, 2)] * 2  # odd pages are not stored
    spark.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = QUERIES["cluster_summary"](spark, str(tmp_path)).collect()

    pairs = every_pair(rows, vector_queries.CLOSE)
    labels = components(pairs)
    by_id = {}
    for i, v in rows:
        by_id.setdefault(i, []).append(v)
    best, size = {}, Counter(labels.values())
    for a, b in pairs:
        sim = max(float(np.dot(x, y)) for x in by_id[a] for y in by_id[b])
        best[labels[a]] = max(best.get(labels[a], 0.0), sim)
    want = sorted((-size[c], -best[c], c, i) for i, c in labels.items())
    assert [(r.cluster_id, r.member_id) for r in got] == [(c, i) for _, _, c, i in want] and len(size) > 1
    assert [r["size"] for r in got] == [-n for n, *_ in want]
    assert [r.max_similarity for r in got] == pytest.approx([-s for _, s, *_ in want], abs=2e-5)
    assert all(r.title == (None if r.member_id % 2 else f"page {r.member_id}") for r in got)
    assert {r.member_id % 2 for r in got} == {0, 1}


def test_connected_labels_on_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 200)] + [(1000, 999)], "a bigint, b bigint")
    labels = {r[0]: r[1] for r in connected_labels(edges, left="a", right="b").collect()}
    assert labels == {**dict.fromkeys(range(201), 0), 999: 999, 1000: 999}
    with pytest.raises(RuntimeError):
        connected_labels(edges, left="a", right="b", max_rounds=1)


def test_title_clusters(spark):
    titles = ["Fed raises rates today", "Fed raises rates today!", "Apple unveils new chip", "short", None,
              "Fed raises rates today", "today raises Fed rates", "unique headline here"]
    df = spark.createDataFrame([(f"b{i}", t) for i, t in enumerate(titles)], "bronze_id string, title string")
    (cluster,) = title_duplicate_clusters(df, HashedEmbedder()).collect()
    assert (cluster.cluster_id, cluster["size"]) == ("b0", 4)
    assert cluster.max_similarity == pytest.approx(1.0, abs=1e-6)
    members = {r.bronze_id for r in title_duplicate_members(df, HashedEmbedder()).collect()}
    assert members == {"b0", "b1", "b5", "b6"}
    one = spark.createDataFrame([("b", "one long title")], "bronze_id string, title string")
    assert title_duplicate_clusters(one, HashedEmbedder()).isEmpty()


def test_search_order_ties_and_threshold(spark):
    chunks = spark.createDataFrame(
        [("p1", [0.8, 0.6]), ("p1", [0.9, 0.1]), ("p2", [0.9, 0.0]), ("p3", [0.5, 0.0]), ("p4", [1.0, 0.0])],
        "page_id string, embedding array<float>",
    )
    pages = spark.createDataFrame(
        [(p, p, "u", "c", "t") for p in ("p1", "p2", "p3")], "page_id string, title string, source_url string, crawled_at string, text string"
    )
    hits = retrieval.search_pages(chunks, pages, [1.0, 0.0], threshold=0.5, top_k=3)
    # p3 is not above the threshold; p4 takes a place but has no page.
    assert [r.row_id for r in hits.collect()] == ["p1", "p2"]
    assert hits.schema["similarity"].dataType.simpleString() == "float"


def test_short_distinct_titles_stay_apart(spark):
    titles = [f"Article {i}" for i in range(1, 60)] + ["Report on the harbour", "report on the Harbour"]
    df = spark.createDataFrame([(f"b{i}", t) for i, t in enumerate(titles)], "bronze_id string, title string")
    members = title_duplicate_members(df, HashedEmbedder()).collect()
    assert sorted(r.title for r in members) == ["Report on the harbour", "report on the Harbour"]
    assert {r.size for r in members} == {2}


def test_prefix_links_against_all_pairs(spark):
    import random

    from pyspark.sql import functions as F

    from tidemark.operators.clusters import prefix_links

    rng = random.Random(11)
    words = [f"w{k}" for k in range(12)] + ["common"] * 6
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 7))) for _ in range(300)] + ["", "common common"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, title string")
    vectors = df.withColumn("entries", HashedEmbedder().entries(F.col("title")))
    rows = {r.id: {e["index"]: e["weight"] for e in r.entries} for r in vectors.collect()}
    for threshold in (0.95, 0.8, 0.5):
        got = {(r.left_id, r.right_id) for r in prefix_links(vectors, id_col="id", entries="entries", threshold=threshold).collect()}
        want = {
            (a, b)
            for a in rows
            for b in rows
            if a < b and sum(w * rows[b].get(i, 0.0) for i, w in rows[a].items()) >= threshold
        }
        assert got == want
        assert want


def test_connected_labels_split_hubs(spark):
    """One group holds a third of all nodes; no task of a relink holds a tenth of the edges."""
    from pyspark.sql import functions as F

    from tidemark.operators import clusters

    hub = [(0, k) for k in range(1, 3001)]
    chains = [(k, k + 1) for k in range(10_000, 15_998) if k % 3]
    edges = spark.createDataFrame(hub + chains, "a long, b long")
    labels = {r[0]: r[1] for r in clusters.connected_labels(edges, left="a", right="b", hub_edges=200).collect()}
    assert all(labels[k] == 0 for k in range(3001))
    assert labels[10_001] == 10_000 and labels[10_002] == 10_000 and labels[10_004] == 10_003

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        both = both.union(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m"))
        relinked = clusters._relink(both, lowest, hub_edges=200)
        per_task = relinked.groupBy(F.spark_partition_id()).count().collect()
        assert relinked.count() == both.count()
        assert max(r["count"] for r in per_task) < both.count() / 10
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
