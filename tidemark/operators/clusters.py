"""Connected groups of similar rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.constants import TITLE_MIN_CHARS, TITLE_SIMILARITY
from tidemark.functions.vectors import Embedder
from tidemark.operators.similarity import similarity_links
from tidemark.session import delete_folder, stage, stage_to

MAX_ROUNDS = 60
#: A node with more edges than this is a hub: its edge list is split over several salted keys.
HUB_EDGES = 100_000


def _hubs(edges: DataFrame, hub_edges: int) -> DataFrame:
    """(u, salts) of the nodes with more than ``hub_edges`` edges as ``u``.

    There are at most 2 x edges / hub_edges of them, so the table is broadcast.
    """
    return F.broadcast(
        edges.groupBy("u")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > hub_edges)
        .select("u", F.ceil(F.col("n") / hub_edges).cast("int").alias("salts"))
    )


def _relink(edges: DataFrame, lowest: DataFrame, hub_edges: int = HUB_EDGES) -> DataFrame:
    """Edges (u, v) with u's lowest neighbour ``m`` attached; u is unique on the other side.

    A hub's edges are dealt over ``salts`` keys by a hash of ``v``, and its row of ``lowest`` is
    copied to each, so no task holds more than about ``hub_edges`` edges of one node.
    """
    hubs = _hubs(edges, hub_edges)
    salts = F.coalesce(F.col("salts"), F.lit(1))
    dealt = edges.join(hubs, "u", "left").withColumn("s", F.pmod(F.xxhash64("v"), salts)).drop("salts")
    copies = lowest.join(hubs, "u", "left").withColumn("s", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
    return dealt.join(copies, ["u", "s"]).drop("s")


def _large_star(edges: DataFrame, hub_edges: int = HUB_EDGES) -> DataFrame:
    """Link every larger neighbour of a node to the node's lowest neighbour or itself."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.min("v").alias("low")).select(
        "u", F.least("u", "low").alias("m")
    )
    return (
        _relink(both, lowest, hub_edges)
        .where(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame, hub_edges: int = HUB_EDGES) -> DataFrame:
    """Link a node and its smaller neighbours to the lowest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    lowest = down.groupBy("u").agg(F.min("v").alias("m"))
    neighbours = _relink(down, lowest, hub_edges).where(F.col("v") != F.col("m")).select(
        F.col("v").alias("u"), F.col("m").alias("v")
    )
    return neighbours.union(lowest.select("u", F.col("m").alias("v"))).distinct()


def _all_stars(edges: DataFrame) -> bool:
    """Every node is either a root or linked to exactly one root; one aggregation."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    roles = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return roles.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def connected_labels(
    edges: DataFrame, *, left: str, right: str, max_rounds: int = MAX_ROUNDS, hub_edges: int = HUB_EDGES
) -> DataFrame:
    """(id, label) of every node with an edge; the label is the smallest id of its group.

    Alternating large-star and small-star rounds: each is two aggregations and two joins on
    one key, no group is gathered anywhere, and the number of rounds grows with the logarithm
    of the graph size rather than its diameter. Minima are combined before the shuffle, and the
    edges of a node with more than ``hub_edges`` of them are split over salted keys, so one
    group holding a third of all nodes is no task's whole load. Raises when ``max_rounds`` do
    not suffice.
    """
    current = edges.select(
        F.greatest(left, right).alias("u"), F.least(left, right).alias("v")
    )
    spark = edges.sparkSession
    current, folder = stage_to(current.where(F.col("u") != F.col("v")).distinct(), "stars")
    for _ in range(max_rounds):
        if _all_stars(current):
            stars = current.select(F.col("u").alias("id"), F.col("v").alias("label"))
            roots = current.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct()
            return stars.unionByName(roots)
        last = folder
        current, folder = stage_to(_small_star(_large_star(current, hub_edges), hub_edges), "stars")
        delete_folder(spark, last)  # each round is written before the one it came from goes
    raise RuntimeError(f"connected groups not settled after {max_rounds} rounds")


def cluster_members(labels: DataFrame, links: DataFrame) -> DataFrame:
    """One row per member: cluster id, member id, cluster size and best pair similarity.

    Members stay rows, so a cluster holding a third of the table is no larger in any task than
    a thousand small ones.
    """
    return labels.select(F.col("label").alias("cluster_id"), F.col("id").alias("member_id")).join(
        _cluster_figures(labels, links), "cluster_id"
    )


def cluster_summary(labels: DataFrame, links: DataFrame, titles: DataFrame) -> DataFrame:
    """The clusters, largest first: size, best pair similarity, member ids and their titles.

    One row per member, as in :func:`cluster_members`, so no cluster is gathered in one row or
    task. ``titles`` holds one (id, title) row per id; a member without one keeps its place with a
    null title.
    """
    named = titles.select(F.col("id").alias("member_id"), "title")
    members = cluster_members(labels, links).join(named, "member_id", "left")
    return order_clusters(members, "member_id").select("cluster_id", "size", "max_similarity", "member_id", "title")


def _cluster_figures(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Per cluster: size and best pair similarity."""
    sizes = labels.groupBy(F.col("label").alias("cluster_id")).agg(F.count("*").alias("size"))
    best = (
        links.where(F.col("similarity").isNotNull())
        .join(labels, links["left_id"] == labels["id"])
        .groupBy(F.col("label").alias("cluster_id"))
        .agg(F.max("similarity").alias("max_similarity"))
    )
    return sizes.join(best, "cluster_id")


def order_clusters(clusters: DataFrame, *within: str) -> DataFrame:
    """Size, then best similarity, both descending; the cluster id breaks ties, and the columns
    ``within`` order the rows of one cluster."""
    return clusters.orderBy(F.desc("size"), F.desc("max_similarity"), "cluster_id", *within)


def prefix_links(vectors: DataFrame, *, id_col: str, entries: str, threshold: float) -> DataFrame:
    """Every pair of sparse unit vectors with a dot product of at least ``threshold``.

    ``entries`` is an array of (index, weight) with distinct indexes and unit length. Indexes are
    ordered globally, rarest first. A vector's prefix is its entries from the first up to the
    last one from which the remaining squared weights still reach ``threshold**2``. If x . y >= t,
    the prefixes of x and y share an index: otherwise all shared indexes lie in the later part of
    one of them, whose length is below t, and by Cauchy-Schwarz so is the product. So the prefixes
    form an inverted index whose self-join gives every close pair; rare indexes come first, so its
    lists are short. Candidates are verified with the whole vectors. Returns ``left_id, right_id,
    similarity, connects`` with ``left_id < right_id``.
    """
    flat = vectors.select(F.col(id_col).alias("id"), F.explode(entries).alias("e")).select("id", "e.index", "e.weight")
    counts = flat.groupBy("index").agg(F.count("*").alias("df"))
    later_first = Window.partitionBy("id").orderBy(F.desc("df"), F.desc("index")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    prefix = (
        flat.join(counts, "index")
        .withColumn("rest", F.sum(F.col("weight") * F.col("weight")).over(later_first))
        .where(F.col("rest") >= F.lit(threshold * threshold - 1e-9))
        .select("id", "index")
    )
    a, b = prefix.alias("a"), prefix.alias("b")
    pairs = (
        a.join(b, (F.col("a.index") == F.col("b.index")) & (F.col("a.id") < F.col("b.id")))
        .select(F.col("a.id").alias("left_id"), F.col("b.id").alias("right_id"))
        .distinct()
    )
    maps = vectors.select(F.col(id_col).alias("id"), F.map_from_entries(entries).alias("m"))
    left = maps.select(F.col("id").alias("left_id"), F.col("m").alias("lm"))
    right = maps.select(F.col("id").alias("right_id"), F.col("m").alias("rm"))
    dot = F.aggregate(
        F.map_entries("lm"), F.lit(0.0),
        lambda total, e: total + e["value"] * F.coalesce(F.try_element_at("rm", e["key"]), F.lit(0.0)),
    )
    return (
        pairs.join(left, "left_id")
        .join(right, "right_id")
        .select("left_id", "right_id", dot.alias("similarity"))
        .where(F.col("similarity") >= threshold)
        .withColumn("connects", F.lit(True))
    )


def title_candidates(df: DataFrame, min_chars: int = TITLE_MIN_CHARS) -> DataFrame:
    """Ids and titles long enough to compare."""
    return df.where(F.length("title") >= min_chars).select("bronze_id", "title")


def _uses_term_entries(embedder: Embedder) -> bool:
    """The embedder offers term entries and compares titles by them: an embedder that brings its
    own ``embed`` over the class that defines ``entries`` has its own vectors compared."""
    kind = type(embedder)
    owner = next((k for k in kind.__mro__ if "entries" in vars(k)), None)
    return owner is not None and getattr(kind, "embed", None) is getattr(owner, "embed", None)


def title_duplicate_members(
    df: DataFrame,
    embedder: Embedder,
    *,
    threshold: float = TITLE_SIMILARITY,
    min_chars: int = TITLE_MIN_CHARS,
) -> DataFrame:
    """Rows whose titles are near copies: (cluster_id, bronze_id, title, size, max_similarity).

    Each distinct title is embedded once and stands for all rows that carry it; the rows come
    back by one join on the title at the end.
    """
    rows = title_candidates(df, min_chars)
    distinct = rows.groupBy("title").agg(F.min("bronze_id").alias("id"), F.count("*").alias("copies"))
    if _uses_term_entries(embedder):
        # Sparse term vectors: close pairs come from a prefix-filtered inverted index.
        titles = stage(distinct.withColumn("entries", embedder.entries(F.col("title"))), "titles")
        links = prefix_links(titles, id_col="id", entries="entries", threshold=threshold)
        length = F.aggregate("entries", F.lit(0.0), lambda acc, e: acc + e["weight"] * e["weight"])
    else:
        titles = stage(distinct.withColumn("vector", embedder.embed(F.col("title"))), "titles")
        method = "keys" if embedder.sparse else "cells"
        links = similarity_links(titles, id_col="id", vector="vector", threshold=threshold, method=method)
        length = F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x)
    links = stage(links, "title-links")
    labels = connected_labels(links.where("connects"), left="left_id", right="right_id")

    labelled = titles.select("id", "title", "copies", length.alias("own")).join(labels, "id", "left")
    labelled = labelled.withColumn("cluster_id", F.coalesce("label", "id")).where(
        F.col("label").isNotNull() | ((F.col("copies") > 1) & (F.col("own") >= threshold))
    )
    linked = (
        links.where(F.col("similarity").isNotNull())
        .join(labels, links["left_id"] == labels["id"])
        .select(F.col("label").alias("cluster_id"), "similarity")
    )
    copied = labelled.where((F.col("copies") > 1) & (F.col("own") >= threshold)).select(
        "cluster_id", F.col("own").alias("similarity")
    )
    best = linked.unionByName(copied).groupBy("cluster_id").agg(
        F.max("similarity").alias("max_similarity")
    )
    sizes = labelled.groupBy("cluster_id").agg(F.sum("copies").alias("size"))
    clusters = sizes.join(best, "cluster_id")
    return rows.join(labelled.select("title", "cluster_id"), "title").join(
        clusters, "cluster_id"
    ).select("cluster_id", "bronze_id", "title", "size", "max_similarity")


def title_duplicate_clusters(
    df: DataFrame,
    embedder: Embedder,
    *,
    threshold: float = TITLE_SIMILARITY,
    min_chars: int = TITLE_MIN_CHARS,
) -> DataFrame:
    """Clusters of near-copy titles, largest first; the members are in
    :func:`title_duplicate_members`."""
    members = title_duplicate_members(df, embedder, threshold=threshold, min_chars=min_chars)
    return order_clusters(
        members.groupBy("cluster_id").agg(
            F.max("size").alias("size"), F.max("max_similarity").alias("max_similarity")
        )
    )
