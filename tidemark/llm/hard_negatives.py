"""Hard-negative mining with Kronecker-packed integer products.

Scores are exact integer inner products of vectors whose components are ``floor(256 x)``. Instead
of one product per candidate and component, the components of ``PACK`` candidates are biased to
be non-negative and laid side by side, each in a field of ``W`` bits, in one wide integer per
component. One multiplication by an anchor's (biased) component then multiplies all of them; the
sum over components holds every candidate's biased product in its own field, because the field
width is chosen from the largest value a field can reach, so no carry crosses into the next.
The fields are cut apart and the bias terms taken off again: the scores are exact.

The Spark side: valid rows are staged once with a row number. Anchors (ids divisible by 100,
distinct rows) fall into blocks of at most ``ANCHOR_BLOCK``; candidates into groups of about
``GROUP_ROWS`` by a hash of the row number, so copies of one vector spread over all groups. Each
(anchor block, candidate group) pair is one cogroup task. The anchors are a stated query set
scored against all rows in these blocks; no pair of candidates is ever formed.

1. Each task keeps, per anchor, its best ``POSITIVES`` same-label rows; a window per anchor
   merges them into the global positives.
2. With the positives' scores attached to the anchors, each task keeps, per (anchor, positive),
   its best ``NEGATIVES`` different-label rows inside the score band; a window merges those.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import new_folder

#: Candidates per wide integer.
PACK = 128
#: Anchors per block and candidate rows per group (bounded work and memory of one task).
ANCHOR_BLOCK = 2048
GROUP_ROWS = 16_384
#: Positives per anchor, negatives per (anchor, positive), and the score band in percent of the positive's.
POSITIVES, NEGATIVES, BAND_LOW, BAND_HIGH = 5, 10, 30, 90
#: Anchors: rows whose id is divisible by this. Labels of ids divisible by SHIFT_EVERY move by one (mod 10).
ANCHOR_EVERY, SHIFT_EVERY, LABELS = 100, 7, 10

__all__ = ["hard_negatives", "packed_scores"]


# ---------------------------------------------------------------- exact scores by packing


def _pack(columns: list[np.ndarray], width: int) -> int:
    """One wide integer whose field k (``width`` bits, lowest first) holds ``columns[k]``."""
    if width <= 64 and width % 8 == 0:
        values = np.asarray(columns, dtype=np.uint64).astype("<u8").view(np.uint8).reshape(-1, 8)[:, : width // 8]
        return int.from_bytes(values.tobytes(), "little")
    total = 0
    for k, value in enumerate(columns):
        total |= int(value) << (k * width)
    return total


def _unpack(value: int, count: int, width: int) -> np.ndarray:
    """The ``count`` fields of ``width`` bits, lowest first: unsigned 64-bit when they fit, else Python ints."""
    if width <= 64 and width % 8 == 0:
        size = width // 8
        raw = np.frombuffer(value.to_bytes(count * size + 8, "little")[: count * size], np.uint8).reshape(count, size)
        wide = np.zeros((count, 8), np.uint8)
        wide[:, :size] = raw
        return wide.view("<u8").reshape(count)
    mask = (1 << width) - 1
    return np.array([(value >> (k * width)) & mask for k in range(count)], dtype=object)


class Packed:
    """Candidates (rows of integer components) packed ``PACK`` to a wide integer per component.

    ``anchor_range`` bounds max(a) - min(a) of every anchor that will be scored; with it the
    field width is chosen so that no field can carry into the next.
    """

    def __init__(self, rows: list[list[int]], dims: int, anchor_range: int, anchor_abs: int):
        self.count, self.dims = len(rows), dims
        row_abs = max((abs(x) for r in rows for x in r), default=0)
        # Scores, and 100 times them, fit 64-bit integers: numpy does the bookkeeping.
        self.small = 100 * max(dims, 1) * max(anchor_abs, 1) * max(row_abs, 1) < 1 << 62
        self.packs: list[tuple[int, int, list[int], np.ndarray]] = []
        kind = np.int64 if self.small else object
        for first in range(0, len(rows), PACK):
            block = [r + [0] * (dims - len(r)) for r in rows[first : first + PACK]]
            low = min((min(r) for r in block if r), default=0)
            shifted = [[x - low for x in r] for r in block]
            top = max((max(r) for r in shifted if r), default=0)
            width = 8 * max(1, -(-((dims * anchor_range * top).bit_length() + 1) // 8))
            words = [_pack([r[i] for r in shifted], width) for i in range(dims)] if top and anchor_range else [0] * dims
            self.packs.append((low, width, words, np.array([sum(r) for r in shifted], dtype=kind)))

    def scores(self, anchor: list[int]) -> np.ndarray:
        """Exact inner products of ``anchor`` with every packed row, in row order."""
        dims = self.dims
        anchor = anchor + [0] * (dims - len(anchor))
        a_low = min(anchor, default=0)
        shifted = [x - a_low for x in anchor]
        a_sum = sum(shifted)
        parts = []
        for low, width, words, row_sums in self.packs:
            total = 0
            for x, word in zip(shifted, words):
                if x:
                    total += x * word
            fields = _unpack(total, len(row_sums), width)
            fields = fields.astype(np.int64) if self.small else fields.astype(object)
            parts.append(fields + (dims * a_low * low + low * a_sum) + a_low * row_sums)
        if not parts:
            return np.zeros(0, np.int64 if self.small else object)
        return np.concatenate(parts)


def _packed(rows: list[list[int]], anchors: list[list[int]]) -> Packed:
    dims = max((len(v) for v in [*anchors, *rows]), default=0)
    spread = max((max(a) - min(a) for a in anchors if a), default=0)
    if any(len(a) < dims for a in anchors):
        spread = max(spread, max((abs(x) for a in anchors for x in a), default=0))
    biggest = max((abs(x) for a in anchors for x in a), default=0)
    return Packed(rows, dims, spread, biggest)


def packed_scores(anchors: list[list[int]], rows: list[list[int]]) -> list[list[int]]:
    """All exact inner products of anchors with rows (shorter vectors count as padded with 0)."""
    packed = _packed(rows, anchors)
    return [[int(x) for x in packed.scores(a)] for a in anchors]


def integer_components(vector) -> list[int]:
    return [math.floor(256.0 * float(x)) for x in vector]


def _best(scores: np.ndarray, ids: np.ndarray, chosen: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` chosen places of highest score, ties by smaller id."""
    if not len(chosen):
        return chosen
    if scores.dtype == object:
        return np.array(sorted(chosen, key=lambda j: (-scores[j], ids[j]))[:k], dtype=np.int64)
    order = np.lexsort((ids[chosen], -scores[chosen]))
    return chosen[order[:k]]


# ---------------------------------------------------------------- the Spark job


def _valid(embeddings: DataFrame) -> DataFrame:
    """Rows that take part, labels shifted; each with a row number that is unique and stable."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    vec = F.col("vec_id").cast("long")
    label = F.when(vec % SHIFT_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label")).cast("long")
    return embeddings.where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite
    ).select(
        vec.alias("vec_id"),
        label.alias("label"),
        F.transform("embedding", lambda x: x.cast("double")).alias("vector"),
        F.monotonically_increasing_id().alias("row"),
    )


def _anchor_key() -> Column:
    return F.xxhash64("vec_id", "label", "vector")


_CAND = "row long, vec_id long, label long, vector array<double>"


def _prepared(cands: pd.DataFrame, anchors: pd.DataFrame):
    ints = [integer_components(v) for v in cands["vector"]]
    a_ints = [integer_components(v) for v in anchors["vector"]]
    return cands["vec_id"].to_numpy(np.int64), cands["label"].to_numpy(np.int64), a_ints, _packed(ints, a_ints)


def _local_positives(cands: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
    out = []
    if len(cands) and len(anchors):
        ids, labels, a_ints, packed = _prepared(cands, anchors)
        rows = cands["row"].to_numpy(np.int64)
        for akey, aid, alabel, a in zip(anchors["akey"], anchors["vec_id"], anchors["label"], a_ints):
            scores = packed.scores(a)
            for j in _best(scores, ids, np.flatnonzero((labels == alabel) & (ids != aid)), POSITIVES):
                out.append((akey, aid, int(rows[j]), int(ids[j]), int(scores[j])))
    return pd.DataFrame(out, columns=["akey", "anchor_id", "prow", "positive_id", "positive_score"])


def _local_negatives(cands: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
    out = []
    if len(cands) and len(anchors):
        ids, labels, a_ints, packed = _prepared(cands, anchors)
        for akey, aid, alabel, a, positives in zip(
            anchors["akey"], anchors["vec_id"], anchors["label"], a_ints, anchors["positives"]
        ):
            scores = packed.scores(a)
            other = labels != alabel
            for positive in positives:
                prow, pid, ps = (positive[k] for k in ("prow", "positive_id", "positive_score"))
                band = other & (BAND_LOW * ps <= 100 * scores) & (100 * scores <= BAND_HIGH * ps)
                for j in _best(scores, ids, np.flatnonzero(band), NEGATIVES):
                    out.append((akey, aid, prow, pid, ps, int(ids[j]), int(scores[j])))
    columns = ["akey", "anchor_id", "prow", "positive_id", "positive_score", "negative_id", "negative_score"]
    return pd.DataFrame(out, columns=columns)


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """For each anchor and positive, the best different-label rows in the score band.

    Rows with a null id, label or vector, or a null or non-finite component, take no part; other
    columns of ``embeddings`` are not read. Vectors of different lengths count as padded with
    zeros. Repeated anchor rows (same id, label and vector) are one anchor; other repeated rows
    are rows of their own, and a row with the anchor's id is never its positive. Ties go to the
    smaller id. An anchor without same-label rows, or a positive without rows in its band, gives
    no rows; an empty table gives none. Scores beyond 64 bits raise. Returns ``anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score``.
    """
    spark = embeddings.sparkSession
    path = new_folder(spark, "hard-negatives")
    _valid(embeddings).write.parquet(path)
    def read() -> DataFrame:
        # Each use reads the staged rows anew, so that the passes never join a plan with itself.
        return spark.read.schema(_CAND).parquet(path)

    def anchors() -> DataFrame:
        rows = read().where(F.col("vec_id") % ANCHOR_EVERY == 0).dropDuplicates(["vec_id", "label", "vector"])
        return rows.select(_anchor_key().alias("akey"), "vec_id", "label", "vector")

    n_rows, n_anchors = read().count(), anchors().count()
    if not n_rows or not n_anchors:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    blocks = -(-n_anchors // ANCHOR_BLOCK)
    groups = -(-n_rows // GROUP_ROWS)

    # Both sides of a cogroup are dealt by the hash of their keys, which depends on the key's type.
    def dealt(key: str, n: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def candidates() -> DataFrame:
        return read().withColumn("g", dealt("row", groups)).withColumn("b", each(blocks))

    def placed() -> DataFrame:
        return anchors().withColumn("b", dealt("akey", blocks)).withColumn("g", each(groups))

    keys = ["b", "g"]
    local = (
        candidates().groupBy(*keys)
        .cogroup(placed().groupBy(*keys))
        .applyInPandas(_local_positives, "akey long, anchor_id long, prow long, positive_id long, positive_score long")
    )
    first = Window.partitionBy("akey").orderBy(F.desc("positive_score"), "positive_id", "prow")
    positives = local.withColumn("n", F.row_number().over(first)).where(F.col("n") <= POSITIVES)
    lists = positives.groupBy("akey").agg(
        F.collect_list(F.struct("prow", "positive_id", "positive_score")).alias("positives")
    )
    asked = placed().join(lists, "akey")
    found = (
        candidates().groupBy(*keys)
        .cogroup(asked.groupBy(*keys))
        .applyInPandas(
            _local_negatives,
            "akey long, anchor_id long, prow long, positive_id long, positive_score long, negative_id long, negative_score long",
        )
    )
    order = Window.partitionBy("akey", "prow").orderBy(F.desc("negative_score"), "negative_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= NEGATIVES)
        .select("anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id", "positive_score", "negative_score")
    )


SQL = """
WITH e AS (
    SELECT row_number() OVER () AS rid, vec_id,
           CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
a AS (SELECT DISTINCT vec_id, label, v FROM e WHERE vec_id % 100 = 0),
s AS (
    SELECT a.vec_id AS anchor_id, a.v AS av, a.label AS alabel, e.rid, e.vec_id AS cid, e.label AS clabel,
           coalesce(list_sum(list_transform(list_zip(a.v, e.v), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))), 0) AS score
    FROM a CROSS JOIN e
),
pos AS (
    SELECT anchor_id, av, alabel, rid AS prid, cid AS positive_id, score AS positive_score FROM (
        SELECT *, row_number() OVER (PARTITION BY anchor_id, av, alabel ORDER BY score DESC, cid) AS r
        FROM s WHERE clabel = alabel AND cid <> anchor_id
    ) WHERE r <= 5
),
neg AS (
    SELECT p.anchor_id, p.positive_id, p.positive_score, s.cid AS negative_id, s.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, p.av, p.alabel, p.prid ORDER BY s.score DESC, s.cid) AS rank
    FROM pos p JOIN s ON s.anchor_id = p.anchor_id AND s.av = p.av AND s.alabel = p.alabel
    WHERE s.clabel <> s.alabel AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id,
       CAST(positive_score AS BIGINT) AS positive_score, CAST(negative_score AS BIGINT) AS negative_score
FROM neg WHERE rank <= 10
"""
