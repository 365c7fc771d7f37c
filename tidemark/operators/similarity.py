"""Exact similarity join of unit vectors, without a cross join.

Two ways to bring close vectors together; neither misses a pair.

``cells``, for dense vectors. ``cos(x, y) >= t`` is ``|x - y| <= eps`` with
``eps = sqrt(2 - 2t)``. The vectors are split into cells around pivot vectors, each at home in
the cell of its nearest pivot. A vector also visits each lower-numbered cell that could hold a
partner, by two bounds (triangle inequality): it lies within ``eps`` of the hyperplane between
the two pivots, and its angle to that cell's pivot is at most the cell's radius plus
``arccos(t)``. How much this prunes depends on the data: with no cluster structure at all every
vector visits most cells, and the work nears that of all comparisons.

``keys``, for sparse vectors such as hashed words. If ``x . y >= t``, the dimensions of ``x``
that ``y`` lacks hold at most ``1 - t*t`` of its squared length. So both vectors can name the
first few dimensions they share, in one global order, by skipping no more than that. Each vector
emits every such short list as a key; at high thresholds that is one key or a handful, and the
work stays near linear.

Neighbouring cells form groups. A vector is sent once to a group with the list of its cells that
it visits, not once to each of them, so few copies of vectors move. Either way a group or key is
cut into blocks of bounded size by a hash of the id, and a task compares two blocks, cell by cell,
in matrix products of bounded tiles: a cell holding a third of all vectors becomes many tasks of
equal size. Where every pair is asked for, each row is placed and compared as it is, so a vector
that many rows hold fills blocks like any other. Links need less: equal vectors are collapsed
beforehand, and are linked to one representative instead of to each other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.shaping import keep_first
from tidemark.session import stage

BLOCK_ROWS = 4096
MAX_CELLS = 1024
KEY_DIMS = 3
#: Cells of one group, and the rows of one side of a task over cells, in units of ``block_rows``.
GROUP_CELLS, TASK_BLOCKS = 4, 8
#: Vectors placed at once, sides of one matrix product, and pairs that a task holds before it sends them.
PLACE_ROWS, TILE_LEFT, TILE_RIGHT, HELD_PAIRS = 1024, 1024, 4096, 1 << 20
_SLACK = 1e-4  # float32 rounding of "unit" vectors; widens the bounds, never the result


@dataclass(frozen=True)
class _Cells:
    """The pivots, as plain arrays; at most MAX_CELLS of them."""

    pivots: np.ndarray
    eps: float
    theta: float

    def dots(self, vectors: pa.Array) -> Iterator[tuple[slice, np.ndarray]]:
        """Products with all pivots, for runs of at most PLACE_ROWS vectors."""
        flat = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), self.pivots.shape[1])
        for start in range(0, len(flat), PLACE_ROWS):
            at = slice(start, start + PLACE_ROWS)
            yield at, flat[at].astype(np.float64) @ self.pivots.T

    def home(self, vector: Column) -> Column:
        """(cell, angle to its pivot) of each vector."""
        kind = T.StructType(
            [T.StructField("cell", T.IntegerType()), T.StructField("angle", T.DoubleType())]
        )

        @F.arrow_udf(kind)
        def assign(vectors: pa.Array) -> pa.Array:
            cell, angle = np.empty(len(vectors), np.int32), np.empty(len(vectors))
            for at, dots in self.dots(vectors):
                cell[at] = dots.argmax(axis=1)
                angle[at] = np.arccos(np.clip(dots.max(axis=1), -1.0, 1.0))
            return pa.StructArray.from_arrays([pa.array(cell), pa.array(angle)], ["cell", "angle"])

        return assign(vector)

    def visits(self, vector: Column, cell: Column, radii: np.ndarray) -> Column:
        """The lower cells a vector must visit, one list per group of cells."""
        gaps = np.sqrt(
            np.maximum(2.0 - 2.0 * self.pivots @ self.pivots.T, 1e-12)
        )

        @F.arrow_udf(T.ArrayType(T.ArrayType(T.IntegerType())))
        def reach(vectors: pa.Array, homes: pa.Array) -> pa.Array:
            all_homes, found = homes.to_numpy(), []
            for at, dots in self.dots(vectors):
                own = all_homes[at]
                to_plane = (dots[np.arange(len(own)), own][:, None] - dots) / gaps[own]
                angle = np.arccos(np.clip(dots, -1.0, 1.0))
                near = (to_plane <= self.eps) & (angle <= radii[None, :] + self.theta)
                near &= np.arange(dots.shape[1])[None, :] < own[:, None]
                rows, cells = np.nonzero(near)
                found.append((rows + at.start, cells.astype(np.int32)))
            rows = np.concatenate([np.zeros(0, np.int64), *(r for r, _ in found)])
            cells = np.concatenate([np.zeros(0, np.int32), *(c for _, c in found)])
            # Rows and cells ascend, so a list starts wherever the row or the group changes.
            group = cells // GROUP_CELLS
            starts = np.ones(len(rows), bool)
            starts[1:] = (rows[1:] != rows[:-1]) | (group[1:] != group[:-1])
            inner = np.append(np.flatnonzero(starts), len(rows))
            outer = np.concatenate([[0], np.cumsum(np.bincount(rows[starts], minlength=len(vectors)))])
            lists = pa.ListArray.from_arrays(pa.array(inner.astype(np.int32)), pa.array(cells))
            return pa.ListArray.from_arrays(pa.array(outer.astype(np.int32)), lists)

        return reach(vector, cell)


@F.arrow_udf(T.BinaryType())
def _vector_bytes(vectors: pa.Array) -> pa.Array:
    # Adding zero turns -0.0 into 0.0, so equal vectors have equal bytes.
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float32) + np.float32(0.0)
    rows = flat.reshape(len(vectors), -1)
    return pa.array([r.tobytes() if r.any() else None for r in rows], pa.binary())


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _nonzero_dims(vectors: pa.Array) -> pa.Array:
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    rows, dims = np.nonzero(flat.reshape(len(vectors), -1))
    offsets = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(vectors)))])
    return pa.ListArray.from_arrays(
        pa.array(offsets.astype(np.int32)), pa.array(dims.astype(np.int32))
    )


def comparable_rows(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, vector) of the rows that can be in a pair: a row without an id, without a vector or
    with a component that is no finite number has no similarity to any other."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vector).alias("vector"))
    finite = F.forall("vector", lambda x: F.abs(x) < F.lit(math.inf))  # null for a null, false for NaN
    return rows.where(F.col("id").isNotNull() & finite)


def with_vector_key(df: DataFrame) -> DataFrame:
    """Add a digest that equal vectors share; zero vectors, similar to nothing, are left out."""
    bytes_key = F.sha2(_vector_bytes(F.col("vector")), 256)
    return df.withColumn("vector_key", bytes_key).where(F.col("vector_key").isNotNull())


def distinct_vectors(keyed: DataFrame) -> DataFrame:
    """One row per distinct vector, the smallest id as its representative."""
    return keep_first(keyed, ["vector_key"], ["id"])


def _blocks(rows: str, block_rows: int) -> Column:
    return F.ceil(F.coalesce(F.col(rows), F.lit(0)) / block_rows).cast("int")


def _cell_members(
    vectors: DataFrame, threshold: float, block_rows: int
) -> tuple[DataFrame, DataFrame]:
    """(id, vector, row, place, cells, at_home) rows, and the block counts of each place, a group of
    cells. ``row`` is a number of the row's own, as ids may repeat."""
    n_cells = max(1, min(MAX_CELLS, vectors.count() // block_rows))
    # Any distinct vectors can be pivots; the result does not depend on which.
    sampled = vectors.orderBy(F.xxhash64("id"), "id").limit(n_cells).select("vector").collect()
    chosen = list(dict.fromkeys(tuple(row[0]) for row in sampled))
    if n_cells == 1:  # fewer rows than two blocks hold
        members = _at_one_place(vectors.withColumn("row", F.lit(0)).withColumn("place", F.lit(0)))
    else:
        cells = _Cells(
            pivots=np.array(chosen, dtype=np.float64),
            eps=math.sqrt(2.0 - 2.0 * threshold) + _SLACK,
            theta=math.acos(threshold) + _SLACK,
        )
        homes = vectors.withColumn("home", cells.home(F.col("vector")))
        homes = homes.select("id", "vector", F.monotonically_increasing_id().alias("row"), "home.*")
        homes = stage(homes, "homes")
        radii = np.full(len(chosen), -np.inf)
        for cell, radius in homes.groupBy("cell").agg(F.max("angle")).collect():  # <= MAX_CELLS
            radii[cell] = radius
        visits = cells.visits(F.col("vector"), F.col("cell"), radii)
        # One row per vector is staged; its copies for the groups are made where they are sent.
        placed = stage(homes.select("id", "vector", "row", "cell", visits.alias("visits")), "placed")

        def stay(some_cells: Column, at_home: bool) -> Column:
            place = F.floor(some_cells[0] / GROUP_CELLS).cast("int")
            return F.struct(place.alias("place"), some_cells.alias("cells"), F.lit(at_home).alias("at_home"))

        stays = F.concat(
            F.array(stay(F.array("cell"), True)), F.transform("visits", lambda some: stay(some, False))
        )
        members = placed.select("id", "vector", "row", F.explode(stays).alias("m")).select("id", "vector", "row", "m.*")
    sizes = members.groupBy("place").agg(
        F.count_if("at_home").alias("h"), F.count_if(~F.col("at_home")).alias("v")
    )
    counts = sizes.select(
        "place",
        _blocks("h", TASK_BLOCKS * block_rows).alias("home_blocks"),
        _blocks("v", TASK_BLOCKS * block_rows).alias("visit_blocks"),
    )
    return members, F.broadcast(counts)  # at most MAX_CELLS rows


def _at_one_place(vectors: DataFrame) -> DataFrame:
    """Rows at home at their place, which is one cell."""
    return vectors.withColumn("cells", F.array(F.lit(0))).withColumn("at_home", F.lit(True))


def _shared_first_keys(
    dims: np.ndarray, energy: np.ndarray, budget: float, base: int
) -> list[int]:
    """Every list of the first KEY_DIMS dimensions (fewer at the end) reached by skipping at
    most ``budget`` of the squared length, as numbers."""
    keys: list[int] = []

    def walk(at: int, key: int, size: int, skipped: float) -> None:
        if size == KEY_DIMS or at == len(dims):
            if size:
                keys.append(key)
            return
        walk(at + 1, key * base + int(dims[at]) + 1, size + 1, skipped)
        if skipped + energy[at] <= budget:
            walk(at + 1, key, size, skipped + energy[at])

    walk(0, 0, 0, 0.0)
    return keys


def _key_members(
    vectors: DataFrame, threshold: float, block_rows: int
) -> tuple[DataFrame, DataFrame]:
    """(id, vector, row, place, cells, at_home) rows with a key as the place, and the block counts."""
    used = vectors.select(F.explode(_nonzero_dims(F.col("vector"))).alias("dim"))
    # At most one row per dimension: rare dimensions come first, they split best.
    counts = used.groupBy("dim").count().orderBy("count", "dim").collect()
    rank = np.zeros(max((row["dim"] for row in counts), default=0) + 1, dtype=np.int64)
    for position, row in enumerate(counts):
        rank[row["dim"]] = position
    budget, base = 1.0 - threshold * threshold + _SLACK, len(rank) + 1

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def keys_of(batch: pa.Array) -> pa.Array:
        matrix = batch.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        matrix = matrix.reshape(len(batch), -1)
        rows = []
        for row in matrix:
            nonzero = np.nonzero(row)[0]
            dims = rank[nonzero]
            order = np.argsort(dims)
            energy = (row[nonzero] ** 2)[order]
            rows.append(_shared_first_keys(dims[order], energy, budget, base))
        return pa.array(rows, pa.list_(pa.int64()))

    keyed = vectors.withColumn("row", F.monotonically_increasing_id()).withColumn("keys", keys_of(F.col("vector")))
    keyed = stage(keyed, "keys")
    members = _at_one_place(keyed.select("id", "vector", "row", F.explode(F.array_distinct("keys")).alias("place")))
    shared = members.groupBy("place").agg(F.count("*").alias("h")).where(F.col("h") > 1)
    sizes = shared.select(
        "place", _blocks("h", block_rows).alias("home_blocks"), F.lit(0).alias("visit_blocks")
    )
    return members, sizes


def _block_tasks(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """(place, kind, i, j, side, id, vector, cells) rows; a task holds about two blocks of vectors."""

    def task(kind: int, i: Column, j: Column, side: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), i.cast("int").alias("i"), j.cast("int").alias("j"),
            side.cast("int").alias("side"),
        )

    def upto(count: Column) -> Column:
        return F.filter(F.sequence(F.lit(0), count), lambda k: k < count)

    own_home = F.pmod(F.xxhash64("row"), "home_blocks").cast("int")
    own_visit = F.pmod(F.xxhash64("row"), F.greatest("visit_blocks", F.lit(1))).cast("int")
    among_home = F.transform(
        upto(F.col("home_blocks")),
        lambda k: task(0, F.least(own_home, k), F.greatest(own_home, k), own_home > k),
    )
    home_to_visit = F.transform(
        upto(F.col("visit_blocks")), lambda k: task(1, own_home, k, F.lit(0))
    )
    visit_to_home = F.transform(
        upto(F.col("home_blocks")), lambda k: task(1, k, own_visit, F.lit(1))
    )
    tasks = F.when(F.col("at_home"), F.concat(among_home, home_to_visit)).otherwise(visit_to_home)
    return (
        members.join(sizes, "place")
        .select("place", F.explode(tasks).alias("task"), "id", "vector", "cells")
        .select("place", "task.*", "id", "vector", "cells")
    )


def _by_cell(cells: pa.Array, chosen: np.ndarray) -> dict[int, np.ndarray]:
    """Positions of the chosen rows, by each of the cells they list."""
    owner = np.repeat(np.arange(len(cells)), pa.compute.list_value_length(cells).to_numpy())
    cell = cells.flatten().to_numpy(zero_copy_only=False)
    owner, cell = owner[chosen[owner]], cell[chosen[owner]]
    order = np.argsort(cell, kind="stable")
    found, starts = np.unique(cell[order], return_index=True)
    return dict(zip(found.tolist(), np.split(owner[order], starts[1:])))


def _close_pairs(block: pa.Table, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Positions and similarities of the close pairs of one task, tile by tile."""
    vectors, cells = block["vector"].combine_chunks(), block["cells"].combine_chunks()
    matrix = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), len(vectors[0]))
    side = block["side"].to_numpy()
    kind, i, j = (block[c][0].as_py() for c in ("kind", "i", "j"))
    among = kind == 0 and i == j
    lefts = _by_cell(cells, np.ones(len(side), bool) if among else side == 0)
    rights = lefts if among else _by_cell(cells, side == 1)
    for cell in lefts.keys() & rights.keys():
        left, right = lefts[cell], rights[cell]
        for c in range(0, len(right), TILE_RIGHT):
            some = right[c : c + TILE_RIGHT]
            columns = matrix[some].astype(np.float64).T
            for r in range(0, len(left), TILE_LEFT):
                if among and left[r] >= some[-1]:
                    break  # positions ascend: the rest is below the diagonal
                at = left[r : r + TILE_LEFT]
                sims = matrix[at].astype(np.float64) @ columns
                close = sims >= threshold
                # A tile of copies is all pairs: it is listed a few rows at a time.
                few = len(at) if np.count_nonzero(close) <= HELD_PAIRS else max(1, HELD_PAIRS // len(some))
                for f in range(0, len(at), few):
                    rows, cols = np.nonzero(close[f : f + few])
                    found = at[f + rows], some[cols], sims[f + rows, cols]
                    if among:
                        once = found[0] < found[1]
                        found = tuple(x[once] for x in found)
                    if len(found[0]):
                        yield found


def _pairs_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("left_id", id_type),
            T.StructField("right_id", id_type),
            T.StructField("similarity", T.DoubleType()),
            T.StructField("connects", T.BooleanType()),
        ]
    )


def _pair_table(ids, left, right, sims, connects) -> pa.Table:
    a, b = ids.take(pa.array(left)), ids.take(pa.array(right))
    swap = pa.compute.greater(a, b)
    return pa.table(
        {
            "left_id": pa.compute.if_else(swap, b, a),
            "right_id": pa.compute.if_else(swap, a, b),
            "similarity": pa.array(sims, pa.float64(), mask=np.isnan(sims)),
            "connects": pa.array(connects, pa.bool_()),
        }
    )


def _spanning_links(n: int, left: np.ndarray, right: np.ndarray, sims: np.ndarray):
    """Links with the same connected groups as the pairs, at most two per node.

    A star around the smallest position of each group, plus the closest pair of each group.
    """
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    order = np.lexsort((right, left, -sims, label[left]))
    _, first = np.unique(label[left][order], return_index=True)
    best = order[first]
    spokes = np.nonzero(label != np.arange(n))[0]
    return (
        np.concatenate([label[spokes], left[best]]),
        np.concatenate([spokes, right[best]]),
        np.concatenate([np.full(len(spokes), np.nan), sims[best]]),
        np.concatenate([np.ones(len(spokes), bool), np.zeros(len(best), bool)]),
    )


def _join(
    vectors: DataFrame, threshold: float, method: str, block_rows: int, *, links: bool
) -> DataFrame:
    if not 0.0 < threshold <= 1.0:
        raise ValueError("threshold must be in (0, 1]")
    place = {"cells": _cell_members, "keys": _key_members}[method]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = pa.Table.from_batches(list(batches)).combine_chunks()  # one task: about two blocks
        ids, held, size = block["id"], [], 0
        names = ids.combine_chunks().dictionary_encode()
        repeated, code = len(names.dictionary) < len(ids), names.indices.to_numpy()

        def together():
            return [np.concatenate(part) for part in zip(*held)]

        for found in _close_pairs(block, threshold):
            if repeated:  # rows of one id are no pair
                apart = code[found[0]] != code[found[1]]
                found = tuple(x[apart] for x in found)
            held.append(found)
            size += len(found[0])
            if size < HELD_PAIRS:
                continue
            if links:  # at most two links per vector stand for the pairs so far
                held = [_spanning_links(len(ids), *together())[:3]]
                size = len(held[0][0])
            else:
                yield from _pair_table(ids, *together(), np.ones(size, bool)).to_batches()
                held, size = [], 0
        if held:
            pairs = together()
            if links:
                *pairs, connects = _spanning_links(len(ids), *pairs)
            else:
                connects = np.ones(size, bool)
            yield from _pair_table(ids, *pairs, connects).to_batches()

    schema = _pairs_schema(vectors.schema["id"].dataType)
    return (
        _block_tasks(*place(vectors, threshold, block_rows))
        .groupBy("place", "kind", "i", "j")
        .applyInArrow(compare, schema)
    )


def _copies(keyed: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """Each copy of a vector linked to its representative.

    The representatives are unique, so a vector holding a third of the rows is a skewed probe
    side, which AQE splits.
    """
    length = F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x)
    heads = reps.select("vector_key", F.col("id").alias("left_id"), length.alias("similarity"))
    return (
        keyed.select("vector_key", F.col("id").alias("right_id"))
        .join(heads, "vector_key")
        .where(F.col("left_id") != F.col("right_id"))
        .where(F.col("similarity") >= threshold)
        .select("left_id", "right_id", "similarity", F.lit(True).alias("connects"))
    )


def _pairs_and_copies(
    df: DataFrame, id_col: str, vector: str, threshold: float, method: str, block_rows: int,
    *, links: bool,
) -> DataFrame:
    keyed = with_vector_key(comparable_rows(df, id_col, vector))
    reps = stage(distinct_vectors(keyed), "vectors")
    distinct = reps.select("id", "vector")
    pairs = _join(distinct, threshold, method, block_rows, links=links)
    if keyed.count() == reps.count():
        return pairs
    return pairs.unionByName(_copies(keyed, reps, threshold))


def _row_pairs(
    df: DataFrame, id_col: str, vector: str, threshold: float, method: str, block_rows: int
) -> DataFrame:
    """Every pair of rows with different ids at or above the threshold, once per pair of rows."""
    rows = comparable_rows(df, id_col, vector).where(F.exists("vector", lambda x: x != 0))
    if method == "cells":  # two rows share only one cell
        rows = stage(rows, "vectors")
        return _join(rows, threshold, method, block_rows, links=False).drop("connects")
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    numbered = rows.select(F.col("row").alias("id"), "vector")
    met = _join(numbered, threshold, method, block_rows, links=False).drop("connects")
    met = met.dropDuplicates(["left_id", "right_id"])  # two rows can share several keys
    for side in ("left", "right"):
        met = met.join(rows.select(F.col("row").alias(f"{side}_id"), F.col("id").alias(side)), f"{side}_id")
    return met.where(F.col("left") != F.col("right")).select(
        F.least("left", "right").alias("left_id"), F.greatest("left", "right").alias("right_id"), "similarity"
    )


def similar_pairs(
    df: DataFrame,
    *,
    id_col: str,
    vector: str,
    threshold: float,
    method: str = "cells",
    block_rows: int = BLOCK_ROWS,
    every_copy: bool = False,
) -> DataFrame:
    """All pairs at or above the threshold. Vectors must have unit length.

    With ``every_copy`` these are all pairs of rows with different ids, one row per pair of rows;
    a vector that m rows hold makes m (m - 1) / 2 pairs by itself. Without it the pairs are those
    of distinct vectors: the representative (smallest id) stands for the copies of a vector, which
    are paired with it alone.
    """
    if every_copy:
        return _row_pairs(df, id_col, vector, threshold, method, block_rows)
    pairs = _pairs_and_copies(df, id_col, vector, threshold, method, block_rows, links=False)
    pairs = pairs.drop("connects")
    # Two vectors can share several keys, but only one cell.
    return pairs.dropDuplicates(["left_id", "right_id"]) if method == "keys" else pairs


def similarity_links(
    df: DataFrame,
    *,
    id_col: str,
    vector: str,
    threshold: float,
    method: str = "cells",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Links with the same connected groups and the same best similarity per group as all pairs.

    Each task sends a number of links linear in its vectors, even when all of them are close.
    The links with ``connects`` make up the groups; the others, and copies, carry the
    ``similarity``. Vectors must have unit length.
    """
    return _pairs_and_copies(df, id_col, vector, threshold, method, block_rows, links=True)
