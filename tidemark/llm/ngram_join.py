"""N-gram Jaccard join by T-occurrence search: which texts share enough of their shingles.

A text is the set of hashes of its word shingles. Two sets with Jaccard similarity of at least
``NUM / DEN`` share at least that part of the larger one, so if each set keeps a little more than
the rest of its shingles in hash order, the two kept parts share a known number T of shingles.

The kept shingles are the inverted lists. Spark counts them; a list of one set is dropped at
once, and so are sets that share fewer than T of their shingles with any others. Of the rest each
set merges only its shortest lists, as many as T leaves open, and skips the long ones: a partner
must stand in one of the short lists. The skipped lists are probed by binary search in the
candidate's sorted shingles, which gives the exact overlap, and pairs that reach the required
overlap are retained.

Only connected groups are asked for, so short lists are merged in rounds. First each set of a
list is paired with the one of a similar size that has the most common shingles: linear work that
connects copies. Then only lists that still hold several groups are searched for near sets of
different groups, with exact bounds on sizes and on differing shingles; lists with the same
smallest set are made one, so that a set is sent once for them all. A list hands on which of
its sets such pairs connect, a pair a set at most and not all pairs. The sets so connected over
all lists meet once more, whole, and links are verified where they meet until no two groups are
left that one could connect.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import windows
from tidemark.llm.common import fresh, stage, text_or_empty
from tidemark.llm.repeats import id_back, id_key, keyed, maybe_touched
from tidemark.operators.clusters import connected_labels
from tidemark.session import delete_folder, stage_to

#: Words in a shingle, and the similarity of a link as a fraction.
SHINGLE = 5
NUM, DEN = 3, 4
#: What two linked sets share at least in what they keep: so many shingles, and one in so many of
#: the set. The number keeps a common line or two from making short texts candidates of each other.
SHARED_LEAST, SHARED_PART = 12, 20
#: A shingle in more kept sets of one Arrow batch is long for certain: the batch sends one row
#: for it instead of one per set.
LONG_IN_BATCH = 64
#: Sets that are searched together, and their shingles where whole sets are.
BLOCK, BLOCK_SHINGLES = 4096, 1 << 21
#: Pairs that a task holds to make them distinct.
HELD_PAIRS = 1_000_000
_LONG = 1 << 62
_BYTES = ("bits", "shingles")
_CACHE_WORDS = 500_000


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str, hashes: dict | None = None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles; A-Z count as lower case."""
    hashes = _Words() if hashes is None else hashes
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    symbols = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    ranges = windows.RangeHash(symbols)
    if len(words) < size:  # the whole sequence, told apart from shingles by its length
        return windows.mixed(ranges.every(len(words)) + np.uint64(len(words)))
    return np.unique(windows.mixed(ranges.every(size)))


def _set_id(shingles: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes()))))


def least_overlap(n: int) -> int:
    """Shingles that a set of ``n`` shares with any linked set, at least."""
    return (NUM * n + DEN - 1) // DEN


def kept_shared(n: int) -> int:
    """T for sets of ``n``: what the kept parts of linked sets share, for the smaller ``n``."""
    return min(least_overlap(n), SHARED_LEAST + n // SHARED_PART)


def kept_size(n: int) -> int:
    return min(n, n - least_overlap(n) + kept_shared(n))


def _scan(rows: DataFrame) -> DataFrame:
    """Rows of two kinds: documents (``id, row, n, set``) and kept shingles (``set, n, shingle, long``).

    A row of a long shingle without a set marks the shingle as long everywhere.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Words()
        names = ["id", "row", "n", "set", "shingle", "long"]
        for batch in batches:
            sets = [shingle_set(t, hashes) for t in batch.column(2).to_pylist()]
            ids = [_set_id(s) if len(s) else None for s in sets]
            sizes = pa.array([len(s) for s in sets], pa.int32())
            none = pa.nulls(len(sets), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), sizes, pa.array(ids, pa.int64()), none, none.cast(pa.bool_())], names=names
            )
            first = {i: s for i, s in zip(ids, sets, strict=True) if i is not None}
            if not first:
                continue
            kept = [s[: kept_size(len(s))] for s in first.values()]
            counts = np.array([len(k) for k in kept])
            shingle = np.concatenate(kept)
            owner = np.repeat(np.array(list(first), np.int64), counts)
            size = np.repeat(np.array([len(s) for s in first.values()]), counts)
            values, times = np.unique(shingle, return_counts=True)
            long = values[times > LONG_IN_BATCH]
            flags = np.isin(shingle, long)
            parts = [(owner, size, shingle, flags), (np.zeros(len(long), np.int64), np.zeros(len(long), np.int64), long, None)]
            for own, n, which, flag in parts:
                if len(which):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.nulls(len(which), pa.int64()),
                            pa.nulls(len(which), pa.int64()),
                            pa.array(n).cast(pa.int32()),
                            pa.array(own) if flag is not None else pa.nulls(len(which), pa.int64()),
                            pa.array(which.view(np.int64)),
                            pa.array(flag) if flag is not None else pa.array(np.ones(len(which), bool)),
                        ],
                        names=names,
                    )

    return rows.mapInArrow(run, "id long, row long, n int, set long, shingle long, long boolean")


def _short_lists(kept: DataFrame) -> DataFrame:
    """``set, n, weight, shingle``: the shortest lists of every set that can have a partner."""
    of_shingle = Window.partitionBy("shingle")
    # Rows of sets in long lists need no count; the marker rows carry the news to all others.
    here = kept.where("NOT long OR set IS NULL").select(
        "set",
        "n",
        "shingle",
        F.count("set").over(of_shingle).alias("length"),
        (F.min("set").over(of_shingle) < F.max("set").over(of_shingle)).alias("several"),
        F.max("long").over(of_shingle).alias("is_long"),
    )
    counted = here.where("set IS NOT NULL AND (several OR is_long)").select(
        "set", "n", F.struct(F.when(F.col("is_long"), F.lit(_LONG)).otherwise(F.col("length")).alias("length"), "shingle").alias("entry")
    )
    long = kept.where("long AND set IS NOT NULL").select("set", "n", F.struct(F.lit(_LONG).alias("length"), "shingle").alias("entry"))
    # Between sets of n and of at least 3/4 n shingles T is that of the smaller.
    smallest = f"(({NUM} * n + {DEN - 1}) div {DEN})"
    overlap = f"(({NUM} * {smallest} + {DEN - 1}) div {DEN})"
    needed = F.expr(f"cast(least({overlap}, {SHARED_LEAST} + {smallest} div {SHARED_PART}) AS int)")
    # The weight is how common a set's shingles are: a text that many others are copies of has most.
    # It is summed with the lists, as an expression beside the explode would run for each list.
    sets = counted.unionByName(long).groupBy("set", "n").agg(
        F.sort_array(F.collect_set("entry")).alias("entries"), (F.sum(F.log("entry.length")) / F.col("n")).alias("weight")
    )
    open_lists = F.slice("entries", 1, F.size("entries") - needed + 1)
    found = sets.where(F.size("entries") >= needed).select("set", "n", "weight", F.explode(open_lists).alias("e"))
    return found.select("set", "n", "weight", "e.shingle")


def _star_pairs(lists: DataFrame) -> DataFrame:
    """Each set with the heaviest set of its list in its band of sizes; linear in the lists.

    There are two series of bands, half a band apart, so no size is on the edge of both.
    """
    place = F.log("n") / F.log(F.lit(DEN / NUM))
    bands = F.explode(F.array(F.floor(place) * 2, F.floor(place + 0.5) * 2 + 1)).alias("band")
    banded = lists.select("shingle", "set", "weight", bands)
    center = banded.groupBy("shingle", "band").agg(F.max(F.struct("weight", "set")).alias("c"))
    pairs = banded.join(center, ["shingle", "band"]).where("c.set <> set")
    return pairs.select(F.least("set", "c.set").alias("a"), F.greatest("set", "c.set").alias("b")).distinct()


def parity_bits(shingles: np.ndarray) -> bytes:
    """A bit per hash bin, the parity of the shingles in it; two bins a shingle, rounded up.

    The bits of two sets differ in no more bins than they differ in shingles, as shared ones
    cancel. Folding the halves onto each other gives the bits for half the bins.
    """
    bins = 2 << max(6, (len(shingles) - 1).bit_length())
    odd = np.bincount((shingles >> np.uint64(20)).astype(np.int64) & (bins - 1), minlength=bins) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _near(sizes: np.ndarray, labels: np.ndarray, bits: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """Each place with the later ones of other groups that the sizes and the parity bits allow.

    The sets come in rising size.
    """
    last = np.searchsorted(sizes * NUM, sizes * DEN, side="right")
    change = np.append(np.flatnonzero(labels[1:] != labels[:-1]) + 1, len(labels))
    other = change[np.searchsorted(change, np.arange(len(labels)), side="right").clip(max=len(change) - 1)]
    places = np.flatnonzero(other < last)
    if not len(places):
        return
    width = np.array([len(b) for b in bits]) // 8
    table = {w: np.frombuffer(b"".join(bits[i] for i in np.flatnonzero(width == w)), np.uint64).reshape(-1, w) for w in np.unique(width)}
    start = {w: int(np.searchsorted(width, w)) for w in table}
    half = {w: t[:, : w // 2] ^ t[:, w // 2 :] for w, t in table.items() if w > 1}
    for i in places.tolist():
        w = int(width[i])
        own = table[w][i - start[w]]
        most = (DEN - NUM) * (sizes[i] + sizes[i + 1 : last[i]]) // (DEN + NUM)
        edge = start[w] + len(table[w])
        parts = [np.bitwise_count(table[w][i + 1 - start[w] : min(last[i], edge) - start[w]] ^ own).sum(axis=1)]
        if last[i] > edge:  # sizes of up to 4/3 can only reach the next width
            parts.append(np.bitwise_count(half[2 * w][: last[i] - edge] ^ own).sum(axis=1))
        good = np.flatnonzero((np.concatenate(parts) <= most) & (labels[i + 1 : last[i]] != labels[i])) + i + 1
        if len(good):
            yield i, good


def near_in_list(sets: np.ndarray, sizes: np.ndarray, labels: np.ndarray, bits: list[bytes]) -> np.ndarray:
    """Sets of one list that near sets of other groups connect, each with the smallest of those.

    A set is in one pair at most, however many are near it.
    """
    order = np.lexsort((sets, sizes))
    sets, part = sets[order], np.arange(len(sets))
    for i, good in _near(sizes[order], labels[order], [bits[k] for k in order]):
        part = _joined(part, np.append(part[good], part[i]))
    lowest = np.full(len(sets), np.iinfo(np.int64).max)
    np.minimum.at(lowest, part, sets)
    pairs = np.c_[lowest[part], sets]
    return pairs[pairs[:, 0] != pairs[:, 1]]


def linked_in_part(sets: np.ndarray, labels: np.ndarray, bits: list[bytes], shingles: list[np.ndarray]) -> np.ndarray:
    """Links that connect what whole sets of different groups connect: fewer than there are sets."""
    sizes = np.array([len(s) for s in shingles], np.int64)
    order = np.lexsort((sets, sizes))
    sets, sizes, labels = sets[order], sizes[order], labels[order]
    part, found = np.unique(labels, return_inverse=True)[1], []
    for i, good in _near(sizes, labels, [bits[k] for k in order]):
        good = good[part[good] != part[i]]  # the others are connected by now
        if not len(good):
            continue
        own, ends = shingles[order[i]], np.cumsum(sizes[good])
        others = np.concatenate([shingles[k] for k in order[good]])
        same = own[np.minimum(np.searchsorted(own, others), len(own) - 1)] == others
        shared = np.add.reduceat(same.astype(np.int64), ends - sizes[good])
        good = good[DEN * shared >= NUM * (sizes[i] + sizes[good] - shared)]
        parts, first = np.unique(part[good], return_index=True)
        if len(parts):
            found.append(np.c_[np.full(len(parts), sets[i]), sets[good[first]]])
            part = _joined(part, np.append(parts, part[i]))
    pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
    return np.sort(pairs, axis=1)


def _joined(part: np.ndarray, met: np.ndarray) -> np.ndarray:
    """``part`` with the parts that have met made one."""
    met = np.unique(met)
    return part if len(met) < 2 else np.where(np.isin(part, met), met[0], part)


def _whole_lists(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Sorted batches as tables that never end inside a list."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.c_[tuple(batch.column(k).to_numpy() for k in keys)]
        others = np.flatnonzero((key != key[-1]).any(axis=1))
        cut = int(others[-1]) + 1 if len(others) else 0
        if cut:
            yield pa.Table.from_batches([*kept, batch.slice(0, cut)])
            kept = []
        elif kept and any(kept[-1].column(k)[-1] != batch.column(k)[0] for k in keys):
            yield pa.Table.from_batches(kept)
            kept = []
        kept.append(batch.slice(cut))
    if kept:
        yield pa.Table.from_batches(kept)


def _pair_batch(found: list[np.ndarray]) -> pa.RecordBatch:
    pairs = np.unique(np.concatenate(found), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _in_blocks(rows: DataFrame, key: str, search: Callable[[dict], np.ndarray]) -> DataFrame:
    """The distinct pairs ``search`` finds in the rows of one ``key``, each row with the ``k`` of its key.

    The rows of a key are dealt to ``k`` blocks by a hash of their set; each block meets itself and
    every other one in a task's memory.
    """
    names = [c for c in rows.columns if c != "k"]
    rows = rows.withColumn("own", F.expr("pmod(xxhash64(set), k)"))
    met = rows.select(*names, "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)).alias("other"))
    met = met.select(F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), *names)
    keys = [key, "lo", "hi"]
    dealt = met.repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for table in _whole_lists(batches, keys):
            columns = {c: table.column(c).to_pylist() if c in _BYTES else table.column(c).to_numpy() for c in table.column_names}
            at = np.c_[tuple(columns[k] for k in keys)]
            cuts = np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1
            for i, j in zip([0, *cuts], [*cuts, len(at)], strict=True):
                if j - i > 1:
                    found.append(search({c: values[i:j] for c, values in columns.items()}))
                    held += len(found[-1])
            if held > HELD_PAIRS:  # lists share pairs, so they are made distinct before they leave
                yield _pair_batch(found)
                found, held = [], 0
        if held:
            yield _pair_batch(found)

    return dealt.mapInArrow(run, "a long, b long").distinct()


def _merged_lists(lists: DataFrame) -> DataFrame:
    """``list, set, n, label``: lists of several groups, those with the same smallest set made one.

    Texts with passages in common share many lists of nearly the same sets, and would be sent and
    compared in each of them. Set ids are hashes, so lists have the same smallest set about as
    often as their sets are the same (min-hash): what is made one is hardly larger than its lists.
    """
    several = lists.groupBy("shingle").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.min("set").alias("list"))
    several = several.where("x < y").select("shingle", "list")
    return lists.join(several, "shingle").select("list", "set", "n", "label").distinct()


def _near_pairs(lists: DataFrame, bits: DataFrame) -> DataFrame:
    """Pairs that connect all sets of one list that are in different groups and may be similar.

    No more pairs than rows leave a list, so they are not the similar pairs themselves: those are
    among the sets that the pairs connect.
    """
    merged = stage(_merged_lists(lists), "merged")
    blocks = merged.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).alias("k"))
    rows = merged.join(blocks, "list").join(bits, "set").select("list", "set", "n", "label", "bits", "k")

    def search(part: dict) -> np.ndarray:
        return near_in_list(part["set"], part["n"].astype(np.int64), part["label"], part["bits"])

    return _in_blocks(rows, "list", search)


def _cross_links(near: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Links that connect the groups, found among the whole sets that ``near`` connects.

    A set belongs to one such part, so it moves once and not once a pair. Parts are dealt to
    blocks of bounded numbers of sets and shingles; only links that connect leave one.
    """
    parts = connected_labels(near, left="a", right="b").select(F.col("id").alias("set"), F.col("label").alias("part"))
    parts = stage(parts, "parts")
    touched = maybe_touched(sets.withColumnRenamed("set", "id"), parts.select(F.col("set").alias("id")))
    members = touched.withColumnRenamed("id", "set").join(parts, "set")
    members = members.join(labels.withColumnRenamed("id", "set"), "set", "left")
    members = members.withColumn("label", F.coalesce("label", "set"))
    size = F.octet_length("shingles") / 8
    total = sets.select("set", size.alias("n")).join(parts, "set").groupBy("part").agg(F.count("*").alias("m"), F.sum("n").alias("n"))
    blocks = total.select("part", F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("n") / BLOCK_SHINGLES)).alias("k"))
    rows = members.join(blocks, "part").select("part", "set", "label", "bits", "shingles", "k")

    def search(part: dict) -> np.ndarray:
        shingles = [np.frombuffer(s, np.uint64) for s in part["shingles"]]
        return linked_in_part(part["set"], part["label"], part["bits"], shingles)

    return _in_blocks(rows, "part", search)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose whole sets are similar enough: overlaps by binary search."""
    left = sets.select(F.col("set").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("set").alias("b"), F.col("shingles").alias("right"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                shared = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                good.append(DEN * shared >= NUM * (len(x) + len(y) - shared))
            yield batch.filter(pa.array(good, pa.bool_())).select(["a", "b"])

    return both.mapInArrow(probe, "a long, b long")


def _whole_sets(rows: DataFrame, docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``set, shingles, bits`` of the wanted sets, each from one document that has it."""
    owners = docs.join(wanted, "set", "left_semi").groupBy("set").agg(F.min(F.struct("id", "row")).alias("o"))
    owners = owners.select("set", "o.id", "o.row")
    texts = maybe_touched(rows, owners.select("id")).dropDuplicates(["id", "row"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Words()
        for batch in batches:
            sets = [shingle_set(t, hashes) for t in batch.column(1).to_pylist()]
            columns = [pa.array([f(s) for s in sets], pa.binary()) for f in (np.ndarray.tobytes, parity_bits)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["set", "shingles", "bits"])

    return owners.join(texts, ["id", "row"]).select("set", "text").mapInArrow(run, "set long, shingles binary, bits binary")


def _groups(docs: DataFrame, text: str) -> DataFrame:
    """``id, row, n, low``: each (id, text) of ``docs`` with its set size and the smallest id of its group."""
    spark, rows = docs.sparkSession, keyed(docs, text)
    scanned, scan_folder = stage_to(_scan(rows), "scan")
    found = stage(scanned.where("shingle IS NULL").select("id", "row", "n", "set"), "found")
    kept = scanned.where("shingle IS NOT NULL").select("set", "n", "shingle", "long")
    lists = stage(_short_lists(kept), "lists")
    delete_folder(spark, scan_folder)  # the lists stand for the shingles from here on
    sets, sets_folder = stage_to(_whole_sets(rows, found, lists.select("set").distinct()), "sets")
    links = stage(_verified(_star_pairs(lists), sets), "links")
    labels = stage(connected_labels(links, left="a", right="b"), "labels")
    grouped = lists.join(labels.withColumnRenamed("id", "set"), "set", "left").withColumn("label", F.coalesce("label", "set"))
    near = stage(_near_pairs(grouped, sets.select("set", "bits")), "near")
    links = stage(links.unionByName(_cross_links(near, labels, sets)), "links")
    delete_folder(spark, sets_folder)
    labels = stage(connected_labels(links, left="a", right="b"), "labels")
    # Groups of sets become groups of documents; copies share a set.
    grouped = found.where("set IS NOT NULL").join(labels.withColumnRenamed("id", "set"), "set", "left")
    grouped = grouped.withColumn("label", F.coalesce("label", "set"))
    lowest = grouped.groupBy("label").agg(F.min("id").alias("low"))
    by_set = grouped.select("set", "label").distinct().join(lowest, "label").select("set", "low")
    return found.join(by_set, "set", "left").select("id", "row", "n", F.coalesce("low", "id").alias("low"))


def similar_groups(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    A text's set holds its distinct shingles of five words (A-Z lower-cased); with fewer words
    the whole sequence is its one shingle; null, empty and blank texts have the empty set and are
    linked with nothing. Two texts are linked when 100 times the size of the intersection is at
    least 75 times that of the union. ``component_id`` is the smallest id that links lead to, the
    own one included. Equal texts are linked; repeated rows and rows with one id are all counted,
    a null id is smaller than any other. An empty table gives an empty result. Other columns are
    not read. Sets are told apart by 64-bit hashes.
    """
    out = _groups(docs, text)
    return out.select(id_back().alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), id_back("low").alias("component_id"))


def one_of_each(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their group, with their columns.

    A row is known by its id and the hash of its text, so a near copy that shares its id with
    the first of another group still goes. Repeated rows of a first (same id, same text) stay
    as they are. Columns of any name pass through.
    """
    groups = _groups(docs, text)
    i, r = fresh(docs, "_id"), fresh(docs, "_row")
    firsts = stage(groups.where(F.col("id") == F.col("low")).select(F.col("id").alias(i), F.col("row").alias(r)).distinct(), "firsts")
    same = (id_key(docs["doc_id"]) == firsts[i]) & (F.xxhash64(text_or_empty(docs[text])) == firsts[r])
    return docs.join(firsts, same, "left_semi")


#: The same rows in DuckDB.
SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, md5(array_to_string(list_slice(w, i, i + least(5, len(w)) - 1), ' ')) AS h
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
few AS (SELECT *, count(*) OVER (PARTITION BY h) AS df FROM s QUALIFY df > 1),
ranked AS (SELECT doc_id, h, n, row_number() OVER (PARTITION BY doc_id ORDER BY df, h) + n - count(*) OVER (PARTITION BY doc_id) AS place FROM few JOIN n USING (doc_id)),
prefix AS (SELECT * FROM ranked WHERE place <= n - (3 * n + 3) // 4 + 1),
pairs AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM prefix a JOIN prefix b USING (h) WHERE a.doc_id < b.doc_id AND a.n * 4 >= b.n * 3 AND b.n * 4 >= a.n * 3),
common AS (SELECT a, b, count(*) AS o FROM pairs JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b AND x.h = y.h GROUP BY a, b),
links AS (SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * o >= 75 * (na.n + nb.n - o)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reach.b) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN reach ON reach.a = d.doc_id GROUP BY d.doc_id
"""
