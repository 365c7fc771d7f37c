"""Remove byte strings that occur earlier, with a logarithmic family of suffix arrays.

Documents come in batches of rising ids. A batch becomes a suffix array: suffixes in the order of
fingerprints of what they start with, dealt to parts by the first fingerprint. Only suffixes that
an anchor selects are kept (``tidemark.llm.windows``): every window of 100 bytes has one anchor, and
equal windows have it at the same place, so no match is lost and one suffix stands for some
thirty. The batch is merge-scanned against the levels of the family, part by part: suffixes
that match a level, or an earlier suffix of the batch, in all their windows are repeats; those
that share only their first bytes are compared window by window. New suffixes enter as a level
of their own, and before the next batch levels of equal size merge, so there are at most a
logarithmic number of levels and each suffix is rewritten that often.

Arrays move and rest as a blob per part, not as a row per suffix: Spark deals, shuffles and joins
the parts, and a task sorts and compares one part at a time with numpy.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import repeats, windows
from tidemark.llm.common import new_folder, stage
from tidemark.session import bounded_batches, brief_shuffles

#: Bytes in a window, and in the string that anchors it.
WINDOW = 100
GRAM = 48
#: Batches that a whole table is dealt to. Each is scanned against all levels before it; levels
#: merge from the third batch on.
BATCHES = 4
#: A gram with more different suffixes in one piece of a batch goes to single windows at once.
LONG_IN_BATCH = 64
#: Parts of an array per shuffle partition; a task holds one part at a time.
PARTS = 4
#: Bytes of text whose suffixes a task selects at a time, and single windows that it hashes before
#: it hands them on; one document at least.
TEXT_AT_ONCE = 4 << 20
WINDOWS_AT_ONCE = 1 << 17

#: One suffix of an array: its slot, the hash of all that its windows cover, what turns the slot
#: into the gram, its place, and how many windows it stands for. With no window it is a mark: the
#: slot's gram is shared. With less than none it is a repeat for sure, wherever it is sent.
_ENTRY = np.dtype(
    [("slot", "<u8"), ("whole", "<u8"), ("shift", "<u8"), ("id", "<i8"), ("row", "<i8"), ("start", "<i4"), ("count", "<i4")]
)
_PLACE = ("id", "row", "start")


def byte_symbols() -> repeats.Symbols:
    return lambda texts: [np.frombuffer(t.encode(), np.uint8) for t in texts]


def to_blob(entries: np.ndarray) -> bytes:
    """First bytes first, then second bytes and so on, so that what entries share compresses."""
    flat = np.ascontiguousarray(entries).view(np.uint8).reshape(-1, _ENTRY.itemsize).T.tobytes()
    return len(flat).to_bytes(8, "little") + pa.compress(flat, codec="lz4_raw", asbytes=True) if flat else b""


def from_blob(blob: pa.Scalar) -> np.ndarray:
    body = blob.as_buffer() if blob.is_valid else b""
    if not len(body):
        return np.zeros(0, _ENTRY)
    size = int.from_bytes(body[:8], "little")
    flat = np.frombuffer(pa.decompress(body[8:], decompressed_size=size, codec="lz4_raw"), np.uint8)
    return np.ascontiguousarray(flat.reshape(_ENTRY.itemsize, -1).T).view(_ENTRY).reshape(-1)


def _several(values: np.ndarray) -> np.ndarray:
    """Which values occur more than once."""
    order = np.argsort(values)
    same = values[order[1:]] == values[order[:-1]]
    out = np.zeros(len(values), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are among ``known``, which is sorted."""
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.searchsorted(known, values)
    at[at == len(known)] = 0
    return known[at] == values


def _kinds(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries are the first of their slot and hash, and which stand later than that.

    An entry at the place of the first is neither.
    """
    first, later = np.ones(len(entries), bool), np.zeros(len(entries), bool)
    some = np.flatnonzero(_several(entries["slot"]))
    some = some[np.lexsort([entries[c][some] for c in (*reversed(_PLACE), "whole", "slot")])]
    if not len(some):
        return first, later
    own = entries[some]
    new = np.ones(len(own), bool)
    new[1:] = (own["slot"][1:] != own["slot"][:-1]) | (own["whole"][1:] != own["whole"][:-1])
    lead = np.flatnonzero(new)[np.cumsum(new) - 1]
    first[some] = new
    later[some] = reduce(np.logical_or, (own[c] != own[c][lead] for c in _PLACE))
    return first, later


def _chained(entries: np.ndarray) -> np.ndarray:
    """Entries in the order of their places; those that follow each other without a gap are one."""
    if not len(entries):
        return entries
    ends = entries["start"] + entries["count"]
    new = np.ones(len(entries), bool)
    new[1:] = reduce(np.logical_or, (entries[c][1:] != entries[c][:-1] for c in ("id", "row"))) | (entries["start"][1:] != ends[:-1])
    at = np.flatnonzero(new)
    out = entries[at]
    out["count"] = ends[np.append(at[1:], len(entries)) - 1] - out["start"]
    return out


def _dealt(entries: np.ndarray, sure: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """A row ``part, blob`` for each part that the entries and the sure repeats are dealt to."""
    sure = _chained(sure)
    # Spread, so that copies don't pile up in one part.
    sure["slot"] = windows.mixed(sure["whole"] + np.arange(len(sure), dtype=np.uint64))
    sure["whole"], sure["shift"], sure["count"] = 0, 0, -sure["count"]
    entries = np.concatenate([entries, sure])
    if not len(entries):
        return
    part = ((entries["slot"] >> np.uint64(32)) % np.uint64(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    entries, part = entries[order], part[order]
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    blobs = [to_blob(entries[a:b]) for a, b in pairwise(cuts)]
    yield pa.RecordBatch.from_arrays([pa.array(part[cuts[:-1]]), pa.array(blobs, pa.binary())], names=["part", "blob"])


def _pieces(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """A batch cut where its texts reach another ``most`` bytes."""
    size = np.cumsum(pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = [0, *(np.flatnonzero(np.diff(size // most)) + 1).tolist(), batch.num_rows]
    return (batch.slice(a, b - a) for a, b in pairwise(cuts))


def suffixes(rows: DataFrame, window: int, gram: int, parts: int) -> DataFrame:
    """The selected suffixes of a batch, dealt to parts (``part, blob``).

    ``slot`` is the fingerprint of the gram. Where many suffixes of one piece of a batch share it,
    each gets a slot of its own and keeps its gram apart; a mark then tells the slot that its
    gram is shared. Of equal suffixes of one piece those at later places are repeats for sure.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = byte_symbols()
        for batch in (piece for whole in batches for piece in _pieces(whole, TEXT_AT_ONCE)):
            runs = windows.find_runs(read(batch.column(2).to_pylist()), window, gram)
            entries = np.zeros(len(runs), _ENTRY)
            entries["id"], entries["row"] = (batch.column(i).to_numpy()[runs.doc] for i in (0, 1))
            entries["slot"], entries["whole"], entries["start"], entries["count"] = runs.gram, runs.whole, runs.start, runs.count
            _, later = _kinds(entries)
            sure, entries = entries[later], entries[~later]
            grams, times = np.unique(entries["slot"], return_counts=True)
            marks = np.zeros(int((times > LONG_IN_BATCH).sum()), _ENTRY)
            marks["slot"] = grams[times > LONG_IN_BATCH]
            long = _among(entries["slot"], marks["slot"])
            own = entries["slot"][long]
            entries["slot"][long] = windows.mixed(own ^ entries["whole"][long])
            entries["shift"][long] = own ^ entries["slot"][long]
            yield from _dealt(np.concatenate([entries, marks]), sure, parts)

    return rows.mapInArrow(scan, "part int, blob binary")


def _merge_scan(new: np.ndarray, levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A part of a batch against the same part of the levels: what enters, repeats, unsure ones.

    Levels are sorted by slot and hold earlier documents. The unsure ones are of the batch and of
    the levels; one of a level is told when its slot is first met by another.
    """
    sure = new[new["count"] < 0]
    sure["count"] *= -1
    marks = np.unique(new["slot"][new["count"] == 0])
    new = new[new["count"] > 0]
    met = np.unique(np.concatenate([new["slot"], marks]))
    old = np.concatenate([np.zeros(0, _ENTRY), *(x[_among(x["slot"], met)] for x in levels)])
    old_marks = np.unique(old["slot"][old["count"] == 0])
    old = old[old["count"] > 0]
    every = np.concatenate([old, new])
    is_new = np.arange(len(every)) >= len(old)
    first, later = _kinds(every)
    kinds, old_kinds = every[first], first & ~is_new
    shared = _among(every["slot"], np.union1d(marks, old_marks))
    shared |= _among(every["slot"], np.unique(kinds["slot"][_several(kinds["slot"])]))
    fresh = first & is_new
    unsure = fresh & (shared | (every["shift"] != 0))
    told = np.union1d(old_marks, np.unique(every["slot"][old_kinds][_several(every["slot"][old_kinds])]))
    touched = np.union1d(np.unique(every["slot"][unsure]), marks)
    unsure |= old_kinds & _among(every["slot"], touched) & ~_among(every["slot"], told) & (every["shift"] == 0)
    lasting = np.zeros(len(marks), _ENTRY)
    lasting["slot"] = marks
    level = np.concatenate([every[fresh], lasting])
    again = np.concatenate([every[later & is_new], sure])
    ends = every[unsure]
    ends["slot"] ^= ends["shift"]
    for part in (again, ends):
        part["whole"], part["shift"] = 0, 0
    again["slot"] = 0
    return _by_slot(level), again, ends


def _by_slot(entries: np.ndarray) -> np.ndarray:
    return entries[np.argsort(entries["slot"])]


def _parts_of(dealt: DataFrame, buckets: int) -> DataFrame:
    """``part, blobs``: all that was dealt to a part."""
    return dealt.repartition(buckets, "part").groupBy("part").agg(F.collect_list("blob").alias("blobs"))


def _whole_part(blobs: pa.Scalar) -> np.ndarray:
    return np.concatenate([from_blob(b) for b in blobs])


def _interval_rows(entries: np.ndarray, window: int) -> pa.RecordBatch:
    """``id, row, i`` (:func:`repeats.packed`) of what repeated suffixes cover."""
    start = entries["start"].astype(np.int64)
    i = (start << 32) | (start + entries["count"] + (window - 1))
    return pa.RecordBatch.from_arrays([pa.array(c) for c in (entries["id"], entries["row"], i)], names=["id", "row", "i"])


@dataclass
class Level:
    table: str
    batches: int


@dataclass
class SuffixFamily:
    """The levels so far. Tables are bucketed by part, so scans and merges shuffle no level."""

    spark: SparkSession
    folder: str
    buckets: int
    levels: list[Level] = field(default_factory=list)

    def _write(self, rows: DataFrame, name: str) -> str:
        table = f"suffixes_{name}_{uuid.uuid4().hex}"
        (
            rows.write.format("parquet")
            .bucketBy(self.buckets, "part")
            .sortBy("part")
            .option("path", f"{self.folder}/{table}")
            .saveAsTable(table)
        )
        return table

    def _drop(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE {table}")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{table}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _level(self, level: Level, name: str) -> DataFrame:
        return self.spark.table(level.table).select("part", F.col("level").alias(name))

    def merge_equal(self) -> None:
        """Merge the two last levels while they hold equally many batches."""

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, *levels in zip(*batch.columns, strict=True):
                    blob = to_blob(_by_slot(np.concatenate([from_blob(x) for x in levels])))
                    yield pa.RecordBatch.from_arrays([pa.array([part.as_py()], pa.int32()), pa.array([blob], pa.binary())], names=["part", "level"])

        while len(self.levels) > 1 and self.levels[-1].batches == self.levels[-2].batches:
            a, b = self.levels[-1], self.levels[-2]
            both = self._level(b, "b").join(self._level(a, "a"), "part", "full").select("part", "b", "a")
            merged = Level(self._write(both.mapInArrow(merge, "part int, level binary"), "merged"), a.batches + b.batches)
            self.levels[-2:] = [merged]
            self._drop(a.table)
            self._drop(b.table)

    def add(self, rows: DataFrame, window: int, gram: int) -> tuple[DataFrame, DataFrame]:
        """Scan a batch of later documents against the levels and take it in.

        Returns what repeats cover (``id, row, i``), whose windows all start earlier too, and
        unsure suffixes (``id, row, start, count, gram``) of the batch and of the levels.
        """
        self.merge_equal()
        parts = _parts_of(suffixes(rows, window, gram, self.buckets * PARTS), self.buckets)
        names = [f"level_{i}" for i in range(len(self.levels))]
        for level, name in zip(self.levels, names, strict=True):
            parts = parts.join(self._level(level, name), "part", "left")

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, blobs, *levels in zip(*batch.columns, strict=True):
                    found = _merge_scan(_whole_part(blobs), [from_blob(x) for x in levels])
                    out = [pa.array([to_blob(x)], pa.binary()) for x in found]
                    yield pa.RecordBatch.from_arrays([pa.array([part.as_py()], pa.int32()), *out], names=["part", "level", "again", "unsure"])

        def again_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for blob in batch.column(0):
                    yield _interval_rows(from_blob(blob), window)

        def unsure_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for blob in batch.column(0):
                    x = from_blob(blob)
                    columns = [pa.array(c) for c in (x["id"], x["row"], x["start"], x["count"], x["slot"].view(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, names=["id", "row", "start", "count", "gram"])

        scanned = parts.select("part", "blobs", *names).mapInArrow(scan, "part int, level binary, again binary, unsure binary")
        table = self._write(scanned, "level")
        self.levels.append(Level(table, 1))
        again = self.spark.table(table).select("again").mapInArrow(again_rows, "id long, row long, i long")
        unsure = self.spark.table(table).select("unsure").mapInArrow(unsure_rows, "id long, row long, start int, count int, gram long")
        return stage(again, "repeats"), stage(unsure, "unsure")

    def close(self) -> None:
        while self.levels:
            self._drop(self.levels.pop().table)


def _window_entries(texts: DataFrame, window: int, parts: int) -> DataFrame:
    """Each window of the runs of each text, dealt to parts (``part, blob``) by its hash.

    Of equal windows hashed together those at later places are repeats for sure.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = byte_symbols()
        held: list[np.ndarray] = []

        def hand_on() -> Iterator[pa.RecordBatch]:
            entries = np.concatenate([np.zeros(0, _ENTRY), *held])
            held.clear()
            _, later = _kinds(entries)
            sure = entries[later]
            yield from _dealt(entries[~later], sure[np.lexsort([sure[c] for c in reversed(_PLACE)])], parts)

        for batch in batches:
            for doc, row, text, lists, grams in zip(*batch.columns, strict=True):
                starts, counts = repeats.unpacked(np.array(lists.values))
                order = np.argsort(starts)
                starts, counts, gram = starts[order], counts[order], np.array(grams.values)[order]
                sequence = read([text.as_py()])[0]
                slices = np.cumsum(counts) // WINDOWS_AT_ONCE
                for some in np.split(np.arange(len(starts)), np.flatnonzero(np.diff(slices)) + 1):
                    base, last = starts[some[0]], some[-1]
                    cut = sequence[base : starts[last] + counts[last] + window - 1]
                    at, hashes = windows.window_hashes(cut, starts[some] - base, counts[some], window)
                    entries = np.zeros(len(at), _ENTRY)
                    entries["id"], entries["row"], entries["start"], entries["count"] = doc.as_py(), row.as_py(), at + base, 1
                    entries["slot"], entries["whole"] = hashes, np.repeat(gram[some], counts[some]).view(np.uint64)
                    held.append(entries)
                    if sum(map(len, held)) >= WINDOWS_AT_ONCE:
                        yield from hand_on()
        yield from hand_on()

    return texts.mapInArrow(scan, "part int, blob binary")


def _later_windows(texts: DataFrame, window: int, buckets: int) -> DataFrame:
    """``id, row, i`` of the windows that an earlier place has too."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blobs in batch.column(1):
                _, again, _ = _merge_scan(_whole_part(blobs), [])
                yield _interval_rows(again, window)

    return _parts_of(_window_entries(texts, window, buckets * PARTS), buckets).mapInArrow(scan, "id long, row long, i long")


def _bounds(rows: DataFrame, batches: int) -> list[int]:
    """Largest ids of all batches but the last."""
    parts = [i / batches for i in range(1, batches)]
    cuts = rows.select("id").agg(F.percentile_approx("id", parts, 10_000).alias("cuts")).first()["cuts"] if parts else []
    return sorted(set(cuts or []))


def remove_repeats(
    docs: DataFrame, *, text: str = "text", window: int = WINDOW, gram: int = GRAM, batches: int = BATCHES
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` for every row of ``docs``.

    A byte of the UTF-8 text goes if a string of ``window`` bytes covers it that also starts
    earlier: in a document with a smaller id, or before in the same one. Strings are judged on
    the input and may overlap; none crosses documents. ``kept`` is the rest as bytes, which may
    break a character. Null and empty texts have no bytes; texts shorter than a window lose
    nothing. Rows with one id and different texts follow each other in the order of a text hash;
    repeated rows are one document and get equal results; a null id comes first. An empty table
    gives an empty result. Other columns are not read.

    Strings are equal when two 64-bit Rabin-Karp hashes are equal (of the string and its anchor).
    """
    spark = docs.sparkSession
    with brief_shuffles(spark), bounded_batches(spark):
        rows = repeats.keyed(docs, text, sparse=True)
        intervals = _found(rows, window, gram, batches)
    return _cut(rows, intervals)


def _found(rows: DataFrame, window: int, gram: int, batches: int) -> DataFrame:
    """``id, row, intervals``: bytes covered by windows that an earlier place has too."""
    spark = rows.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    family = SuffixFamily(spark, new_folder(spark, "suffixes"), buckets)
    cuts = [None, *_bounds(rows, batches), None]
    found, unsure = [], []
    try:
        for low, high in pairwise(cuts):
            part = rows
            if low is not None:
                part = part.where(F.col("id") > low)
            if high is not None:
                part = part.where(F.col("id") <= high)
            again, shared = family.add(part, window, gram)
            found.append(again)
            unsure.append(shared)
    finally:
        family.close()
    texts = repeats.texts_of_runs(rows, reduce(DataFrame.unionByName, unsure))
    return stage(repeats.gathered(*found, _later_windows(texts, window, buckets)), "found")


def _cut(rows: DataFrame, intervals: DataFrame) -> DataFrame:
    joined = rows.join(intervals, ["id", "row"], "left").select("id", "text", "intervals")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, gone, spans, kept = [], [], [], []
            for text, found in zip(batch.column(1), batch.column(2), strict=True):
                left = body = text.as_py().encode()
                runs = 0
                if found.is_valid:
                    starts, ends = repeats.unpacked(np.array(found.values))
                    drop = windows.covered(len(body), starts, ends)
                    left = np.frombuffer(body, np.uint8)[~drop].tobytes()
                    runs = int(drop[0]) + int((drop[1:] & ~drop[:-1]).sum())
                sizes.append(len(body))
                gone.append(len(body) - len(left))
                spans.append(runs)
                kept.append(left)
            numbers = [pa.array(c, pa.int64()) for c in (sizes, gone, spans)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *numbers, pa.array(kept, pa.binary())], names=["id", "n_bytes", "n_removed", "n_spans", "kept"]
            )

    out = joined.mapInArrow(cut, "id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.select(repeats.id_back().alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept")


#: :func:`remove_repeats` in DuckDB, with the hash of the kept bytes. Bytes are taken from the
#: hex digits of the text, so that no character is cut by mistake.
SQL = r"""
WITH d AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS x FROM documents),
w AS (SELECT doc_id, i, substr(x, 2 * i - 1, 200) AS s FROM (SELECT doc_id, x, unnest(generate_series(1, len(x) // 2 - 99)) AS i FROM d WHERE len(x) >= 200)),
f AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM w) WHERE k > 1),
o AS (SELECT doc_id, i, lag(i) OVER p AS before, lead(i) OVER p AS after FROM f WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
a AS (SELECT doc_id, i AS lo, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM o WHERE before IS NULL OR i - before > 100),
b AS (SELECT doc_id, i + 99 AS hi, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM o WHERE after IS NULL OR after - i > 100),
r AS (SELECT a.doc_id, k, lo, hi, lag(hi, 1, 0) OVER (PARTITION BY a.doc_id ORDER BY k) AS last FROM a JOIN b USING (doc_id, k)),
s AS (SELECT doc_id, sum(hi - lo + 1)::BIGINT AS n_removed, count(*) AS n_spans, max(hi) AS hi,
  string_agg(substr(x, 2 * last + 1, 2 * (lo - 1 - last)), '' ORDER BY k) AS kept FROM r JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, len(x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
 sha256(unhex(coalesce(kept || substr(x, 2 * hi + 1), x))) AS kept_sha256 FROM d LEFT JOIN s USING (doc_id)
"""
