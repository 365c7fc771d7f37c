"""Token ids as a binary output: canonical length-limited Huffman codes in independent blocks.

The job is four Spark passes:

1. Documents are range-partitioned by ``doc_id`` (a row number from the scan breaks ties, so one
   id held by a third of all rows still spreads over many ranges) and sorted within each range.
   Each task tokenizes its range in order with a worker-cached encoder and stages the ids,
   16 bits each when the vocabulary allows, with the range number, the row's place in it and
   the number of ids before it in the range.
2. Global id counts: each Arrow batch is counted with ``numpy.bincount``; Spark sums the counts
   per id (partial sums before the shuffle). At most one row per vocabulary entry reaches the
   driver, which derives a canonical Huffman code whose lengths are limited to ``MAX_BITS``.
3. Encoding: the staged rows are read in their range order and packed into blocks of whole
   documents. A block holds its documents' ids and lengths, the code bits, and the bit offset of
   every ``CHECKPOINT_TOKENS``-th id, so that a reader starts decoding anywhere at such a mark.
   Blocks are rows of a Parquet table in the shared checkpoint folder; the code (id, length) is
   written beside them.
4. Reading back: each block is decoded on its own, all its checkpoint lanes at once, through a
   table indexed by the next ``MAX_BITS`` bits. Per document: its ids, their count and CRC-32;
   ``start`` is the range's offset (a table of one row per range) plus the offset in the range.

Nothing passes through the driver but the code (bounded by the vocabulary) and one row per range.
"""

from __future__ import annotations

import heapq
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import new_folder, text_or_empty

#: Longest code. Decoding looks up the next MAX_BITS bits in one table of 2**MAX_BITS entries (5 MB).
MAX_BITS = 20
#: A checkpoint (bit offset) every so many ids: the lanes of a block decode side by side.
CHECKPOINT_TOKENS = 256
#: A block closes once it holds this many ids; a longer document is one block of its own.
BLOCK_TOKENS = 1 << 17
#: Worker cache of pieces (text between the tokenizer's split points) and their ids.
CACHE_PIECES = 400_000

#: The tokenizer's own split pattern for byte-level BPE (fixed values: the public GPT-2 rule).
BYTE_LEVEL_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Texts of these characters alone, and the same pattern for them: Python's own expressions are faster
#: but do not know the classes of letters and numbers. Any other text is split by the pattern above.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
PLAIN_TEXT = re.compile(rf"[\n\t -~{_LETTERS}‘’“”–—…]*")
PLAIN_SPLIT = re.compile(rf"""'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s0-9{_LETTERS}]+|\s+(?!\S)|\s+""")

__all__ = ["BLOCK_TOKENS", "CHECKPOINT_TOKENS", "MAX_BITS", "canonical_code", "code_lengths", "decode_block", "encode_block", "token_ids", "write_token_ids", "read_token_ids"]


# ---------------------------------------------------------------- encoding texts into ids


def _byte_chars() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the rest move past 255."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    chars, extra = {}, 0
    for byte in range(256):
        if byte in kept:
            chars[byte] = chr(byte)
        else:
            chars[byte] = chr(256 + extra)
            extra += 1
    return chars


class _Pieces(dict):
    """The ids of every piece seen, as bytes, so that a text's ids are one join of its pieces'."""

    def __init__(self, tokenizer):
        super().__init__()
        self.model, self.table = tokenizer.model, _byte_chars()
        self.space = self.table[0x20]

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHE_PIECES:
            self.clear()
        if piece.isascii() and piece.isprintable():  # of these only the space has another character
            mapped = piece.replace(" ", self.space)
        else:
            mapped = piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.table)
        ids = [t.id for t in self.model.tokenize(mapped)]
        found = self[piece] = struct.pack(f"<{len(ids)}I", *ids)
        return found


class Encoder:
    """Ids of texts as the tokenizer gives them (``add_special_tokens=False``), with a worker cache.

    A byte-level BPE never merges across its split points, so a text's ids are the ids of its
    pieces in order; the strings of special tokens are cut out first, as the tokenizer does by
    default. Any other kind of tokenizer encodes whole texts.
    """

    def __init__(self, tokenizer_json: str):
        import json

        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(tokenizer_json)
        pre = spec.get("pre_tokenizer") or {}
        specials = [t for t in spec.get("added_tokens", []) if t.get("special")]
        self.cached = (
            spec.get("normalizer") is None
            and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True)
            and not pre.get("add_prefix_space", False)
            and spec.get("model", {}).get("type") == "BPE"
            and not spec.get("model", {}).get("dropout")
            and all(not (t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized")) for t in specials)
        )
        self.special_ids = {t["content"]: t["id"] for t in specials}
        contents = sorted(self.special_ids, key=len, reverse=True)
        self.specials = regex.compile("(" + "|".join(regex.escape(c) for c in contents) + ")") if contents else None
        self.split = regex.compile(BYTE_LEVEL_SPLIT)
        self.cache = _Pieces(self.tokenizer)

    def encoded(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if not self.cached:
            return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        special = any(content in text for content in self.special_ids)
        split = PLAIN_SPLIT.findall if PLAIN_TEXT.fullmatch(text) else self.split.findall
        ids = []
        for n, part in enumerate(self.specials.split(text) if special else [text]):
            if n % 2:
                ids.append(struct.pack("<I", self.special_ids[part]))
            else:
                ids.extend(map(self.cache.__getitem__, split(part)))
        return b"".join(ids)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encoded(text), "<u4").tolist()


_ENCODERS: dict[int, Encoder] = {}


def worker_encoder(tokenizer_json: str) -> Encoder:
    """One encoder, and so one cache, per Python worker and tokenizer; workers serve many tasks."""
    key = hash(tokenizer_json)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(tokenizer_json)
    return _ENCODERS[key]


# ---------------------------------------------------------------- the code


def code_lengths(counts: dict[int, int], max_bits: int = MAX_BITS) -> dict[int, int]:
    """Huffman code lengths of the ids with a positive count, none longer than ``max_bits``.

    Ties in the Huffman merge go by the smaller id. Lengths over the limit are cut to it and the
    Kraft sum is brought back to at most 1 by lengthening the least frequent shorter codes, which
    keeps the code prefix-free; a single id gets length 1.
    """
    ids = sorted(i for i, c in counts.items() if c > 0)
    if len(ids) > 1 << max_bits:
        raise ValueError(f"{len(ids)} ids do not fit codes of {max_bits} bits")
    if not ids:
        return {}
    if len(ids) == 1:
        return {ids[0]: 1}
    heap = [(counts[i], i, [i]) for i in ids]
    heapq.heapify(heap)
    depth = dict.fromkeys(ids, 0)
    while len(heap) > 1:
        c1, k1, m1 = heapq.heappop(heap)
        c2, k2, m2 = heapq.heappop(heap)
        for i in m1:
            depth[i] += 1
        for i in m2:
            depth[i] += 1
        merged = m1 + m2 if len(m1) >= len(m2) else m2 + m1
        heapq.heappush(heap, (c1 + c2, min(k1, k2), merged))
    lengths = {i: min(d, max_bits) for i, d in depth.items()}
    over = sum(1 << (max_bits - n) for n in lengths.values()) - (1 << max_bits)
    if over > 0:
        for i in sorted(ids, key=lambda i: (-lengths[i], counts[i], i)):
            while over > 0 and lengths[i] < max_bits:
                over -= 1 << (max_bits - lengths[i] - 1)
                lengths[i] += 1
            if over <= 0:
                break
    return lengths


def canonical_code(lengths: dict[int, int]) -> dict[int, tuple[int, int]]:
    """Canonical codes: ids ordered by (length, id) take consecutive values, shifted at each new length."""
    code, previous, out = 0, 0, {}
    for i in sorted(lengths, key=lambda i: (lengths[i], i)):
        code <<= lengths[i] - previous
        out[i] = (code, lengths[i])
        previous = lengths[i]
        code += 1
    return out


class Code:
    """Lookup arrays of one canonical code, for encoding and table-driven decoding."""

    def __init__(self, lengths: dict[int, int], max_bits: int = MAX_BITS):
        self.max_bits = max_bits
        size = max(lengths, default=0) + 1
        self.length = np.zeros(size, np.int64)
        self.value = np.zeros(size, np.int64)
        # The tables that decoding reads at random stay small, for the processor's caches.
        self.symbol = np.full(1 << max_bits, -1, np.int32)
        self.width = np.zeros(1 << max_bits, np.uint8)
        # As canonical_code: ids by (length, id), each after the span of table entries of the one before.
        ids, n = np.fromiter(lengths, np.int64, len(lengths)), np.fromiter(lengths.values(), np.int64, len(lengths))
        order = np.lexsort((ids, n))
        ids, n = ids[order], n[order]
        spans = np.int64(1) << (max_bits - n)
        ends = np.cumsum(spans)
        self.length[ids], self.value[ids] = n, (ends - spans) >> (max_bits - n)
        self.symbol[: spans.sum()], self.width[: spans.sum()] = np.repeat(ids, spans), np.repeat(n, spans)


def encode_block(ids: np.ndarray, code: Code) -> tuple[bytes, np.ndarray]:
    """Code bits of ``ids`` (most significant bit first) and the bit offset of every checkpoint id.

    Codes never overlap, so the 32-bit words of the stream are sums of shifted codes: a code of
    at most 20 bits reaches into two words at most.
    """
    if len(ids) == 0:
        return b"", np.zeros(0, np.int64)
    lengths = code.length[ids]
    if (lengths == 0).any():
        raise ValueError("an id without a code")
    values = code.value[ids]
    ends = np.cumsum(lengths)
    starts = ends - lengths
    word = starts >> 5
    last = (starts & 31) + lengths  # end of the code within its first word, 1..52
    spill = np.maximum(last - 32, 0)
    first_part = (values >> spill) << np.maximum(32 - last, 0)
    second_part = (values & ((1 << spill) - 1)) << (32 - spill)
    size = int(ends[-1] + 31) >> 5
    words = np.bincount(word, weights=first_part, minlength=size + 1)
    words += np.bincount(word + 1, weights=np.where(spill > 0, second_part, 0), minlength=size + 1)
    data = words[:size].astype(np.uint64).astype(">u4").tobytes()
    return data[: (int(ends[-1]) + 7) >> 3], starts[::CHECKPOINT_TOKENS].astype(np.int64)


def decode_lanes(data: bytes, positions: np.ndarray, bases: np.ndarray, counts: np.ndarray, total: int, code: Code) -> np.ndarray:
    """Ids of many lanes at once: lane k starts at bit ``positions[k]`` of ``data`` and puts its
    ``counts[k]`` (at most ``CHECKPOINT_TOKENS``) ids at ``bases[k]`` of the result. Each step
    looks up the next ``MAX_BITS`` bits of every live lane in the code's table."""
    out = np.zeros(total, np.int32)
    if total == 0:
        return out
    # The 32 bits from every byte on, so that a step reads once per lane.
    buffer = np.frombuffer(data + b"\0" * 8, np.uint8).astype(np.uint32)
    words = (buffer[:-3] << 24) | (buffer[1:-2] << 16) | (buffer[2:-1] << 8) | buffer[3:]
    # Longer lanes first: those still live at a step are the first ones.
    counts = np.asarray(counts, np.int64)
    order = np.argsort(-counts, kind="stable")
    position, at = np.asarray(positions, np.int64)[order], np.asarray(bases, np.int64)[order]
    steps = int(counts.max(initial=0))
    live = np.searchsorted(-counts[order], -np.arange(steps), side="left")
    mask, free = np.uint32((1 << code.max_bits) - 1), np.uint32(32 - code.max_bits)
    for step, k in enumerate(live.tolist()):
        position, at = position[:k], at[:k]
        window = (words[position >> 3] >> (free - (position & 7).astype(np.uint32))) & mask
        symbol = code.symbol[window]
        if symbol.min() < 0:
            raise ValueError("bits that are no code")
        out[at + step] = symbol
        position = position + code.width[window]
    return out


def _lanes(checkpoints: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each checkpoint's lane puts its ids, and how many it has."""
    bases = np.arange(len(checkpoints), dtype=np.int64) * CHECKPOINT_TOKENS
    return bases, np.minimum(CHECKPOINT_TOKENS, count - bases)


def decode_block(data: bytes, checkpoints: np.ndarray, count: int, code: Code) -> np.ndarray:
    """``count`` ids from one block; the lanes that start at its checkpoints decode side by side."""
    bases, counts = _lanes(np.asarray(checkpoints), count)
    return decode_lanes(data, checkpoints, bases, counts, count, code)


# ---------------------------------------------------------------- the Spark job

_STAGED = "part int, ord long, doc_id long, local_start long, n_tokens long, ids binary"
_BLOCKS = (
    "part int, first_ord long, local_start long, doc_ids array<long>, doc_tokens array<long>, "
    "checkpoints array<long>, bits binary"
)
_READ = "part int, ord long, doc_id long, local_start long, n_tokens long, ids_crc32 long"


def _tokenized(docs: DataFrame, tokenizer_json: str, end_id: int | None, wide: bool, parts: int) -> DataFrame:
    """Step 1: ids of every document in doc_id order, ranges of it staged with local offsets."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(tokenizer_json)
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
        .withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange(parts, F.col("doc_id").asc_nulls_last(), "_row")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "_row")
        .select(F.spark_partition_id().alias("part"), "doc_id", "text")
    )
    dtype = np.dtype("<u4") if wide else np.dtype("<u2")
    end = b"" if end_id is None else struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(shared.value)
        ord_, local = 0, 0
        for batch in batches:
            parts_, ids_, texts = (batch.column(i).to_pylist() for i in range(3))
            ords, starts, counts, blobs = [], [], [], []
            for blob in map(encoder.encoded, texts):
                ids = np.frombuffer(blob + end, "<u4")
                ords.append(ord_)
                starts.append(local)
                counts.append(len(ids))
                blobs.append(ids.astype(dtype, copy=False).tobytes())
                ord_ += 1
                local += len(ids)
            yield pa.RecordBatch.from_pydict(
                {"part": parts_, "ord": ords, "doc_id": ids_, "local_start": starts, "n_tokens": counts, "ids": blobs},
                schema=pa.schema([("part", pa.int32()), ("ord", pa.int64()), ("doc_id", pa.int64()), ("local_start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]),
            )

    return ordered.mapInArrow(run, _STAGED)


def _counts(staged: DataFrame, wide: bool) -> dict[int, int]:
    """Step 2: how often each id occurs, summed in Spark; one row per id reaches the driver."""
    dtype = np.dtype("<u4") if wide else np.dtype("<u2")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = [b for b in batch.column(0).to_pylist() if b]
            if not blobs:
                continue
            tally = np.bincount(np.frombuffer(b"".join(blobs), dtype))
            found = np.flatnonzero(tally)
            yield pa.RecordBatch.from_pydict({"id": found.astype(np.int64), "n": tally[found].astype(np.int64)})

    rows = staged.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return {r["id"]: r["n"] for r in rows.collect()}


def _blocks(staged: DataFrame, lengths: dict[int, int], wide: bool) -> DataFrame:
    """Step 3: consecutive documents of a range packed into blocks with checkpoints."""
    shared = staged.sparkSession.sparkContext.broadcast(lengths)
    dtype = np.dtype("<u4") if wide else np.dtype("<u2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(shared.value)
        held: list[tuple] = []

        def flush():
            ids = np.frombuffer(b"".join(h[5] for h in held), dtype).astype(np.int64)
            bits, marks = encode_block(ids, code)
            row = {
                "part": [held[0][0]], "first_ord": [held[0][1]], "local_start": [held[0][3]],
                "doc_ids": [[h[2] for h in held]], "doc_tokens": [[h[4] for h in held]],
                "checkpoints": [marks.tolist()], "bits": [bits],
            }
            held.clear()
            return pa.RecordBatch.from_pydict(row, schema=_BLOCK_ARROW)

        size = 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if held and (row[0] != held[-1][0] or row[1] != held[-1][1] + 1 or size >= BLOCK_TOKENS):
                    yield flush()
                    size = 0
                held.append(row)
                size += row[4]
        if held:
            yield flush()

    return staged.sortWithinPartitions("part", "ord").mapInArrow(run, _BLOCKS)


_BLOCK_ARROW = pa.schema([
    ("part", pa.int32()), ("first_ord", pa.int64()), ("local_start", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
    ("doc_tokens", pa.list_(pa.int64())), ("checkpoints", pa.list_(pa.int64())), ("bits", pa.binary()),
])


def write_token_ids(
    docs: DataFrame, tokenizer_path: str, folder: str, *, end_id: int | None = None, parts: int | None = None
) -> str:
    """Encode every document (``doc_id``, ``text``) and write the blocks and the code under ``folder``.

    Null texts are empty; with ``end_id`` each document ends with that id. Documents follow
    ascending ``doc_id``, null ids last; repeated rows are documents of their own, in any order
    among themselves. An empty table writes no block. Returns ``folder``.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        source = file.read()
    from tokenizers import Tokenizer

    vocabulary = max(Tokenizer.from_str(source).get_vocab_size(with_added_tokens=True), (end_id or 0) + 1)
    wide = vocabulary > 1 << 16
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    staged_path = f"{folder}/staged"
    _tokenized(docs, source, end_id, wide, parts).write.parquet(staged_path)
    staged = spark.read.schema(_STAGED).parquet(staged_path)
    lengths = code_lengths(_counts(staged, wide))
    spark.createDataFrame(sorted(lengths.items()), "id long, length int").coalesce(1).write.parquet(f"{folder}/code")
    _blocks(staged, lengths, wide).write.parquet(f"{folder}/blocks")
    from tidemark.session import delete_folder

    delete_folder(spark, staged_path)
    return folder


def read_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of the files: ``doc_id``, ``start``, ``n_tokens`` and the CRC-32 of its ids.

    The CRC-32 is unsigned, over the ids as little-endian unsigned 32-bit integers.
    """
    lengths = {r["id"]: r["length"] for r in spark.read.parquet(f"{folder}/code").collect()}
    shared = spark.sparkContext.broadcast(lengths)
    blocks = spark.read.schema(_BLOCKS).parquet(f"{folder}/blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(shared.value)
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(7)]
            # All lanes of all blocks of the batch decode together.
            sizes = [int(sum(c)) for c in columns[4]]
            token_at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            byte_at = np.concatenate([[0], np.cumsum([len(b) for b in columns[6]])]).astype(np.int64)
            positions, bases, counts = [], [], []
            for k, (marks, size) in enumerate(zip(columns[5], sizes)):
                marks = np.asarray(marks, np.int64)
                lane_bases, lane_counts = _lanes(marks, size)
                positions.append(marks + 8 * byte_at[k])
                bases.append(lane_bases + token_at[k])
                counts.append(lane_counts)
            ids = decode_lanes(
                b"".join(columns[6]), np.concatenate(positions or [np.zeros(0, np.int64)]),
                np.concatenate(bases or [np.zeros(0, np.int64)]), np.concatenate(counts or [np.zeros(0, np.int64)]),
                int(token_at[-1]), code,
            ).astype("<u4")
            out: dict[str, list] = {k: [] for k in ("part", "ord", "doc_id", "local_start", "n_tokens", "ids_crc32")}
            for k, (part, first, local, doc_ids, doc_counts) in enumerate(zip(*columns[:5])):
                at = int(token_at[k])
                for j, (doc, n) in enumerate(zip(doc_ids, doc_counts)):
                    out["part"].append(part)
                    out["ord"].append(first + j)
                    out["doc_id"].append(doc)
                    out["local_start"].append(local + at - int(token_at[k]))
                    out["n_tokens"].append(n)
                    out["ids_crc32"].append(zlib.crc32(ids[at : at + n].tobytes()))
                    at += n
            yield pa.RecordBatch.from_pydict(out, schema=_READ_ARROW)

    rows = blocks.mapInArrow(run, _READ)
    # One row per range, summed from the blocks' lengths alone: its offset is the sum of all ranges before it.
    sizes = F.aggregate("doc_tokens", F.lit(0).cast("long"), lambda total, n: total + n)
    totals = blocks.groupBy("part").agg(F.sum(sizes).alias("total"))
    offsets = totals.select(
        "part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("offset")
    )
    return rows.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("offset") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )


_READ_ARROW = pa.schema([
    ("part", pa.int32()), ("ord", pa.int64()), ("doc_id", pa.int64()), ("local_start", pa.int64()),
    ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
])


def token_ids(docs: DataFrame, tokenizer_path: str, *, end_id: int | None = 2, folder: str | None = None) -> DataFrame:
    """Write every document's ids in the block format and read them back (see the module text).

    The files go to ``folder``, by default a new folder in the shared checkpoint folder. Only
    ``doc_id`` and ``text`` are read; other columns, whatever their names, are not.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "token-ids")
    write_token_ids(docs, tokenizer_path, folder, end_id=end_id)
    return read_token_ids(spark, folder)
