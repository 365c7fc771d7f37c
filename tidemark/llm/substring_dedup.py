"""Remove passages of at least 50 words that an earlier document has too."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from tidemark.llm import repeats, windows
from tidemark.llm.common import stage

#: Words in a window, and in the gram that anchors it.
WINDOW = 50
GRAM = 16
_CACHE_WORDS = 500_000


class _Words(dict):
    """64-bit hashes of words, computed once per worker while the cache has room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def split_words(text: str) -> list[bytes]:
    """Words in UTF-8; the split is at the six ASCII white-space characters."""
    return text.encode().split()


def word_symbols() -> repeats.Symbols:
    hashes = _Words()

    def read(texts: list[str]) -> list[np.ndarray]:
        out = []
        for text in texts:
            words = split_words(text)
            out.append(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)))
        return out

    return read


def remove_repeats(docs: DataFrame, *, text: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` for every row of ``docs``.

    A word goes if it lies in ``window`` consecutive words whose sequence also starts in a
    document with a smaller id; windows are judged on the input. Words are unchanged; the kept
    ones are joined by one space. Null and empty texts have no words and keep an empty text;
    texts shorter than a window lose nothing. Rows with the same id never remove each other's
    words, so repeated rows get equal results; a null id counts as smaller than all others. An
    empty table gives an empty result. No column but ``doc_id`` and the text is read.

    Windows are equal when two 64-bit Rabin-Karp hashes are equal (of the window and of its gram).
    """
    rows = repeats.keyed(docs, text)
    runs = stage(repeats.run_rows(rows, word_symbols, window, gram), "runs")
    kinds = repeats.unsure(repeats.firsts(runs, same_document=False))
    found = stage(repeats.repeated_intervals(rows, runs, kinds, word_symbols, window, same_document=False), "found")
    joined = rows.join(found, ["id", "row"], "left").select("id", "text", "intervals")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, kept = [], [], []
            for words, found in zip(map(split_words, batch.column(1).to_pylist()), batch.column(2), strict=True):
                left = words
                if found.is_valid:
                    starts, ends = repeats.unpacked(np.array(found.values))
                    drop = windows.covered(len(words), starts, ends)
                    left = [w for w, d in zip(words, drop.tolist(), strict=True) if not d]
                total.append(len(words))
                gone.append(len(words) - len(left))
                kept.append(b" ".join(left))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept).cast(pa.string())],
                names=["id", "n_words", "n_removed", "kept_text"],
            )

    out = joined.mapInArrow(cut, "id long, n_words long, n_removed long, kept_text string")
    return out.select(repeats.id_back().alias("doc_id"), "n_words", "n_removed", "kept_text")


#: :func:`remove_repeats` in DuckDB, with the hash of the kept text.
SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT doc_id, unnest(generate_series(1, len(words) - 49)) AS i, words FROM d WHERE len(words) >= 50),
h AS (SELECT doc_id, i, md5(array_to_string(list_slice(words, i, i + 49), ' ')) AS h FROM w),
f AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY h) AS first FROM h) WHERE first < doc_id),
g AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS i FROM f),
r AS (SELECT doc_id, list(i) AS gone FROM g GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(len(gone), 0) AS n_removed,
 sha256(array_to_string(list_filter(list_transform(words, lambda x, i: CASE WHEN list_contains(gone, i) THEN NULL ELSE x END), lambda x: x IS NOT NULL), ' ')) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id)
"""
