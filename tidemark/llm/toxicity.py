"""Toxicity by compression distance: which of two zstandard dictionaries suits a passage better.

Both dictionaries are trained here on bounded samples of labelled texts. The ordinary one is
plain text of ordinary documents. The toxic one is the same text with the word beginnings that
toxic documents hold far more often, closest to the end, where they cost least. A text is cut
into short overlapping windows; each is compressed with both, and the saving of the toxic
dictionary in bytes is its distance. Windows of ordinary text save bytes at a low, known rate;
a logistic model calibrates how far a document's counts of savings are above that rate.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, text_or_empty
from tidemark.llm.logistic import fit_logistic, logistic

#: Labelled documents that a model is fitted on, by class, in the order of a hash of their id.
SAMPLE_DOCUMENTS = {1: 4000, 0: 6000}
#: Bytes of a sampled document that its model sees; scoring reads whole texts.
SAMPLE_BYTES = 16_384
#: Bytes of a window, and from one window to the next.
WINDOW, STEP = 64, 32
#: Bytes of ordinary text in both dictionaries, and word beginnings in the toxic one.
PLAIN_BYTES, BEGINNINGS = 131_072, 120
#: A beginning is toxic if its share of toxic documents is so many times that of ordinary ones.
LEAST_RATIO = 15.0
#: Toxic documents that must hold it: so many, and this share of them.
LEAST_DOCUMENTS, LEAST_SHARE = 4, 0.008
#: Savings of a window, in bytes, that are told apart.
SAVINGS = 9
#: Score from which a document counts as toxic.
THRESHOLD = 0.7


def is_held_out(doc_id: str | Column = "doc_id") -> Column:
    """Rows that no model may learn from: crc32 of the id as text leaves 1 modulo 3."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def windows_of(text: str) -> list[bytes]:
    body = text.lower().encode()
    return [body[i : i + WINDOW] for i in range(0, max(1, len(body) - STEP), STEP)]


def _parameters() -> zstandard.ZstdCompressionParameters:
    return zstandard.ZstdCompressionParameters(
        window_log=18,
        chain_log=16,
        hash_log=17,
        search_log=4,
        min_match=3,
        strategy=zstandard.STRATEGY_GREEDY,
        write_content_size=0,
        write_dict_id=0,
    )


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    parameters = _parameters()
    shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    shared.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(dict_data=shared, compression_params=parameters)


class Savings:
    """Counts a text's windows by how many bytes the toxic dictionary saves."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.toxic, self.ordinary = _compressor(toxic), _compressor(ordinary)

    def __call__(self, text: str) -> np.ndarray:
        toxic, ordinary = self.toxic.compress, self.ordinary.compress
        saved = [len(ordinary(w)) - len(toxic(w)) for w in windows_of(text)]
        return np.bincount(np.clip(saved, 0, SAVINGS), minlength=SAVINGS + 1)


def _beginnings(text: str) -> set[bytes]:
    found = set()
    for word in set(text.lower().encode().split()):
        found.add(word[:32])
        found.update(word[:n] for n in range(4, min(len(word), 13)))
    return found


def train_dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """Contents of the toxic and of the ordinary dictionary."""
    plain = b" ".join(b" ".join(t.lower().encode().split()) for t in ordinary)
    if len(plain) > PLAIN_BYTES:  # passages from all over the sample
        piece = 512
        starts = np.linspace(0, len(plain) - piece, PLAIN_BYTES // piece).astype(int)
        plain = b" ".join(plain[i : i + piece] for i in starts)
    yes, no = Counter(), Counter()
    for texts, counts in ((toxic, yes), (ordinary, no)):
        for text in texts:
            counts.update(_beginnings(text))

    def ratio(b: bytes) -> float:
        return (yes[b] + 0.5) / (len(toxic) + 1) * (len(ordinary) + 1) / (no[b] + 0.5)

    least = max(LEAST_DOCUMENTS, LEAST_SHARE * len(toxic))
    marked = sorted(
        (b for b, n in yes.items() if n >= least and ratio(b) > LEAST_RATIO),
        key=lambda b: (-np.log(ratio(b)) * np.sqrt(yes[b]), b),
    )[: 3 * BEGINNINGS]
    # A beginning is left out where nearly all of its documents hold a longer one.
    longest = [b for b in marked if not any(m != b and m.startswith(b) and yes[m] >= 0.8 * yes[b] for m in marked)]
    return plain + b" " + b" ".join(reversed(longest[:BEGINNINGS])), plain


@dataclass
class Model:
    """Dictionaries, the rates of savings in ordinary windows, and the calibration."""

    toxic: bytes
    ordinary: bytes
    rates: np.ndarray
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def scores(self, counts: np.ndarray) -> np.ndarray:
        z = (_features(counts, self.rates) - self.center) / self.scale
        return logistic(np.c_[np.ones(len(z)), z] @ self.weights)


def _at_least(counts: np.ndarray) -> np.ndarray:
    """From windows by saving to windows that save at least 1, 2, … bytes."""
    return np.cumsum(counts[:, ::-1], axis=1)[:, ::-1][:, 1:]


def _features(counts: np.ndarray, rates: np.ndarray) -> np.ndarray:
    n, over = counts.sum(axis=1, keepdims=True), _at_least(counts)
    return np.c_[(over - rates * n) / np.sqrt(rates * n + 1), np.sqrt(over / n), np.log(n)]


def fit(texts: list[str], labels: list[int]) -> Model:
    """A model from labelled texts: two thirds train dictionaries, the others the calibration.

    Without texts of both classes there is nothing to tell apart: every score is the share of
    toxic labels (0 without labels).
    """
    y = np.array(labels, float)
    classes = [[i for i, k in enumerate(labels) if k == kind] for kind in (1, 0)]
    train = [[texts[i] for n, i in enumerate(own) if n % 3 or len(own) < 3] for own in classes]
    rest = [i for own in classes for i in (own[::3] if len(own) >= 30 else own)]
    contents = train_dictionaries(*train)
    width = 2 * SAVINGS + 1
    if not all(classes):
        weights = np.zeros(width + 1)
        weights[0] = 30.0 if len(y) and y.all() else -30.0
        return Model(*contents, np.zeros(SAVINGS), np.zeros(width), np.ones(width), weights)
    savings = Savings(*contents)
    counts = np.array([savings(texts[i]) for i in rest])
    plain = counts[y[rest] == 0]
    rates = (_at_least(plain).sum(axis=0) + 1) / (plain.sum() + SAVINGS + 1)
    x = _features(counts, rates)
    center, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    return Model(*contents, rates, center, scale, fit_logistic((x - center) / scale, y[rest]))


def learn(docs: DataFrame, labels: DataFrame, *, text: str = "text") -> Model:
    """A model from the rows of ``labels`` that are not held out.

    The sample is bounded by ``SAMPLE_DOCUMENTS`` and ``SAMPLE_BYTES``; the driver reads it. Of
    the rows of one id it holds that with the smallest text hash.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~is_held_out()).select("doc_id", "toxic")
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id")
    chosen = [known.where(F.col("toxic") == k).orderBy(order, "doc_id").limit(n) for k, n in SAMPLE_DOCUMENTS.items()]
    sample = chosen[0].unionByName(chosen[1])
    body = F.substring(text_or_empty(text), 1, SAMPLE_BYTES).alias("body")
    known_rows = docs.select("doc_id", F.xxhash64(text_or_empty(text)).alias("hash"), body).join(F.broadcast(sample), "doc_id")
    one = known_rows.groupBy("doc_id", "toxic").agg(F.min(F.struct("hash", "body")).alias("one"))
    rows = one.select("doc_id", "toxic", "one.body").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["body"]))
    return fit([r["body"] for r in rows], [r["toxic"] for r in rows])


def score(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """``docs`` with a ``score`` from 0 to 1 of every whole text, higher for toxic ones.

    Null and empty texts are one empty window and get a score too; repeated rows get equal
    scores; an empty table stays empty. The other columns pass through; an own column ``score``
    is replaced.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    kept = docs.drop("score")
    rows = kept.select("*", text_or_empty(text).alias(fresh(kept, "_body")))
    schema = kept.select("*", F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learnt = shared.value
        savings = Savings(learnt.toxic, learnt.ordinary)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            scores = learnt.scores(np.array([savings(t) for t in texts])) if texts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores)], names=schema.names)

    return rows.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, *, text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Without usable labels every score is near 0. See :func:`score` for the other cases.
    """
    scored = score(docs.select("doc_id", text), learn(docs, labels, text=text), text=text)
    return scored.select(
        "doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, labels: DataFrame, *, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with their columns."""
    model = learn(docs, labels, text=text)
    # The row rides in one struct beside its text, so no column of docs meets a helper's name.
    whole, body = fresh(docs, "_whole"), fresh(docs, "_text")
    packed = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias(whole), docs[text].alias(body))
    judged = score(packed, model, text=body)
    return judged.where(F.col("score") < THRESHOLD).select(f"{whole}.*")
