"""Quality by co-training: a classifier of the text and one of the page teach each other.

The text view sees characters and words: hashed frequencies of byte pairs and a few shares. The
page view sees what is known about the page: source, language, length and how its lines are
laid out. Both start from the same bounded sample of labelled documents. In each round each view
labels a bounded pool of unlabelled documents and hands the ones it is surest of to the other
view. At the end both are calibrated on labelled documents that neither has learnt from, their
calibrated log odds are combined, and Spark scores every document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_or_empty
from tidemark.llm.logistic import fit_logistic, logistic
from tidemark.llm.toxicity import is_held_out

#: Labelled documents by class, and unlabelled ones in the pool; the rest is scored, not learnt.
SAMPLE_DOCUMENTS = {1: 4000, 0: 4000}
POOL_DOCUMENTS = 8000
#: Rounds, and what each view hands over per round and class, as a share of the pool.
ROUNDS, HANDED = 4, 0.02
#: How sure a view must be of what it hands over.
SURE = 0.9
PAIRS, SOURCES, SHARES = 128, 16, 8
THRESHOLD = 0.5

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[b for b in range(33, 127) if not chr(b).isalnum()]] = True


def text_features(text: str) -> np.ndarray:
    """Byte pairs by hash, and shares of upper case, symbols, digits, repeats and long words."""
    body = np.frombuffer(text.encode(), np.uint8)
    out = np.zeros(PAIRS + SHARES)
    if not len(body):
        return out
    pairs = (body[:-1].astype(np.uint32) * 257 + body[1:]) * np.uint32(2654435761) >> np.uint32(25)
    out[:PAIRS] = np.sqrt(np.bincount(pairs, minlength=PAIRS) / max(1, len(pairs)))
    words = text.split()
    n, m = len(body), max(1, len(words))
    upper = ((body >= 65) & (body <= 90)).sum()
    again = sum(a == b for a, b in zip(words, words[1:], strict=False))
    out[PAIRS:] = [
        upper / n,
        _SYMBOLS[body].sum() / n,
        ((body >= 48) & (body <= 57)).sum() / n,
        again / m,
        len(set(words)) / m,
        n / m / 20,
        sum(w.isupper() for w in words) / m,
        (body >= 128).sum() / n,
    ]
    return out


def page_features(source: str | None, lang: str | None, text: str) -> np.ndarray:
    """Hashed source and language, length, and the layout of lines."""
    out = np.zeros(2 * SOURCES + 5)
    out[zlib.crc32((source or "").encode()) % SOURCES] = 1
    out[SOURCES + zlib.crc32((lang or "").encode()) % SOURCES] = 1
    lines = [len(line) for line in text.split("\n")]
    n = max(1, len(text))
    out[2 * SOURCES :] = [
        np.log1p(len(text)),
        np.log1p(len(lines)),
        np.log1p(max(lines)),
        np.log1p(n / len(lines)),
        sum(length < 40 for length in lines) / len(lines),
    ]
    return out


@dataclass
class View:
    """A logistic model on standardised features, with the slope and offset of its calibration."""

    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def odds(self, x: np.ndarray) -> np.ndarray:
        raw = np.c_[np.ones(len(x)), (x - self.center) / self.scale] @ self.weights
        return self.slope * np.clip(raw, -30, 30) + self.offset


def _view(x: np.ndarray, y: np.ndarray) -> View:
    center, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    return View(center, scale, fit_logistic((x - center) / scale, y, steps=12))


@dataclass
class Model:
    text: View
    page: View
    joint: np.ndarray

    def scores(self, text: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Combined score, and the calibrated scores of the two views."""
        a, b = self.text.odds(text), self.page.odds(page)
        return logistic(np.c_[np.ones(len(a)), a, b] @ self.joint), logistic(a), logistic(b)


def _constant(value: float, text: int, page: int) -> Model:
    def flat(n: int) -> View:
        return View(np.zeros(n), np.ones(n), np.zeros(n + 1))

    return Model(flat(text), flat(page), np.array([value, 0.0, 0.0]))


def co_train(labelled: list[np.ndarray], y: np.ndarray, pool: list[np.ndarray]) -> Model:
    """Views of labelled rows and of the pool, as (text features, page features).

    Every third labelled row only calibrates. Without both classes the score is constant: the
    share of good labels, one half without labels.
    """
    check = np.arange(len(y)) % 3 == 2
    if len(np.unique(y[~check])) < 2 or len(np.unique(y[check])) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        return _constant(float(np.log(share / (1 - share))), labelled[0].shape[1], labelled[1].shape[1])
    known = [(x[~check], y[~check]) for x in labelled]
    free = np.ones(len(pool[0]), bool)
    handed = max(1, int(HANDED * len(free)))
    for _ in range(ROUNDS):
        views = [_view(*k) for k in known]
        for giver, taker in ((0, 1), (1, 0)):
            rows = np.flatnonzero(free)
            if not len(rows):
                break
            p = logistic(views[giver].odds(pool[giver][rows]))
            order = np.argsort(p, kind="stable")
            bad, good = order[:handed], order[::-1][:handed]
            bad, good = rows[bad[p[bad] <= 1 - SURE]], rows[good[p[good] >= SURE]]
            chosen = np.concatenate([bad, good])
            x, labels = known[taker]
            known[taker] = (np.r_[x, pool[taker][chosen]], np.r_[labels, np.zeros(len(bad)), np.ones(len(good))])
            free[chosen] = False
    views = [_view(*k) for k in known]
    for view, x in zip(views, labelled, strict=True):
        view.offset, view.slope = fit_logistic(view.odds(x[check])[:, None], y[check])
    odds = np.c_[views[0].odds(labelled[0][check]), views[1].odds(labelled[1][check])]
    return Model(views[0], views[1], fit_logistic(odds, y[check]))


def _features(batch: pa.RecordBatch, at: int) -> tuple[np.ndarray, np.ndarray]:
    source, lang, text = (batch.column(at + i).to_pylist() for i in range(3))
    x = np.array([text_features(t) for t in text]).reshape(-1, PAIRS + SHARES)
    z = np.array([page_features(*row) for row in zip(source, lang, text, strict=True)]).reshape(-1, 2 * SOURCES + 5)
    return x, z


def _inputs(docs: DataFrame, text: str) -> DataFrame:
    return docs.select("doc_id", F.col("source").cast("string"), F.col("lang").cast("string"), text_or_empty(text).alias("_text"))


def learn(docs: DataFrame, labels: DataFrame, *, text: str = "text") -> Model:
    """A model from ``labels.quality`` of rows that are not held out, and a pool without labels.

    Features of the bounded samples are computed in Spark; the driver reads them and fits. Of the rows of one id a
    sample holds that with the smallest text hash.
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~is_held_out())
    known = known.groupBy("doc_id").agg(F.max("quality").alias("y"))
    order = F.xxhash64("doc_id")
    parts = [known.where(F.col("y") == k).orderBy(order, "doc_id").limit(n) for k, n in SAMPLE_DOCUMENTS.items()]
    named = labels.select("doc_id").distinct()
    pool = docs.select("doc_id").where("doc_id IS NOT NULL").join(named, "doc_id", "left_anti").distinct()
    pool = pool.orderBy(order, "doc_id").limit(POOL_DOCUMENTS).withColumn("y", F.lit(None).cast("int"))
    sample = parts[0].unionByName(parts[1]).select("doc_id", F.col("y").cast("int")).unionByName(pool)
    rows = F.broadcast(sample).join(_inputs(docs, text), "doc_id")
    one = F.min(F.struct(F.xxhash64("_text").alias("hash"), "source", "lang", "_text")).alias("one")
    rows = rows.groupBy("doc_id", "y").agg(one).select("doc_id", "y", "one.source", "one.lang", "one._text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, z = _features(batch, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([r.tobytes() for r in np.c_[x, z].astype(np.float32)], pa.binary())],
                names=["doc_id", "y", "x"],
            )

    got = rows.mapInArrow(run, "doc_id long, y int, x binary").collect()
    got.sort(key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"], r["x"]))
    width = PAIRS + SHARES
    x = np.array([np.frombuffer(r["x"], np.float32) for r in got], float).reshape(-1, width + 2 * SOURCES + 5)
    y = np.array([np.nan if r["y"] is None else r["y"] for r in got], float)
    has = ~np.isnan(y)
    return co_train([x[has][:, :width], x[has][:, width:]], y[has], [x[~has][:, :width], x[~has][:, width:]])


def quality(docs: DataFrame, labels: DataFrame, *, text: str = "text") -> DataFrame:
    """``doc_id, score, kept, text_score, page_score`` for every row of ``docs``.

    Scores run from 0 to 1, higher for better documents; ``kept`` means a score of at least
    one half. Whole texts are read. Null texts are empty; null sources and languages are values
    of their own; such documents are scored like any other. Repeated rows get equal scores. An
    empty table gives an empty result; without labels of both classes all scores are equal.
    Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, text=text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [pa.array(s) for s in shared.value.scores(*_features(batch, 1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *scores], names=["doc_id", "score", "text_score", "page_score"])

    scored = _inputs(docs, text).mapInArrow(run, "doc_id long, score double, text_score double, page_score double")
    return scored.select("doc_id", "score", (F.col("score") >= THRESHOLD).alias("kept"), "text_score", "page_score")
