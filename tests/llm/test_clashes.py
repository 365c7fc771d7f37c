"""Stage functions keep every column of the documents, whatever its name, and lose no near copy."""

import pytest

from tidemark.llm import decontamination, exact_dedup, mixing, ngram_join, toxicity

from .conftest import prose

CLASHING = "doc_id long, text string, source string, _id long, _body string, _score double, score double, words long, copy long, _sha string, _n long, _row long, _whole string, _text string"


@pytest.fixture(scope="module")
def clashing(spark):
    base = prose(31, 200)
    near = base.split()
    near[100] = "other"
    rows = [
        (1, base, "a"),
        (2, " ".join(near), "b"),
        (2, base, "b"),  # a repeated id with an equal text
        (3, base.upper(), None),
        (4, prose(32, 150), "a"),
        (5, None, "c"),
        (None, prose(33, 80), "a"),
    ]
    full = [(d, t, s, 7, "x", 0.5, 0.25, 9, 11, "s", 13, 17, "w", "t") for d, t, s in rows]
    return spark.createDataFrame(full, CLASHING)


def test_keep_one_keeps_columns(clashing):
    kept = exact_dedup.keep_one(clashing)
    assert kept.columns == clashing.columns
    rows = kept.collect()
    assert {r.doc_id for r in rows} == {2, 3, 4, 5, None}  # 3 holds base folded; 1 and (2, base) go
    assert all(r._id == 7 and r._body == "x" and r.words == 9 and r.copy == 11 for r in rows)


def test_one_of_each_keeps_columns_and_drops_near_copies(clashing):
    kept = ngram_join.one_of_each(clashing)
    assert kept.columns == clashing.columns
    rows = kept.collect()
    # 1, 2 (both texts) and 3 are one group, first 1; (2, near) goes although id 2 is no first.
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == [(False, 1), (False, 4), (False, 5), (True, 0)]


def test_one_of_each_one_id_in_two_groups(spark, table):
    a, b = prose(41, 120), prose(42, 120)
    docs = table([(5, a), (3, b), (5, b + " tail")])
    kept = sorted((r.doc_id, r.text) for r in ngram_join.one_of_each(docs).collect())
    assert kept == [(3, b), (5, a)]


def test_without_items_keeps_columns(spark, clashing):
    bench = spark.createDataFrame([(1, prose(33, 80))], "item_id long, text string")
    kept = decontamination.without_items(clashing, bench)
    assert kept.columns == clashing.columns
    assert None not in {r.doc_id for r in kept.collect()}  # the row that holds the item goes


def test_without_toxic_keeps_columns(spark, clashing):
    labels = spark.createDataFrame([(1, 1, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    kept = toxicity.without_toxic(clashing, labels)
    assert kept.columns == clashing.columns
    rows = kept.collect()
    assert len(rows) == clashing.count()
    assert {(r._score, r.score, r._body) for r in rows} == {(0.5, 0.25, "x")}


def test_mixed_documents_renames_own_copy_and_words(clashing):
    mixed = mixing.mixed_documents(clashing)
    assert mixed.columns[-2:] == ["copy", "words"]
    assert {"copy_", "words_"} <= set(mixed.columns)
    rows = mixed.collect()
    assert rows and all(r.copy_ == 11 and r.words_ == 9 for r in rows)
