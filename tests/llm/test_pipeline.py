"""The pipeline's stages against brute force, each on what its predecessor kept."""

import random

import pytest

import corpus_pipeline
from tidemark.llm import mixing
from tidemark.llm.queries import QUERIES

from .conftest import prose
from .test_dedup import exact_brute, group_brute
from .test_scoring import contaminated_brute, items

MARKED = ["grumblefish", "snarkweed", "vilemoss"]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng, rows, labels = random.Random(2), [], []
    bench = [prose(900 + i, 25, 3000) for i in range(4)]
    for i in range(240):
        text = prose(i, rng.randrange(40, 120), 3000)
        bad = i % 5 == 0
        if bad:
            words = text.split()
            for _ in range(10):
                words[rng.randrange(len(words))] = rng.choice(MARKED)
            text = " ".join(words)
        if i % 16 == 3:
            text = f"{text} {bench[i % 4]}"
        rows.append((i, text))
        labels.append((i, 1, int(bad)))
    rows += [(300 + i, rows[i][1].upper()) for i in range(1, 20)]
    rows += [(400 + i, rows[i][1] + " tail") for i in range(1, 20)]
    rows += [(500, None), (501, ""), rows[7]]
    folder = str(tmp_path_factory.mktemp("sf"))
    full = [(i, t, "en", None if i % 9 == 8 else f"s{i % 3}", None if t is None else len(t)) for i, t in rows]
    spark.createDataFrame(full, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    items(spark, bench).write.parquet(f"{folder}/benchmark.parquet")
    return folder


def pairs(rows):
    return sorted(((r["doc_id"], r["text"]) for r in rows), key=repr)


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    before, kept = docs.collect(), []
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        if number < 4:
            assert docs.dtypes == [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint")]
        after = docs.collect()
        rows = [(r["doc_id"], r["text"]) for r in before]
        if name == "toxicity":
            bad = {r["doc_id"] for r in before if any(w in (r["text"] or "").lower() for w in MARKED)}
            gone = {r["doc_id"] for r in before} - {r["doc_id"] for r in after}
            assert len(gone - bad) <= 2 and len(bad - gone) <= 0.1 * len(bad)
        elif name == "exact dedup":
            good = {(r[0], r[4]) for r in exact_brute(rows) if r[3]}
            assert len(after) == len(good) and pairs(after) == sorted({p for p in rows if p[0] in {g[0] for g in good}}, key=repr)
        elif name == "n-gram join":
            assert pairs(after) == sorted((p for p in rows if (p[0], p[0]) in {(r[0], r[2]) for r in group_brute(rows)}), key=repr)
        elif name == "decontamination":
            clean = [p for p in rows if not any(contaminated_brute(p[1], b) >= 0.75 for b in bench)]
            assert pairs(after) == sorted(clean, key=repr) and len(clean) < len(rows)
        else:
            words = {}
            for r in after:
                words[r["doc_id"]] = words.get(r["doc_id"], 0) + r["words"]
                assert r["copy"] <= mixing.MOST_EPOCHS
            source = spark.createDataFrame(before, COLUMNS)
            assert words == {r["doc_id"]: r["taken"] for r in mixing.mix(source).collect() if r["taken"]}
        before = after
        kept.append(len(after))
    assert kept[1] < kept[0] and kept[2] < kept[1]


def test_run_is_the_registered_query(spark, sf_dir):
    assert QUERIES["pipeline"] is corpus_pipeline.run
    rows = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "text", "lang", "source", "n_chars", "copy", "words"} == set(rows.columns)
    assert rows.count() > 100


def test_empty_tables(spark, tmp_path):
    none = {"documents": COLUMNS, "labels": "doc_id long, quality int, toxic int", "benchmark": "item_id long, text string"}
    for name, schema in none.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
