"""Token counts, mixing, learned scores, URL rules and decontamination."""

import random
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import decontamination, mixing, quality, token_counts, toxicity, url_filter

from .conftest import prose

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "it's THE end<|endoftext|>of <|startoftext|> all",
    "nbsp\u00a0here and\u2003em\u0085next\x1cfs\x00nul",
    "e\u0301 cafe\u0301 İstanbul ΣΑΣ ﬁ ℌ 漢字 한국 emoji 😀😀 ١٢٣",
    "12345 don't we'll I'VE 'tis a'b'c --- !!!??",
    "ŉ ǆ ß ẞ ſ \u00ad soft",
    "x" * 5000,
]


def test_token_counts(table, awkward):
    rows = awkward + [(100 + i, t) for i, t in enumerate(ODD)]
    library = Tokenizer.from_file(TOKENIZER)
    library.no_truncation()
    want = sorted(
        ((i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 2048) for i, t in rows),
        key=repr,
    )
    got = token_counts.token_counts(table(rows), TOKENIZER)
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_token_counts_without_table(table, awkward, monkeypatch):
    """The frequent pieces only save work."""
    monkeypatch.setattr(token_counts, "TABLE_PIECES", 3)
    monkeypatch.setattr(token_counts, "CACHE_PIECES", 5)
    test_token_counts(table, awkward)
    assert token_counts.token_counts(table([]), TOKENIZER).count() == 0


def test_mix(table, awkward):
    docs = table(awkward, sources=("é", "b", None, "a"))
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(awkward)
    words = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in awkward}
    totals = {}
    for r in rows:
        assert r["size"] == words[r["doc_id"]]
        assert 0 <= r["taken"] <= 3 * r["size"]
        t = totals.setdefault(r["source"], [0, 0, r["target"], r["source_size"]])
        t[0] += r["taken"]
        t[1] += r["size"]
    for taken, size, target, source_size in totals.values():
        assert size == source_size and target <= 3 * size
        assert taken == int(target)
    assert abs(sum(t[2] for t in totals.values()) - sum(words[i] for i, _ in awkward)) < 1e-6
    assert sorted(map(repr, mixing.mix(docs.repartition(5)).collect())) == sorted(map(repr, rows))
    assert mixing.mix(table([])).count() == 0


def test_capped_targets_are_shared_again(spark):
    sizes = spark.createDataFrame([(1, "a", 10), (2, "b", 1000), (3, "c", 20), (4, None, 0)], "doc_id int, source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    assert got == {"a": 30.0, "c": 60.0, None: 0.0, "b": 940.0}


def test_copies_of_the_mix(table, awkward):
    docs = table([r for r in awkward if r[0] != 9])
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect()}
    sums = {}
    for r in mixing.mixed_documents(docs).collect():
        sums[r["doc_id"]] = sums.get(r["doc_id"], 0) + r["words"]
    assert sums == {i: n for i, n in taken.items() if n}


def test_copies_of_rows_with_one_id_or_none(table):
    """Each row takes its own share: other texts and sources of an id, null ids, repeated rows."""
    rows = [(i, prose(n, 5 + 7 * n)) for n, i in enumerate([None, None, None, None, 4, 4, 4, 8, 8, 8, 9, 10])]
    docs = table([*rows, rows[0], rows[4]], sources=("b", "a"))
    want, got = {}, {}
    for r in mixing.mix(docs).collect():
        of = (r["doc_id"], r["source"], r["size"])
        want[of] = want.get(of, 0) + r["taken"]
    for r in mixing.mixed_documents(docs).collect():
        of = (r["doc_id"], r["source"], len(r["text"].split()))
        got[of] = got.get(of, 0) + r["words"]
    assert got == {of: n for of, n in want.items() if n}


def toxic_corpus(table, spark, n=360):
    rng = random.Random(3)
    texts, labels = [], []
    for i in range(n):
        words = prose(i, rng.randrange(60, 200)).split()
        bad = i % 4 == 0
        for _ in range(12 if bad else 0):
            words[rng.randrange(len(words))] = rng.choice(["grumblefish", "snarkweed", "vilemoss"])
        texts.append((i, " ".join(words)))
        labels.append((i, 1 - int(bad), int(bad)))
    labels += [(1, None, None), (None, 1, 1), (10_000, 0, 1)]
    return table(texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(table, spark):
    docs, labels = toxic_corpus(table, spark)
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got.values())
    held = [r for r in got.values() if r["held_out"]]
    right = sum(r["predicted"] == int(r["doc_id"] % 4 == 0) for r in held)
    assert len(held) > 80 and right >= 0.95 * len(held)
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if not r["predicted"]}
    assert kept.where("score = 0.5").count() == kept.count()


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0)]])
def test_models_without_both_classes(table, spark, awkward, labels):
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = table(awkward)
    assert toxicity.toxicity(docs, known).where("predicted = 0").count() == len(awkward)
    assert quality.quality(docs, known).select("score").distinct().count() == 1
    assert toxicity.toxicity(table([]), known).count() == quality.quality(table([]), known).count() == 0


def test_quality_on_held_out_rows(table, spark):
    rng = random.Random(5)
    texts, labels = [], []
    for i in range(300):
        good = i % 3 != 0
        text = prose(i, rng.randrange(40, 120))
        texts.append((i, text + "." if good else "\n".join(w.upper() + "!!" for w in text.split())))
        if i % 5 != 4:
            labels.append((i, int(good), 0))
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = quality.quality(table(texts), known).withColumn("out", toxicity.is_held_out()).where("out").collect()
    assert sum(r["kept"] == (r["doc_id"] % 3 != 0) for r in rows) >= 0.95 * len(rows) > 70


def test_samples_hold_one_row_per_id(table, spark, monkeypatch):
    """Very many rows of an id count once, the same row in every run."""
    docs = table([(i, prose(n, 30)) for n, i in enumerate([0, 2, 3, 50] * 20)])
    known = spark.createDataFrame([(0, 1, 0), (2, 0, 1), (3, 1, 0)], "doc_id long, quality int, toxic int")
    known, seen = known.where(~toxicity.is_held_out()), []
    n = known.count()
    fit, co_train = toxicity.fit, quality.co_train
    monkeypatch.setattr(toxicity, "fit", lambda texts, y: (seen.append(texts), fit(texts, y))[1])
    monkeypatch.setattr(quality, "co_train", lambda x, y, pool: (seen.append((len(y), len(pool[0]))), co_train(x, y, pool))[1])
    for some in (docs, docs.repartition(5)):
        toxicity.learn(some, known)
        quality.learn(some, known)
    assert seen[0] == seen[2] and len(seen[0]) == n > 0 and seen[1] == seen[3] == (n, 4 - n)


def items(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def contaminated_brute(text, item):
    """Highest weighted similarity of an aligned window and the item."""
    from collections import Counter

    a, b = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower()), re.findall(r"[^\x20\x09-\x0D]+", (item or "").lower())
    if not b:
        return 0.0
    k, best = min(5, len(b)), 0.0
    other = Counter(tuple(b[j : j + k]) for j in range(len(b) - k + 1))
    for s in range(len(a) - len(b) + 1):
        own = Counter(tuple(a[j : j + k]) for j in range(s, s + len(b) - k + 1))
        both = sum((own & other).values())
        best = max(best, both / (own.total() + other.total() - both))
    return best


def test_decontamination(table, spark, awkward):
    rng = random.Random(9)
    bench = [prose(1000 + i, rng.randrange(14, 60), 5000) for i in range(25)] + ["", None, "two words", "same same same same same same same"]
    rows = list(awkward)
    for i, item in enumerate(bench[:25]):
        words = item.split()
        for _ in range(i % 4):
            words[rng.randrange(len(words))] = "edited"
        rows.append((200 + i, f"{prose(i, 30)} {' '.join(words).upper()} {prose(i + 500, 20)}"))
    rows += [(300, "Two Words"), (301, "here two words stand"), (302, "same " * 9)]
    rows = [r for r in rows if r[0] not in (20, 21)]
    docs, benchmark = table(rows), items(spark, bench)
    want = {}
    for i, text in rows:
        hits = [b for b, item in enumerate(bench) if contaminated_brute(text, item) >= 0.75]
        want.setdefault(i, set()).add(tuple(hits))
    got = decontamination.contamination(docs, benchmark).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r["item_ids"] or ()) in want[r["doc_id"]]
        assert r["kept"] == (not r["item_ids"])
    kept = decontamination.without_items(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in got)
    for empty in (docs.limit(0), docs):
        assert decontamination.contamination(empty, items(spark, [])).where("kept").count() == empty.count()


def window_brute(text, item):
    """:func:`contaminated_brute` for texts of any length: one with fewer words than the item is one window."""
    a, b = text.lower().split(), item.lower().split()
    if len(a) >= len(b):
        return contaminated_brute(text, item)
    own, other = ({tuple(w[j : j + 5]) for j in range(len(w) - 4)} for w in (a, b))
    return len(own & other) / len(own | other)


def test_items_cut_at_the_ends_of_a_text(table, spark):
    """Items without their first or last words, alone too, and one with swapped halves."""
    rows, bench = [], []
    for i, (n, lost) in enumerate([(14, 1), (30, 2), (60, 3)]):
        words = prose(2000 + i, n, 5000).split()
        bench.append(" ".join(words))
        head, tail, half, rest = (*map(" ".join, (words[:-lost], words[lost:], words[n // 2 :])), prose(2100 + i, 100, 5000))
        rows += [(10 * i + k, t) for k, t in enumerate([f"{tail} {rest}", f"{rest} {head}", tail, head, half, rest])]
    swapped = bench[2].split()
    rows.append((50, f"{prose(2200, 80, 5000)} {' '.join(swapped[30:] + swapped[:30])} {prose(2201, 80, 5000)}"))
    got = {r["doc_id"]: r for r in decontamination.contamination(table(rows), items(spark, bench)).collect()}
    for i, text in rows:
        best = max(window_brute(text, b) for b in bench)
        assert got[i]["kept"] == (best < 0.75) == (i % 10 in (4, 5))
        assert got[i]["kept"] or got[i]["similarity"] == pytest.approx(best)


def test_blocks_guarantee_the_radius(spark):
    """Fingerprints within the radius agree in a block."""
    rng = random.Random(1)
    pairs = []
    for _ in range(300):
        x, y = rng.getrandbits(64), 0
        y = x
        for bit in rng.sample(range(64), rng.randrange(decontamination.RADIUS + 1)):
            y ^= 1 << bit
        pairs.append((x - (1 << 63), y - (1 << 63)))
    df = spark.createDataFrame(pairs, "x long, y long")
    b = [decontamination.blocks(c, decontamination.RADIUS) for c in "xy"]
    assert df.where(F.arrays_overlap(*b)).count() == len(pairs)


URLS = [
    (1, "https://WWW.Example.org/es/1", "example.org/es/", "block"),
    (2, "http://a.example.org/en/12?x=/de/", "example.org/en/1", "block"),
    (3, "http://a.example.org/fr/", "org/", "allow"),
    (4, "http://notexample.org/es/", "org/", "allow"),
    (5, "http://x.com/de/a#b", "com/de/", "block"),
    (6, "http://x.com/fr/a", "com/fr/", "allow"),
    (7, "http://x.com", None, None),
    (8, "http://example.org?q", None, None),
    (9, None, None, "allow"),
    (10, "no scheme/com/de/", None, "allow"),
    (11, "", None, "allow"),
    (12, "a://b://c.com/de/", None, None),
    (13, "http://Ünï.COM:80/DE/", None, None),
]


def test_url_rules(spark):
    pages = spark.createDataFrame([u[:2] for u in URLS], "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, bad int")
    got = {r["page_id"]: r for r in url_filter.filter_urls(pages, none).collect()}
    for page, _, rule, verdict in URLS:
        assert got[page]["rule"] == rule and got[page]["verdict"] == (verdict or "allow")
    assert (got[2]["host"], got[2]["path"]) == ("a.example.org", "/en/12")
    assert (got[7]["host"], got[7]["path"]) == ("x.com", "")
    assert (got[12]["host"], got[12]["path"]) == ("b:", "//c.com/de/")
    assert got[13]["host"] == "Ünï.com:80"
    assert got[9]["host"] == got[10]["host"] == got[10]["path"] == ""
    assert url_filter.filter_urls(pages.limit(0), none).count() == 0


def test_host_reputation_shrinks(spark):
    pages, bad = [], []
    for host, n, k in (("bad.spam.net", 200, 190), ("good.fine.net", 200, 4), ("new.spam.net", 1, 0), ("ok.fine.net", 1, 1)):
        for _ in range(n):
            i = len(pages)
            pages.append((i, f"http://{host}/p"))
            bad.append((i, int(k > 0)))
            k -= 1
    pages += [(len(pages), "http://unseen.spam.net/"), (len(pages), "http://unseen.fine.net/")]
    got = url_filter.filter_urls(
        spark.createDataFrame(pages, "page_id long, url string"),
        spark.createDataFrame([*bad, (99_999, 1), (0, None)], "page_id long, bad int"),
    )
    share = {r["host"]: r["bad_share"] for r in got.select("host", "bad_share").distinct().collect()}
    verdict = {r["host"]: r["verdict"] for r in got.select("host", "verdict").distinct().collect()}
    assert verdict["bad.spam.net"] == "block" and verdict["good.fine.net"] == "allow"
    assert share["new.spam.net"] > share["ok.fine.net"] or share["ok.fine.net"] < 1
    assert share["unseen.spam.net"] > share["unseen.fine.net"]
