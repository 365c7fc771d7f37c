"""Hard negatives (11), token-id blocks (12) and lexical search (13) against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import hard_negatives, lexical_search, token_ids

from .conftest import prose

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


# ---------------------------------------------------------------- 12: token ids


def _expected_ids(rows, end_id=2):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0))
    out, start = [], 0
    for doc_id, text in ordered:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id]
        out.append((doc_id, start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_ids_round_trip(spark, table, awkward):
    """Nulls, empty and long texts, repeated ids, special strings and clashing columns."""
    texts = [*awkward, (30, "a<|endoftext|>b <|endoftext|>"), (31, "  \n\n x\t\ty  ")]
    docs = table(texts).withColumnRenamed("row", "ids").withColumnRenamed("size", "part")
    got = token_ids.token_ids(docs, TOKENIZER, end_id=2).collect()
    want = _expected_ids(texts)
    # Repeated ids are documents of their own in any order among themselves: compare by id.
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (d is None, d or 0, n, c) for d, _, n, c in want
    )
    by_start = sorted(got, key=lambda r: r.start)
    assert by_start[0].start == 0
    for a, b in zip(by_start, by_start[1:]):
        assert b.start == a.start + a.n_tokens
    assert [r.doc_id for r in by_start][-1] is None  # null ids go last


def test_token_ids_empty(spark, table):
    assert token_ids.token_ids(table([]), TOKENIZER).count() == 0


def test_huffman_codes_and_blocks():
    rng = random.Random(4)
    counts = {i: rng.choice([1, 1, 2, 5, 1000, 10**9]) for i in range(3000)}
    lengths = token_ids.code_lengths(counts, max_bits=12)
    assert max(lengths.values()) <= 12
    assert sum(2.0 ** -n for n in lengths.values()) <= 1.0
    code = token_ids.Code(lengths, max_bits=12)
    ids = np.array([rng.randrange(3000) for _ in range(5000)])
    bits, marks = token_ids.encode_block(ids, code)
    assert len(marks) == math.ceil(5000 / token_ids.CHECKPOINT_TOKENS)
    assert (token_ids.decode_block(bits, marks, len(ids), code) == ids).all()
    assert token_ids.code_lengths({7: 3}) == {7: 1}
    assert token_ids.code_lengths({}) == {}


def test_code_tables_are_the_canonical_code():
    rng = random.Random(6)
    for counts in ({}, {7: 3}, {i * 3: rng.choice([1, 2, 5, 1000, 10**9]) for i in range(700)}):
        lengths = token_ids.code_lengths(counts, max_bits=12)
        code = token_ids.Code(lengths, max_bits=12)
        symbol = np.full(1 << 12, -1)
        for i, (value, n) in token_ids.canonical_code(lengths).items():
            assert (code.value[i], code.length[i]) == (value, n)
            symbol[value << (12 - n) : (value + 1) << (12 - n)] = i
        assert (code.symbol == symbol).all()
        assert all(code.width[k] == (code.length[i] if i >= 0 else 0) for k, i in enumerate(symbol))


def test_encoder_equals_tokenizer():
    with open(TOKENIZER, encoding="utf-8") as file:
        encoder = token_ids.Encoder(file.read())
    tokenizer = Tokenizer.from_file(TOKENIZER)
    samples = [prose(9, 500), "It's 'S 1234 ２３ é x  　y\n\n\n z", "<|endoftext|><|endoftext|>x", "", " ", "😀 ok"]
    for text in samples:
        assert encoder.encode(text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_plain_texts_split_as_all_others():
    """Whichever pattern splits a text, the pieces and the ids are the library's; ids are cached as bytes."""
    with open(TOKENIZER, encoding="utf-8") as file:
        encoder = token_ids.Encoder(file.read())
    tokenizer = Tokenizer.from_file(TOKENIZER)
    rng = random.Random(11)
    plain = "aZé ÿÀ×÷09'stvemrld \n\t -_.,!¡~’“—…"
    plain = [c for c in plain if token_ids.PLAIN_TEXT.fullmatch(c)]
    others = [*plain, "²", "½", "ß", "\x1c", "\x85", "\xa0", "\u3000", "٣", "漢", "\r", "\x7f", "😀", "<|endoftext|>"]
    for n in range(400):
        text = "".join(rng.choices(plain if n % 2 else others, k=rng.randrange(60)))
        if n % 2:
            assert token_ids.PLAIN_TEXT.fullmatch(text)
            assert token_ids.PLAIN_SPLIT.findall(text) == encoder.split.findall(text)
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == want
        assert encoder.encoded(text) == np.array(want, "<u4").tobytes()
    assert not token_ids.PLAIN_TEXT.fullmatch("a²") and all(isinstance(v, bytes) for v in encoder.cache.values())


# ---------------------------------------------------------------- 13: lexical search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return TERM.findall(text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))) if text else []


def _brute_search(docs, items):
    terms = [(d, _terms(t)) for d, t in docs]
    big_n = sum(1 for _, t in terms if t)
    big_l = sum(len(t) for _, t in terms)
    df = Counter(x for _, t in terms for x in set(t))
    out = []
    for item_id, text in dict.fromkeys(items):
        wanted = set(_terms(text))
        scored = []
        for d, t in terms:
            if not t:
                continue
            m = 10 + (90 * len(t) * big_n) // big_l
            tf = Counter(t)
            score = sum(
                math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[x] + 1))) * ((10**9 * tf[x]) // (1000 * tf[x] + 8 * m))
                for x in wanted
                if tf[x]
            )
            if score > 0:
                scored.append((score, d))
        scored.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        out += [(item_id, k + 1, d, s) for k, (s, d) in enumerate(scored[:10])]
    return out


def test_search_against_brute_force(spark, table, awkward):
    rng = random.Random(3)
    words = ["Alpha", "beta", "gamma", "delta", "ÉCOLE", "x1", "naïve", "the", "of"]
    texts = [*awkward, *[(100 + i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 30)))) for i in range(60)]]
    texts += [(200, "alpha beta"), (201, "alpha beta"), (202, "alpha beta")]  # ties
    items = [(1, "alpha beta"), (2, "ÉCOLE of the"), (3, None), (4, "unknownword"), (2, "ÉCOLE of the"), (5, "w1 w2, w3.")]
    docs = table(texts).withColumnRenamed("row", "item").withColumnRenamed("size", "score")
    item_df = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", lexical_search.F.lit(1))
    got = lexical_search.search(docs, item_df).collect()
    want = _brute_search(texts, items)
    key = lambda r: (r[0], r[1])
    assert sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in got), key=key) == sorted(want, key=key)


def test_search_empty(spark, table):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical_search.search(table([]), items).count() == 0
    assert lexical_search.search(table([(1, "a")]), items.limit(0)).count() == 0


# ---------------------------------------------------------------- 11: hard negatives


def _brute_negatives(rows):
    valid = []
    for vec_id, label, vector in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        valid.append((vec_id, label, [math.floor(256 * x) for x in vector]))

    def dot(a, b):
        n = max(len(a), len(b))
        a, b = a + [0] * (n - len(a)), b + [0] * (n - len(b))
        return sum(x * y for x, y in zip(a, b))

    out = []
    for aid, alabel, av in dict.fromkeys((v, lab, tuple(vec)) for v, lab, vec in valid if v % 100 == 0):
        scored = [(dot(list(av), c), cid, clab) for cid, clab, c in valid]
        pos = sorted([s for s in scored if s[2] == alabel and s[1] != aid], key=lambda s: (-s[0], s[1]))[:5]
        for ps, pid, _ in pos:
            band = [s for s in scored if s[2] != alabel and 30 * ps <= 100 * s[0] <= 90 * ps]
            for rank, (ns, nid, _) in enumerate(sorted(band, key=lambda s: (-s[0], s[1]))[:10], 1):
                out.append((aid, pid, rank, nid, ps, ns))
    return out


def test_hard_negatives_against_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for i in range(700):
        vector = [rng.uniform(-0.5, 0.5) for _ in range(8)]
        rows.append((i, rng.randrange(3), vector))
    rows += [(1000, 1, [0.25] * 8), (1001, 1, [0.25] * 8), (1002, 2, [0.25] * 8)]  # ties by id
    rows += [(1100, None, [0.1] * 8), (1200, 1, None), (1300, 1, [0.1, None] + [0.0] * 6), (1400, 2, [float("nan")] * 8)]
    rows += [(1500, 1, [0.3] * 5), (None, 1, [0.3] * 8), (200, 1, rows[200][2])]  # short vector, null id, repeated anchor
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    df = df.withColumn("akey", df.vec_id).withColumn("row", df.label)  # clashing names
    got = hard_negatives.hard_negatives(df).collect()
    floats = [(v, lab, None if vec is None else [None if x is None else float(np.float32(x)) for x in vec]) for v, lab, vec in rows]
    want = _brute_negatives(floats)
    assert len(want) > 100
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_hard_negatives_over_several_partitions(spark, monkeypatch):
    """Anchors and candidates meet when the shuffle keeps its partitions, and over several blocks and groups."""
    rng = random.Random(7)
    rows = [(i, rng.randrange(3), [rng.randint(-128, 128) / 256 for _ in range(8)]) for i in range(601)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    want = sorted(_brute_negatives(rows))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert sorted(tuple(r) for r in hard_negatives.hard_negatives(df).collect()) == want
        monkeypatch.setattr(hard_negatives, "GROUP_ROWS", 200)
        monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", 3)
        assert sorted(tuple(r) for r in hard_negatives.hard_negatives(df).collect()) == want
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(want) > 100


def test_hard_negatives_empty(spark):
    df = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert hard_negatives.hard_negatives(df).count() == 0


def test_packed_scores_exact_for_huge_components():
    rng = random.Random(6)
    anchors = [[rng.randint(-(10**30), 10**30) for _ in range(5)] for _ in range(3)]
    rows = [[rng.randint(-(10**20), 10**20) for _ in range(rng.choice([3, 5]))] for _ in range(300)]
    got = hard_negatives.packed_scores(anchors, rows)
    assert got == [[sum(x * y for x, y in zip(a, r)) for r in rows] for a in anchors]


@pytest.mark.parametrize("width", [8, 24, 72])
def test_pack_unpack(width):
    values = [random.Random(width).randrange(1 << (width - 1)) for _ in range(40)]
    assert [int(x) for x in hard_negatives._unpack(hard_negatives._pack(values, width), 40, width)] == values
