"""Exact, n-gram, byte and word deduplication against brute force."""

import hashlib
import itertools
import random
import re
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, ngram_join, substring_dedup, suffix_dedup, windows

from .conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(value):
    return -1 if value is None else value


def found(df, *columns):
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=repr)


def exact_brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[(text or "").translate(UPPER)].append(i)
    out = []
    for i, text in rows:
        norm = (text or "").translate(UPPER)
        keep = max(groups[norm], key=key)
        out.append((i, keep, len(groups[norm]), i == keep, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


EXACT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_exact_groups(table, awkward):
    assert found(exact_dedup.exact_groups(table(awkward)), *EXACT) == exact_brute(awkward)


def test_exact_empty(table):
    assert exact_dedup.exact_groups(table([])).count() == 0


def test_equal_digests_of_other_bytes_stay_apart(table, awkward):
    got = exact_dedup.exact_groups(table(awkward), digest=lambda t: F.unhex(F.substring(F.sha2(t, 256), 1, 1)))
    assert found(got, *EXACT) == exact_brute(awkward)


def test_keep_one(table, awkward):
    docs = table(awkward)
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    want = sorted({(i, t) for i, t in awkward if (i, True) in {(r[0], r[3]) for r in exact_brute([(i, t)for i, t in awkward])}}, key=repr)
    assert found(kept, "doc_id", "text") == want


def test_keep_one_of_each_repeated_text_of_an_id(table):
    """One id, and the null id, with several texts that each stand twice or once."""
    texts = ["first text", "second text", "third text"]
    rows = [(i, f"{t} {i}") for i in (7, None) for t in texts for _ in range(2)] + [(7, "single"), (None, "alone")]
    assert found(exact_dedup.keep_one(table(rows)), "doc_id", "text") == sorted(set(rows), key=repr)


def shingle_sets(rows):
    out = []
    for _, text in rows:
        words = WORD.findall((text or "").translate(UPPER))
        n = len(words)
        out.append({tuple(words[k : k + 5]) for k in range(n - 4)} if n >= 5 else ({tuple(words)} if n else set()))
    return out


def group_brute(rows):
    sets = shingle_sets(rows)
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    label[root(a)] = root(b)
    groups = defaultdict(list)
    for x in range(len(rows)):
        groups[root(x)].append(rows[x][0])
    return sorted(
        ((i, len(sets[x]), min(groups[root(x)], key=key)) for x, (i, _) in enumerate(rows)), key=repr
    )


GROUP = ("doc_id", "n_shingles", "component_id")


def test_similar_groups(table, awkward):
    assert found(ngram_join.similar_groups(table(awkward)), *GROUP) == group_brute(awkward)


def test_similar_groups_empty(table):
    assert ngram_join.similar_groups(table([])).count() == 0


def near_copies():
    """Texts around the threshold: words replaced in a base text, and a line that all hold."""
    import random

    rng = random.Random(7)
    line = "the very common line that each of all these texts holds here"
    rows, base = [], [f"b{k}" for k in range(120)]
    for i in range(90):
        words = list(base) if i < 60 else [f"o{i}_{k}" for k in range(60)]
        for _ in range(rng.randrange(8)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10_000)}"
        rows.append((i, " ".join(words[: rng.randrange(40, 121)]) + " " + line))
    return rows


@pytest.mark.parametrize("long", [64, 3])
def test_near_copies_at_the_threshold(table, monkeypatch, long):
    monkeypatch.setattr(ngram_join, "LONG_IN_BATCH", long)
    rows = near_copies()
    assert found(ngram_join.similar_groups(table(rows)), *GROUP) == group_brute(rows)


def test_one_of_each(table, awkward):
    docs = table(awkward)
    got = ngram_join.one_of_each(docs)
    assert got.columns == docs.columns
    want = sorted((i for i, _, c in group_brute(awkward) if i == c), key=repr)
    assert sorted((r["doc_id"] for r in got.collect()), key=repr) == want


def words_brute(rows, window=50):
    split = [(key(i), WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, words in split:
        for k in range(len(words) - window + 1):
            w = tuple(words[k : k + window])
            first[w] = min(first.get(w, i), i)
    out = []
    for (i, _), (d, words) in zip(rows, split, strict=True):
        gone = set()
        for k in range(len(words) - window + 1):
            if first[tuple(words[k : k + window])] < d:
                gone.update(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), kept))
    return sorted(out, key=repr)


WORDS = ("doc_id", "n_words", "n_removed", "kept_text")


def test_word_windows(table, awkward):
    assert found(substring_dedup.remove_repeats(table(awkward)), *WORDS) == words_brute(awkward)


def test_word_windows_empty(table):
    assert substring_dedup.remove_repeats(table([])).count() == 0


def bytes_brute(rows, window=100):
    places = sorted((key(i), t or "") for i, t in set(rows))
    first = {}
    for d, text in places:
        body = text.encode()
        for k in range(len(body) - window + 1):
            first.setdefault(body[k : k + window], (d, text, k))
    out = []
    for i, text in rows:
        body = (text or "").encode()
        gone = set()
        for k in range(len(body) - window + 1):
            if first[body[k : k + window]] != (key(i), text or "", k):
                gone.update(range(k, k + window))
        spans = sum(k - 1 not in gone for k in gone)
        out.append((i, len(body), len(gone), spans, bytes(b for k, b in enumerate(body) if k not in gone)))
    return sorted(out, key=repr)


BYTES = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept")


@pytest.mark.parametrize("batches", [1, 3])
def test_byte_windows(table, awkward, batches):
    rows = [r for r in awkward if r[0] not in (20, 21)] + [(30, "xy" * 40_000)]
    got = suffix_dedup.remove_repeats(table(rows), batches=batches)
    got = sorted(((*r[:4], bytes(r[4])) for r in got.select(*BYTES).collect()), key=repr)
    assert got == bytes_brute(rows)


def test_levels_merge_by_default(table, awkward, monkeypatch):
    """The registered query's batches are enough for levels to merge, and the rest to be scanned."""
    levels, merge = [], suffix_dedup.SuffixFamily.merge_equal

    def watched(self):
        before = len(self.levels)
        merge(self)
        levels.append((before, len(self.levels)))

    monkeypatch.setattr(suffix_dedup.SuffixFamily, "merge_equal", watched)
    rows = [r for r in awkward if r[0] not in (20, 21)]
    got = suffix_dedup.remove_repeats(table(rows))
    assert sorted(((*r[:4], bytes(r[4])) for r in got.select(*BYTES).collect()), key=repr) == bytes_brute(rows)
    assert (2, 1) in levels and (2, 2) in levels


def test_byte_windows_empty(table):
    assert suffix_dedup.remove_repeats(table([])).count() == 0


def test_shared_line_goes_to_single_windows(table, monkeypatch):
    """A passage with many different surroundings, below and above a window's length."""
    monkeypatch.setattr(suffix_dedup, "LONG_IN_BATCH", 2)
    passage = "".join(f"{k:03d}-" for k in range(30))
    rows = [(i, f"{i * 7919 % 9973:060d}" + passage[: 80 + 5 * i] + f"{i * 31337 % 9973:060d}") for i in range(9)]
    got = suffix_dedup.remove_repeats(table(rows), batches=2)
    got = sorted(((*r[:4], bytes(r[4])) for r in got.select(*BYTES).collect()), key=repr)
    assert got == bytes_brute(rows)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab é", min_size=0, max_size=60), min_size=1, max_size=8))
def test_byte_windows_of_any_texts(table, texts):
    rows = list(enumerate(texts))
    got = suffix_dedup.remove_repeats(table(rows), window=8, gram=3, batches=2)
    got = sorted(((*r[:4], bytes(r[4])) for r in got.select(*BYTES).collect()), key=repr)
    assert got == bytes_brute(rows, 8)


def test_suffixes_take_little_disk(table, spark, monkeypatch):
    """A suffix is written once per level that takes it in, with its place, and no shuffle outlives its step."""
    rng = random.Random(11)
    rows = [(i, rng.randbytes(1500).hex()) for i in range(400)]
    suffixes = len(windows.find_runs([np.frombuffer(t.encode(), np.uint8) for _, t in rows], 100, 48))
    written, write = [], suffix_dedup.SuffixFamily._write

    def sized(self, *args):
        name = write(self, *args)
        files = Path(self.folder.removeprefix("file:")) / name
        written.append(sum(f.stat().st_size for f in files.rglob("*.parquet")))
        return name

    def shuffle_files():
        held = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in held.mkString("|").split("|") if "/shuffle_" in f}

    monkeypatch.setattr(suffix_dedup.SuffixFamily, "_write", sized)
    docs, before = table(rows).localCheckpoint(), shuffle_files()
    got = suffix_dedup.remove_repeats(docs, batches=2)
    assert not shuffle_files() - before
    assert sum(written) < 40 * suffixes
    assert got.where("n_removed = 0 AND n_bytes = 3000").count() == 400


def test_pieces_meet(table, monkeypatch):
    """Copies, near copies and shared passages in different pieces, parts, batches and levels."""
    for name, value in (("TEXT_AT_ONCE", 900), ("WINDOWS_AT_ONCE", 64), ("LONG_IN_BATCH", 3)):
        monkeypatch.setattr(suffix_dedup, name, value)
    rng = random.Random(12)
    base, line = prose(21, 60), prose(22, 25)
    rows = []
    for i in range(40):
        text = base if i % 5 == 0 else " ".join(prose(i + 100, 8) for _ in range(2)) + line + prose(i + 200, 12)
        at = rng.randrange(len(text))
        rows.append((i * 17 % 40, text[:at] + "#" * (i % 3) + text[at:]))
    rows += rows[:3]
    got = suffix_dedup.remove_repeats(table(rows))
    got = sorted(((*r[:4], bytes(r[4])) for r in got.select(*BYTES).collect()), key=repr)
    assert got == bytes_brute(rows)


def many_near(groups=40, size=8):
    """Sets around one text, each group within reach of its own centre and near all other groups."""
    rng = np.random.default_rng(5)
    common = rng.integers(0, 1 << 62, 300, np.int64).astype(np.uint64)
    sets = []
    for _ in range(groups * size):
        sets.append(np.unique(np.append(common, rng.integers(0, 1 << 62, int(rng.integers(20, 90)), np.int64).astype(np.uint64))))
    return sets, np.repeat(np.arange(groups), size)


def test_search_rows_grow_no_faster_than_a_list():
    """A list of near sets of many groups hands on fewer pairs than it has sets, which still
    connect all that must be compared; the links found connect what all pairs would connect."""
    sets, labels = many_near()
    ids, sizes = np.arange(len(sets)), np.array([len(s) for s in sets])
    bits = [ngram_join.parity_bits(s) for s in sets]
    near = ngram_join.near_in_list(ids, sizes, labels, bits)
    links = ngram_join.linked_in_part(ids, labels, bits, sets)
    brute = []
    for i, j in itertools.combinations(range(len(sets)), 2):
        shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        if labels[i] != labels[j] and 4 * shared >= 3 * (sizes[i] + sizes[j] - shared):
            brute.append((i, j))
    assert len(brute) > len(sets) > len(near) and len(links) < len(set(labels))

    def parts(pairs, start):
        part = np.array(start)
        for i, j in pairs:
            part[part == part[i]] = part[j]
        return part

    alone = parts(near, ids)
    assert all(alone[i] == alone[j] for i, j in brute)
    assert {tuple(p) for p in links.tolist()} <= set(brute)
    one, other = parts(links, labels), parts(brute, labels)
    assert len(set(zip(one, other))) == len(set(one)) == len(set(other))


def test_parts_in_many_blocks(table, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 7)
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 900)
    rows = near_copies()
    assert found(ngram_join.similar_groups(table(rows)), *GROUP) == group_brute(rows)


def test_a_set_is_sent_once_for_lists_of_the_same_sets(spark, monkeypatch):
    """Ten lists of the sets 1 to 6, one of 3 and 9, one of a single group: eight rows, not 62."""
    sent, in_blocks = [], ngram_join._in_blocks

    def counted(rows, key, search):
        sent.append(rows.count())
        return in_blocks(rows, key, search)

    monkeypatch.setattr(ngram_join, "_in_blocks", counted)
    members = [(shingle, i) for shingle in range(10) for i in range(1, 7)] + [(10, 3), (10, 9), (11, 20), (11, 21)]
    rows = [(shingle, i, 100, 20 if i > 9 else i) for shingle, i in members]
    lists = spark.createDataFrame(rows, "shingle long, set long, n int, label long")
    alike = bytes(ngram_join.parity_bits(np.arange(100, dtype=np.uint64) << np.uint64(20)))
    bits = spark.createDataFrame([(i, alike) for i in (*range(1, 7), 9, 20, 21)], "set long, bits binary")
    near = {tuple(p) for p in ngram_join._near_pairs(lists, bits).collect()}
    assert near == {*((1, i) for i in range(2, 7)), (3, 9)} and sent == [8]
