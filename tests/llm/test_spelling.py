"""Spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stationflow.llm import bytesops, queries, spelling

KIND = "doc_id long, text string, word string, n long, run string, id long"


def misspelt(doc_id, run):
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    at = h % len(run)
    return run[:at] + run[at + 1 :] if h % 31 == 0 else run


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(counts, times=10):
    found = {}
    for w, n in counts.items():
        close = [v for v in counts if near(w, v)]
        best = min(close, key=lambda v: (-counts[v], v), default=None)
        formed = best is not None and counts[best] >= times * n
        found[w] = (n, len(close), best if formed else None, counts[best] if formed else None)
    out = {}
    for w, (n, n_near, form, form_n) in found.items():
        root = w
        while found[root][2]:
            root = found[root][2]
        out[w] = (n, n_near, form, form_n, root)
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(2)
    base = ["".join(rng.choice("abcdeéÿ") for _ in range(rng.randint(6, 10))) for _ in range(60)]
    words = [w for w in base for _ in range(rng.choice([1, 3, 30, 300]))]
    words += ["éàçèêëü"] * 300 + ["éàçèêëa"] * 20 + ["éàçèêba"] * 2 + ["zzzzzzzz"] * 5 + ["zzzzzzz"] * 50 + ["Zzzzzzzy"] * 3
    for k, w in enumerate(list(words)):
        if k % 9 == 0:
            at = rng.randrange(len(w))
            words.append(w[:at] + rng.choice("aéz") + w[at + rng.randint(0, 1) :])
    rng.shuffle(words)
    texts = [" ".join(words[k : k + 40]) for k in range(0, len(words), 40)]
    texts += [None, "", "a1b", "SHORT Ünïcôde-Ünïcôde ünïcôde×÷", "q" * 3000 + " " + "q" * 3000 + " " + "q" * 2999 + "," + "q" * 2999, "Ābcdefgh Ābcdefgh"]
    rows = [(k, t, "clash", 1, "clash", 9) for k, t in enumerate(texts)]
    rows += [(0, texts[0], None, None, None, None), (None, None, None, None, None, None)]
    return spark.createDataFrame(rows, KIND).repartition(3)


def counted(docs):
    counts = Counter()
    for r in docs.collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            counts[misspelt(r.doc_id, "".join(c.lower() if c < "\x7f" else c for c in run))] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def test_variants_equal_brute_force(docs, monkeypatch):
    words = spelling.word_counts(docs, 7, 2, queries._misspelt)
    want = plain_variants(counted(docs))
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.variants(words).collect()}
    assert got == want
    assert any(v[2] and want[v[2]][2] for v in want.values())  # a chain of forms


def test_any_number_of_parts_and_rounds_gives_the_same(docs, monkeypatch):
    """A vocabulary beyond a part's and a round's bound: many parts, each broadcast in a round of its own."""
    monkeypatch.setattr(spelling, "PART_WORDS", 20)
    monkeypatch.setattr(spelling, "ROUND_BYTES", 400)
    words = spelling.word_counts(docs, 7, 2, queries._misspelt)
    want = {(w, v) for w in counted(docs) for v in counted(docs) if near(w, v)}
    got = [(r.word, r.near) for r in spelling.neighbours(words).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    sizes = {7: (30, 7), 8: (1, 5)}
    rounds = spelling._rounds(sizes)
    assert sorted(p for r in rounds for p in r) == [*[(7, k) for k in range(30)], (8, 0)]
    assert len(rounds) > 3 and all(sum(8 * sizes[length][1] for length, _ in r) <= 400 for r in rounds)


def test_without_a_change(spark):
    docs = spark.createDataFrame([(1, "Abcdefg abcdefg ABCDEFG abcdefgh abcdefgh abcdefx")], "doc_id long, text string")
    got = {r.word: r.n for r in spelling.word_counts(docs, 7, 2).collect()}
    assert got == {"abcdefg": 3, "abcdefgh": 2}


def test_nothing(spark, docs):
    words = spelling.word_counts(docs.limit(0), 7, 2, queries._misspelt)
    assert spelling.variants(words).count() == 0
    one = spelling.variants(spark.createDataFrame([("abcdefg", 5)], "word string, n long")).collect()
    assert [tuple(r[c] for c in ("word", "n", "n_near", "form", "form_n", "root")) for r in one] == [("abcdefg", 5, 0, None, None, "abcdefg")]


def test_the_filter_lets_every_word_through_and_little_else():
    rng = np.random.default_rng(1)
    words = rng.integers(97, 123, (5000, 9), dtype=np.uint8)
    shape = {9: (3, 5000 * spelling.BITS_PER_WORD // 64 // 3 + 1)}
    hashes = bytesops.mixed(spelling.word_hashes(words))
    part = (bytesops.mixed(hashes) % np.uint64(3)).astype(int)
    size, parts = shape[9][1], {}
    high, bits = spelling._probe(hashes)
    for k in range(3):
        blocks = np.zeros(size, np.uint64)
        np.bitwise_or.at(blocks, ((high[part == k] * np.uint64(size)) >> np.uint64(32)).astype(int), bits[part == k])
        parts[9, k] = blocks.tobytes()
    whole = spelling.Filters(shape, parts)
    assert whole.may_hold(9, spelling.word_hashes(words)).all()
    other = spelling.word_hashes(rng.integers(97, 123, (50_000, 9), dtype=np.uint8))
    assert whole.may_hold(9, other).mean() < 0.02
    assert not whole.may_hold(8, other).any()


def test_edit_hashes_are_those_of_the_edited_words():
    word = np.frombuffer("aabcéddé".encode("latin-1"), np.uint8).reshape(1, -1)

    class All:
        starts = {7: 1, 8: 1}
        seen: list = []

        def may_hold(self, length, hashes):
            self.seen.append((length, hashes.ravel().tolist()))
            return np.ones(hashes.shape, bool)

    probe = All()
    found = [(r, p, letter) for rows, places, letter in spelling._edits(word, np.frombuffer(b"bz\xe9", np.uint8), probe) for r, p in zip(rows, places, strict=True)]
    raw = word.tobytes()
    deleted = [raw[:p] + raw[p + 1 :] for p in range(8)]
    assert probe.seen[0][1] == [int(spelling.word_hashes(np.frombuffer(d, np.uint8).reshape(1, -1))[0]) for d in deleted]
    assert [p for _, p, letter in found if letter < 0] == [0, 2, 3, 4, 5, 7]
    for letter, (_, hashes) in zip(b"bz\xe9", probe.seen[1:], strict=True):
        edits = [raw[:p] + bytes([letter]) + raw[p + 1 :] for p in range(8) if raw[p] < letter]
        assert hashes == [int(spelling.word_hashes(np.frombuffer(e, np.uint8).reshape(1, -1))[0]) for e in edits]


def test_letters_come_in_bounded_slices(monkeypatch):
    monkeypatch.setattr(spelling, "SLICE", 40)
    words = ["a" * n for n in (3, 8, 8, 8, 8, 8, 8, 100, 3)]
    seen = [(rows.tolist(), m.shape) for rows, m in spelling.letters(pa.array(words))]
    assert sorted(r for rows, _ in seen for r in rows) == list(range(9)) and all(n * k <= 40 or n == 1 for _, (n, k) in seen)


def test_roots(spark):
    chain = [(f"w{k}", f"w{k + 1}") for k in range(19)] + [("x", "w7")]
    got = {r.word: r.root for r in spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert set(got.values()) == {"w19"} and len(got) == 20
    with pytest.raises(RuntimeError):
        spelling.roots(spark.createDataFrame([("a", "b"), ("b", "a")], "word string, form string"))


def test_only_what_passes_the_filter_is_shuffled(spark, docs):
    words = spelling.written(spelling.word_counts(docs, 7, 2, queries._misspelt), "vocabulary")
    pairs = spelling.neighbours(words)
    assert pairs.where(F.col("word") == F.col("near")).count() == 0
