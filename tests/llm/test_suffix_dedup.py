from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from docsync.llm import suffix_dedup as dedup
from tests.llm.helpers import ODD, docs, vocabulary, words


def brute(texts):
    texts = [(t or "").encode() for t in texts]
    seen = Counter(t[p : p + 200] for t in texts for p in range(len(t) - 199))
    for t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - 199):
            if seen[t[p : p + 200]] > 1:
                gone[p : p + 200] = b"\1" * 200
        kept = bytes(x for x, y in zip(t, gone) if not y)
        runs = sum(bool(gone[i]) and (i == 0 or not gone[i - 1]) for i in range(len(gone)))
        yield len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()


def check(spark, rows):
    got = dedup.deduplicate(docs(spark, rows, extra=True)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((i, *b)) for (i, _), b in zip(rows, brute([t for _, t in rows])))


def corpus(seed, n=110):
    rng = random.Random(seed)
    vocab = vocabulary(rng)
    base = [words(rng, vocab, rng.randint(10, 250)) for _ in range(30)]
    for i in range(n):
        kind = rng.random()
        text = rng.choice(base)
        if kind < 0.3:
            text = words(rng, vocab, rng.randint(1, 150))
        elif kind < 0.7:
            edited = text.split()
            for _ in range(rng.randint(1, 6)):
                edited[rng.randrange(len(edited))] = rng.choice(vocab)
            text = " ".join(edited)
        elif kind < 0.9:
            at = rng.randrange(len(text))
            text = words(rng, vocab, 20) + text[at : at + rng.choice([150, 199, 200, 201, 230, 400])] + words(rng, vocab, 20)
        yield i, text


def test_against_brute_force(spark):
    rows = list(corpus(5))
    rows += [(500, "a" * 199), (501, "b" * 200), (502, "c" * 201), (503, "d" * 1500), (504, "xyz" * 300), (505, rows[0][1] * 3), (7, rows[7][1]), (7, rows[3][1])]
    check(spark, rows)


def test_edits_that_keep_a_texts_length(spark):
    """Blocks cut short by the ends of texts of one length, that differ just outside what they share."""
    rng = random.Random(12)
    vocab = ["".join(rng.choice("abcdef") for _ in range(6)) for _ in range(100)]
    base = words(rng, vocab, 60)
    rows = [(0, base)]
    for i in range(1, 40):
        edited = base.split()
        for at in rng.sample(range(60), rng.randint(1, 3)):
            edited[at] = rng.choice(vocab)
        rows.append((i, " ".join(edited)))
    check(spark, rows)


@pytest.mark.parametrize("seed", range(3))
def test_more_corpora(spark, seed):
    check(spark, list(corpus(20 + seed, 60)))


def test_odd_rows(spark):
    check(spark, ODD)
    assert dedup.deduplicate(docs(spark, ODD).limit(0)).count() == 0


@pytest.fixture
def small_chunks(monkeypatch):
    dedup._tables.cache_clear()
    monkeypatch.setattr(dedup, "CHUNK", 700)
    yield
    dedup._tables.cache_clear()


def test_pieces_of_long_texts(small_chunks):
    texts = [t.encode() for _, t in corpus(8, 12)] + [b"q" * 5000, bytes(random.Random(1).randbytes(4000))]
    got = dedup.intervals(texts)
    for i, text in enumerate(texts):
        own = got[0] == i
        covered = sorted((a, b) for a, b in zip(got[1][own], got[2][own]))
        assert [p for a, b in covered for p in range(a, b + 1)] == list(range(max(0, len(text) - 199)))
        first, last, suffix = got[1][own], got[2][own], got[3][own]
        if not len(first):
            continue
        assert ((suffix >= last) & (suffix - first <= 150)).all()
        a, b, s, _, content = dedup.blocks(text, first, last, suffix)
        assert set(p for x, y in zip(a, b) for p in range(x, y + 1)) >= set(range(len(text) - 199))
        place, ids, check_ = dedup.positions(text, a, b)
        strings = {}
        for p, x, c in zip(place, ids, check_):
            assert strings.setdefault(text[p : p + 200], (x, c)) == (x, c)
        assert len(set(strings.values())) == len(strings)


def test_equal_strings_choose_alike():
    rng = np.random.default_rng(4)
    middle = rng.bytes(300)
    one, two = rng.bytes(500) + middle + rng.bytes(90), rng.bytes(77) + middle + rng.bytes(400)
    _, first, last, suffix, bucket, _ = dedup.intervals([one, two])
    which = dedup.intervals([one, two])[0]
    of = {}
    for w, a, b, s, k in zip(which, first, last, suffix, bucket):
        for p in range(a, b + 1):
            of[w, p] = (s - p, k)
    assert all(of[0, 500 + i] == of[1, 77 + i] for i in range(101))
