from __future__ import annotations

import hashlib
import random

from docsync.llm import piecewise
from tests.llm.helpers import ODD, docs, vocabulary, words


def slow(text):
    """A fingerprint byte by byte."""
    data = text.encode()
    k = 0
    while (3 << k) * 64 < len(data):
        k += 1

    def level(i):
        roll, factor = 0, 1
        for b in range(min(7, i + 1)):
            roll = (roll + (data[i - b] + 1) * factor) & 0xFFFFFFFF
            factor = factor * 0x01000193 & 0xFFFFFFFF
        roll ^= roll >> 15
        roll = roll * 0x2C1B3C6D & 0xFFFFFFFF
        roll ^= roll >> 13
        over, rest = divmod(roll + 1, 3)
        return -1 if rest else (over & -over).bit_length() - 1

    def letter(piece):
        h, power = 0, 1
        for b in piece:
            h, power = (h + (b + 1) * power) & (2**64 - 1), power * 0x9E3779B97F4A7C15 & (2**64 - 1)
        h ^= h >> 32
        return chr(piecewise._ALPHABET[(h * 0xD6E8FEB86659FD93 & (2**64 - 1)) >> 58])

    levels = [level(i) for i in range(len(data))]
    while k and sum(x >= k for x in levels) < 32:
        k -= 1

    def signature(k):
        out, begin = "", 0
        for i in range(len(data) - 1):
            if levels[i] >= k and len(out) < 63:
                out += letter(data[begin : i + 1])
                begin = i + 1
        return out + (letter(data[begin:]) if data else "")

    return f"{3 << k}:{signature(k)}:{signature(k + 1)}"


def texts():
    rng = random.Random(2)
    return ["", "a", "é" * 50, "ab" * 500, "x" * 3000] + ["".join(rng.choice("abcdefgh é\n") for _ in range(rng.randint(0, 3000))) for _ in range(30)]


def test_fingerprints_byte_by_byte(monkeypatch):
    assert piecewise.fingerprints(texts()) == [slow(t) for t in texts()]
    monkeypatch.setattr(piecewise, "BATCH_BYTES", 100)
    assert piecewise.fingerprints(texts()) == [slow(t) for t in texts()]


def test_distances():
    rng = random.Random(3)
    make = lambda: [bytes(rng.choice(b"abcd") for _ in range(rng.randint(1, 64))) for _ in range(40)]
    a, b = make(), make()

    def distance(x, y):
        row = list(range(len(y) + 1))
        for i, c in enumerate(x, 1):
            last, row[0] = row[0], i
            for j, d in enumerate(y, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (0 if c == d else 2))
        return row[-1]

    assert piecewise._distances(a, b).tolist() == [distance(x, y) for x, y in zip(a, b)]


def test_likeness():
    rng = random.Random(4)
    vocab = vocabulary(rng, 2000)
    a, b = words(rng, vocab, 600), words(rng, vocab, 600)
    fa, fb, fe = piecewise.fingerprints([a, b, piecewise.edited(a, b)])
    same, edit, other = piecewise.likeness([fa, fa, fa], [fa, fe, fb])
    assert same == 1 and edit > 0.55 and other < 0.35
    assert piecewise.likeness(["3:AB:C"], ["12:AB:C"])[0] == 0
    assert piecewise.likeness(["3:AB:C"], ["6:C:D"])[0] == 1


def check(spark, rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] or "").encode()))
    whole = [t or "" for _, t in order]
    following = whole[1:] + whole[:1]
    changed = [piecewise.edited(a, b) for a, b in zip(whole, following)]
    marks, edits = piecewise.fingerprints(whole), piecewise.fingerprints(changed)
    near, nexts = piecewise.likeness(marks, edits), piecewise.likeness(marks, marks[1:] + marks[:1])
    want = [
        (i, len(t), hashlib.sha256(c.encode()).hexdigest(), f, e, float(n), float(x))
        for (i, _), t, c, f, e, n, x in zip(order, whole, changed, marks, edits, near, nexts)
    ]
    got = [tuple(r) for r in piecewise.compare_with_next(docs(spark, rows, extra=True)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_neighbours_across_ranges(spark, monkeypatch):
    monkeypatch.setattr(piecewise, "RANGE_ROWS", 7)
    rng = random.Random(5)
    check(spark, [(i * i - 50, t) for i, t in enumerate(texts() + [words(rng, ["a", "b"], 50)] * 20)])


def test_odd_rows(spark, monkeypatch):
    check(spark, ODD)
    monkeypatch.setattr(piecewise, "RANGE_ROWS", 1)
    check(spark, ODD)
    check(spark, [(None, "x"), (None, "y")])
    check(spark, [(1, "alone")])
    assert piecewise.compare_with_next(docs(spark, ODD).limit(0)).count() == 0
