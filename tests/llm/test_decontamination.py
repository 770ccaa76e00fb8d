from __future__ import annotations

import hashlib
import random
import re

import numpy as np

from docsync.llm import decontamination
from tests.llm.helpers import ODD, docs, vocabulary, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items):
    ws = split(text)
    hit, found = set(), set()
    for name, item in items:
        iw = split(item)
        n = min(13, len(iw))
        for i in range(len(iw) - n + 1 if n else 0):
            for p in range(len(ws) - n + 1):
                if ws[p : p + n] == iw[i : i + n]:
                    hit.update(range(p, p + n))
                    found.add("null" if name is None else str(name))
    return len(ws), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(ws)


def sample():
    rng = random.Random(9)
    vocab = vocabulary(rng, 60)
    items = [(i, words(rng, vocab, rng.choice([1, 2, 5, 12, 13, 14, 30]))) for i in range(12)] + [(20, None), (21, "..."), (None, "lone word here"), (5, words(rng, vocab, 15))]
    items.append((30, items[3][1]))
    rows = []
    for i in range(60):
        parts = [words(rng, vocab, rng.randint(0, 60)) for _ in range(3)]
        item = rng.choice(items)[1] or ""
        cut = item.split()
        rows.append((i, "! ".join([parts[0], " ".join(cut[rng.randint(0, 2) :]).upper(), parts[1], item, parts[2]])))
    return items, rows + [(i, t) for i, t in ODD]


def run(spark, items, rows):
    benchmark = spark.createDataFrame([(*x, "z") for x in items], "item_id long, text string, found string")
    found = decontamination.find(docs(spark, rows, extra=True), benchmark)
    got = sorted(str(tuple(r)) for r in decontamination.digest(found).collect())
    assert got == sorted(str((i, *brute(t, items))) for i, t in rows)
    return found


def test_against_brute_force_whatever_the_blocks(spark, monkeypatch):
    items, rows = sample()
    run(spark, items, rows)
    original = decontamination.blocks_of
    monkeypatch.setattr(decontamination, "blocks_of", lambda b: original(b, limit=300))
    run(spark, items, rows)


def test_small_batches(monkeypatch):
    items, rows = sample()
    named = [("null" if n is None else str(n), t) for n, t in items]
    block = decontamination.Block.of(named)
    searcher = block.anchored(np.zeros(len(block.vocabulary)))

    def postings(text):
        ids = np.array([block.vocabulary.get(w, -1) for w in decontamination.words_of(text)], np.int32)
        at = np.flatnonzero(ids >= 0)
        return len(ids), ids[at], at

    indexed = [postings(t) for _, t in rows]
    whole = list(decontamination._search_rows(searcher, indexed, 16))
    monkeypatch.setattr(decontamination, "BATCH_WORDS", 50)
    assert list(decontamination._search_rows(searcher, indexed, 16)) == whole


def test_proximity(spark):
    items = [(1, "zebra quagga")]
    rows = [(1, "the quagga and then a zebra"), (2, "zebra " + "x " * 40 + "quagga"), (3, "zebra quagga"), (4, "zebra only")]
    found = {r.doc_id: (r["items"], r.near) for r in run(spark, items, rows).collect()}
    assert found == {1: ([], ["1"]), 2: ([], []), 3: (["1"], ["1"]), 4: ([], [])}


def test_nothing_to_find_or_to_search(spark):
    run(spark, [], ODD)
    benchmark = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontamination.find(docs(spark, ODD).limit(0), benchmark).count() == 0


def test_the_index_is_positional(spark):
    block = decontamination.Block.of([("1", "b a x")])
    row = decontamination.build_index(docs(spark, [(1, "a B c a; b")]), block).first()
    assert (row.n_words, row.terms, row.positions) == (5, [0, 0, 1, 1], [1, 4, 0, 3])


def test_clean(spark):
    items, rows = sample()
    rows += rows[:3]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    kept = decontamination.clean(docs(spark, rows), benchmark).collect()
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept))) == sorted(str(r) for r in rows if not brute(r[1], items)[-1])
