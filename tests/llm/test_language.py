from __future__ import annotations

import math
import os
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docsync.llm import language
from docsync.llm.common import table
from tests.llm.helpers import ODD, docs

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
TAUGHT = [(i, t, l) for i, (t, l) in enumerate([("the cat and the dog", "en"), ("le chat et le chien", "fr"), ("der hund und die katze", "de")] * 5)]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
def test_held_out_accuracy(spark):
    data = table(spark, SF_DIR, "documents")
    out = language.held_out(F.col("doc_id"))
    rows = language.predict(data, language.fit(data.where(~out))).select("row.*", "lang_pred", "score").where(out).collect()
    assert rows and sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_rule(spark):
    rows = spark.range(50).select("id", language.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)


def test_odd_rows(spark):
    model = language.fit(docs(spark, TAUGHT + [(100, None, "xx"), (101, "zzz", None)]))
    assert model.languages == ["de", "en", "fr", "xx"]
    got = language.predict(docs(spark, ODD, extra=True), model).select("row.doc_id", "row.text", "lang_pred", "score", "row.score").collect()
    assert len(got) == len(ODD)
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and (letters or r[3] == 0)


def test_nothing_learned(spark):
    model = language.fit(docs(spark, TAUGHT).limit(0))
    assert {r.lang_pred for r in language.predict(docs(spark, TAUGHT), model).collect()} == {"und"}
    assert language.predict(docs(spark, TAUGHT).limit(0), language.fit(docs(spark, TAUGHT))).count() == 0


def test_long_texts_in_blocks_score_alike(monkeypatch):
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(list("abc é1"), n)) for n in (3, 50, 999, 1000, 1001, 5000)]
    model = language.Model(["a", "b"], rng.normal(size=(language.BUCKETS + 1, 2)).astype(np.float32))
    model.log_probability[language.BUCKETS] = 0
    whole = language._score(model, texts)
    monkeypatch.setattr(language, "BLOCK", 1000)
    pieces = language._score(model, texts)
    assert whole[0][:4] == pieces[0][:4] and np.allclose(whole[1][:4], pieces[1][:4])
    each = [language._score(model, [t]) for t in texts]
    assert [e[0][0] for e in each] == pieces[0] and np.allclose([e[1][0] for e in each], pieces[1])


def test_training_counts_do_not_depend_on_partitions(spark):
    a = language.fit(docs(spark, TAUGHT)).log_probability
    b = language.fit(docs(spark, TAUGHT).repartition(7)).log_probability
    assert np.array_equal(a, b)


def _slow_grams(text: str | None) -> Counter:
    """Buckets of a text's n-grams, one character after the other."""
    out: Counter = Counter()
    if not text:
        return out
    codes = [32, 32, *[ord(c) if c.isalpha() else 32 for c in text.lower()], 32, 32]
    for order in language.ORDERS:
        for at in range(len(codes) - order + 1):
            gram = codes[at : at + order]
            if any(c != 32 for c in gram):
                h = order
                for c in gram:
                    h = (h ^ c) * 0x9E3779B97F4A7C15 % 2**64
                    h ^= h >> 29
                out[h % language.BUCKETS] += 1
    return out


def _slow(taught, texts) -> list[tuple[str, float]]:
    """Naive Bayes with equal priors in plain Python: (language, posterior) of each text."""
    counts: dict[str, Counter] = {}
    for text, lang in taught:
        if lang is not None:
            counts.setdefault(lang, Counter()).update(_slow_grams(text))
    names = sorted(counts)
    totals = {n: sum(counts[n].values()) + language.SMOOTHING * language.BUCKETS for n in names}
    out = []
    for text in texts:
        grams = _slow_grams(text)
        if not grams or not names:
            out.append(("und", 0.0))
            continue
        logs = [math.fsum(k * math.log((counts[n][b] + language.SMOOTHING) / totals[n]) for b, k in grams.items()) for n in names]
        top = max(logs)
        out.append((names[logs.index(top)], 1 / math.fsum(math.exp(x - top) for x in logs)))
    return out


def _equals_slow(spark, taught, asked) -> None:
    model = language.fit(taught)
    got = language.predict(asked, model).select("row.text", "lang_pred", "score").collect()
    want = _slow([(r.text, r.lang) for r in taught.collect()], [r.text for r in got])
    assert len(got) == len(want) > 0
    for r, (lang, score) in zip(got, want):
        # The matrix is of 32 bits, so sums over a long text differ a little.
        assert abs(r.score - score) < 1e-2 and (r.lang_pred == lang or score < 0.51)


def test_equals_plain_python(spark):
    _equals_slow(spark, docs(spark, TAUGHT + [(100, None, "xx"), (101, "zzz", None)]), docs(spark, ODD + [(200, "le the der"), (201, "ch\u00e4t \U0001f600"), (202, "cat")]))


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
def test_equals_plain_python_on_documents(spark):
    data = table(spark, SF_DIR, "documents").select("doc_id", "text", "lang")
    _equals_slow(spark, data.where(~language.held_out(F.col("doc_id"))), data.where(language.held_out(F.col("doc_id"))))
