from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from docsync.llm import simhash
from docsync.llm.components import components
from tests.llm.helpers import ODD, docs, vocabulary, words


def slow(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(blank, " ")
    ws = [w for w in lowered.split(" ") if w]
    shingles = [" ".join(ws[i : i + 3]) for i in range(max(1, len(ws) - 2))] if ws else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(pairs, items):
    """Least id reachable, by plain search."""
    parent = {x: x for x in items}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[find(a)] = find(b)
    return find


def near(fps):
    return [(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if (a ^ b).bit_count() <= 2]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def check_docs(spark, rows):
    got = simhash.digest(simhash.near_duplicates(docs(spark, rows, extra=True))).collect()
    marks = [slow(t) for _, t in rows]
    find = classes(near(sorted(set(marks))), set(marks))
    least = defaultdict(list)
    for (i, _), m in zip(rows, marks):
        least[find(m)] += [i] if i is not None else []
    want = [(i, f"{m:016x}", min(least[find(m)], default=None)) for (i, _), m in zip(rows, marks)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def corpus():
    rng = random.Random(6)
    vocab = vocabulary(rng, 400)
    base = [words(rng, vocab, rng.randint(1, 80)) for _ in range(20)]
    rows = []
    for i in range(150):
        text = rng.choice(base)
        if rng.random() < 0.5:
            text += " " + rng.choice(vocab)
        rows.append((i, text.upper() if rng.random() < 0.2 else text))
    return rows


def test_against_brute_force(spark):
    check_docs(spark, corpus() + ODD)


def test_spark_hash_is_the_same(spark):
    text = "héllo wörld \U0001f600 of three"
    assert spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] % 2**64 == xxhash.xxh64_intdigest(text.encode(), 42)


def test_chunks(monkeypatch):
    text = corpus()[0][1] * 20
    monkeypatch.setattr(simhash, "_CHUNK", 7)
    assert simhash.fingerprint(text) % 2**64 == slow(text)


def dense(n=700):
    rng = random.Random(1)
    base = rng.getrandbits(64)
    out = {base, 0, 1, 3, 2**63, 2**64 - 1}
    while len(out) < n:
        x = rng.choice(sorted(out)[:50]) if rng.random() < 0.5 else base
        for _ in range(rng.randint(1, 3)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return sorted(out | {rng.getrandbits(64) for _ in range(100)})


@pytest.mark.parametrize("leaf", [2, 128])
def test_dense_groups(spark, monkeypatch, leaf):
    """One large group of near copies: nodes overflow and are descended to the end."""
    monkeypatch.setattr(simhash, "LEAF", leaf)
    fps = dense(700 if leaf > 2 else 120)
    links = simhash.links(spark.createDataFrame([(signed(f),) for f in fps], "fp long")).distinct()
    pairs = [(a % 2**64, b % 2**64) for a, b in links.collect()]
    assert len(pairs) <= 65 * len(fps)
    one, two = classes(pairs, fps), classes(near(fps), fps)
    assert len({(one(f), two(f)) for f in fps}) == len({one(f) for f in fps}) == len({two(f) for f in fps})


@pytest.mark.parametrize("radius", [2, 4])
def test_many_ranges(spark, monkeypatch, radius):
    """Links between ranges, and a range whose searches are several tasks'."""
    monkeypatch.setattr(simhash, "RANGE", 40)
    monkeypatch.setattr(simhash, "SEARCHES", 30)
    fps = dense(400)
    found = simhash.links(spark.createDataFrame([(signed(f),) for f in fps], "fp long").repartition(3), radius)
    pairs = [(a % 2**64, b % 2**64) for a, b in found.collect()]
    assert all(a != b for a, b in pairs)
    near_ones = [(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if (a ^ b).bit_count() <= radius]
    one, two = classes(pairs, fps), classes(near_ones, fps)
    assert len({(one(f), two(f)) for f in fps}) == len({one(f) for f in fps}) == len({two(f) for f in fps})


@pytest.mark.parametrize("width", [8, 1 << 20])
def test_index_finds_all(monkeypatch, width):
    monkeypatch.setattr(simhash, "_WIDTH", width)
    fps = np.array(sorted(dense(150), key=lambda f: f), np.uint64)
    found = {(int(a), int(b)) for who, entry in simhash.GrayIndex(fps, fps).search(fps, 3) for a, b in zip(who, entry)}
    assert found == {(i, j) for i, a in enumerate(fps) for j, b in enumerate(fps) if int(a ^ b).bit_count() <= 3}


def test_groups_are_pruned():
    """In Gray order a group shares bits, and a search leaves it by their sum alone."""
    rng = random.Random(3)
    fps = np.array([rng.getrandbits(64) for _ in range(4096)], np.uint64)
    rank = fps.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    index = simhash.GrayIndex(*[fps[np.argsort(rank)]] * 2)
    looked = []
    count = np.bitwise_count
    simhash.np.bitwise_count = lambda x: looked.append(len(x)) or count(x)
    try:
        assert sum(len(who) for who, _ in index.search(fps[:64], 2)) == 64
    finally:
        simhash.np.bitwise_count = count
    assert sum(looked) < 64 * 4096 / 4


def test_gray_rank(spark):
    ranks = {r.r % 2**64: r.p % 2**64 for r in spark.range(64).select(F.col("id").alias("p"), simhash.gray_rank(F.col("id")).alias("r")).collect()}
    assert all((ranks[i] ^ ranks[i + 1]).bit_count() == 1 for i in range(63))


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 200)] + [(i, 1000 + i) for i in range(200)]])
def test_components(spark, edges):
    got = components(spark.createDataFrame(edges, "a long, b long").repartition(3)).collect()
    items = {x for e in edges if e[0] != e[1] for x in e}
    find = classes([e for e in edges], items | {x for e in edges for x in e})
    assert {r.v for r in got} == items and len(got) == len(items)
    for r in got:
        assert r.root == min(x for x in items if find(x) == find(r.v))


def test_one_of_each(spark):
    rows = corpus() + ODD + ODD[:3]
    kept = simhash.one_of_each(docs(spark, rows)).collect()
    marks = {slow(t) for _, t in rows}
    find = classes(near(sorted(marks)), marks)
    assert len(kept) == len({find(m) for m in marks})
    for r in kept:
        ids = [i for i, t in rows if find(slow(t)) == find(slow(r.text)) and i is not None]
        assert r.doc_id == min(ids, default=None)
    assert simhash.one_of_each(docs(spark, ODD).limit(0)).count() == 0


def test_the_order_of_rows_does_not_choose(spark):
    rows = [(1, "a b c d", "en", s) for s in ("s2", "s1", "s3")] + [(1, "a b c d", None, "s4")] + [(2, "a b c d", "en", "s0")]
    for some in (rows, rows[::-1]):
        (kept,) = simhash.one_of_each(docs(spark, some).coalesce(1)).collect()
        assert (kept.doc_id, kept.lang, kept.source) == (1, None, "s4")
    extra = docs(spark, rows).withColumn("m", F.create_map(F.lit("k"), "source")).withColumn("v", F.parse_json(F.lit("{}")))
    assert simhash.one_of_each(extra).count() == 1


def similarity(a, b):
    a, b = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (a.lower().split(), b.lower().split()))
    return len(a & b) / len(a | b)


def edited_copies(n=120):
    """(id, text, id of its original): every other document a copy with a few words put in for others."""
    rng = random.Random(8)
    vocab = vocabulary(rng, 3000, "abcdefghij")
    rows = []
    for i in range(n):
        text = words(rng, vocab, rng.choice([50, 120, 400, 1500])).split()
        rows.append((2 * i, " ".join(text), None))
        for _ in range(rng.randint(1, max(1, len(text) // 50))):
            text[rng.randrange(len(text))] = rng.choice(vocab)
        rows.append((2 * i + 1, " ".join(text), 2 * i))
    return rows


def test_edited_copies_are_caught(spark):
    """Of copies of 5-word similarity 0.8 or more at least 0.9; texts that are not alike stay apart."""
    rows = edited_copies()
    root = {r.doc_id: r.component_id for r in simhash.near_groups(docs(spark, rows, extra=True)).collect()}
    text = {i: t for i, t, _ in rows}
    near_ones = [(i, of) for i, t, of in rows if of is not None and similarity(t, text[of]) >= 0.8]
    assert len(near_ones) > 100
    assert sum(root[i] == root[of] for i, of in near_ones) >= 0.9 * len(near_ones)
    assert all(root[i] // 2 == i // 2 for i in root)


def test_wide_groups_hold_the_narrow(spark):
    rows = docs(spark, corpus() + ODD + ODD[:3], extra=True)
    narrow = simhash.near_duplicates(rows).select("doc_id", "text_hash", F.col("root").alias("narrow")).distinct()
    wide = simhash.near_groups(rows).select("doc_id", "text_hash", "root").distinct()
    pairs = {(r.narrow, r.root) for r in narrow.join(wide, [narrow.doc_id.eqNullSafe(wide.doc_id), narrow.text_hash == wide.text_hash]).collect()}
    assert len(pairs) == len({a for a, _ in pairs})
    assert simhash.one_of_each(rows, groups=simhash.near_groups).count() == len({b for _, b in pairs})
    assert simhash.one_of_each(rows.limit(0), groups=simhash.near_groups).count() == 0
