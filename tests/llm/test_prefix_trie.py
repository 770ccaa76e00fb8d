from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from docsync.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
CLASHING = ["row", "conv", "ref", "words", "at", "hi", "lo", "total", "part", "depth", "before", "length", "base", "h", "head", "mark", "digest"]
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def frame(spark, rows, parts: int = 4):
    whole = [(*r, *("x" * len(CLASHING))) for r in rows]
    return spark.createDataFrame(whole, SCHEMA + "".join(f", {c} string" for c in CLASHING)).repartition(parts)


def slow(rows):
    """Whole sequences as keys, subtrees by walking them."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs[c].append(((turn is not None, turn or 0), role, hashlib.sha256(text.encode()).hexdigest(), text))
    own = {c: [(role, text) for _, role, _, text in sorted(ts)] for c, ts in convs.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[b] for b in below) or 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[b] for b in below)
    out = []
    for node, cs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in cs if built[c] == node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(cs), len(node), parent, len(cs), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, **options):
    got = prefix_trie.digest(prefix_trie.build(frame(spark, rows), **options))
    assert got.columns == COLUMNS
    return sorted(map(tuple, got.collect()), key=str)


ODD = [
    (None, 0, "user", "lost"), (0, None, None, None), (0, 0, "user", "a  b\tc"), (0, 0, "user", "a  b\tc"), (0, 1, "assistant", ""), (1, None, "user", "x"),
    (1, None, "user", "w"), (2, 0, "", "x"), (2, 1, "x", ""), (3, 5, "user", " \n"), (-7, 0, "user", "a"), (-20, 0, "user", "z z"), (-21, 0, "user", "b"),
    (25, 0, "user", "no base"), (26, 3, "user", "no base"), (40, 0, "u", "ab"), (41, 0, "ua", "b"), (42, 0, "u", "ab"), (45, 0, "u", "long " * 30000),
]


def test_odd_rows(spark):
    assert found(spark, ODD) == slow(ODD)


def talk(rng, n=160, most=9):
    rows = []
    for c in range(n):
        for turn in range(rng.randint(0, most)):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(["yes", "no", "well, maybe so", "a b c d"]) if rng.random() < 0.9 else f"t {rng.random()}"))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_walking_whole_sequences(spark, seed):
    rows = talk(random.Random(seed))
    assert found(spark, rows) == slow(rows)


def test_a_conversation_of_a_third_of_the_rows_spans_ranges(spark):
    rng = random.Random(3)
    rows = talk(rng, 60) + [(20, i, "user", f"turn {rng.randint(0, 9)}") for i in range(400)] + [(21, i % 3, "user", "again") for i in range(150)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "31")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(spark, rows) == slow(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_copies_of_a_conversation(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(300) for t in range(3)]
    assert found(spark, rows) == slow(rows)


def test_empty(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "a")]) == []


def test_one_digest_for_two_turns_is_seen(spark):
    rows = talk(random.Random(4), 40)
    tried = []

    def weak(seed, role, text):
        tried.append(seed)
        return F.lit("same") if seed == 0 else prefix_trie.content_digest(seed, role, text)

    assert found(spark, rows, digest=weak) == slow(rows) and tried == [0, 1]


def test_one_fingerprint_for_two_prefixes_is_seen(spark):
    rows = talk(random.Random(5), 40)
    with pytest.raises(RuntimeError, match="two things"):
        found(spark, rows, modulus=13)
    assert found(spark, rows, modulus=1_000_003) == slow(rows)


def test_monoid():
    p, b = prefix_trie.MODULUS, prefix_trie.base_of(0, prefix_trie.MODULUS)
    rng = random.Random(6)
    one = [(1, rng.randrange(1, 10**9), rng.randrange(5)) for _ in range(9)]
    join = lambda x, y: prefix_trie.joined(x, y, b, p)
    for x, y, z in zip(one, one[1:], one[2:]):
        assert join(join(x, y), z) == join(x, join(y, z))
    assert join((0, 0, 0), one[0]) == one[0] == join(one[0], (0, 0, 0))


def test_turn_references(spark):
    rows = talk(random.Random(7), 30)
    trie = prefix_trie.build(frame(spark, rows))
    said = {r.row: (r.role, r.text) for r in trie.turns.collect()}
    assert len({said[r.ref] for r in trie.nodes.where("depth = 1").collect()}) == trie.nodes.where("depth = 1").count()
