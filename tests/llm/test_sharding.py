from __future__ import annotations

import zlib
from collections import Counter, defaultdict

from docsync.llm import sharding
from docsync.llm.sharding import Leaf, Tree
from tests.llm.helpers import ODD, docs


def numbered(rows):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    return all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_odd_rows(spark):
    tree = sharding.balanced_tree(5, 2, 2)
    rows = sharding.shard(docs(spark, ODD, extra=True), tree, tree.grown(Leaf(0, 0, 5))).collect()
    assert len(rows) == len(ODD) and numbered(rows)
    assert sorted(((r.doc_id is not None, r.doc_id or 0), r.size, r.text_crc32) for r in rows) == sorted(
        ((i is not None, i or 0), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in ODD
    )
    assert len({r.shard for r in rows if r.doc_id == 5}) == 1


def test_empty(spark):
    assert sharding.shard(docs(spark, ODD).limit(0), sharding.balanced_tree(3)).count() == 0


def test_growth_moves_only_into_the_new_shard_wherever_it_stands(spark):
    base = docs(spark, [(i, "t") for i in range(3000)])
    tree = sharding.balanced_tree(12, 3, 2)
    for leaf in (Leaf(1, 1, 12), Leaf(7, 0, 12), Leaf(0, 5, 12, 3.0)):
        once = tree.grown(leaf)
        twice = once.grown(Leaf(1, 1, 13))
        first = {r.doc_id: (r.shard, r.grown_shard) for r in sharding.shard(base, tree, once).collect()}
        second = {r.doc_id: (r.shard, r.grown_shard) for r in sharding.shard(base, once, twice).collect()}
        assert all(a == b or b == 12 for a, b in first.values())
        assert all(a == b or b == 13 for a, b in second.values())
        assert {k: b for k, (_, b) in first.items()} == {k: a for k, (a, _) in second.items()}
        moved = sum(b == 12 for _, b in first.values())
        assert abs(moved - 3000 * leaf.weight / (12 + leaf.weight)) < 90


def test_weights(spark):
    tree = Tree(((Leaf(0, 0, 0, 1.0), Leaf(0, 1, 1, 2.0), Leaf(1, 0, 2, 5.0)),))
    counts = Counter(r.shard for r in sharding.shard(docs(spark, [(i, "") for i in range(4000)]), tree).collect())
    assert [abs(counts[i] - 500 * w) < 120 for i, w in enumerate((1, 2, 5))] == [True] * 3


def test_a_row_repeated_very_often_keeps_slots_gapless(spark):
    rows = sharding.shard(docs(spark, [(1, "same")] * 500 + [(i, "x") for i in range(50)]), sharding.balanced_tree(2)).collect()
    assert len(rows) == 550 and numbered(rows)


def test_a_row_repeated_very_often_is_dealt_in_ranges(spark):
    """No task unrolls all copies, and no array holds them."""
    from pyspark.sql import functions as F

    n = 10_000_000
    base = spark.range(n).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    placed = sharding.shard(base, sharding.balanced_tree(3)).withColumn("part", F.spark_partition_id())
    told = placed.groupBy("part").agg(F.count("*").alias("n"), F.min("slot").alias("least"), F.max("slot").alias("most"), F.sum("slot").alias("sum")).collect()
    assert sum(r.n for r in told) == n and min(r.least for r in told) == 0 and max(r.most for r in told) == n - 1
    assert sum(r.sum for r in told) == n * (n - 1) // 2
    assert max(r.n for r in told) < n / 2


def test_copies_on_both_sides_of_few(spark, monkeypatch):
    rows = [(1, "a")] * 9 + [(1, "b")] * 4 + [(2, "")] * 30 + [(None, None)] * 17 + [(i, "x") for i in range(3, 60)]
    wanted = None
    for few in (1, 10, 1000):
        monkeypatch.setattr(sharding, "FEW_COPIES", few)
        got = sharding.shard(docs(spark, rows), sharding.balanced_tree(4)).collect()
        assert numbered(got) and len(got) == len(rows)
        assert wanted in (None, sorted(map(str, got)))
        wanted = sorted(map(str, got))


def test_a_very_long_text(spark):
    text = "long text " * 3_000_000
    (row,) = sharding.shard(docs(spark, [(1, text)]), sharding.balanced_tree(2)).collect()
    assert (row["size"], row.text_crc32, row.slot) == (len(text) + 16, zlib.crc32(text.encode()), 0)
