from __future__ import annotations

from collections import Counter

import pytest

from docsync.llm import mixing
from tests.llm.helpers import ODD, docs


def sample(spark):
    rows = [(i, "x" * 100, "en", "big") for i in range(2000)] + [(i, "y" * 100, "en", "small") for i in range(2000, 2200)]
    return docs(spark, rows, extra=True)


def test_sources_reach_their_weights(spark):
    got = mixing.mix(sample(spark)).select("row.source").collect()
    n = Counter(r.source for r in got)
    assert abs(n["big"] - 1100) < 130 and abs(n["small"] - 1100) < 130


def test_named_weights_and_large_rates(spark):
    got = Counter(r.source for r in mixing.mix(sample(spark), {"small": 3.0}).select("row.source").collect())
    assert set(got) == {"small"} and abs(got["small"] - 2200) < 200
    one = docs(spark, [(i, "x", "en", "a") for i in range(990)] + [(i, "x", "en", "b") for i in range(1000, 1004)])
    n = Counter(r.source for r in mixing.mix(one, {"a": 1.0, "b": 1.0}).select("row.source").collect())
    assert abs(n["b"] - 497) < 100  # a mean of 124 a document, in several draws


def test_repeatable_whatever_the_partitions(spark):
    take = lambda df: sorted((r.doc_id, r.copy, r.shuffle_key) for r in mixing.mix(df).select("row.doc_id", "copy", "shuffle_key").collect())
    assert take(sample(spark)) == take(sample(spark).repartition(7))


def test_order_has_no_trace_of_sources(spark):
    rows = mixing.mix(sample(spark)).orderBy("shuffle_key").select("row.source").collect()
    half = len(rows) // 2
    assert abs(sum(r.source == "small" for r in rows[:half]) - sum(r.source == "small" for r in rows[half:])) < 150


def test_odd_rows(spark):
    rows = [(i, t, "en", s) for (i, t), s in zip(ODD, ["a", None] * 6)]
    got = mixing.mix(docs(spark, rows, extra=True)).collect()
    assert {r.row.source for r in got} <= {"a", None}
    assert mixing.mix(docs(spark, ODD).limit(0)).count() == 0
    assert mixing.mix(docs(spark, ODD), {"none": 1.0}).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(docs(spark, ODD), {"s": -1.0})


def test_broadcast_and_shuffle_agree(spark, monkeypatch):
    take = lambda: sorted((r.row.doc_id, r.copy) for r in mixing.mix(sample(spark)).collect())
    small = take()
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert take() == small


def test_draws_and_copies_in_ranges_are_those_of_one_task(spark, monkeypatch):
    rows = [(i, "x" * 50, "en", "a") for i in range(200)] + [(900, None, "en", "b"), (901, "y", "en", None), (901, "z", "en", None)]
    take = lambda: sorted((r.row.doc_id, r.row.text or "", r.copy, r.shuffle_key) for r in mixing.mix(docs(spark, rows)).collect())
    ranged = take()
    monkeypatch.setattr(mixing, "FEW_STEPS", 1 << 40)
    assert take() == ranged
    n = Counter(r[0] for r in ranged)
    assert abs(n[900] - 3334) < 350 and abs(n[901] - 3334) < 500


def test_counts_past_an_int_are_cut_into_ranges(spark):
    n = 3_000_000_017
    got = mixing._ranges(spark.createDataFrame([("k", n)], "key string, n long"), "n").selectExpr(
        "sum(last - first + 1) AS copies", "max(last) AS last", "max(last - first + 1) AS longest", "count(*) AS ranges"
    ).first()
    assert (got.copies, got.last) == (n, n - 1) and got.longest < 60_000 and got.ranges < 60_000
