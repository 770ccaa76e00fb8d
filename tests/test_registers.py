"""Registers: the same fold, in Spark's state, for many collections, under maps that change."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from docsync.operators import fold, registers as R
from docsync.operators.history import MapHistory, as_of, changes_of_history, errors_across, fold_across, table_across, version_rows
from docsync.operators.mapping import make_map
from docsync.sources import feed, files
from docsync.streaming import stateful
from tests.helpers import events_frame, replay, rows_by_key
from tests.test_fold import EXTRA, TWO, as_source, changes, leftover_events, leftover_replay, leftovers, random_events
from tests.test_stream import put

KEY = ("id", "_id", "TEXT")


@pytest.mark.parametrize("seed", range(2))
def test_leftovers_by_registers_equal_replay(spark, seed):
    events = list(leftover_events(150, 20 + seed))
    want = leftover_replay({}, events)
    assert leftovers(fold.rows_of_fold(fold.fold_sparse(changes(spark, events), EXTRA), EXTRA)) == want
    mixed = random.Random(seed).sample(events, len(events))
    folds = [fold.fold_sparse(changes(spark, mixed[:70]), EXTRA), fold.fold_changes(changes(spark, mixed[70:]), EXTRA)]
    assert leftovers(fold.rows_of_fold(fold.merge_folds([f.select(*folds[1].columns) for f in folds], EXTRA), EXTRA)) == want
    parts = R.registers(changes(spark, mixed[:70])).unionByName(R.registers(changes(spark, mixed[70:])))
    assert leftovers(fold.rows_of_fold(R.to_fold(R.combined(parts), EXTRA), EXTRA)) == want


def test_leftovers_of_wide_maps_are_folded_by_field(spark):
    n = fold.WIDE_MAP + 1
    wide = make_map("Wide", "wide", [KEY] + [(f"c{i}", f"c{i}", "DOUBLE PRECISION") for i in range(n)], extra_props=True)
    assert fold.is_wide(wide)
    events = [("insert", "Wide", "1", {"_id": "1", "c1": 1, "x": None}, None, 1), ("update", "Wide", "1", {"c2": "bad", "y": 2}, ["c1"], 2)]
    folded = fold.fold_changes(changes(spark, events), wide)
    row = fold.rows_of_fold(folded, wide).withColumn("e", F.to_json("_extra_props")).first()
    assert (row["c1"], row["c2"], row["e"]) == (None, None, '{"c2":"bad","x":null,"y":2}')
    plan = folded._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("max_by(") <= 2 and plan.count("Aggregate") == 2


def test_few_fields_are_folded_a_row_a_change(spark, monkeypatch):
    rng, values = random.Random(7), [None, "x", "1.5", 7, {"a": 1}, [1]]
    events = []
    for seq in range(200):
        op = rng.choice(["insert", "update", "update", "replace", "delete"])
        fields = {} if op == "delete" else {rng.choice("abcd"): rng.choice(values) for _ in range(3)}
        events.append((op, rng.choice(["Thing", "Other"]), str(rng.randrange(12)), fields, rng.choice([None, ["a"], ["b", "z"]]) if op == "update" else None, seq))
    few = R.registers(changes(spark, events), ["a", "b", "c"])
    plan = few._jdf.queryExecution().executedPlan().toString()
    # Changes are aggregated as they are; what is taken apart are documents, after it.
    assert plan.count("Generate ") == 1 and plan.index("Generate ") < plan.index("Aggregate")

    def told(rows):
        return sorted(tuple(r) for r in rows.withColumn("value", F.to_json("value")).fillna("-", ["key"]).collect())

    def folded(rows):
        m = make_map("Thing", "thing", [KEY, ("a", "a", "DOUBLE PRECISION"), ("b", "b", "JSONB"), ("c", "c", "TEXT")])
        return sorted(tuple(r) for r in R.to_fold(rows.where("coll_name = 'Thing'"), m).withColumn("b", F.to_json("b")).collect())

    got = told(few), folded(few)
    want = told(R.registers(changes(spark, events)).where("key IS NULL OR key IN ('a', 'b', 'c')"))
    monkeypatch.setattr(R, "NAMED_FIELDS", 2)
    many = R.registers(changes(spark, events), ["a", "b", "c"])
    assert got == (told(many), folded(many)) and got[0] == want


@pytest.mark.parametrize("extra_props", [True, False])
def test_wide_and_narrow_folds_are_the_same(spark, monkeypatch, extra_props):
    types = ("TEXT", "DOUBLE PRECISION", "TIMESTAMP", "BOOLEAN", "JSONB")
    mixed = make_map("Thing", "thing", [KEY] + [(f"c{i}", f"f{i}", t) for i, t in enumerate(types * 2)], extra_props=extra_props)
    rng, values = random.Random(5), [None, "x", "", "2024-01-02 03:04:05", "1.5", 7, 2.5, True, {}, {"a": 1}, [], [1]]
    events = []
    for seq in range(300):
        op = rng.choice(["insert", "update", "update", "update", "replace", "delete"])
        fields = {f"f{rng.randrange(13)}": rng.choice(values) for _ in range(4)} | ({"_id": "1"} if op == "insert" else {})
        removed = [f for f in (f"f{rng.randrange(13)}",) if f not in fields] if op == "update" else None
        events.append((op, "Thing", str(rng.randrange(15)), {} if op == "delete" else fields, removed, seq))
    rows = R.registers(changes(spark, events))

    def told(wide_map):
        monkeypatch.setattr(R, "WIDE_MAP", wide_map)
        state = R.to_fold(rows, mixed)
        assert state.columns == fold.fold_schema(mixed).names and [f.dataType.simpleString() for f in state.schema] == [f.dataType.simpleString() for f in fold.fold_schema(mixed)]
        parts = [F.to_json(F.struct(c.column)) for c in mixed.value_columns]
        entries = F.transform(F.array_sort(F.map_keys("_fields")), lambda k: F.concat_ws(":", k, F.to_json(F.col("_fields")[k]))) if extra_props else F.lit(0)
        return sorted(map(tuple, state.select("id", "_deleted", "_live", "_changes", *parts, entries).collect()))

    assert told(0) == told(1000) and len(told(0)) == 15


def test_casts_of_a_wide_fold_do_not_grow_with_the_map(spark):
    def casts(n):
        wide = make_map("Wide", "wide", [KEY] + [(f"c{i}", f"c{i}", "DOUBLE PRECISION") for i in range(n)], extra_props=True)
        state = R.to_fold(R.registers(changes(spark, [("insert", "Wide", "1", {"c1": 1}, None, 1)])), wide)
        plan = state._jdf.queryExecution().optimizedPlan()
        return sum(e.count("variant_get(") for e in plan.toString().split("\n"))

    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        assert casts(400) == casts(200) < 20
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")


@pytest.mark.parametrize("seed", range(2))
def test_state_over_restarts_equals_replay(spark, folder, seed):
    events = random_events(150, 60 + seed) + [("insert", "Other", "o", {"x": 1}, None, 5000)]
    mixed = random.Random(seed).sample(events, len(events))
    root = f"{folder}/registers"
    for i, (lo, hi) in enumerate(((0, 40), (40, 90), (90, 151))):
        put(f"{folder}/feed", f"{i}.json", mixed[lo:hi])
        stream = feed.stream_feed(spark, f"{folder}/feed", max_files=1)
        stateful.start_stateful_sync(stream, root, f"{folder}/checkpoint").awaitTermination()
        assert as_source(stateful.read_table(spark, root, TWO)) == replay({}, [e for e in mixed[:hi] if e[1] == "Thing"], ["a", "b"])
        if i == 1:
            assert stateful.merge(spark, root) and stateful.merge(spark, root) is None
            assert len(files.names(spark, root)) == 1
    base = {str(i): {"a": f"base{i}", "b": float(i)} for i in range(0, 20, 2)}
    frame = spark.createDataFrame([(k, v["a"], v["b"]) for k, v in base.items()], "id string, a string, b double")
    assert as_source(stateful.read_table(spark, root, TWO, frame)) == replay(base, [e for e in events if e[1] == "Thing"], ["a", "b"])


def test_only_what_changed_is_written(spark, folder):
    for i, events in enumerate(([("insert", "Thing", str(n), {"a": "x", "b": n}, None, n) for n in range(20)], [("update", "Thing", "3", {"b": 7}, None, 30)])):
        put(f"{folder}/feed", f"{i}.json", events)
        stateful.start_stateful_sync(feed.stream_feed(spark, f"{folder}/feed"), f"{folder}/r", f"{folder}/c").awaitTermination()
    counts = {n: spark.read.parquet(f"{folder}/r/{n}").count() for n in files.names(spark, f"{folder}/r")}
    assert sorted(counts.values()) == [2, 60]  # the field and the document; each of 20 documents with two fields
    assert rows_by_key(stateful.read_table(spark, f"{folder}/r", TWO))["3"] == {"a": "x", "b": 7.0}


def test_a_batch_not_written_to_the_end_is_not_read(spark, folder):
    root = f"{folder}/r"
    stateful.write_registers(R.registers(changes(spark, [("insert", "Thing", "1", {"a": "x"}, None, 1)])), f"{root}/batch=0")
    stateful.write_registers(R.registers(changes(spark, [("delete", "Thing", "1", {}, None, 2)])), f"{root}/batch=1")
    os.remove(f"{root}/batch=1/_SUCCESS")
    assert stateful.read_table(spark, root, TWO).count() == 1
    assert stateful.read_table(spark, f"{folder}/none", TWO).count() == 0


def test_dead_letters_of_a_stream(spark, folder):
    put(f"{folder}/feed", "0.json", [("explode", "Thing", "1", {}, None, 1), ("insert", "Thing", "2", {"a": "x"}, None, 2)])
    stateful.start_dead_letters(feed.stream_feed(spark, f"{folder}/feed"), f"{folder}/errors", f"{folder}/c").awaitTermination()
    assert [r["message"] for r in spark.read.parquet(f"{folder}/errors").collect()] == ["operation is unknown: explode: 1: 1"]


def test_tables_of_one_shape_are_read_together(spark, folder):
    events = [("insert", f"C{i % 4}", str(i), {"a": f"v{i}", "b": i}, None, i) for i in range(12)]
    stateful.write_registers(R.registers(feed.normalise(events_frame(spark, events))), f"{folder}/batch=0")
    maps = [make_map(f"C{i}", f"c{i}", [KEY, ("a", "a", "TEXT")]) for i in range(3)]
    got = stateful.read_tables(spark, folder, maps)
    assert sorted(map(tuple, got.collect())) == sorted((f"C{i % 4}", str(i), f"v{i}") for i in range(12) if i % 4 < 3)
    plan = stateful.stored_registers(spark, folder, ["C1"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "C1" in plan[plan.index("PartitionFilters"):]
    with pytest.raises(ValueError):
        stateful.read_tables(spark, folder, [maps[0], TWO])


HISTORY = MapHistory((
    (None, make_map("Thing", "thing", [KEY, ("a", "a", "TEXT"), ("b", "b", "DOUBLE PRECISION")])),
    (100, make_map("Thing", "thing", [KEY, ("a", "a", "DOUBLE PRECISION"), ("c", "c", "TEXT")])),
    (200, make_map("Thing", "thing", [KEY, ("first", "a", "TEXT"), ("b", "b", "BOOLEAN"), ("c", "c", "DOUBLE PRECISION")])),
))


def history_replay(base, events):
    """One event after the other, the rows carried along whenever a map begins."""
    number = lambda t: None if t is None else float(t) if str(t).replace(".", "", 1).isdigit() else None
    rows, at = {k: dict(v) for k, v in base.items()}, 0
    for op, _, i, fields, removed, seq in [*sorted(events, key=lambda e: e[5]), ("end", "", "", {}, None, 10**9)]:
        if at == 0 and seq >= 100:
            at, rows = 1, {k: {"a": number(v["a"]), "c": None} for k, v in rows.items()}
        if at == 1 and seq >= 200:
            text = lambda x: None if x is None else str(x)
            at, rows = 2, {k: {"a": text(v["a"]), "b": None, "c": number(v["c"])} for k, v in rows.items()}
        kinds = ({"a": str, "b": number}, {"a": number, "c": str}, {"a": str, "b": bool, "c": number})[at]
        if op == "end":
            continue
        if op == "delete":
            rows.pop(i, None)
            continue
        row = rows.setdefault(i, dict.fromkeys(kinds))
        for f, make in kinds.items():
            if f in (removed or []):
                row[f] = None
            elif f in fields and (fields[f] is not None or op != "insert"):
                row[f] = None if fields[f] is None else make(fields[f])
            elif op == "replace":
                row[f] = None
    return rows


def history_events(n, seed):
    rng = random.Random(seed)
    for seq in rng.sample(range(300), n):
        op = rng.choice(["insert", "update", "update", "replace", "delete"])
        fields = {f: rng.choice([None, "bad", "12", "7.5"]) for f in "abc" if rng.random() < 0.5}
        removed = [f for f in "abc" if f not in fields and rng.random() < 0.3] if op == "update" else None
        yield op, "Thing", str(rng.randrange(9)), {} if op == "delete" else fields, removed, seq


@pytest.mark.parametrize("seed", range(3))
def test_events_are_read_under_the_map_of_their_position(spark, seed):
    events = list(history_events(140, seed))
    start = {str(i): {"a": ["3", "base"][i % 2], "b": float(i)} for i in range(12)}
    want = {k: {"first": v["a"], "b": v["b"], "c": v["c"]} for k, v in history_replay(start, events).items()}
    base = spark.createDataFrame([(k, v["a"], v["b"]) for k, v in start.items()], "id string, a string, b double")
    assert rows_by_key(table_across(base, R.registers(changes(spark, events)), HISTORY)) == want
    mixed = random.Random(seed).sample(events, len(events))
    parts = [R.registers(changes(spark, mixed[i : i + 50])) for i in range(0, 140, 50)]
    together = R.combined(parts[2].unionByName(parts[0]).unionByName(parts[1]))
    assert rows_by_key(table_across(base, together, HISTORY)) == want
    last = HISTORY.last()
    assert fold_across(changes(spark, events), HISTORY).columns == fold.fold_schema(last).names


def test_map_versions_as_of_positions(spark):
    rows = spark.createDataFrame([("Thing", s) for s in (0, 99, 100, 199, 200, 999)] + [("Ghost", 5)], "coll_name string, seq long")
    told = as_of(rows, version_rows(spark, [HISTORY]))
    assert sorted((r.coll_name, r.seq, r.map_version) for r in told.collect()) == [
        ("Ghost", 5, None), ("Thing", 0, 0), ("Thing", 99, 0), ("Thing", 100, 1), ("Thing", 199, 1), ("Thing", 200, 2), ("Thing", 999, 2)
    ]
    events = [("insert", "Thing", str(s), {"a": "bad", "b": "bad", "c": "bad"}, None, s) for s in (50, 150, 250)]
    assert sorted(r.message for r in errors_across(changes(spark, events), HISTORY).collect()) == [
        "value does not fit: a: 150", "value does not fit: b: 50", "value does not fit: c: 250",
    ]


def test_what_each_map_changed(spark):
    got = {(r.since, r.source, r.change) for r in changes_of_history(spark, HISTORY).collect()}
    assert got == {(100, "a", "retyped"), (100, "b", "removed"), (100, "c", "added"), (200, "a", "retyped"), (200, "b", "added"), (200, "c", "retyped")}


def test_a_retype_that_may_not_be_tried_leaves_the_type():
    h = MapHistory(((None, make_map("T", "t", [KEY, ("a", "a", "DOUBLE PRECISION")])), (5, make_map("T", "t", [KEY, ("a", "a", "JSONB")]))))
    assert h.last().columns[1].type == "DOUBLE PRECISION"
    with pytest.raises(ValueError):
        MapHistory(((3, h.last()),))
