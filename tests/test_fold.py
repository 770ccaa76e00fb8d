from __future__ import annotations

import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from docsync.operators import fold, records
from docsync.operators.mapping import make_map
from docsync.plans.tables import TableStore
from docsync.sources import feed
from tests.helpers import COMPANY, EMPLOYEE, events_frame, replay, rows_by_key

TWO = make_map("Thing", "thing", [("id", "_id", "TEXT"), ("a", "a", "TEXT"), ("b", "b", "DOUBLE PRECISION")])


def changes(spark, events):
    return feed.normalise(events_frame(spark, events))


def base_frame(spark, rows):
    return spark.createDataFrame([(k, v["a"], v["b"]) for k, v in rows.items()], "id string, a string, b double")


def as_source(df):
    return {k: {"a": v["a"], "b": v["b"]} for k, v in rows_by_key(df).items()}


def test_change_events_of_the_fixture(spark):
    base = spark.createDataFrame([("1", "J", "Snow", "black"), ("2", "S", "S", "red")], "id string, first_name string, last_name string, hair string")
    events = [
        ("update", "Employee", "1", {"firstName": "Janos", "lastName": None, "hair": None}, None, 1),
        ("update", "Company", "2", {"domains": ["dragonglass.org"]}, None, 2),
        ("update", "Employee", "2", {"firstName": "Arja", "lastName": "Stark", "hair": "blonde"}, None, 3),
    ]
    all_changes = changes(spark, events)
    people = fold.apply_changes(base, all_changes.where("coll_name = 'Employee'"), EMPLOYEE)
    assert rows_by_key(people) == {
        "1": {"first_name": "Janos", "last_name": None, "hair": None},
        "2": {"first_name": "Arja", "last_name": "Stark", "hair": "blonde"},
    }
    firms = spark.sql("SELECT '2' AS id, true AS active, parse_json('[\"old.org\"]') AS domains, 'node' AS signup_code")
    got = fold.apply_changes(firms, all_changes.where("coll_name = 'Company'"), COMPANY)
    row = got.withColumn("domains", F.to_json("domains")).first()
    assert tuple(row) == ("2", True, '["dragonglass.org"]', "node")


MERGES = {
    "set": ([("update", {"a": "x", "b": 1}, None)], ("x", True, 1.0, True, False)),
    "whole document, field absent": ([("replace", {"a": "x"}, None)], ("x", True, None, True, False)),
    "whole document with null": ([("replace", {"a": None}, None)], (None, True, None, True, False)),
    "set and unset": ([("update", {"a": "x"}, ["b"])], ("x", True, None, True, False)),
    "null is unset": ([("update", {"a": None}, None)], (None, True, None, False, False)),
    "two updates": ([("update", {"a": "x", "b": 1}, None), ("update", {"a": "y"}, ["b"])], ("y", True, None, True, True)),
    "dotted path is no field": ([("update", {"a.b": 1}, ["a.c"])], (None, False, None, False, False)),
}


@pytest.mark.parametrize("name", MERGES)
def test_merging_updates(spark, name):
    steps, want = MERGES[name]
    events = [(op, "Thing", "k", f, r, i) for i, (op, f, r) in enumerate(steps)]
    row = fold.merge_updates(changes(spark, events), TWO).first()
    assert (row["a"], row["touched_a"], row["b"], row["touched_b"], row["merged"]) == want


def random_events(n, seed, ids=12):
    rng = random.Random(seed)
    out = []
    for seq in rng.sample(range(10 * n), n):
        op = rng.choice(["insert", "update", "update", "update", "replace", "delete"])
        # One id takes a third of everything.
        i = "hot" if rng.random() < 0.34 else str(rng.randrange(ids))
        fields = {k: rng.choice([None, v]) for k, v in (("a", f"v{seq}"), ("b", float(seq))) if rng.random() < 0.6}
        removed = rng.sample(["a", "b", "c"], rng.randrange(3)) if op == "update" and rng.random() < 0.4 else None
        removed = [r for r in removed or [] if r not in fields]
        out.append((op, "Thing", i, {} if op == "delete" else fields, removed, seq))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_fold_equals_replay_in_any_batching(spark, seed):
    events = random_events(400, seed)
    start = {str(i): {"a": f"base{i}", "b": float(i)} for i in range(0, 20, 2)}
    want = replay(start, events, ["a", "b"])
    base = base_frame(spark, start)
    whole = changes(spark, events)
    assert as_source(fold.apply_changes(base, whole, TWO)) == want
    assert as_source(fold.apply_changes(base, whole, TWO, small=True)) == want

    # Any split, merged in any order, even with a part repeated.
    shuffled = random.Random(seed).sample(events, len(events))
    parts = [shuffled[:30], shuffled[30:200], shuffled[200:], shuffled[100:150]]
    folds = [fold.fold_changes(changes(spark, p), TWO) for p in parts]
    assert as_source(fold.apply_fold(base, fold.merge_folds(folds, TWO), TWO)) == want

    # In order, batch on batch, rows only in between.
    ordered = sorted(events, key=lambda e: e[5])
    table = base
    for lo, hi in ((0, 7), (7, 150), (150, 400)):
        table = fold.apply_changes(table, changes(spark, ordered[lo:hi]), TWO)
    assert as_source(table) == want

    no_base = fold.rows_of_fold(fold.fold_changes(whole, TWO), TWO)
    assert as_source(no_base) == replay({}, events, ["a", "b"])


@pytest.mark.parametrize("seed", range(2))
def test_sparse_fold_is_the_same_fold(spark, seed):
    events = random_events(300, 40 + seed)
    whole = changes(spark, events)
    dense, sparse = fold.fold(fold.touch(whole, TWO), TWO), fold.fold_sparse(whole, TWO)
    assert sorted(map(repr, sparse.select(dense.columns).collect())) == sorted(map(repr, dense.collect()))
    parts = [fold.fold_sparse(changes(spark, events[:100]), TWO), fold.fold(fold.touch(changes(spark, events[100:]), TWO), TWO)]
    got = fold.rows_of_fold(fold.merge_folds([p.select(dense.columns) for p in parts], TWO), TWO)
    assert as_source(got) == replay({}, events, ["a", "b"])


def test_wide_maps_are_folded_by_field(spark):
    n = fold.WIDE_MAP + 1
    wide = make_map("Wide", "wide", [("id", "_id", "TEXT")] + [(f"c{i}", f"c{i}", "DOUBLE PRECISION") for i in range(n)])
    assert fold.is_wide(wide) and not fold.is_wide(TWO)
    events = [("insert", "Wide", "1", {"c1": 1, "c2": 2}, None, 1), ("update", "Wide", "1", {"c2": None, "c3": "bad"}, ["c1"], 2), ("update", "Wide", "1", {"c5": 5}, None, 3)]
    row = fold.rows_of_fold(fold.fold_changes(changes(spark, events), wide), wide).first()
    assert (row["id"], row["c1"], row["c2"], row["c3"], row["c5"]) == ("1", None, None, None, 5.0) and len(row) == n + 1


def test_extra_props_follow_each_leftover(spark):
    m = make_map("Thing", "thing", [("id", "_id", "TEXT"), ("a", "a", "DOUBLE PRECISION")], extra_props=True)
    events = [
        ("insert", "Thing", "1", {"_id": "1", "a": 1, "x": 1}, None, 1),
        ("update", "Thing", "1", {"a": 2}, None, 2),
        ("insert", "Thing", "2", {"_id": "2", "a": "bad"}, None, 3),
        ("update", "Thing", "2", {"y": None}, None, 4),
    ]
    state = fold.fold_changes(changes(spark, events), m)
    got = fold.rows_of_fold(state, m).select("id", "a", F.to_json("_extra_props").alias("e"))
    assert {r["id"]: (r["a"], r["e"]) for r in got.collect()} == {"1": (2.0, '{"x":1}'), "2": (None, '{"a":"bad","y":null}')}
    errors = fold.change_errors(changes(spark, events), m).collect()
    assert [e["message"] for e in errors] == ["value does not fit: a: 2"]


EXTRA = make_map("Thing", "thing", [("id", "_id", "TEXT"), ("a", "a", "DOUBLE PRECISION")], extra_props=True)


def leftover_events(n, seed):
    rng = random.Random(seed)
    for seq in rng.sample(range(10 * n), n):
        op = rng.choice(["insert", "update", "update", "update", "replace", "delete"])
        fields = {k: rng.choice([seq, "bad" if k == "a" else f"v{seq}"]) for k in "axyz" if rng.random() < 0.4}
        removed = [k for k in "axyz" if k not in fields and rng.random() < 0.2] if op == "update" else None
        yield op, "Thing", str(rng.randrange(8)), {} if op == "delete" else fields, removed, seq


def leftover_replay(base, events):
    """``{id: leftovers}``: fields that are not mapped or do not fit, one change after the other."""
    rows = {k: dict(v) for k, v in base.items()}
    for op, _, i, fields, removed, _ in sorted(events, key=lambda e: e[5]):
        if op == "delete":
            rows.pop(i, None)
            continue
        row = {} if op in ("insert", "replace") else rows.get(i, {})
        for k, v in fields.items():
            row.pop(k, None)
            if k != "a" or v == "bad":
                row[k] = v
        rows[i] = {k: v for k, v in row.items() if k not in (removed or [])}
    return rows


def leftovers(df):
    return {r["id"]: json.loads(r["e"]) if r["e"] else {} for r in df.select("id", F.to_json("_extra_props").alias("e")).collect()}


@pytest.mark.parametrize("seed", range(2))
def test_leftovers_equal_replay_in_any_batching(spark, folder, seed):
    events = list(leftover_events(150, seed))
    start = {str(i): {"x": "base", "w": i} for i in range(4)}
    want = leftover_replay(start, events)
    base = spark.createDataFrame([(k, json.dumps(v)) for k, v in start.items()], "id string, e string").selectExpr("id", "CAST(NULL AS DOUBLE) AS a", "parse_json(e) AS _extra_props")
    whole = changes(spark, events)
    assert leftovers(fold.apply_changes(base, whole, EXTRA)) == want
    assert leftovers(fold.apply_changes(base, whole, EXTRA, small=True)) == want
    shuffled = random.Random(seed).sample(events, len(events))
    folds = [fold.fold_changes(changes(spark, p), EXTRA) for p in (shuffled[:40], shuffled[40:], shuffled[20:60])]
    assert leftovers(fold.apply_fold(base, fold.merge_folds(folds, EXTRA), EXTRA)) == want
    assert leftovers(fold.rows_of_fold(fold.fold_changes(whole, EXTRA), EXTRA)) == leftover_replay({}, events)
    store = TableStore(spark, folder)
    store.publish("thing", base, EXTRA)
    for i in range(0, 150, 50):
        store.add_fold("thing", fold.fold_changes(changes(spark, shuffled[i : i + 50]), EXTRA), EXTRA, "f", i)
        if i == 50:
            store.compact("thing")
    assert leftovers(store.read("thing")) == want


def test_big_fold_is_one_shuffle_and_no_python(spark):
    plan = fold.fold_changes(changes(spark, random_events(5, 1)), TWO)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_max_by" in plan and "Python" not in plan and "Window" not in plan


@pytest.mark.parametrize("levels", [(20, 40, None), (2, 5, None), (1, 2, 3, None), (None,)])
def test_operation_runs(spark, levels):
    events = [(op, random.Random(s).choice(["A", "B"]), i, {}, None, s) for s, (op, _, i, *_rest) in enumerate(random_events(300, 7))]
    # Long equal runs too, over many ranges, with gaps between positions.
    events += [("update", "A", "1", {}, None, 1000 + 3 * s) for s in range(60)]
    want = []
    for coll in ("A", "B"):
        mine = sorted((e for e in events if e[1] == coll), key=lambda e: e[5])
        for op, group in itertools.groupby(mine, key=lambda e: e[0]):
            seqs = [e[5] for e in group]
            want.append((coll, op, seqs[0], seqs[-1], len(seqs)))
    got = fold.operation_runs(changes(spark, events), levels)
    assert sorted((r["coll_name"], r["op"], r["first_seq"], r["last_seq"], r["n_changes"]) for r in got.collect()) == sorted(want)


def test_only_edges_of_ranges_go_on(spark):
    """Finished runs leave after the first level; what the second one shuffles is bounded by ranges."""
    rng = random.Random(9)
    events = [(rng.choice(["insert", "update", "delete"]), "A", "1", {}, None, s) for s in range(512)]
    first = fold.join_runs(fold.single_runs(changes(spark, events)), 5)
    edges = first.where("_head OR _tail").count()
    assert edges <= 2 * 512 // 32 < first.count() / 4
    # Counted where it happens: rows written by the exchanges of the second level.
    df = fold.operation_runs(changes(spark, events), (5, 7, None))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = fold.operation_runs(changes(spark, events), (5, 7, None))
        df.collect()
        plan, written = df._jdf.queryExecution().executedPlan(), []

        def walk(node):
            if node.nodeName() == "Exchange":
                written.append(node.metrics().apply("shuffleRecordsWritten").value())
            for i in range(node.children().size()):
                walk(node.children().apply(i))

        walk(plan)
        assert sorted({w for w in written if w})[-1] == 512 and all(w == 512 or w <= edges for w in written)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_feed_filters_and_audit(spark):
    events = [
        ("update", "Thing", "1", {"a": "x"}, None, 1), ("update", "Thing", "1", {"a": "y"}, None, 2),
        ("delete", "Thing", "2", {}, None, 3), ("insert", "Other", "3", {}, None, 4), ("invalidate", "Thing", "9", {}, None, 5),
    ]
    raw = events_frame(spark, events)
    assert feed.supported(raw).count() == 4
    assert feed.mapped(raw, ["Thing"]).count() == 4
    mine = feed.since(changes(spark, events).where("coll_name = 'Thing'"), 2)
    assert mine.count() == 2
    audit = records.audit_rows(changes(spark, events).where("coll_name = 'Thing'"), TWO, F.lit(7))
    got = {r["seq"]: (r["obj_id"], r["operation"], r["merged"], r["document"], r["ts"]) for r in audit.collect()}
    assert got == {1: ("1", "update", True, '{"a":"x"}', 7), 2: ("1", "update", True, '{"a":"y"}', 7), 3: ("2", "delete", False, None, 7)}
    assert records.latest_position(changes(spark, events), TWO).first()["latest_successful_ts"] == 4
