from __future__ import annotations

import os
import random
import time

import pytest

from docsync.operators.mapping import make_map
from docsync.plans.snapshot import load_collection
from docsync.plans.tables import TableStore
from docsync.sources import feed
from docsync.streaming import sync
from tests.helpers import docs_frame, event_json, events_frame, replay, rows_by_key
from tests.test_fold import TWO, as_source, random_events

OTHER = make_map("Other", "other", [("id", "_id", "TEXT"), ("x", "x", "DOUBLE PRECISION")])
MAPS = {"Thing": TWO, "Other": OTHER}


def put(folder, name, events):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/.{name}", "w") as f:
        f.write("\n".join(event_json(*e) for e in events) + "\n")
    os.rename(f"{folder}/.{name}", f"{folder}/{name}")
    time.sleep(0.02)


def run(spark, store, folder, maps=MAPS, **options):
    events = feed.stream_feed(spark, f"{folder}/feed", max_files=1)
    query = sync.start_sync(store, events, maps, f"{folder}/checkpoint", **options)
    query.awaitTermination()


def test_stream_equals_replay_over_restarts(spark, folder):
    events = random_events(120, 3)
    ordered = sorted(events, key=lambda e: e[5])
    store = TableStore(spark, f"{folder}/tables")
    for i, (lo, hi) in enumerate(((0, 30), (30, 60))):
        put(f"{folder}/feed", f"{i}.json", ordered[lo:hi])
    run(spark, store, folder, merge_every=2)
    assert as_source(store.read("thing")) == replay({}, ordered[:60], ["a", "b"])
    assert len(store.commit_of("thing").folds) == 1  # merged on the way
    store.compact("thing")
    put(f"{folder}/feed", "2.json", ordered[60:] + [("insert", "Other", "o", {"x": 1}, None, 5000), ("insert", "Ghost", "g", {}, None, 5001)])
    run(spark, store, folder)
    assert as_source(store.read("thing")) == replay({}, ordered, ["a", "b"])
    assert rows_by_key(store.read("other")) == {"o": {"x": 1.0}}
    assert store.position("thing") == ordered[-1][5] and store.relations() == ["other", "thing"]
    audited = {(r["operation"]) for r in store.service("audit").collect()}
    assert audited == {"insert", "update", "replace", "delete"}
    n = store.commit_of("thing").number
    run(spark, store, folder)  # nothing new
    assert store.commit_of("thing").number == n


def test_repeated_batch_changes_nothing(spark, folder):
    store = TableStore(spark, folder)
    batch = events_frame(spark, [("insert", "Thing", "1", {"a": "x"}, None, 1), ("delete", "Thing", "2", {}, None, 2)])
    sync.apply_batch(store, MAPS, batch, "f", 0)
    sync.apply_batch(store, MAPS, batch, "f", 0)
    assert store.service("audit").count() == 2 and rows_by_key(store.read("thing")) == {"1": {"a": "x", "b": None}}


@pytest.mark.parametrize("named_fields", [sync.NAMED_FIELDS, 0])
def test_misfits_are_searched_only_where_a_fold_counts_some(spark, folder, monkeypatch, named_fields):
    monkeypatch.setattr(sync, "NAMED_FIELDS", named_fields)
    searched, search = [], sync.map_errors
    monkeypatch.setattr(sync, "map_errors", lambda *a: searched.append(1) or search(*a))
    texts = make_map("Texts", "texts", [("id", "_id", "TEXT"), ("x", "x", "TEXT")])
    maps, store = {"Other": OTHER, "Texts": texts}, TableStore(spark, folder)
    batches = [
        [("insert", "Other", "1", {"x": 5, "y": "bad"}, None, 1), ("update", "Other", "1", {"x": None}, None, 2), ("delete", "Texts", "2", {}, None, 3)],
        [("insert", "Other", "1", {"x": "bad"}, None, 4), ("update", "Other", "1", {"x": "6"}, None, 5), ("insert", "Texts", "2", {"x": "fits"}, None, 6), ("update", "Ghost", "3", {"x": "bad"}, None, 7)],
    ]
    counts = []
    for i, batch in enumerate(batches):
        sync.apply_batch(store, maps, events_frame(spark, batch), "f", i, audit=False)
        counts.append(len(searched))
    assert counts == ([0, 1] if named_fields else [1, 2])
    # One register of 1 has the value that did not fit no more: it is in the feed that misfits are looked for.
    assert [(r["location"], r["message"]) for r in store.service("errors").collect()] == [("other", "value does not fit: x: 1")]
    assert rows_by_key(store.read("other")) == {"1": {"x": 6.0}} and rows_by_key(store.read("texts")) == {"2": {"x": "fits"}}


def test_a_batch_that_only_some_tables_took(spark, folder, monkeypatch):
    """The driver dies between two tables' commits; the batch is repeated."""
    store = TableStore(spark, folder)
    batch = events_frame(spark, [("insert", "Thing", "1", {"a": "x", "b": "bad"}, None, 1), ("insert", "Other", "2", {"x": 5}, None, 2)])
    lay = TableStore.lay
    with monkeypatch.context() as m:
        m.setattr(TableStore, "lay", lambda self, relation, *a: lay(self, relation, *a) if relation == "other" else (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError, match="died"):
            sync.apply_batch(store, MAPS, batch, "f", 0)
    sync.apply_batch(store, MAPS, batch, "f", 0)
    sync.apply_batch(store, MAPS, batch, "f", 0)
    assert rows_by_key(store.read("thing")) == {"1": {"a": "x", "b": None}} and rows_by_key(store.read("other")) == {"2": {"x": 5.0}}
    assert store.service("audit").count() == 2 and [r["message"] for r in store.service("errors").collect()] == ["value does not fit: b: 1"]
    assert store.clean("other") == [] or rows_by_key(store.read("other")) == {"2": {"x": 5.0}}


def test_jobs_do_not_grow_with_collections(spark, folder):
    from docsync.operators.mapping import make_map as mm

    def jobs(n):
        maps = {f"C{i}": mm(f"C{i}", f"c{i}", [("id", "_id", "TEXT"), ("a", "a", "DOUBLE PRECISION")]) for i in range(n)}
        store = TableStore(spark, f"{folder}/{n}")
        events = events_frame(spark, [("insert", f"C{i % n}", str(i), {"a": i}, None, i) for i in range(60)])
        before = set(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
        sync.apply_batch(store, maps, events, "f", 0)
        made = len(set(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - before)
        assert [store.read(f"c{i}").count() for i in (0, n - 1)] == [len(range(0, 60, n)), len(range(n - 1, 60, n))]
        return made

    assert 0 < jobs(30) <= jobs(2) + 2


def test_batches_may_come_in_any_order_compacted_or_not(spark, folder):
    store = TableStore(spark, folder)
    sync.apply_batch(store, MAPS, events_frame(spark, [("update", "Thing", "1", {"a": "late"}, None, 20)]), "f", 0)
    sync.apply_batch(store, MAPS, events_frame(spark, [("insert", "Thing", "1", {"a": "early", "b": 5}, None, 10)]), "f", 1)
    assert rows_by_key(store.read("thing")) == {"1": {"a": "late", "b": 5.0}}
    store.compact("thing")
    # What is older than the version is placed by the positions it keeps.
    sync.apply_batch(store, MAPS, events_frame(spark, [("update", "Thing", "1", {"a": "older"}, None, 15), ("update", "Thing", "1", {"b": 6}, None, 21)]), "f", 2)
    assert rows_by_key(store.read("thing")) == {"1": {"a": "late", "b": 6.0}}
    assert store.service("errors").isEmpty()
    sync.apply_batch(store, MAPS, events_frame(spark, [("insert", "Thing", "2", {"a": "older"}, None, 5), ("delete", "Thing", "1", {}, None, 18)]), "f", 3)
    assert rows_by_key(store.read("thing")) == {"1": {"a": "late", "b": 6.0}, "2": {"a": "older", "b": None}}
    store.compact("thing")
    sync.apply_batch(store, MAPS, events_frame(spark, [("delete", "Thing", "1", {}, None, 30), ("delete", "Thing", "3", {}, None, 9)]), "f", 4)
    store.compact("thing")
    late = [("update", "Thing", "1", {"a": "no"}, None, 29), ("insert", "Thing", "3", {"a": "no"}, None, 8), ("update", "Thing", "3", {"b": 1}, None, 10)]
    sync.apply_batch(store, MAPS, events_frame(spark, late), "f", 5)
    assert rows_by_key(store.read("thing")) == {"2": {"a": "older", "b": None}, "3": {"a": None, "b": 1.0}}


@pytest.mark.parametrize("buckets", [0, 2])
def test_shuffled_batches_with_and_without_compaction(spark, folder, buckets):
    events = random_events(60, 8)
    want = replay({}, events, ["a", "b"])
    rng = random.Random(4)
    rng.shuffle(events)
    plain, compacted = TableStore(spark, f"{folder}/a", buckets), TableStore(spark, f"{folder}/b", buckets)
    for i in range(0, 60, 15):
        batch = events_frame(spark, events[i : i + 15])
        sync.apply_batch(plain, MAPS, batch, "f", i, merge_every=99)
        sync.apply_batch(compacted, MAPS, batch, "f", i, merge_every=2)
        compacted.compact("thing")
    assert as_source(plain.read("thing")) == want
    assert as_source(compacted.read("thing")) == want


@pytest.mark.parametrize("kind", ["DOUBLE PRECISION", "TEXT", "BOOLEAN", "TIMESTAMP", "JSONB"])
@pytest.mark.parametrize("audit", [True, False])
def test_a_batch_of_old_changes_only(spark, folder, kind, audit):
    m = make_map("Thing", "thing", [("id", "_id", "TEXT"), ("a", "a", kind)])
    store = TableStore(spark, folder)
    load_collection(store, docs_frame(spark, [{"_id": "1", "a": 1}]), m, position=100)
    sync.apply_batch(store, {"Thing": m}, events_frame(spark, [("update", "Thing", "1", {"a": 2}, None, 50)]), "f", 0, audit=audit)
    assert store.committed("thing", "f", 0) and store.read("thing").count() == 1 and store.position("thing") == 100


def test_a_batch_does_not_read_the_version(spark, folder):
    store = TableStore(spark, folder)
    load_collection(store, docs_frame(spark, [{"_id": str(i), "a": "x"} for i in range(20)]), TWO)
    base = store.commit_of("thing").base
    os.rename(base, base + "-away")
    for i in range(5):
        sync.apply_batch(store, MAPS, events_frame(spark, [("update", "Thing", str(i), {"b": i}, None, i)]), "f", i, merge_every=2)
    os.rename(base + "-away", base)
    rows = rows_by_key(store.read("thing"))
    assert len(rows) == 20 and rows["4"] == {"a": "x", "b": 4.0} and len(store.commit_of("thing").folds) < 5
    assert store.due("thing", 0.0001) and not store.due("thing", 1e9)


def test_events_that_cannot_be_folded_are_told(spark, folder):
    os.makedirs(f"{folder}/feed")
    good = event_json("insert", "Thing", "1", {"a": "x"}, None, 1)
    lines = [good, "no json", event_json("insert", "Thing", None, {"a": "x"}, None, 2), event_json("insert", "Thing", "2", {}, None, None), event_json("explode", "Thing", "3", {}, None, 4)]
    with open(f"{folder}/feed/0.json", "w") as f:
        f.write("\n".join(lines))
    store = TableStore(spark, f"{folder}/tables")
    run(spark, store, folder)
    assert list(rows_by_key(store.read("thing"))) == ["1"]
    told = sorted(r["message"].split(":")[0] for r in store.service("errors").collect())
    assert told == ["event has no id", "event has no position", "line is not an event", "operation is unknown"]


def test_snapshot_then_feed(spark, folder):
    docs = [{"_id": "1", "a": "now", "b": 1}, {"_id": "2", "a": "z"}]
    events = [("insert", "Thing", "1", {"a": "first"}, None, 1), ("update", "Thing", "1", {"a": "now", "b": 1}, None, 2)]
    put(f"{folder}/feed", "0.json", events)
    store = TableStore(spark, f"{folder}/tables")
    stream = feed.stream_feed(spark, f"{folder}/feed", max_files=1)
    stored = lambda: feed.read_feed(spark, f"{folder}/feed")
    collections = lambda: {"Thing": docs_frame(spark, docs)}
    sync.snapshot_and_sync(store, collections, stored, stream, MAPS, f"{folder}/c1").awaitTermination()
    assert as_source(store.read("thing")) == {"1": {"a": "now", "b": 1.0}, "2": {"a": "z", "b": None}}
    assert store.service("errors").isEmpty() and store.position("thing") == 2
    put(f"{folder}/feed", "1.json", [("delete", "Thing", "2", {}, None, 3)])
    run(spark, store, folder)  # a new checkpoint reads the feed from its beginning
    assert sorted(rows_by_key(store.read("thing"))) == ["1"] and store.service("errors").isEmpty()
    assert sync.resume_position(store, ["thing", "ghost"]) == 3

    # From a stored position on: no load, only what follows.
    other = TableStore(spark, f"{folder}/other")
    again = sync.snapshot_and_sync(other, collections, stored, feed.stream_feed(spark, f"{folder}/feed"), MAPS, f"{folder}/c2", start=3)
    again.awaitTermination()
    assert other.read("thing").isEmpty() and other.position("thing") == 3


def test_map_is_followed_while_running(spark, folder):
    store = TableStore(spark, f"{folder}/tables")
    put(f"{folder}/feed", "0.json", [("insert", "Thing", "1", {"a": "5", "b": 1, "c": True}, None, 1)])
    run(spark, store, folder, {"Thing": TWO})
    wider = make_map("Thing", "thing", [("id", "_id", "TEXT"), ("a", "a", "DOUBLE PRECISION"), ("c", "c", "BOOLEAN")])
    put(f"{folder}/feed", "1.json", [("update", "Thing", "1", {"a": 6}, None, 2), ("insert", "Other", "o", {"x": 2}, None, 3)])
    versions = iter([{"Thing": wider, "Other": OTHER}] * 9)
    source = {"Thing": docs_frame(spark, [{"_id": "1", "a": "5", "c": True}])}
    run(spark, store, folder, lambda: next(versions), collections=source)
    assert rows_by_key(store.read("thing")) == {"1": {"a": 6.0, "c": True}}
    assert rows_by_key(store.read("other")) == {"o": {"x": 2.0}}
    # Untracked: the table stays, and is no longer filled.
    put(f"{folder}/feed", "2.json", [("update", "Thing", "1", {"a": 7}, None, 4), ("update", "Other", "o", {"x": 9}, None, 5)])
    run(spark, store, folder, {"Thing": wider})
    assert rows_by_key(store.read("other")) == {"o": {"x": 2.0}} and rows_by_key(store.read("thing"))["1"]["a"] == 7.0


def test_a_renamed_column_keeps_values_and_positions(spark, folder):
    store = TableStore(spark, folder)
    sync.apply_batch(store, MAPS, events_frame(spark, [("insert", "Thing", "1", {"a": "5", "b": 1}, None, 10)]), "f", 0)
    renamed = make_map("Thing", "thing", [("id", "_id", "TEXT"), ("b", "a", "DOUBLE PRECISION"), ("amount", "b", "DOUBLE PRECISION")])
    used = sync.refresh_maps(store, {"Thing": TWO}, {"Thing": renamed})
    assert rows_by_key(store.read("thing")) == {"1": {"b": 5.0, "amount": 1.0}}
    sync.apply_batch(store, used, events_frame(spark, [("update", "Thing", "1", {"a": "7", "b": 2}, None, 9)]), "f", 1)
    assert rows_by_key(store.read("thing")) == {"1": {"b": 5.0, "amount": 1.0}}
    sync.apply_batch(store, used, events_frame(spark, [("update", "Thing", "1", {"b": 3}, None, 11)]), "f", 2)
    assert rows_by_key(store.read("thing")) == {"1": {"b": 5.0, "amount": 3.0}}


def test_tables_are_not_rewritten_without_need(spark, folder):
    for buckets in (0, 2):
        store = TableStore(spark, f"{folder}/{buckets}", buckets=buckets)
        rows = spark.createDataFrame([("1", "x", 1.0)], TWO.schema())
        store.publish("thing", rows, TWO)
        base = store.commit_of("thing").base
        assert sync.refresh_maps(store, {}, {"Thing": TWO}) == {"Thing": TWO}
        refused = make_map("Thing", "thing", [("id", "_id", "TEXT"), ("a", "a", "DOUBLE PRECISION"), ("b", "b", "DOUBLE PRECISION")])
        used = sync.refresh_maps(store, {}, {"Thing": refused})["Thing"]
        assert used.columns[1].type == "text" and store.commit_of("thing").base == base
        wider = make_map("Thing", "thing", [("id", "_id", "TEXT"), ("c", "c", "JSONB"), ("b", "b", "DOUBLE PRECISION"), ("a", "a", "TEXT")])
        sync.refresh_maps(store, {"Thing": TWO}, {"Thing": wider})
        assert store.commit_of("thing").base == base and store.read("thing").columns == ["id", "c", "b", "a"]
        assert tuple(store.read("thing").first()) == ("1", None, 1.0, "x")
        sync.apply_batch(store, {"Thing": wider}, events_frame(spark, [("update", "Thing", "1", {"c": [1]}, None, 5)]), "f", 0)
        assert store.read("thing").selectExpr("to_json(c)").first()[0] == "[1]"
        narrower = make_map("Thing", "thing", [("id", "_id", "TEXT"), ("a", "a", "TEXT")])
        sync.refresh_maps(store, {"Thing": wider}, {"Thing": narrower})
        assert store.commit_of("thing").base != base and tuple(store.read("thing").first()) == ("1", "x")
