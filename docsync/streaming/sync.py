"""Keeping tables current from a change feed."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from docsync.functions import types as ct
from docsync.functions.cast import can_fail, variant_cast_sql, variant_failed_sql
from docsync.functions.naming import quoted
from docsync.operators import records
from docsync.operators.evolve import backfill, effective_map, evolve_stored, map_changes
from docsync.operators.fold import AT, FAILURES
from docsync.operators.mapping import CollectionMap, MappedColumn, map_frame
from docsync.operators.project import cast_fields, failed_sql, has_path
from docsync.operators.registers import NAMED_FIELDS, UPDATES, entries, registers
from docsync.plans.snapshot import load_collection, transfer
from docsync.plans.tables import TableStore
from docsync.sources import feed as feed_source

# Fixed value: how often a flush is due unless told otherwise.
FLUSH_INTERVAL = "30 seconds"

# Folds laid on a table before they are merged among themselves.
MERGE_EVERY = 20

Maps = dict[str, CollectionMap]
Collections = dict[str, DataFrame]


def apply_batch(
    store: TableStore,
    maps: Maps,
    events: DataFrame,
    feed: str,
    batch_id: int,
    merge_every: int = MERGE_EVERY,
    audit: bool = True,
) -> list[str]:
    """Fold one batch of change events into its tables; returns their names.

    Safe to repeat: a batch a table has already taken is skipped there, and
    anything written on the way replaces what an earlier attempt left.  Events
    that cannot be folded become error rows.  A batch never reads a table's
    version: it writes what changed, and now and then merges waiting folds.
    """
    batch = events.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # At most as many names as the map has collections, and a row for whether there are others.
        fault = feed_source.fault(batch)
        told = batch.select(F.when(fault.isNull(), F.col("ns.coll")).alias("coll"), fault.isNotNull().alias("faulty"))
        seen = told.where(F.col("faulty") | F.col("coll").isin(*maps)).distinct().collect()
        if any(r.faulty for r in seen):
            _append_errors(store, records.dead_letters(batch), f"dead-{feed}-{batch_id}")
        names = sorted(r.coll for r in seen if not r.faulty)
        wanted = feed_source.mapped(feed_source.placeable(batch), names)
        _apply_collections(store, {n: maps[n] for n in names}, feed_source.normalise(wanted), feed, batch_id, audit)
        for name in names:
            if len(store.commit_of(maps[name].relation).folds) >= merge_every:
                store.merge_waiting(maps[name].relation)
        return [maps[n].relation for n in names]
    finally:
        batch.unpersist()


def _apply_collections(store: TableStore, maps: Maps, changes: DataFrame, feed: str, batch_id: int, audit: bool) -> None:
    """Fold the changes of all these collections together: one aggregate, one write.

    The number of Spark jobs does not depend on the number of collections; a table's
    part of the batch becomes visible by its commit, and once that is made it is done.
    """
    commits = {n: store.commit_of(m.relation) for n, m in maps.items()}
    todo = [n for n in maps if commits[n] is None or commits[n].batches.get(feed, -1) < batch_id]
    if not todo:
        return
    # All of the batch is written again, for the service rows of an attempt replace those of one before.
    used = {n: store.map_of(m.relation) if commits[n] is not None and commits[n].map is not None else m for n, m in maps.items()}
    # Changes up to a load's position are in what was loaded.
    known = [(n, m.relation, commits[n].base_position if commits[n] is not None else None) for n, m in maps.items()]
    targets = F.broadcast(store.spark.createDataFrame(known, "_coll string, relation string, _passed long"))
    chosen = changes.join(targets, F.col("coll_name") == F.col("_coll")).where(F.col("_passed").isNull() | (F.col("seq") > F.col("_passed")))
    relations = F.broadcast(store.spark.createDataFrame([(n, m.relation) for n, m in maps.items()], "_named string, relation string"))
    # Leftovers are of any name; fields that no map knows are else never read.
    fields = {c.source for m in used.values() for c in m.value_columns}
    if len(fields) > NAMED_FIELDS or any(m.extra_props for m in used.values()):
        folded = registers(chosen)
    else:
        folded = registers(_with_failures(chosen, used), fields)
    rows = folded.join(relations, F.col("coll_name") == F.col("_named"))
    folder, found, failures = store.add_registers(rows, feed, batch_id)
    part = f"{feed}-{batch_id}"
    if audit:
        often = store.registers_in(folder).where(f"key IS NULL AND {UPDATES} > 1").select("relation", "id")
        store.append_service("audit", records.audit_rows(chosen, "relation", often=often, by=("relation", "id")), part)
    if failures != 0:
        _append_errors(store, map_errors(chosen, used), f"cast-{part}")
    for n in todo:
        added, last = found.get(maps[n].relation, (None, None))
        store.lay(maps[n].relation, added, used[n], feed, batch_id, last)


def map_errors(changes: DataFrame, maps: Maps) -> DataFrame:
    """One error row per changed value that does not fit its collection's map, for all
    collections together: ``(location, message, ts)``.

    Fields are looked up in the maps' columns that can fail, a short table.
    """
    fields = [(n, c.source, ct.canonical(c.type), m.relation) for n, m in maps.items() for c in m.value_columns if can_fail(c.type)]
    columns = changes.sparkSession.createDataFrame(fields, "_coll_name string, _source string, _type string, _location string")
    if len(fields) <= feed_source.MAX_BROADCAST_NAMES:
        columns = F.broadcast(columns)
    counted = _with_failures(changes, maps)
    suspects = counted.where(f"{FAILURES} > 0") if FAILURES in counted.columns else changes
    touched = entries(suspects).where("key IS NOT NULL AND value IS NOT NULL").select("coll_name", "id", "key", "value")
    mapped = touched.join(columns, (F.col("coll_name") == F.col("_coll_name")) & (F.col("key") == F.col("_source")))
    kinds = sorted({t for _, _, t, _ in fields})
    ready = mapped.selectExpr("*", "schema_of_variant(value) AS _t")
    ready = ready.selectExpr("*", *[f"{variant_cast_sql('value', '_t', t)} AS _x{i}" for i, t in enumerate(kinds)])
    failed = " OR ".join(f"(_type = '{t}' AND {variant_failed_sql(f'_x{i}', '_t', t)})" for i, t in enumerate(kinds)) or "false"
    return ready.where(failed).select(
        F.col("_location").alias("location"),
        F.concat_ws(": ", F.lit("value does not fit"), F.col("key"), F.col("id")).alias("message"),
        F.unix_timestamp().cast("int").alias("ts"),
    )


def _with_failures(changes: DataFrame, maps: Maps) -> DataFrame:
    """Changes with how many fields hold a value that the map of any collection cannot take.

    So a change without is without errors.  Told without taking changes apart; where
    the fields that can fail are many, they are not counted.
    """
    fields = sorted({(c.source, ct.canonical(c.type)) for m in maps.values() for c in m.value_columns if can_fail(c.type)})
    if len(fields) > NAMED_FIELDS or not all(has_path(source) for source, _ in fields):
        return changes
    columns = [MappedColumn(f"c{i}", source, t) for i, (source, t) in enumerate(fields)]
    return cast_fields(changes, columns, "fields").selectExpr(*map(quoted, changes.columns), f"size({failed_sql(columns)}) AS {FAILURES}")


def _append_errors(store: TableStore, errors: DataFrame, part: str) -> None:
    if not errors.isEmpty():
        store.append_service("errors", errors, part)


def refresh_maps(store: TableStore, old: Maps, new: Maps, collections: Collections | None = None) -> Maps:
    """Follow a changed map: evolve tables, load new ones, stop filling others.

    Added columns are filled from the collection where it can be read; a table
    is written again only if its rows change.  Gives
    the maps to go on with: the old type where a retype was refused.
    """
    out: Maps = {}
    collections = collections or {}
    frames = [map_frame(store.spark, maps.values()) for maps in (old, new)]
    changed = {r["collection_name"] for r in map_changes(*frames).select("collection_name").distinct().collect()}
    for name, cmap in new.items():
        same = name in old and name not in changed and old[name].extra_props == cmap.extra_props
        # The order of columns and the table's name are no changes of fields.
        same = same and [c.column for c in old[name].columns] == [c.column for c in cmap.columns] and old[name].relation == cmap.relation
        if same and store.exists(cmap.relation):
            out[name] = store.map_of(cmap.relation)
        elif not store.exists(cmap.relation):
            if name in collections:
                load_collection(store, collections[name], cmap)
            else:
                store.create(cmap.relation, cmap)
            out[name] = cmap
        else:
            # The waiting folds are in it, under the map they were made with.
            before = store.map_of(cmap.relation)
            table, report = evolve_stored(store.read_stored(cmap.relation), before, cmap)
            used = effective_map(cmap, report)
            if used == before:
                out[name] = used  # nothing to do, or nothing that could be done
                continue
            added = [r.column for r in report if r.change == "added" and r.column in {c.column for c in used.columns}]
            fill = bool(added) and name in collections
            if fill:
                # What the collection holds now is at least as new as the feed so far.
                at = F.lit(store.position(cmap.relation)).cast("long")
                table = backfill(table, collections[name], used, added).withColumns({AT + c: at for c in added if AT + c in table.columns})
            waiting = store.commit_of(cmap.relation).folds
            if not fill and not waiting and all(r.change in ("added", "refused") for r in report):
                store.widen(cmap.relation, used)
            else:
                store.publish(cmap.relation, table, used)
            out[name] = used
    return out


def start_sync(
    store: TableStore,
    events: DataFrame,
    maps: Maps | Callable[[], Maps],
    checkpoint: str,
    start: int | None = None,
    collections: Collections | None = None,
    merge_every: int = MERGE_EVERY,
    audit: bool = True,
    interval: str | None = None,
) -> StreamingQuery:
    """Start folding a stream of change events into the tables.

    ``maps`` may be a function; it is asked again at the start of every batch,
    and the tables follow what it says.  ``start`` leaves out events before a
    position.  With no ``interval`` everything available is taken, in as many
    batches as the source's limits ask for, and the query ends.
    """
    current: dict[str, Maps] = {"asked": {}, "used": {}}

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        asked = maps() if callable(maps) else maps
        if asked != current["asked"]:
            current["used"] = refresh_maps(store, current["asked"], asked, collections)
            current["asked"] = asked
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint
        apply_batch(store, current["used"], batch, query_id, batch_id, merge_every, audit)

    chosen = events if start is None else feed_source.since(events, start)
    writer = chosen.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def feed_position(events: DataFrame) -> dict[str, int]:
    """Last position per collection of a stored feed."""
    return {
        r["coll"]: r["last"]
        for r in events.groupBy(F.col("ns.coll").alias("coll")).agg(F.max("seq").alias("last")).collect()
    }


def snapshot_and_sync(
    store: TableStore,
    collections: Callable[[], Collections],
    stored_feed: Callable[[], DataFrame],
    feed_stream: DataFrame,
    maps: Maps,
    checkpoint: str,
    start: int | None = None,
    **options,
) -> StreamingQuery:
    """Initial load, then the feed.

    The feed's position is noted before the load begins and changes are taken
    from there, so none made during the load is missed; those the load already
    saw are applied again and end in the same rows.  A given ``start`` means
    the tables are there already: no load, only the feed from that position.
    """
    if start is None:
        known = feed_position(stored_feed())
        transfer(store, collections(), maps, positions=known)
    return start_sync(store, feed_stream, maps, checkpoint, start=start, **options)


def resume_position(store: TableStore, relations: list[str]) -> int | None:
    """The earliest stored position among these tables: a safe place to resume."""
    known = [p for p in (store.position(r) for r in relations) if p is not None]
    return min(known) if known else None


periodic_sync = partial(start_sync, interval=FLUSH_INTERVAL)
