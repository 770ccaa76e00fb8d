"""Loading whole collections into tables."""

from __future__ import annotations

import logging
import time
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from py4j.protocol import Py4JError
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from docsync.functions.naming import ref
from docsync.operators import records
from docsync.operators.evolve import ColumnChange, effective_map, evolve_stored, schema_changed
from docsync.operators.fold import with_positions
from docsync.operators.mapping import CollectionMap
from docsync.operators.project import FAILED, cast_errors, project
from docsync.operators.rows import delete_keys, one_per_key
from docsync.plans.tables import TableStore, stats_row
from docsync.sources.documents import DOC, is_document_frame, unparsed

log = logging.getLogger("docsync")

_ORDER = "_load_order"


@dataclass(frozen=True)
class Loaded:
    """What the load of one collection did."""

    relation: str
    action: str
    rows: int
    failures: int
    evolution: tuple[ColumnChange, ...] = ()
    unparsable: int = 0
    without_id: int = 0


def load_collection(
    store: TableStore,
    docs: DataFrame,
    cmap: CollectionMap,
    mode: str | None = None,
    position: int | None = None,
    action: str | None = None,
    order: str | None = None,
    statistics: bool = False,
    record: bool = True,
) -> Loaded:
    """Load one collection as the next version of its table.

    ``mode`` is ``append`` or ``upsert``; by default a first load appends and
    later ones upsert whole rows.  One pass over the documents; counts of rows
    and of values that did not fit are taken along the way, and only if some
    did not fit are they looked at again for the error table.

    Ids of a collection are unique, so none are looked for twice; where they
    are not, ``order`` names the column by which the last document wins.  Documents
    without an id become error rows: no later load could match them.  ``statistics`` has
    Spark analyse the table (where the catalog knows it) and records that; without
    ``record`` the caller records what was done (:func:`record_load`).
    """
    spark, relation = store.spark, cmap.relation
    started = int(time.time())
    found = store.exists(relation)
    mode = mode or ("upsert" if found else "append")
    seen, whole = Observation(), docs
    broken = F.count_if(F.col(DOC).isNull()).alias("broken")
    if is_document_frame(docs):
        docs = docs.observe(seen, broken).where(F.col(DOC).isNotNull())

    report: list[ColumnChange] = []
    table, used = None, cmap
    if found:
        before, table = store.map_of(relation), store.read_stored(relation)
        if schema_changed(store.schema(relation), cmap) or before != cmap:
            table, report = evolve_stored(table, before, cmap)
            used = effective_map(cmap, report)

    counted, key = Observation(), ref(used.key.column)
    # The order goes by a name of its own: the map may have a column of its name.
    ordered = docs.withColumn(_ORDER, ref(order)) if order else docs
    flagged = project(ordered, used, keep=(_ORDER,) if order else (), with_failures=True)
    anonymous = F.count_if(key.isNull()).alias("anonymous")
    if order:
        # Told apart before one of each id is taken.
        named = one_per_key(flagged.where(key.isNotNull()), used.key.column, _ORDER).drop(_ORDER)
        flagged = named.unionByName(flagged.where(key.isNull()).drop(_ORDER))
    sums = [F.count_if(key.isNotNull()).alias("rows"), F.sum(F.when(key.isNotNull(), F.size(FAILED))).alias("failures"), anonymous]
    rows = flagged.observe(counted, *sums).where(key.isNotNull()).drop(FAILED)
    if table is not None:
        if mode == "upsert":
            table = delete_keys(table, flagged.where(key.isNotNull()), used.key.column)
        # Rows without a position of their own are as new as the feed so far.
        rows = table.unionByName(with_positions(rows, used, store.position(relation) if position is None else position))
    store.publish(relation, rows, used, position)

    found_in = metrics(counted, flagged, sums)
    n, failures, without_id = found_in["rows"], found_in["failures"] or 0, found_in["anonymous"]
    if failures:
        store.append_service("errors", cast_errors(docs, used))
    if without_id:
        store.append_service("errors", records.anonymous_errors(docs, used))
    unparsable = metrics(seen, whole, [broken])["broken"] if whole is not docs else 0
    if unparsable:
        store.append_service("errors", records.unparsable_errors(unparsed(whole), used))
    done = Loaded(relation, action or records.ACTION_UPSERT, n, failures, tuple(report), unparsable, without_id)
    if statistics:
        store.analyze(relation)
    if record:
        record_load(store, done, started, statistics)
    return done


def record_load(store: TableStore, done: Loaded, started: int, statistics: bool = False) -> None:
    """Transfer statistics of a load, and of its table's having been analysed."""
    store.append_service("transfer_stats", stats_row(store.spark, done.action, done.relation, done.rows, started))
    if statistics:
        store.append_service("transfer_stats", stats_row(store.spark, records.ACTION_VACUUM, done.relation, done.rows, started))


def metrics(seen: Observation, df: DataFrame, sums: list[Column]) -> dict:
    """What was observed; where Spark left the observed part of a plan out, as it
    does with what it knows to be empty, the sums are worked out."""
    try:
        out = seen.get
    except (AssertionError, Py4JError, PySparkException):
        out = {}
    return out or df.agg(*sums).first().asDict()


def transfer(
    store: TableStore,
    collections: dict[str, DataFrame],
    maps: dict[str, CollectionMap],
    requested: Iterable[str] | None = None,
    drop: bool = False,
    truncate: bool = False,
    positions: dict[str, int] | None = None,
    at_once: int = 1,
    statistics: bool = False,
) -> list[Loaded]:
    """Load every requested collection that exists and has a map, in order.

    Each one is a Spark job over all its rows; up to ``at_once`` run beside each other,
    each in a scheduler pool of its own, so that a small one does not wait for a large
    one's tasks.  What was done is recorded in the order asked for.  If a collection
    fails, the others are loaded all the same; then the failure is raised.
    """
    if not maps:
        raise ValueError("the map names no collections")
    wanted = list(maps if requested is None else requested)
    absent = [c for c in wanted if c not in collections or c not in maps]
    if absent:
        log.warning("not loaded, for want of a collection or a map: %s", ", ".join(absent))
    chosen = [maps[c] for c in wanted if c in collections and c in maps]
    relations = [m.relation for m in chosen]
    if drop:
        store.drop(relations)
    elif truncate:
        store.truncate(relations)
    store.create_service_tables()
    action = records.ACTION_INSERT if drop or truncate else records.ACTION_UPSERT
    context = store.spark.sparkContext

    def load(m: CollectionMap) -> tuple[Loaded, int]:
        started = int(time.time())
        if at_once > 1:
            context.setLocalProperty("spark.scheduler.pool", m.relation)
        position = (positions or {}).get(m.collection)
        return load_collection(store, collections[m.collection], m, position=position, action=action, statistics=statistics, record=False), started

    loaded, failed = [], []
    with ThreadPoolExecutor(max_workers=max(1, at_once)) as threads:
        for task in [threads.submit(inheritable_thread_target(store.spark)(load), m) for m in chosen]:
            try:
                done, started = task.result()
            except Exception as error:  # raised below, when the others are done
                failed.append(error)
                continue
            record_load(store, done, started, statistics)
            loaded.append(done)
    if failed:
        raise failed[0]
    return loaded


def loaded_frame(spark: SparkSession, loaded: Iterable[Loaded]) -> DataFrame:
    rows = [(x.relation, x.action, x.rows, x.failures) for x in loaded]
    return spark.createDataFrame(rows, "relation string, action string, number_of_rows long, failures long")
