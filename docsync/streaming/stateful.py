"""Folding a feed in Spark's own state store.

A streaming aggregation keeps every field's register (``operators/registers.py``) of
every document of every collection, keyed by collection, id and field.  In update mode
a batch gives out only the registers it changed; they are written as they are, one
folder a batch, partitioned by collection: one job a batch, however many collections
there are.  A register given out holds all that went before, so the newest one of each
is the table, and neither merged folds nor commit files are needed: Spark's checkpoint
says how far the feed was taken, and its ``_SUCCESS`` file that a folder is whole.

State grows with the tables.  Beyond tests set
``spark.sql.streaming.stateStore.providerClass`` to Spark's RocksDB provider, which
keeps it on the executors' disks and the checkpoint's file system.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from docsync.operators import records
from docsync.operators.fold import apply_fold, rows_of_fold
from docsync.operators.history import MapHistory, carried_rows, fold_registers
from docsync.operators.mapping import CollectionMap
from docsync.operators.registers import SCHEMA, latest, registers, to_fold
from docsync.sources import feed as feed_source, files

#: ``batch=<n>`` is what batch n changed, ``upto=<n>`` all registers after batch n.
BATCH, UPTO = "batch=", "upto="


def write_registers(rows: DataFrame, folder: str) -> None:
    """Registers as a folder of their own, a partition for each collection."""
    rows.write.mode("overwrite").partitionBy("coll_name").parquet(folder)


def _whole(spark: SparkSession, root: str) -> list[tuple[str, int]]:
    """(kind, number) of the folders that were written to the end."""
    found = [n for n in files.names(spark, root) if n.startswith((BATCH, UPTO)) and files.exists(spark, f"{root}/{n}/_SUCCESS")]
    return [(n[: n.index("=") + 1], int(n[n.index("=") + 1 :])) for n in found]


def _newest(spark: SparkSession, root: str) -> list[str]:
    """The folders that together hold all registers."""
    whole = _whole(spark, root)
    upto = max((n for kind, n in whole if kind == UPTO), default=None)
    after = sorted(n for kind, n in whole if kind == BATCH and (upto is None or n > upto))
    return ([f"{root}/{UPTO}{upto}"] if upto is not None else []) + [f"{root}/{BATCH}{n}" for n in after]


def stored_registers(spark: SparkSession, root: str, collections: list[str] | None = None) -> DataFrame:
    """Each register as it is now; of these collections only their partitions are read."""
    schema = T.StructType([f for f in SCHEMA.fields if f.name != "coll_name"] + [SCHEMA["coll_name"]])
    folders = _newest(spark, root)
    rows = spark.createDataFrame([], schema)
    for folder in folders:
        rows = rows.unionByName(spark.read.schema(schema).parquet(folder)) if folder != folders[0] else spark.read.schema(schema).parquet(folder)
    if collections is not None:
        rows = rows.where(F.col("coll_name").isin(*collections))
    return rows if len(folders) < 2 else latest(rows)


def merge(spark: SparkSession, root: str) -> str | None:
    """Write all registers as one folder, beside the stream; older ones go."""
    whole = _whole(spark, root)
    last = max((n for _, n in whole), default=None)
    if last is None or len(_newest(spark, root)) < 2:
        return None
    folder = f"{root}/{UPTO}{last}"
    write_registers(stored_registers(spark, root).select(*SCHEMA.names), folder)
    for kind, n in whole:
        if (kind == BATCH and n <= last) or (kind == UPTO and n < last):
            files.delete(spark, f"{root}/{kind}{n}")
    return folder


def start_stateful_sync(
    events: DataFrame, root: str, checkpoint: str, start: int | None = None, interval: str | None = None
) -> StreamingQuery:
    """Start folding a stream of change events of any number of collections.

    ``start`` leaves out events before a position.  With no ``interval`` everything
    available is taken and the query ends; started again with the same checkpoint it
    goes on where it was.  A batch that was written to the end is not written again.
    """
    spark = events.sparkSession
    chosen = events if start is None else feed_source.since(events, start)
    state = registers(feed_source.normalise(chosen))

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        folder = f"{root}/{BATCH}{batch_id}"
        if not files.exists(spark, f"{folder}/_SUCCESS"):
            write_registers(batch, folder)

    writer = state.writeStream.outputMode("update").foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def start_dead_letters(events: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Events that cannot be folded, as error rows appended below ``path``."""
    writer = records.dead_letters(events).writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def read_table(spark: SparkSession, root: str, how: CollectionMap | MapHistory, base: DataFrame | None = None) -> DataFrame:
    """Current rows of one collection, under a map or a history of maps.

    ``base`` are rows that were there before the feed (under the history's first map).
    """
    history = how if isinstance(how, MapHistory) else MapHistory(((None, how),))
    state = fold_registers(stored_registers(spark, root, [history.collection]), history)
    last = history.last()
    return rows_of_fold(state, last) if base is None else apply_fold(carried_rows(base, history), state, last)


def read_tables(spark: SparkSession, root: str, maps: list[CollectionMap]) -> DataFrame:
    """Rows of several collections of one shape of map: ``(collection, ...)``, in one pass."""
    shape = maps[0]
    if any(m.columns != shape.columns or m.extra_props != shape.extra_props for m in maps):
        raise ValueError("collections read together have maps of one shape")
    rows = stored_registers(spark, root, [m.collection for m in maps])
    return rows_of_fold(to_fold(rows, shape, by=("coll_name", "id")), shape, keep=("coll_name",))

