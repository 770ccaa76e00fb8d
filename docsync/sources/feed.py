"""Change events: reading them, and bringing them to one normal form."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from docsync.functions.naming import id_text, namespace_collection

INSERT, UPDATE, REPLACE, DELETE = "insert", "update", "replace", "delete"
OPERATIONS = (INSERT, UPDATE, REPLACE, DELETE)

# One change event as it comes from the feed.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("operationType", T.StringType()),
        T.StructField(
            "ns",
            T.StructType([T.StructField("db", T.StringType()), T.StructField("coll", T.StringType())]),
        ),
        T.StructField("documentKey", T.StructType([T.StructField("_id", T.StringType())])),
        T.StructField(
            "updateDescription",
            T.StructType(
                [
                    T.StructField("updatedFields", T.VariantType()),
                    T.StructField("removedFields", T.ArrayType(T.StringType())),
                ]
            ),
        ),
        T.StructField("fullDocument", T.VariantType()),
        T.StructField("seq", T.LongType()),
    ]
)

# Where a line of a feed file that is no event is kept.
CORRUPT = "_corrupt_record"

# Collection names that may be broadcast.
MAX_BROADCAST_NAMES = 100_000

# Columns of a normalised change.
CHANGE_COLUMNS = ("db_name", "coll_name", "id", "seq", "op", "fields", "removed")


def read_feed(spark: SparkSession, path: str, fmt: str = "json", **options: str) -> DataFrame:
    """Batch read of stored change events."""
    return spark.read.format(fmt).schema(_file_schema(fmt)).options(**options).load(path)


def _file_schema(fmt: str) -> T.StructType:
    """Text formats also tell which lines they could not read."""
    corrupt = [T.StructField(CORRUPT, T.StringType())] if fmt == "json" else []
    return T.StructType([*EVENT_SCHEMA.fields, *corrupt])


def stream_feed(
    spark: SparkSession, path: str, fmt: str = "json", max_files: int = 1000, **options: str
) -> DataFrame:
    """Streaming read of a folder that change-event files are added to."""
    return (
        spark.readStream.format(fmt)
        .schema(_file_schema(fmt))
        .option("maxFilesPerTrigger", max_files)
        .options(**options)
        .load(path)
    )


def supported(events: DataFrame) -> DataFrame:
    return events.where(F.col("operationType").isin(*OPERATIONS))


def fault(events: DataFrame) -> Column:
    """Why an event cannot be folded; null if it can."""
    corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in events.columns else F.lit(False)
    known = F.coalesce(F.col("operationType").isin(*OPERATIONS), F.lit(False))
    return (
        F.when(corrupt, "line is not an event")
        .when(~known, "operation is unknown")
        .when(F.col("documentKey._id").isNull(), "event has no id")
        .when(F.col("seq").isNull(), "event has no position")
    )


def placeable(events: DataFrame) -> DataFrame:
    """Events that can be folded."""
    return events.where(fault(events).isNull())


def mapped(events: DataFrame, collections: Iterable[str]) -> DataFrame:
    """Events of the collections that have a map (a short list of names)."""
    return events.where(F.col("ns.coll").isin(*list(collections)))


def in_map(events: DataFrame, namespace: Column, map_df: DataFrame) -> DataFrame:
    """Same test against the map held as a DataFrame, by ``db.coll`` name.

    The names are counted first, and broadcast if they are few, as names of
    collections are: one collection may be most of the feed and should stay
    spread out.
    """
    names = map_df.select(F.col("collection_name").alias("_mapped")).distinct()
    if names.limit(MAX_BROADCAST_NAMES + 1).count() <= MAX_BROADCAST_NAMES:
        names = F.broadcast(names)
    return events.join(names, namespace_collection(namespace) == F.col("_mapped"), "left_semi")


def since(changes: DataFrame, position: int | Column, column: str = "seq") -> DataFrame:
    """Changes at or after a start position; pushed down to the scan."""
    return changes.where(F.col(column) >= position)


def normalise(events: DataFrame) -> DataFrame:
    """Events -> ``(db_name, coll_name, id, seq, op, fields, removed)``.

    ``fields`` holds the changed fields of an update and the whole document of
    an insert or replace; ``removed`` the fields an update took away.  A delete
    has only its key.
    """
    op = F.col("operationType")
    is_update = op == UPDATE
    whole = op.isin(INSERT, REPLACE)
    return placeable(events).select(
        F.col("ns.db").alias("db_name"),
        F.col("ns.coll").alias("coll_name"),
        id_text(F.col("documentKey._id")).alias("id"),
        F.col("seq").cast("long").alias("seq"),
        op.alias("op"),
        F.when(is_update, F.col("updateDescription.updatedFields"))
        .when(whole, F.col("fullDocument"))
        .alias("fields"),
        F.when(is_update, F.col("updateDescription.removedFields")).alias("removed"),
    )
