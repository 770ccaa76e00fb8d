"""Service rows: audit, transfer statistics, errors and positions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from docsync.functions.naming import ref
from docsync.operators.mapping import CollectionMap
from docsync.operators.project import field_path
from docsync.sources.documents import DOC, is_document_frame
from docsync.sources.feed import CORRUPT, REPLACE, UPDATE, fault

# What a transfer statistic says was done, and below it the names
# of the service columns.
ACTION_UPSERT = "UPSERT"
ACTION_INSERT = "INSERT"
ACTION_VACUUM = "FULL VACUUM"


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


AUDIT_SCHEMA = _schema(
    ("seq", T.LongType()),
    ("operation", T.StringType()),
    ("relation", T.StringType()),
    ("obj_id", T.StringType()),
    ("ts", T.IntegerType()),
    ("merged", T.BooleanType()),
    ("document", T.StringType()),
)
POSITION_SCHEMA = _schema(("relation", T.StringType()), ("latest_successful_ts", T.LongType()))
STATS_SCHEMA = _schema(
    ("action", T.StringType()),
    ("relation", T.StringType()),
    ("number_of_rows", T.LongType()),
    ("ts_start", T.LongType()),
    ("ts_end", T.LongType()),
)
ERROR_SCHEMA = _schema(("location", T.StringType()), ("message", T.StringType()), ("ts", T.IntegerType()))

SERVICE_SCHEMAS = {
    "audit": AUDIT_SCHEMA,
    "position": POSITION_SCHEMA,
    "transfer_stats": STATS_SCHEMA,
    "errors": ERROR_SCHEMA,
}


def updated_often(changes: DataFrame, by: tuple[str, ...] = ("id",)) -> DataFrame:
    """Ids that a batch updates more than once."""
    updates = changes.where(F.col("op").isin(UPDATE, REPLACE))
    return updates.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*by)


def audit_rows(
    changes: DataFrame,
    relation: CollectionMap | str,
    ts: Column | None = None,
    often: DataFrame | None = None,
    by: tuple[str, ...] = ("id",),
) -> DataFrame:
    """What a batch did: one row per change, deletes included.

    ``document`` is what the change says, as JSON text; ``merged`` tells that
    several updates of the id are in the batch, and so went into the row together.

    ``relation`` is a map, or names a column.  ``often`` are the ids updated more than
    once (:func:`updated_often`), told by the columns ``by``.  Read from a written table
    they are broadcast if they are few, and else joined so that Spark can split an id
    that is much of the batch; worked out on the way they would keep it in one task.
    """
    found = updated_often(changes, by) if often is None else often
    several = found.select(*[F.col(c).alias(f"_several_{c}") for c in by])
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_several_{c}") for c in by])
    rows = changes.join(several, same, "left")
    return rows.select(
        "seq",
        F.col("op").alias("operation"),
        (F.col(relation) if isinstance(relation, str) else F.lit(relation.relation)).alias("relation"),
        F.col("id").alias("obj_id"),
        (ts if ts is not None else F.unix_timestamp()).cast("int").alias("ts"),
        (F.col("op").isin(UPDATE, REPLACE) & F.col(f"_several_{by[-1]}").isNotNull()).alias("merged"),
        F.to_json("fields").alias("document"),
    )


def latest_position(changes: DataFrame, cmap: CollectionMap) -> DataFrame:
    """Position after a batch: ``(relation, latest_successful_ts)``."""
    return changes.agg(F.max("seq").alias("latest_successful_ts")).select(
        F.lit(cmap.relation).alias("relation"), "latest_successful_ts"
    )


def dead_letters(events: DataFrame) -> DataFrame:
    """Events that cannot be folded, as error rows: lines that are no JSON,
    operations nobody knows, and events without id or position."""
    bad = events.withColumn("_reason", fault(events)).where("_reason IS NOT NULL")
    told = [F.col("operationType"), F.col("documentKey._id"), F.col("seq").cast("string")]
    if CORRUPT in events.columns:
        told.append(F.col(CORRUPT))
    return bad.select(
        F.coalesce("ns.coll", F.lit("feed")).alias("location"),
        F.concat_ws(": ", "_reason", *told).alias("message"),
        F.unix_timestamp().cast("int").alias("ts"),
    )


def unparsable_errors(texts: DataFrame, cmap: CollectionMap) -> DataFrame:
    """Documents that are no JSON, whole, as error rows."""
    return texts.select(
        F.lit(cmap.relation).alias("location"),
        F.concat_ws(": ", F.lit("document is not JSON"), F.col("document")).alias("message"),
        F.unix_timestamp().cast("int").alias("ts"),
    )


def anonymous_errors(docs: DataFrame, cmap: CollectionMap) -> DataFrame:
    """Documents without an id, whole, as error rows."""
    source = cmap.key.source
    if is_document_frame(docs):
        value = F.try_variant_get(DOC, field_path(source), "variant")
        nameless, text = docs.where(value.isNull() | F.is_variant_null(value)), F.to_json(DOC)
    else:
        nameless = docs.where(ref(source).isNull()) if source in docs.columns else docs
        text = F.to_json(F.struct(*[ref(c) for c in docs.columns]))
    return nameless.select(
        F.lit(cmap.relation).alias("location"),
        F.concat_ws(": ", F.lit("document has no id"), text).alias("message"),
        F.unix_timestamp().cast("int").alias("ts"),
    )
