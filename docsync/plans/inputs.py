"""The given tables in the shapes the operators take: collections and feeds."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docsync.operators.mapping import CollectionMap, make_map
from docsync.sources import documents, feed, files

TABLES = (
    "benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels",
    "lineitem", "nation", "orders", "pages", "part", "region", "supplier",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder for written tables, on the file system the cluster shares."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/docsync-{uuid.uuid4().hex}"


# --------------------------------------------------------------- collections

EVENT_MAP = make_map(
    "Events",
    "events",
    [
        ("id", "_id", "TEXT"),
        ("created_at", "createdAt", "TIMESTAMP"),
        ("user_id", "userId", "DOUBLE PRECISION"),
        ("event_type", "eventType", "TEXT"),
        ("value", "value", "DOUBLE PRECISION"),
        ("has_value", "hasValue", "BOOLEAN"),
        ("props", "props", "JSONB"),
    ],
)


def event_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as JSON texts: ``(body, seq)``."""
    e = table(spark, sf_dir, "events")
    body = F.struct(
        F.col("event_id").alias("_id"),
        F.col("ts").cast("string").alias("createdAt"),
        F.col("user_id").alias("userId"),
        F.col("event_type").alias("eventType"),
        F.when(F.col("event_type") != "view", F.col("value")).alias("value"),
        (F.col("value") > 10).alias("hasValue"),
        F.parse_json("props").alias("props"),
    )
    return e.select(F.to_json(body, {"ignoreNullFields": "false"}).alias("body"), F.col("event_id").alias("seq"))


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.from_json(event_texts(spark, sf_dir), "body", "seq")


def mixed_order_fields() -> dict[str, Column]:
    """Order documents whose fields differ in type from one to the next."""
    status = F.col("o_orderstatus")
    return {
        "_id": F.col("o_orderkey").cast("string"),
        "totalPrice": F.col("o_totalprice"),
        "orderedAt": F.col("o_orderdate"),
        "payload": F.when(status == "F", F.col("o_orderpriority").cast("variant"))
        .when(status == "O", F.col("o_totalprice").cast("variant"))
        .otherwise(F.parse_json(F.lit("null"))),
        "Detail": F.when(status == "P", F.to_variant_object(F.array("o_custkey")))
        .when(F.col("o_totalprice") > 250000, (F.col("o_custkey") > 100).cast("variant"))
        .otherwise(F.to_variant_object(F.struct("o_orderpriority"))),
        "nothing": F.lit(None).cast("string"),
    }


def mixed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.from_table(table(spark, sf_dir, "orders"), "o_orderkey", mixed_order_fields())


def keyed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order documents with a field named after the customer, and a rare one."""
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    text = F.concat(
        F.lit('{"_id": '), q(F.col("o_orderkey").cast("string")), F.lit(', "totalPrice": '), F.col("o_totalprice").cast("string"),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit(', "Note": '), q(F.col("o_orderpriority")))).otherwise(""),
        F.when(F.col("o_orderkey") % 1000 == 0, F.lit(', "rare": true')).otherwise(""),
        F.lit(', "c'), F.col("o_custkey").cast("string"), F.lit('": {"seen": 1}}'),
    )
    return documents.from_json(table(spark, sf_dir, "orders").select(text.alias("body"), F.col("o_orderkey").alias("seq")), "body", "seq")


def every_collection(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Every given table as a typed collection, and the column each is ordered by."""
    out = {name: table(spark, sf_dir, name) for name in TABLES}
    return out, {name: df.schema.fields[0].name for name, df in out.items()}


# --------------------------------------------------------------------- feeds

USER_MAP = make_map(
    "Users",
    "users",
    [
        ("id", "_id", "TEXT"),
        ("value", "value", "DOUBLE PRECISION"),
        ("event_type", "eventType", "TEXT"),
        ("k", "k", "DOUBLE PRECISION"),
    ],
)


def as_feed(events: DataFrame, collection: Column | None = None, purchase_replaces: bool = False) -> DataFrame:
    """``events`` read as change events of a collection keyed by user.

    A signup inserts, an error deletes, everything else updates: a view sets
    ``value`` to null, a click leaves ``k`` out, a purchase takes ``k`` away
    (or, with ``purchase_replaces``, replaces the whole document).
    """
    kind = F.col("event_type")
    whole = kind.isin("signup", "purchase") if purchase_replaces else kind == "signup"
    value = F.when(kind != "view", F.col("value")).alias("value")
    k = F.try_variant_get(F.parse_json("props"), "$.k", "long").alias("k")
    full = F.to_variant_object(F.struct(value, kind.alias("eventType"), k))
    without_k = F.to_variant_object(F.struct(value, kind.alias("eventType")))
    fields = F.when(kind.isin("click", "purchase"), without_k).otherwise(full)
    op = F.when(kind == "signup", feed.INSERT).when(kind == "error", feed.DELETE)
    if purchase_replaces:
        op = op.when(kind == "purchase", feed.REPLACE)
    is_update = ~kind.isin("error") & ~whole
    return events.select(
        op.otherwise(feed.UPDATE).alias("operationType"),
        F.struct(
            F.lit("app").alias("db"), (F.lit("Users") if collection is None else collection).alias("coll")
        ).alias("ns"),
        F.struct(F.col("user_id").cast("string").alias("_id")).alias("documentKey"),
        F.when(
            is_update,
            F.struct(
                fields.alias("updatedFields"),
                F.when(kind == "purchase", F.array(F.lit("k"))).alias("removedFields"),
            ),
        ).alias("updateDescription"),
        F.when(whole, fields).alias("fullDocument"),
        F.col("event_id").alias("seq"),
    )


#: Fields of the documents of ``wide_feed`` that a map knows.
WIDE_FIELDS = 300


def wide_feed(events: DataFrame) -> DataFrame:
    """``events`` as changes of documents of many fields, each change naming two:
    a mapped ``c<n>`` (a text after a click, taken away by a purchase), and an ``x<n>``."""
    kind, k = F.col("event_type"), F.coalesce(F.try_variant_get(F.parse_json("props"), "$.k", "long"), F.lit(0)).cast("string")
    name = F.concat(F.lit("c"), (F.col("event_id") % WIDE_FIELDS).cast("string"))
    mapped = F.concat(F.lit('"'), name, F.lit('": '), F.when(kind == "click", F.lit('"bad"')).otherwise(k), F.lit(", "))
    other = F.concat(F.lit('"x'), (F.col("event_id") % 7).cast("string"), F.lit('": '), k)
    fields = F.parse_json(F.concat(F.lit("{"), F.when(kind == "purchase", F.lit("")).otherwise(mapped), other, F.lit("}")))
    update = F.struct(fields.alias("updatedFields"), F.when(kind == "purchase", F.array(name)).alias("removedFields"))
    return events.select(
        F.when(kind == "signup", feed.INSERT).when(kind == "error", feed.DELETE).otherwise(feed.UPDATE).alias("operationType"),
        F.struct(F.lit("app").alias("db"), F.lit("Wide").alias("coll")).alias("ns"),
        F.struct(F.col("user_id").cast("string").alias("_id")).alias("documentKey"),
        F.when(~kind.isin("signup", "error"), update).alias("updateDescription"),
        F.when(kind == "signup", fields).alias("fullDocument"),
        F.col("event_id").alias("seq"),
    )


#: Rows to a feed file.  A task reads no less than a file's row group, so files are to grow in number and not in size.
FEED_FILE_ROWS = 100_000


def write_feed(events: DataFrame, key: str, folder: str) -> int:
    """Add events to a folder of feed files, three at least; returns how many."""
    n_files = max(3, -(-events.count() // FEED_FILE_ROWS))
    events.repartition(n_files, key).write.mode("append").parquet(folder)
    return n_files


WIDE_MAP: CollectionMap = make_map(
    "Wide", "wide", [("id", "_id", "TEXT")] + [(f"c{i}", f"c{i}", "DOUBLE PRECISION") for i in range(WIDE_FIELDS)], extra_props=True
)


def user_feed(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    return as_feed(table(spark, sf_dir, "events"), **how)


def user_changes(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    return feed.normalise(user_feed(spark, sf_dir, **how))


def stored_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows the feed is folded into: the customers, in the users' columns."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_acctbal").alias("value"),
        F.col("c_mktsegment").alias("event_type"),
        F.col("c_nationkey").cast("double").alias("k"),
    )


def user_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same customers as documents of the ``Users`` collection."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("_id"),
        F.col("c_acctbal").alias("value"),
        F.col("c_mktsegment").alias("eventType"),
        F.col("c_nationkey").alias("k"),
    )


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a streaming source, stored as one file or as a folder."""
    path = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if files.is_folder(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)


CUSTOMER_MAP: CollectionMap = make_map(
    "Customer",
    "customer",
    [
        ("id", "_id", "TEXT"),
        ("name", "name", "TEXT"),
        ("nation_key", "nationKey", "DOUBLE PRECISION"),
        ("acct_bal", "acctBal", "DOUBLE PRECISION"),
        ("mkt_segment", "mktSegment", "TEXT"),
    ],
)


def customer_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a typed collection with document field names."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("_id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationKey"),
        F.col("c_acctbal").alias("acctBal"),
        F.col("c_mktsegment").alias("mktSegment"),
    )


ORDER_MAP: CollectionMap = make_map(
    "Orders",
    "orders",
    [
        ("id", "_id", "TEXT"),
        ("customer", "customer", "TEXT"),
        ("total_price", "totalPrice", "DOUBLE PRECISION"),
        ("ordered_at", "orderedAt", "TIMESTAMP"),
        ("priority", "priority", "TEXT"),
    ],
)


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("_id"),
        F.col("o_custkey").alias("customer"),
        F.col("o_totalprice").alias("totalPrice"),
        F.col("o_orderdate").alias("orderedAt"),
        F.col("o_orderpriority").alias("priority"),
    )
