"""One query per operator over the given tables, for use and for checking.

Every entry is ``name -> (spark, sf_dir) -> DataFrame``; ``oracle.py`` holds the
same questions as SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from docsync.functions import types as ct
from docsync.functions.cast import can_fail, cast_typed, variant_failed_sql
from docsync.functions.naming import namespace, snake_case, start_epoch
from docsync.operators import evolve, fold, history, mapping, project, records, rows
from docsync.operators.registers import combined, registers, to_fold
from docsync.plans import inputs
from docsync.plans.snapshot import load_collection, loaded_frame, transfer
from docsync.plans.tables import TableStore
from docsync.session import configure
from docsync.sources import collections, documents, feed
from docsync.streaming import stateful
from docsync.streaming.sync import apply_batch, refresh_maps, resume_position as stored_position, start_sync

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    @wraps(fn)
    def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    QUERIES[fn.__name__] = configured
    return configured


# ------------------------------------------------------- documents to rows


@query
def documents_to_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = project.project(inputs.event_documents(spark, sf_dir), inputs.EVENT_MAP)
    k = F.try_variant_get("props", "$.k", "double")
    return out.select("id", "created_at", "user_id", "event_type", "value", "has_value", k.alias("props_k"))


@query
def typed_documents_to_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.project(inputs.order_documents(spark, sf_dir), inputs.ORDER_MAP)


@query
def extra_props_spill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half the fields unmapped, and one mapped to a type it does not fit."""
    partial = mapping.make_map(
        "Events", "events",
        [("id", "_id", "TEXT"), ("event_type", "eventType", "DOUBLE PRECISION"), ("value", "value", "DOUBLE PRECISION")],
        extra_props=True,
    )
    out = project.project(inputs.event_documents(spark, sf_dir), partial)
    extra = lambda path, t: F.try_variant_get("_extra_props", path, t)
    return out.select(
        "id",
        "event_type",
        "value",
        extra("$.eventType", "string").alias("extra_event_type"),
        extra("$.userId", "long").alias("extra_user_id"),
        extra("$.hasValue", "boolean").alias("extra_has_value"),
        extra("$.props.k", "long").alias("extra_k"),
        F.size(F.map_keys(F.col("_extra_props").cast("map<string,variant>"))).cast("long").alias("n_extra"),
    )


@query
def cast_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every target type from text, number, boolean, null and object values."""
    o = inputs.table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    doc = F.to_variant_object(
        F.struct(
            F.col("o_orderpriority").alias("words"),
            F.substring("o_orderpriority", 1, 1).alias("digit"),
            F.col("o_orderdate").cast("string").alias("date"),
            (F.floor("o_totalprice") % 2).alias("bit"),
            (status == "F").alias("flag"),
            F.when(status != "O", "").alias("blank"),
            F.when(status == "F", F.parse_json(F.lit("{}"))).otherwise(F.parse_json(F.lit('{"a":[]}'))).alias("object"),
        )
    )
    wanted = [
        ("words_text", "words", ct.TEXT), ("words_double", "words", ct.DOUBLE), ("words_timestamp", "words", ct.TIMESTAMP),
        ("words_boolean", "words", ct.BOOLEAN), ("digit_double", "digit", ct.DOUBLE), ("date_timestamp", "date", ct.TIMESTAMP),
        ("bit_boolean", "bit", ct.BOOLEAN), ("flag_text", "flag", ct.TEXT), ("flag_double", "flag", ct.DOUBLE),
        ("flag_boolean", "flag", ct.BOOLEAN), ("blank_boolean", "blank", ct.BOOLEAN), ("blank_double", "blank", ct.DOUBLE),
        ("object_boolean", "object", ct.BOOLEAN), ("object_double", "object", ct.DOUBLE),
    ]
    columns = [mapping.MappedColumn(*w) for w in wanted]
    ready = project.cast_fields(o.select("o_orderkey", doc.alias("doc")), columns)
    out = ["o_orderkey"]
    for i, c in enumerate(columns):
        out.append(f"_x{i} AS {c.column}")
        if can_fail(c.type):
            out.append(f"{variant_failed_sql(f'_x{i}', f'_t{i}', c.type)} AS {c.column}_failed")
    return ready.selectExpr(*out)


@query
def cast_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrong = mapping.make_map("Orders", "orders", [("id", "_id", "TEXT"), ("priority", "priority", "DOUBLE PRECISION"), ("ordered_at", "orderedAt", "DOUBLE PRECISION")])
    return project.cast_errors(inputs.order_documents(spark, sf_dir), wrong).select("location", "message")


# ------------------------------------------------------------------- maps


@query
def type_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    votes = mapping.type_histogram(inputs.mixed_orders(spark, sf_dir))
    return votes.select("field", "column", "type", F.col("n").alias("n_documents"))


@query
def dominant_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = mapping.dominant_types(mapping.type_histogram(inputs.mixed_orders(spark, sf_dir)))
    return best.select("field", "column", "type")


@query
def inferred_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map of every given table, all documents voting."""
    typed, seqs = inputs.every_collection(spark, sf_dir)
    maps = mapping.infer_map(typed, sample=None, seqs=seqs, read_typed=True)
    return mapping.column_rows(maps)


@query
def inferred_map_of_keyed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map of documents that have ids as field names: columns are what a twentieth of them has."""
    docs = inputs.keyed_orders(spark, sf_dir)
    return mapping.column_rows(mapping.infer_map({"KeyedOrders": docs}, min_share=0.05, max_names=2000))


@query
def inferred_document_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map of collections of JSON texts, all documents voting."""
    texts = {"Events": inputs.event_documents(spark, sf_dir), "MixedOrders": inputs.mixed_orders(spark, sf_dir)}
    return mapping.column_rows(mapping.infer_map(texts, sample=None))


@query
def sampled_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map from the newest documents only."""
    maps = mapping.infer_map({"MixedOrders": inputs.mixed_orders(spark, sf_dir)}, sample=documents.DEFAULT_SAMPLE)
    return mapping.column_rows(maps)


@query
def recent_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = inputs.table(spark, sf_dir, "events")
    return documents.newest(e, seq="event_id").select("event_id", "user_id", "event_type", "value")


@query
def projected_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.projected(inputs.table(spark, sf_dir, "orders"), ["o_orderkey", "o_totalprice"])


@query
def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.lookup(inputs.table(spark, sf_dir, "orders"), 42, "o_orderkey")


@query
def collection_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.count_documents({n: inputs.table(spark, sf_dir, n) for n in inputs.TABLES})


REQUESTED = ("signup", "refund", "error", "logout")


def _event_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = inputs.table(spark, sf_dir, "events")
    return e.select(F.col("event_type").alias("collection_name")).distinct()


@query
def collections_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = collections.requested(spark, REQUESTED)
    return collections.present(wanted, _event_collections(spark, sf_dir))


@query
def collections_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = collections.requested(spark, REQUESTED)
    return collections.missing(wanted, _event_collections(spark, sf_dir))


@query
def snake_case_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column names made of whatever words begin the documents."""
    d = inputs.table(spark, sf_dir, "documents")
    name = F.regexp_replace(F.col("text"), "[^A-Za-z_]", "")
    return d.select("doc_id", snake_case(name).alias("column_name"))


@query
def snake_case_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column names made of whole texts: digits, blanks, punctuation and other scripts stay."""
    d = inputs.table(spark, sf_dir, "documents")
    return d.select("doc_id", snake_case(F.col("text")).alias("column_name"))


# ------------------------------------------------------------ row changes


@query
def append_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return rows.append(o.where("o_orderstatus = 'F'"), o.where("o_orderstatus <> 'F'"))


def _accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = inputs.table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("amount"), F.col("c_mktsegment").alias("note"))


def _account_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: many per account, in order-key order."""
    o = inputs.table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("amount"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("note"),
        F.col("o_orderkey").alias("seq"),
        F.when(F.col("o_orderstatus") == "P", F.array(F.lit("amount"))).alias("unset"),
    )


@query
def insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _accounts(spark, sf_dir).where("note <> 'BUILDING'")
    return rows.insert_ignore(base, _account_changes(spark, sf_dir), "id", "seq")


@query
def upsert_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _accounts(spark, sf_dir).where("note <> 'BUILDING'")
    return rows.upsert(base, _account_changes(spark, sf_dir), "id", "seq")


@query
def upsert_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _accounts(spark, sf_dir).where("note <> 'BUILDING'")
    touched = rows.non_null_touched(["amount", "note"], "unset")
    return rows.upsert_partial(base, _account_changes(spark, sf_dir), touched, "id", "seq")


@query
def delete_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    returned = inputs.table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return rows.delete_keys(o, returned, "o_orderkey")


@query
def key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.key_violations(inputs.table(spark, sf_dir, "lineitem"), "l_orderkey")


@query
def composite_key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.key_violations(inputs.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# ------------------------------------------------------------------- feed


@query
def normalise_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = inputs.user_changes(spark, sf_dir, purchase_replaces=True)
    get = lambda path, t: F.try_variant_get("fields", path, t)
    return changes.select(
        namespace(F.col("db_name"), F.col("coll_name")).alias("ns"),
        "id", "seq", "op",
        get("$.value", "double").alias("value"),
        get("$.eventType", "string").alias("event_type"),
        get("$.k", "long").alias("k"),
        F.coalesce(F.is_variant_null(get("$.value", "variant")), F.lit(False)).alias("value_is_null"),
        F.array_join("removed", ",").alias("removed"),
    )


@query
def changes_in_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of mapped collections; here each big spender type is one."""
    changes = inputs.user_changes(spark, sf_dir, collection=F.concat(F.lit("Users."), F.col("event_type")))
    names = inputs.table(spark, sf_dir, "events").where("value > 100").groupBy("event_type").count()
    known = names.where("event_type <> 'click'").select(F.concat(F.lit("Users."), "event_type").alias("collection_name"))
    kept = feed.in_map(changes, namespace(F.col("db_name"), F.col("coll_name")), known)
    return kept.groupBy("coll_name", "op").agg(F.count(F.lit(1)).alias("n_changes"), F.max("seq").alias("last_seq"))


@query
def merge_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold.merge_updates(inputs.user_changes(spark, sf_dir), inputs.USER_MAP)


@query
def replace_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = inputs.user_changes(spark, sf_dir, purchase_replaces=True)
    return fold.apply_changes(inputs.stored_users(spark, sf_dir), changes, inputs.USER_MAP)


@query
def operation_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.when(F.col("value") >= 20, "Big").otherwise("Small")
    return fold.operation_runs(inputs.user_changes(spark, sf_dir, collection=size))


@query
def fold_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: a whole change feed folded into a stored table."""
    changes = inputs.user_changes(spark, sf_dir)
    return fold.apply_changes(inputs.stored_users(spark, sf_dir), changes, inputs.USER_MAP)


@query
def fold_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, each third of the month folded by itself, then merged."""
    events = inputs.table(spark, sf_dir, "events")
    day = F.dayofmonth("ts")
    thirds = [events.where(day > 20), events.where(day <= 10), events.where((day > 10) & (day <= 20))]
    m = inputs.USER_MAP
    folds = [fold.fold_changes(feed.normalise(inputs.as_feed(t)), m) for t in thirds]
    return fold.apply_fold(inputs.stored_users(spark, sf_dir), fold.merge_folds(folds, m), m)


@query
def fold_with_extra_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fold under a map that lacks ``eventType`` and ``k``, in two batches: each leftover by itself."""
    m = mapping.make_map("Users", "users", [("id", "_id", "TEXT"), ("value", "value", "DOUBLE PRECISION")], extra_props=True)
    changes = inputs.user_changes(spark, sf_dir)
    later = F.pmod(F.xxhash64("seq"), F.lit(2)) == 1
    state = fold.merge_folds([fold.fold_changes(changes.where(later), m), fold.fold_changes(changes.where(~later), m)], m)
    extra = lambda name, t: F.try_variant_get("_extra_props", f"$.{name}", t)
    return fold.rows_of_fold(state, m).select(
        "id", "value", extra("eventType", "string").alias("extra_event_type"), extra("k", "long").alias("extra_k"),
        F.size(F.map_keys(F.col("_extra_props").cast("map<string,variant>"))).cast("long").alias("n_extra"),
    )


@query
def stream_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by Structured Streaming, into a stored table."""
    root = inputs.scratch(spark)
    store = TableStore(spark, f"{root}/tables")
    store.publish("users", inputs.stored_users(spark, sf_dir), inputs.USER_MAP)
    events = inputs.as_feed(inputs.event_stream(spark, sf_dir))
    done = start_sync(store, events, {"Users": inputs.USER_MAP}, f"{root}/checkpoint", audit=False)
    done.awaitTermination()
    return store.read("users")


def _users_store(spark: SparkSession, sf_dir: str) -> TableStore:
    store = TableStore(spark, f"{inputs.scratch(spark)}/tables")
    store.publish("users", inputs.stored_users(spark, sf_dir), inputs.USER_MAP)
    return store


#: More keys than one pushed list holds, among them one that no row has.
SOUGHT = [str(k) for k in (*range(1, 13), 10**12)]


@query
def stored_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by key from a stored table with a fold on top."""
    store = _users_store(spark, sf_dir)
    state = fold.fold_changes(inputs.user_changes(spark, sf_dir), inputs.USER_MAP)
    store.add_fold("users", state, inputs.USER_MAP, "feed", 0)
    return store.find("users", SOUGHT)


USERS = {"Users": inputs.USER_MAP}


@query
def stream_fold_stateful(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in Spark's own state: several batches, a restart from the checkpoint, and a merge."""
    root = inputs.scratch(spark)
    events = inputs.table(spark, sf_dir, "events")
    for half in range(2):
        some = events.where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == half)
        n_files = inputs.write_feed(some, "event_id", f"{root}/feed")
        a_batch = -(-n_files * 2 // 3)
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", a_batch).parquet(f"{root}/feed")
        stateful.start_stateful_sync(inputs.as_feed(stream), f"{root}/registers", f"{root}/checkpoint").awaitTermination()
        if not half:
            stateful.merge(spark, f"{root}/registers")
    return stateful.read_table(spark, f"{root}/registers", inputs.USER_MAP, inputs.stored_users(spark, sf_dir))


N_COLLECTIONS = 50


@query
def fold_many_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed of 50 collections, folded and written in one pass, partitioned by collection."""
    folder = f"{inputs.scratch(spark)}/{stateful.BATCH}0"
    name = F.concat(F.lit("c"), (F.col("user_id") % N_COLLECTIONS).cast("string"))
    stateful.write_registers(registers(inputs.user_changes(spark, sf_dir, collection=name)), folder)
    root = folder.rpartition("/")[0]
    whole = [(c.column, c.source, c.type) for c in inputs.USER_MAP.columns]
    even, odd = ([mapping.make_map(f"c{i}", f"c{i}", columns) for i in range(first, N_COLLECTIONS, 2)] for first, columns in ((0, whole), (1, whole[:-1])))
    return stateful.read_tables(spark, root, even).unionByName(stateful.read_tables(spark, root, odd), allowMissingColumns=True)


def user_history(events: DataFrame) -> history.MapHistory:
    """Three maps of the users, each valid for a third of the feed."""
    last = events.agg(F.max("event_id")).first()[0] or 0
    key, value = ("id", "_id", "TEXT"), "value"
    return history.MapHistory((
        (None, mapping.make_map("Users", "users", [key, (value, "value", "DOUBLE PRECISION"), ("event_type", "eventType", "TEXT")])),
        (last // 3, mapping.make_map("Users", "users", [key, (value, "value", "TEXT"), ("kind", "eventType", "BOOLEAN"), ("k", "k", "TEXT")])),
        (last // 3 * 2, mapping.make_map("Users", "users", [key, (value, "value", "DOUBLE PRECISION"), ("known", "eventType", "BOOLEAN"), ("k", "k", "DOUBLE PRECISION")])),
    ))


@query
def fold_across_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event under the map valid at its position, the feed folded in two mixed halves."""
    maps = user_history(inputs.table(spark, sf_dir, "events"))
    changes = inputs.user_changes(spark, sf_dir)
    later = F.pmod(F.xxhash64("seq"), F.lit(2)) == 1
    halves = registers(changes.where(later)).unionByName(registers(changes.where(~later)))
    return history.table_across(inputs.stored_users(spark, sf_dir).drop("k"), combined(halves), maps)


@query
def errors_across_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that did not fit under the map valid at their position."""
    events = inputs.table(spark, sf_dir, "events")
    last = events.agg(F.max("event_id")).first()[0] or 0
    key = ("id", "_id", "TEXT")
    types = ((None, "TEXT"), (last // 2, "TIMESTAMP"))
    maps = history.MapHistory(tuple((since, mapping.make_map("Users", "users", [key, ("event_type", "eventType", t)])) for since, t in types))
    errors = history.errors_across(inputs.user_changes(spark, sf_dir), maps)
    return errors.groupBy("location", "message").agg(F.count("*").alias("n_errors"))


@query
def fold_wide_with_extra_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """300 mapped columns and leftovers, in two batches: only fields that are there are folded."""
    m = inputs.WIDE_MAP
    changes = feed.normalise(inputs.wide_feed(inputs.table(spark, sf_dir, "events")))
    later = F.pmod(F.xxhash64("seq"), F.lit(2)) == 1
    state = to_fold(combined(registers(changes.where(later)).unionByName(registers(changes.where(~later)))), m)
    columns = F.array(*[F.col(c.column) for c in m.value_columns])
    extra = F.col("_extra_props").cast("map<string,variant>")
    return fold.rows_of_fold(state, m).select(
        "id", F.size(F.array_compact(columns)).cast("long").alias("n_values"),
        F.aggregate(F.array_compact(columns), F.lit(0.0), lambda a, x: a + x).alias("sum_values"),
        F.size(extra).cast("long").alias("n_extra"),
        F.size(F.map_keys(F.map_filter(extra, lambda k, v: F.schema_of_variant(v) == "STRING"))).cast("long").alias("n_misfits"),
    )


@query
def stream_fold_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in batches that are no stretches of the feed, each compacted at once."""
    store = _users_store(spark, sf_dir)
    events = inputs.user_feed(spark, sf_dir)
    for i in range(4):
        batch = events.where(F.pmod(F.xxhash64("seq"), F.lit(4)) == i)
        apply_batch(store, USERS, batch, "shuffled", i, merge_every=1 if i % 2 else 20, audit=False)
        store.compact("users")
    return store.read("users")


@query
def repeated_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, the whole feed taken three times: as one batch, again, and as another feed."""
    store = _users_store(spark, sf_dir)
    for name in ("feed", "feed", "again"):
        apply_batch(store, USERS, inputs.user_feed(spark, sf_dir), name, 0, audit=False)
    return store.read("users")


@query
def feed_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events without id or position, and of an operation nobody knows."""
    events = inputs.table(spark, sf_dir, "events")
    made = inputs.as_feed(events)
    op = F.col("operationType")
    broken = made.select(
        F.when(op == feed.INSERT, F.lit("explode")).otherwise(op).alias("operationType"), "ns",
        F.struct(F.when(op != feed.DELETE, F.col("documentKey._id")).alias("_id")).alias("documentKey"),
        "updateDescription", "fullDocument",
        F.when((op != feed.UPDATE) | F.col("updateDescription.removedFields").isNull(), F.col("seq")).alias("seq"),
    )
    store = TableStore(spark, f"{inputs.scratch(spark)}/tables")
    apply_batch(store, USERS, broken, "feed", 0, audit=False)
    return store.service("errors").select("location", "message")


@query
def resume_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of the feed from the position a table was brought to."""
    store = _users_store(spark, sf_dir)
    events = inputs.table(spark, sf_dir, "events")
    apply_batch(store, USERS, inputs.as_feed(events.where(F.dayofmonth("ts") <= 15)), "feed", 0, audit=False)
    start = stored_position(store, ["users"])
    return feed.normalise(feed.since(inputs.user_feed(spark, sf_dir), F.lit(start))).select("id", "seq", "op")


@query
def resume_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes from a written start time on."""
    start = F.timestamp_seconds(start_epoch(F.lit("12-01-24T06:30:00"))).cast("timestamp_ntz")
    events = feed.since(inputs.table(spark, sf_dir, "events"), start, "ts")
    return feed.normalise(inputs.as_feed(events)).select("id", "seq", "op")


# -------------------------------------------------------------- evolution


@query
def stored_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The map of every given table, written and read back."""
    typed, seqs = inputs.every_collection(spark, sf_dir)
    path = f"{inputs.scratch(spark)}/map"
    mapping.write_map(mapping.infer_map(typed, seqs=seqs, read_typed=True), path)
    return mapping.column_rows(mapping.read_map(spark, path))


RENAMED_MAP = mapping.make_map(
    "Customer", "customer",
    [("id", "_id", "TEXT"), ("name", "mktSegment", "TEXT"), ("balance", "acctBal", "TEXT"), ("customer_name", "name", "TEXT")],
)


@query
def evolve_renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns called otherwise (one takes another's old name) keep their values."""
    store = TableStore(spark, inputs.scratch(spark))
    load_collection(store, inputs.customer_documents(spark, sf_dir), inputs.CUSTOMER_MAP)
    refresh_maps(store, {"Customer": inputs.CUSTOMER_MAP}, {"Customer": RENAMED_MAP})
    return store.read("customer").select("id", "name", F.col("balance").cast("double").alias("balance"), "customer_name")


def _two_maps(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Maps of the data before and after it changed shape."""
    fields = inputs.mixed_order_fields()
    o = inputs.table(spark, sf_dir, "orders")
    later = {**fields, "totalPrice": F.col("o_orderpriority"), "customer": F.col("o_custkey")}
    del later["nothing"]
    old = mapping.infer_map(
        {"Orders": documents.from_table(o, "o_orderkey", fields),
         "Customer": documents.from_table(inputs.customer_documents(spark, sf_dir), "_id")}, sample=None)
    new = mapping.infer_map(
        {"Orders": documents.from_table(o, "o_orderkey", later),
         "Part": documents.from_table(inputs.table(spark, sf_dir, "part"), "p_partkey")}, sample=None)
    renamed = F.transform(
        "types",
        lambda c: F.struct(
            F.when(c["source"] == "orderedAt", F.lit("ordered_on")).otherwise(c["column"]).alias("column"),
            c["source"].alias("source"), c["type"].alias("type"),
        ),
    )
    return old, new.withColumn("types", renamed)


@query
def map_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _two_maps(spark, sf_dir)
    return evolve.map_diff(old, new)


@query
def track_untrack(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _two_maps(spark, sf_dir)
    return evolve.map_changes(old, new).where(F.col("source").isNull()).select("collection_name", "change")


def _typed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).alias("rank"), "o_totalprice", "o_orderdate", "o_orderpriority"
    )


RETYPES = {
    "rank": (ct.TEXT, ct.DOUBLE),
    "o_totalprice": (ct.DOUBLE, ct.BOOLEAN),
    "o_orderdate": (ct.TIMESTAMP, ct.TEXT),
}
REFUSED = {
    "o_orderpriority": (ct.TEXT, ct.DOUBLE),
    "o_totalprice": (ct.DOUBLE, ct.JSONB),
    "o_orderdate": (ct.TIMESTAMP, ct.DOUBLE),
    "rank": (ct.TEXT, ct.DOUBLE),
}


@query
def retype_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evolve.retype_all(_typed_orders(spark, sf_dir), RETYPES)[0]


@query
def retype_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _typed_orders(spark, sf_dir)
    return evolve.report_frame(df, "orders", evolve.retype_all(df, REFUSED)[1])


EVOLVED_MAP = mapping.make_map(
    "Customer", "customer",
    [("id", "_id", "TEXT"), ("mkt_segment", "mktSegment", "TEXT"), ("comment", "comment", "TEXT"),
     ("acct_bal", "acctBal", "TEXT"), ("nation_key", "nationKey", "BOOLEAN")],
)


@query
def evolve_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name goes, comment comes, a key becomes a flag, all in one projection."""
    table = project.project(inputs.customer_documents(spark, sf_dir), inputs.CUSTOMER_MAP)
    out, _ = evolve.evolve(table, EVOLVED_MAP)
    return out.withColumn("acct_bal", F.col("acct_bal").cast("double"))


@query
def evolve_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = project.project(inputs.customer_documents(spark, sf_dir), inputs.CUSTOMER_MAP)
    return evolve.report_frame(table, "customer", evolve.evolve(table, EVOLVED_MAP)[1])


@query
def backfill_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.customer_documents(spark, sf_dir)
    full = inputs.CUSTOMER_MAP
    before = project.project(docs, full).drop("mkt_segment", "nation_key").where("acct_bal > 0")
    table, report = evolve.evolve(before, full)
    added = [r.column for r in report if r.change == "added"]
    return evolve.backfill(table, docs, full, added)


@query
def convertible_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which types met in one field could be converted into one another."""
    votes = mapping.type_histogram(inputs.mixed_orders(spark, sf_dir)).where(F.col("type").isNotNull())
    old = votes.select("field", F.col("type").alias("old_type"), F.col("n").alias("n_old"))
    new = votes.select("field", F.col("type").alias("new_type"))
    return old.join(new, "field").where("old_type <> new_type").select(
        "*", ct.convertible_column(F.col("old_type"), F.col("new_type")).alias("convertible")
    )


# ------------------------------------------------------------ service rows


@query
def audit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes, folder = inputs.user_changes(spark, sf_dir), f"{inputs.scratch(spark)}/often"
    records.updated_often(changes).write.parquet(folder)
    return records.audit_rows(changes, inputs.USER_MAP, often=spark.read.schema("id string").parquet(folder)).select(
        "seq", "operation", "relation", "obj_id", "merged",
        *[F.get_json_object("document", f"$.{c}").cast(t).alias(f"document_{c}") for c, t in (("eventType", "string"), ("value", "double"), ("k", "long"))],
    )


@query
def change_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrong = mapping.make_map("Users", "users", [("id", "_id", "TEXT"), ("event_type", "eventType", "DOUBLE PRECISION")])
    errors = fold.change_errors(inputs.user_changes(spark, sf_dir), wrong)
    return errors.groupBy("location", "message").agg(F.count(F.lit(1)).alias("n_errors"))


@query
def position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.latest_position(inputs.user_changes(spark, sf_dir), inputs.USER_MAP)


def _snapshot(spark: SparkSession, sf_dir: str) -> tuple[TableStore, list]:
    store = TableStore(spark, inputs.scratch(spark))
    sources = {"Orders": inputs.order_documents(spark, sf_dir), "Customer": inputs.customer_documents(spark, sf_dir)}
    maps = {"Orders": inputs.ORDER_MAP, "Customer": inputs.CUSTOMER_MAP}
    return store, transfer(store, sources, maps, ["Orders", "Absent", "Customer"], truncate=True)


@query
def snapshot_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two collections loaded into tables, read back by what they hold."""
    store, _ = _snapshot(spark, sf_dir)
    o = store.read("orders").groupBy(F.col("priority").alias("kind")).agg(
        F.count("id").alias("n_rows"), F.countDistinct("customer").alias("n_values"), F.max("total_price").alias("top")
    )
    c = store.read("customer").groupBy(F.col("mkt_segment").alias("kind")).agg(
        F.count("id").alias("n_rows"), F.countDistinct("name").alias("n_values"), F.max("acct_bal").alias("top")
    )
    return o.withColumn("relation", F.lit("orders")).unionByName(c.withColumn("relation", F.lit("customer")))


@query
def transfer_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, loaded = _snapshot(spark, sf_dir)
    stored = store.service("transfer_stats").select("relation", "action", "number_of_rows")
    return stored.join(loaded_frame(spark, loaded).select("relation", "failures"), "relation")


@query
def second_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A collection loaded again in part: whole rows are replaced."""
    store = TableStore(spark, inputs.scratch(spark))
    orders = inputs.order_documents(spark, sf_dir)
    load_collection(store, orders, inputs.ORDER_MAP)
    urgent = orders.where("priority = '1-URGENT'").withColumns({"totalPrice": -F.col("totalPrice"), "orderedAt": F.lit(None).cast("timestamp_ntz")})
    load_collection(store, urgent, inputs.ORDER_MAP)
    return store.read("orders")


@query
def load_without_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without an id become error rows, however often they are loaded."""
    store = TableStore(spark, inputs.scratch(spark))
    orders = inputs.order_documents(spark, sf_dir)
    docs = orders.withColumn("_id", F.when(F.col("priority") != "1-URGENT", F.col("_id")))
    done = [load_collection(store, docs, inputs.ORDER_MAP) for _ in range(2)][-1]
    errors = store.service("errors").groupBy("location", F.substring_index("message", ":", 1).alias("message")).agg(F.count("*").alias("n_errors"))
    held = store.read("orders").agg(F.count("*").alias("n_rows"), F.count("id").alias("n_ids")).first()
    told = held.asDict() | {"n_loaded": done.rows}
    return errors.select("*", *[F.lit(n).cast("long").alias(c) for c, n in told.items()])


@query
def inferred_date_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates are timestamps, as columns of a typed collection and in documents."""
    typed = inputs.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("orderDay"))
    docs = documents.from_table(typed, "o_orderkey", {"_id": F.col("o_orderkey").cast("string"), "orderDay": F.col("orderDay").cast("variant")})
    return mapping.column_rows(mapping.infer_map({"Days": docs, "TypedDays": typed}, seqs={"TypedDays": "o_orderkey"}, read_typed=True))


@query
def load_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that are no JSON become error rows of the load."""
    texts = inputs.event_texts(spark, sf_dir)
    cut = F.when(F.try_variant_get(F.parse_json("body"), "$.eventType", "string") == "error", F.concat(F.lit('{"broken": '), "seq"))
    store = TableStore(spark, inputs.scratch(spark))
    docs = documents.from_json(texts.select(F.coalesce(cut, "body").alias("body"), "seq"), "body", "seq")
    done = load_collection(store, docs, inputs.EVENT_MAP)
    return store.service("errors").select("location", "message", F.lit(done.rows).alias("rows_loaded"))


@query
def typed_cast_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same cast rules on columns whose types are known when planning."""
    e = inputs.table(spark, sf_dir, "embeddings")
    schema = e.schema
    out = [F.col("vec_id")]
    for c in ("label", "embedding"):
        for t in (ct.BOOLEAN, ct.DOUBLE, ct.TIMESTAMP):
            k = cast_typed(F.col(c), schema[c].dataType, t)
            out += [k.value.alias(f"{c}_{t.split()[0]}"), k.failed.alias(f"{c}_{t.split()[0]}_failed")]
    doc = cast_typed(F.col("embedding"), schema["embedding"].dataType, ct.JSONB).value
    out.append(F.try_variant_get(doc, "$[0]", "double").alias("first_value"))
    # NaN is null, however deep in a typed value.
    odd = F.when(F.col("label") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("label").cast("double"))
    nested = e.select("*", F.array(F.struct(odd.alias("x"), F.create_map(F.lit("k"), F.array(odd)).alias("y"))).alias("nested"))
    told = F.to_json(cast_typed(F.col("nested"), nested.schema["nested"].dataType, ct.JSONB).value)
    return nested.select(*out, told.alias("nested_jsonb"))
