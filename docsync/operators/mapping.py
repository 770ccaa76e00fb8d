"""Column maps: inferring them from documents, storing them, reading them back."""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from docsync.functions import types as ct
from docsync.functions.naming import EXTRA_COLUMN, EXTRA_SOURCE, KEY_COLUMN, KEY_SOURCE, literal, literals, quoted, snake_case
from docsync.sources.documents import DOC, KEYS, SEQ, from_table, is_document_frame, newest_by_cutoff

COLUMN_STRUCT = T.StructType(
    [
        T.StructField("column", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("type", T.StringType()),
    ]
)
MAP_SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("collection_name", T.StringType()),
        T.StructField("relation_name", T.StringType()),
        T.StructField("types", T.ArrayType(COLUMN_STRUCT)),
    ]
)


@dataclass(frozen=True)
class MappedColumn:
    """Field ``source`` of a document goes to ``column`` as ``type``."""

    column: str
    source: str
    type: str

    @property
    def spark_type(self) -> T.DataType:
        return ct.spark_type(self.type) or T.StringType()


@dataclass(frozen=True)
class CollectionMap:
    """How one collection becomes one table."""

    collection: str
    relation: str
    columns: tuple[MappedColumn, ...]
    extra_props: bool = False

    @property
    def key(self) -> MappedColumn:
        for c in self.columns:
            if c.source == KEY_SOURCE:
                return c
        return MappedColumn(KEY_COLUMN, KEY_SOURCE, ct.TEXT)

    @property
    def value_columns(self) -> tuple[MappedColumn, ...]:
        return tuple(c for c in self.columns if c.source != KEY_SOURCE)

    def schema(self) -> T.StructType:
        """Schema of the target table, in map order."""
        fields = [T.StructField(c.column, c.spark_type) for c in self.columns]
        if self.extra_props:
            fields.append(T.StructField(EXTRA_COLUMN, ct.SPARK_TYPES[ct.JSONB]))
        return T.StructType(fields)

    def details(self) -> list[MappedColumn]:
        """Every column of the table, the leftovers column included."""
        extra = [MappedColumn(EXTRA_COLUMN, EXTRA_SOURCE, ct.JSONB)] if self.extra_props else []
        return list(self.columns) + extra

    def with_extra_props(self, on: bool = True) -> CollectionMap:
        return replace(self, extra_props=on)


def make_map(collection: str, relation: str, columns: Iterable[tuple[str, str, str]], extra_props: bool = False) -> CollectionMap:
    return CollectionMap(collection, relation, tuple(MappedColumn(*c) for c in columns), extra_props)


# ---------------------------------------------------------------- inference


#: Names that one task holds while it looks for those of most documents.
MAX_NAMES = 100_000


def _with_keys(docs: DataFrame) -> DataFrame:
    return docs if KEYS in docs.columns else docs.withColumn(KEYS, F.map_keys(F.col(DOC).try_cast("map<string,variant>")))


def frequent_fields(docs: DataFrame, min_share: float, max_names: int = MAX_NAMES) -> list[str]:
    """Names of the fields that at least ``min_share`` of the documents have.

    For collections that use objects as dictionaries, where ids are field names and
    there may be as many of them as documents.  A sketch of heavy hitters, of
    ``max_names`` names a task, tells which names may be so frequent; only those are
    counted.  The sketch misses none above 7 / ``max_names`` of all names
    (twice its error of 3.5 / ``max_names``); if that is too coarse for the share, it is
    said so, with the number that would do.  At most ``max_names`` come to the driver.
    """
    names = _with_keys(docs).select(F.posexplode(KEYS).alias("at", "field"))
    found = names.agg(
        F.expr(f"approx_top_k(field, {max_names}, {max_names})").alias("top"), F.count("*").alias("names"), F.count_if(F.col("at") == 0).alias("documents")
    ).first()
    if not found["documents"]:
        return []
    least = min_share * found["documents"]
    if 7 * found["names"] > least * max_names:
        raise ValueError(f"max_names must be {math.ceil(7 * found['names'] / least)} for a share of {min_share}")
    maybe = docs.sparkSession.createDataFrame([(t["item"],) for t in found["top"]], "_maybe string")
    counted = names.join(F.broadcast(maybe), F.col("field") == F.col("_maybe"), "left_semi").groupBy("field").count()
    return sorted(r["field"] for r in counted.where(F.col("count") >= least).collect())


def field_votes(docs: DataFrame, only: list[str] | None = None) -> DataFrame:
    """One row per field of a document (of these fields, if told): ``(field, type, _seq, pos)``.

    Two fields of one document whose column names coincide: only the first
    counts.  ``type`` is null for a null value.
    """
    entries = F.map_entries(F.col(DOC).try_cast("map<string,variant>"))
    docs = _with_keys(docs)
    if only is not None:
        wanted = f"k IN ({literals(only)})" if only else "false"
        entries = F.map_entries(F.expr(f"map_filter(try_cast({DOC} AS MAP<STRING, VARIANT>), (k, v) -> {wanted})"))
        docs = docs.withColumn(KEYS, F.expr(f"filter({KEYS}, k -> {wanted})"))
    # Names can only coincide if the keys do without case and underscores;
    # that is cheap to rule out, and nearly always the case.
    bare = f"split(lower(replace(array_join({KEYS}, ','), '_', '')), ',')"
    suspect = F.expr(f"size(array_distinct({bare})) <> size({KEYS})")
    names = F.transform(F.col(KEYS), snake_case)
    first_of_name = F.filter(
        F.col("_entries"),
        lambda e: F.array_position(names, snake_case(e["key"])) == F.array_position(F.col(KEYS), e["key"]),
    )
    # The outer form: a plain explode makes Spark filter empty documents out
    # first, working out every document's entries twice.
    return (
        docs.select(SEQ, KEYS, entries.alias("_entries"))
        .select(SEQ, KEYS, F.explode_outer(F.when(suspect, first_of_name).otherwise(F.col("_entries"))).alias("e"))
        .where("e.key IS NOT NULL")
        .selectExpr("e.key AS field", "schema_of_variant(e.value) AS _schema", SEQ, f"array_position({KEYS}, e.key) AS pos")
        .select("field", ct.type_of_schema(F.col("_schema")).alias("type"), SEQ, "pos")
    )


def schema_votes(df: DataFrame) -> DataFrame:
    """Votes of a typed collection by its schema alone: no document is read."""
    rows = ", ".join(f"({literal(f.name)}, {literal(ct.column_type_of(f.dataType))}, 1L, 0L, {i + 1}L)" for i, f in enumerate(df.schema.fields))
    votes = df.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS v(field, type, n, newest, pos)")
    return votes.select("field", snake_case(F.col("field")).alias("column"), "type", "n", "newest", "pos")


def is_typed(docs: DataFrame) -> bool:
    """Are all types known from the schema?"""
    return not is_document_frame(docs) and not any(isinstance(f.dataType, T.VariantType) for f in docs.schema.fields)


def typed_votes(df: DataFrame, seq: str) -> DataFrame:
    """Histogram of a typed collection: ``(field, type, n, newest, pos)``.

    Types are known and every document has every field, so a column is only
    counted; ``newest`` is the collection's newest document throughout.
    """
    fields = df.schema.fields
    counts = [F.expr(f"count({quoted(f.name)}) AS _n{i}") for i, f in enumerate(fields)]
    totals = df.agg(F.expr("count(1) AS _all"), F.expr(f"max(CAST({quoted(seq)} AS BIGINT)) AS newest"), *counts)
    # Written as SQL text: one expression instead of a dozen calls per column.
    rows = ", ".join(
        f"struct({i} AS i, {kind} AS type, {n} AS n)"
        for i, f in enumerate(fields)
        for kind, n in ((f"'{ct.column_type_of(f.dataType)}'", f"_n{i}"), ("CAST(NULL AS STRING)", f"_all - _n{i}"))
    )
    names = literals(f.name for f in fields)
    return totals.selectExpr("newest", f"inline(array({rows}))").selectExpr(
        f"get(array({names}), i) AS field", "type", "n", "newest", "CAST(i + 1 AS BIGINT) AS pos"
    ).where("n > 0")


def type_histogram(docs: DataFrame, null_votes_as_jsonb: bool = False, seq: str = SEQ, only: list[str] | None = None) -> DataFrame:
    """Votes per field and type: ``(field, column, type, n, newest, pos)``.

    ``newest`` is the newest document with that vote and ``pos`` the field's
    place in it.  Votes are summed within each task before they are shuffled,
    so the shuffle carries a row per task, field and type, however many
    documents share a field.  A typed collection, ordered by ``seq``, is
    counted column by column instead.  Documents vote on ``only`` these fields, if told.
    """
    any_type = F.coalesce("type", F.lit(ct.JSONB)) if null_votes_as_jsonb else F.col("type")
    if not is_document_frame(docs) and not is_typed(docs):
        docs = from_table(docs, seq)
    if is_document_frame(docs):
        sums = (F.count(F.lit(1)).alias("n"), F.max(SEQ).alias("newest"), F.max_by("pos", SEQ).alias("pos"))
        votes = field_votes(docs, only).groupBy("field", any_type.alias("type")).agg(*sums)
    else:
        votes = typed_votes(docs, seq)
        if null_votes_as_jsonb:
            sums = (F.sum("n").alias("n"), F.max("newest").alias("newest"), F.max("pos").alias("pos"))
            votes = votes.groupBy("field", any_type.alias("type")).agg(*sums)
    return votes.select("field", snake_case(F.col("field")).alias("column"), "type", "n", "newest", "pos")


def dominant_types(histogram: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Most voted type per field: ``(field, column, type, newest, pos)``.

    Nulls do not vote; a field that is always null is text.  A tie goes to the
    type seen on the newest document.
    """
    voted = F.col("type").isNotNull()
    return histogram.groupBy(*by, "field", "column").agg(
        F.coalesce(
            F.max_by("type", F.when(voted, F.struct("n", "newest"))), F.lit(ct.TEXT)
        ).alias("type"),
        F.max("newest").alias("newest"),
        F.max_by("pos", "newest").alias("pos"),
    )


def unique_columns(dominant: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``(column, source, type, newest, pos)``: when two fields lead to one
    column name, the first seen keeps it."""
    rank = F.struct(F.col("newest"), -F.col("pos"))
    return dominant.groupBy(*by, "column").agg(
        F.max_by("field", rank).alias("source"),
        F.upper(F.max_by("type", rank)).alias("type"),
        F.max("newest").alias("newest"),
        F.max_by("pos", rank).alias("pos"),
    )


def infer_map(
    collections: dict[str, DataFrame],
    sample: int | None = None,
    null_votes_as_jsonb: bool = False,
    seqs: dict[str, str] | None = None,
    read_typed: bool = False,
    min_share: float | None = None,
    max_names: int = MAX_NAMES,
) -> DataFrame:
    """Map of several collections, sorted by name, columns in first-seen order.

    Every document votes, unless ``sample`` limits the votes to so many of the
    newest documents of each: fields on older ones only then get no column.
    ``seqs`` names the ordering column of each typed collection.  With
    ``read_typed`` or a ``sample`` their documents vote too: a column without any
    value is text, and a collection without documents has no columns, as among
    documents.  Without, typed collections are not read: their schema has a
    column's type, whatever it holds.  With ``min_share`` a field of documents becomes a
    column only if so large a share of them has it (:func:`frequent_fields`); the rest
    is for the leftovers (``load_maps(extra_props=True)``).  Each collection is reduced to its votes by
    itself; the rest is worked out for all of them together, on a row per field
    and type.
    """
    votes = []
    for position, name in enumerate(sorted(collections)):
        docs = collections[name]
        seq = SEQ if is_document_frame(docs) else (seqs or {}).get(name, SEQ)
        if is_typed(docs) and not read_typed and sample is None:
            histogram = schema_votes(docs)
        else:
            seen = docs if sample is None else newest_by_cutoff(docs, sample, seq)
            only = frequent_fields(seen, min_share, max_names) if min_share and is_document_frame(seen) else None
            histogram = type_histogram(seen, null_votes_as_jsonb, seq, only)
        votes.append(histogram.select(F.lit(position).alias("id"), F.lit(name).alias("collection_name"), "*"))
    by = ("id", "collection_name")
    columns = unique_columns(dominant_types(reduce(DataFrame.unionByName, votes), by), by)
    ordered = F.sort_array(
        F.collect_list(F.struct((-F.col("newest")).alias("a"), F.col("pos").alias("b"), "column", "source", "type"))
    )
    plain = F.transform(ordered, lambda c: F.struct(c["column"].alias("column"), c["source"].alias("source"), c["type"].alias("type")))
    # As many values per row as the collection's table will have columns.
    return columns.groupBy(*by).agg(plain.alias("types")).select(
        "id", "collection_name", snake_case(F.col("collection_name")).alias("relation_name"), "types"
    )


def infer_columns(docs: DataFrame, sample: int | None = None, null_votes_as_jsonb: bool = False, seq: str = SEQ) -> DataFrame:
    """Columns of one collection: ``(column, source, type, newest, pos)``."""
    order = SEQ if is_document_frame(docs) else seq
    seen = docs if sample is None else newest_by_cutoff(docs, sample, order)
    return unique_columns(dominant_types(type_histogram(seen, null_votes_as_jsonb, order)))


# ------------------------------------------------------- storing and reading


def map_frame(spark: SparkSession, maps: Iterable[CollectionMap]) -> DataFrame:
    """Maps as a DataFrame in the stored shape."""
    rows = [
        (i, m.collection, m.relation, [(c.column, c.source, c.type) for c in m.columns])
        for i, m in enumerate(maps)
    ]
    return spark.createDataFrame(rows, MAP_SCHEMA)


def write_map(map_df: DataFrame, path: str, fmt: str = "json") -> None:
    map_df.write.format(fmt).mode("overwrite").save(path)


def read_map(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return spark.read.format(fmt).schema(MAP_SCHEMA).load(path).orderBy("id")


def collection_names(map_df: DataFrame) -> DataFrame:
    return map_df.orderBy("id").select("collection_name")


def column_rows(map_df: DataFrame, collection: str | None = None) -> DataFrame:
    """The map as one row per column, in order."""
    chosen = map_df if collection is None else map_df.where(F.col("collection_name") == collection)
    return chosen.select(
        "collection_name", "relation_name", F.posexplode("types").alias("position", "c")
    ).select("collection_name", "relation_name", "position", "c.column", "c.source", "c.type")


def load_maps(map_df: DataFrame, extra_props: bool = False) -> dict[str, CollectionMap]:
    """Maps on the driver, to build projections from; metadata only."""
    return {
        r["collection_name"]: make_map(
            r["collection_name"],
            r["relation_name"],
            [(c["column"], c["source"], c["type"]) for c in r["types"]],
            extra_props,
        )
        for r in map_df.orderBy("id").collect()
    }


def map_json(map_df: DataFrame) -> DataFrame:
    """Each collection's columns serialised: ``(collection_name, types_json)``."""
    return map_df.select("collection_name", F.to_json("types").alias("types_json"))
