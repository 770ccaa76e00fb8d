"""Maps that change while a feed goes on.

A history is a collection's maps, each with the position from which on it is valid.
Every event is read under the map valid at its position, whenever it is folded:

* a field counts as touched only by events since it has been mapped without a break
* its value is cast to the type the map gave it then, and from there as the column was
  retyped by later maps; what does not fit on the way is null
* a retype that may not be tried (``types.CONVERTIBLE``) leaves the type as it was
* a column called otherwise is the same column, by its field

So the table depends on the events and the history alone, not on batches, and a map
that becomes known late gives the table it would have given in time.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from docsync.functions import types as ct
from docsync.functions.cast import variant_cast_sql
from docsync.functions.naming import ref
from docsync.operators.evolve import map_changes, retype_expr
from docsync.operators.fold import apply_fold, change_errors, rows_of_fold
from docsync.operators.mapping import CollectionMap, MappedColumn, map_frame
from docsync.operators.registers import registers, to_fold
from docsync.sources.feed import MAX_BROADCAST_NAMES

VERSION = "map_version"
VERSION_SCHEMA = "collection_name string, since long, map_version int"


@dataclass(frozen=True)
class MapHistory:
    """Maps of one collection, oldest first: (valid from, map); the first from any position on."""

    versions: tuple[tuple[int | None, CollectionMap], ...]

    def __post_init__(self) -> None:
        starts = [s for s, _ in self.versions]
        if not starts or starts[0] is not None or None in starts[1:] or starts[1:] != sorted(set(starts[1:])):
            raise ValueError("a history begins with a map of no position, then goes up")

    @property
    def collection(self) -> str:
        return self.versions[-1][1].collection

    def held(self) -> list[CollectionMap]:
        """The maps with the types their columns really had."""
        out: list[CollectionMap] = []
        for _, m in self.versions:
            before = {c.source: c.type for c in out[-1].columns} if out else {}

            def kept(c: MappedColumn) -> str:
                old = before.get(c.source, c.type)
                return c.type if ct.same_type(old, c.type) or ct.convertible(old, c.type) else old

            columns = tuple(MappedColumn(c.column, c.source, kept(c)) for c in m.columns)
            out.append(CollectionMap(m.collection, m.relation, columns, m.extra_props))
        return out

    def last(self) -> CollectionMap:
        return self.held()[-1]

    def types_of(self, source: str) -> list[tuple[int, str]]:
        """(version, type) of a field since it has been mapped without a break."""
        out = []
        for n, m in reversed(list(enumerate(self.held()))):
            found = [c.type for c in m.columns if c.source == source]
            if not found:
                break
            out.append((n, found[0]))
        return out[::-1]


def version_rows(spark: SparkSession, histories: Iterable[MapHistory]) -> DataFrame:
    """``(collection_name, since, map_version)``: which map is valid from where."""
    rows = [(h.collection, since, n) for h in histories for n, (since, _) in enumerate(h.versions)]
    return spark.createDataFrame(rows, VERSION_SCHEMA)


def as_of(rows: DataFrame, versions: DataFrame) -> DataFrame:
    """``rows (coll_name, seq, ...)`` with the map version valid at each one's position.

    An as-of join: versions become stretches of positions.  They are broadcast if they
    are few, as map versions are, so that a collection which is most of the feed stays
    spread out.
    """
    next_one = F.lead("since").over(Window.partitionBy("collection_name").orderBy(F.asc_nulls_first("since")))
    stretches = versions.select(F.col("collection_name").alias("_of"), F.col("since").alias("_from"), next_one.alias("_until"), VERSION)
    if stretches.limit(MAX_BROADCAST_NAMES + 1).count() <= MAX_BROADCAST_NAMES:
        stretches = F.broadcast(stretches)
    seq, since, until = F.col("seq"), F.col("_from"), F.col("_until")
    valid = (F.col("coll_name") == F.col("_of")) & (since.isNull() | (seq >= since)) & (until.isNull() | (seq < until))
    return rows.join(stretches, valid, "left").drop("_of", "_from", "_until")


def version_at(seq: Column, history: MapHistory) -> Column:
    """The same of one collection, whose few versions are part of the expression: no join."""
    version = F.lit(0)
    for n, (since, _) in enumerate(history.versions):
        if since is not None:
            version = F.when(seq >= since, n).otherwise(version)
    return version


def _cast(history: MapHistory):
    """How a column's value is made of the raw one: by the version of its position."""

    def chain(value: Column, types: list[str]) -> Column:
        for old, new in zip(types, types[1:]):
            value = retype_expr(value, old, new)
        return value

    def cast(column: MappedColumn, value: str, schema: str, seq: str) -> Column | None:
        types = history.types_of(column.source)
        if len({ct.canonical(t) for _, t in types}) == 1:
            return None
        version = version_at(F.col(seq), history)
        out = F.lit(None).cast(column.spark_type)
        for i, (n, t) in enumerate(types):
            then = MappedColumn(column.column, column.source, t)
            first = F.expr(f"CAST({variant_cast_sql(value, schema, t)} AS {then.spark_type.simpleString()})")
            out = F.when(version == n, chain(first, [t for _, t in types[i:]])).otherwise(out)
        return out

    return cast


def fold_across(changes: DataFrame, history: MapHistory) -> DataFrame:
    """Normalised changes of one collection -> fold in the shape of the last map."""
    return fold_registers(registers(changes), history)


def fold_registers(rows: DataFrame, history: MapHistory) -> DataFrame:
    """The same from registers: raw values and their positions are all that it takes."""
    last, since = history.last(), {}
    for c in last.value_columns:
        n = history.types_of(c.source)[0][0]
        if history.versions[n][0] is not None:
            since[c.source] = history.versions[n][0]
    return to_fold(rows, last, since=since, cast=_cast(history))


def carried_rows(base: DataFrame, history: MapHistory) -> DataFrame:
    """Rows stored under the first map, as rows of the last one."""
    held = history.held()
    out = []
    for c in held[-1].details():
        types = history.types_of(c.source)
        if not types or types[0][0] > 0:
            out.append(F.lit(None).cast(c.spark_type).alias(c.column))
            continue
        first = next(x for x in held[0].columns if x.source == c.source)
        value = ref(first.column)
        for (_, old), (_, new) in zip(types, types[1:]):
            value = retype_expr(value, old, new)
        out.append(value.cast(c.spark_type).alias(c.column))
    return base.select(*out)


def table_across(base: DataFrame | None, rows: DataFrame, history: MapHistory) -> DataFrame:
    """Current rows, of registers on top of what was stored under the first map."""
    state, last = fold_registers(rows, history), history.last()
    return rows_of_fold(state, last) if base is None else apply_fold(carried_rows(base, history), state, last)


def errors_across(changes: DataFrame, history: MapHistory) -> DataFrame:
    """One error row per value that did not fit under the map valid at its position."""
    told = changes.where(F.col("coll_name") == history.collection).withColumn(VERSION, version_at(F.col("seq"), history))
    out = [change_errors(told.where(F.col(VERSION) == n), m) for n, m in enumerate(history.held())]
    return reduce(DataFrame.unionByName, out)


def changes_of_history(spark: SparkSession, history: MapHistory) -> DataFrame:
    """What each map changed against the one before it: ``since`` and the columns of
    ``evolve.map_changes``."""
    steps = zip(history.versions, history.versions[1:])
    out = [
        map_changes(map_frame(spark, [old]), map_frame(spark, [new])).select(F.lit(since).cast("long").alias("since"), "*")
        for (_, old), (since, new) in steps
    ]
    return reduce(DataFrame.unionByName, out) if out else map_changes(*[map_frame(spark, [history.last()])] * 2).select(F.lit(None).cast("long").alias("since"), "*")
