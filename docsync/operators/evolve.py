"""Comparing maps, and bringing a table in line with a changed map."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from docsync.functions import types as ct
from docsync.functions.cast import number_of_text
from docsync.functions.naming import ref
from docsync.operators.fold import AT, CLEARED, DELETED, FIELDS, LIVE, position_columns, state_schema
from docsync.operators.mapping import CollectionMap, MappedColumn, column_rows
from docsync.operators.project import project
from docsync.operators.rows import Keys

# ------------------------------------------------------------ comparing maps


def map_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Column-by-column difference of two maps, for collections in both.

    ``(collection_name, source, old_column, new_column, old_type, new_type,
    change)`` with change one of added, removed, retyped, renamed, same.  A
    column both renamed and retyped is ``retyped`` with two column names.
    """
    on = ["collection_name", "source"]

    def side(m: DataFrame, mine: str, other: str) -> DataFrame:
        return column_rows(m).selectExpr(
            *on, f"column AS {mine}_column", f"type AS {mine}_type",
            f"CAST(NULL AS STRING) AS {other}_column", f"CAST(NULL AS STRING) AS {other}_type",
        )

    # Outer join by aggregate, so that each map is worked out only once.
    parts = ["old_column", "new_column", "old_type", "new_type"]
    joined = side(old, "old", "new").unionByName(side(new, "new", "old")).groupBy(*on).agg(*[F.max(p).alias(p) for p in parts])
    # A window holds the columns of one collection.
    w = Window.partitionBy("collection_name")
    joined = (
        joined.withColumn("_in_old", F.count("old_column").over(w))
        .withColumn("_in_new", F.count("new_column").over(w))
        .where("_in_old > 0 AND _in_new > 0")
    )
    same_type = ct.canonical_column(F.col("old_type")) == ct.canonical_column(F.col("new_type"))
    change = (
        F.when(F.col("old_column").isNull(), "added")
        .when(F.col("new_column").isNull(), "removed")
        .when(~same_type, "retyped")
        .when(F.col("old_column") != F.col("new_column"), "renamed")
        .otherwise("same")
    )
    return joined.select(*on, "old_column", "new_column", "old_type", "new_type", change.alias("change"))


def _only_in(mine: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Collections of ``mine`` whose ``key`` the other map lacks.

    An anti-join by aggregate: the sides are a row per collection each, and
    names that are constants would otherwise turn it into a nested loop.
    """
    names = ["collection_name", "relation_name"]
    both = mine.select(*names, F.lit(1).alias("_mine"), F.lit(0).alias("_other")).unionByName(
        other.select(*names, F.lit(0).alias("_mine"), F.lit(1).alias("_other"))
    )
    found = F.collect_set(F.when(F.col("_mine") == 1, F.struct(*names)))
    alone = both.groupBy(key).agg(F.max("_other").alias("_other"), found.alias("c")).where("_other = 0")
    return alone.select(F.inline("c"))


def to_track(old: DataFrame, new: DataFrame) -> DataFrame:
    """Collections only the new map has."""
    return _only_in(new, old, "collection_name")


def to_untrack(old: DataFrame, new: DataFrame) -> DataFrame:
    """Collections whose table the new map no longer fills; the table stays."""
    return _only_in(old, new, "relation_name")


def map_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Everything that differs between two maps; empty if nothing does."""
    empty = F.lit(None).cast("string")

    def collections(df: DataFrame, change: str) -> DataFrame:
        return df.select(
            "collection_name", empty.alias("source"), empty.alias("old_column"), empty.alias("new_column"),
            empty.alias("old_type"), empty.alias("new_type"), F.lit(change).alias("change"),
        )

    columns = map_diff(old, new).where(F.col("change") != "same")
    return columns.unionByName(collections(to_track(old, new), "track")).unionByName(
        collections(to_untrack(old, new), "untrack")
    )


def schema_changed(schema: T.StructType, cmap: CollectionMap) -> bool:
    """Does the table differ from the map, by name or type of any column?"""
    table = {f.name: ct.column_type_of(f.dataType) for f in schema.fields}
    wanted = {c.column: ct.canonical(c.type) for c in cmap.details()}
    return not table or table != wanted


# ---------------------------------------------------------------- retyping


def retype_expr(value: Column, old: str, new: str) -> Column:
    """The value as the new type, null where it does not fit."""
    a, b = ct.canonical(old), ct.canonical(new)
    target = ct.SPARK_TYPES[b]
    if a == b:
        return value
    nothing = F.lit(None).cast(target)
    if a == ct.JSONB:
        get = lambda t: F.try_variant_get(value, "$", t)
        schema = F.schema_of_variant(value)
        if b == ct.TEXT:
            return F.to_json(value)
        if b == ct.DOUBLE:
            return F.when(ct.is_numeric_schema(schema), get("double")).when(
                schema == "STRING", number_of_text(get("string"))
            )
        if b == ct.TIMESTAMP:
            return F.when(schema.startswith("TIMESTAMP"), get("timestamp_ntz")).when(
                schema == "STRING", get("string").try_cast("timestamp_ntz")
            )
        return nothing
    if b == ct.JSONB:
        plain = F.when(~F.isnan(value), value) if a == ct.DOUBLE else value
        return plain.cast("variant")
    if (a, b) == (ct.TEXT, ct.DOUBLE):
        return number_of_text(value)
    if a == ct.TEXT:
        return value.try_cast(target)
    if b == ct.TEXT:
        return value.cast("string")
    if (a, b) == (ct.BOOLEAN, ct.DOUBLE):
        return value.cast("double")
    if (a, b) == (ct.DOUBLE, ct.BOOLEAN):
        return value != 0
    return nothing


def retype_failures(df: DataFrame, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """How many values of each column do not fit its new type.

    One row for all columns together, so one pass over the table, reading only
    these columns.  ``columns`` maps a name to its old and new type.
    """
    return df.agg(
        *[
            F.count_if(ref(c).isNotNull() & retype_expr(ref(c), old, new).isNull()).alias(c)
            for c, (old, new) in columns.items()
        ]
    )


@dataclass(frozen=True)
class ColumnChange:
    """What happened to one column: added, removed, renamed, retyped or refused."""

    column: str
    change: str
    old_type: str | None
    new_type: str | None
    failures: int = 0


def retype(df: DataFrame, column: str, old: str, new: str) -> tuple[DataFrame, ColumnChange]:
    """Retype one column, all or nothing."""
    out, report = retype_all(df, {column: (old, new)})
    return out, report[0]


def retype_all(df: DataFrame, columns: dict[str, tuple[str, str]]) -> tuple[DataFrame, list[ColumnChange]]:
    """Retype several columns, each all or nothing, after one counting pass.

    Only the counts come to the driver.  A column that may not be converted,
    or has a value that does not fit, keeps its type and is reported refused.
    """
    report, tried = [], {}
    for c, (old, new) in columns.items():
        if ct.same_type(old, new):
            continue
        if ct.convertible(old, new):
            tried[c] = (old, new)
        else:
            report.append(ColumnChange(c, "refused", old, new))
    counts = retype_failures(df, tried).first().asDict() if tried else {}
    done = {}
    for c, (old, new) in tried.items():
        if counts[c]:
            report.append(ColumnChange(c, "refused", old, new, counts[c]))
        else:
            done[c] = retype_expr(ref(c), old, new)
            report.append(ColumnChange(c, "retyped", old, new))
    return df.select(*[done.get(c, ref(c)).alias(c) for c in df.columns]), report


# ---------------------------------------------------------------- evolving


def add_columns(df: DataFrame, columns: list[MappedColumn]) -> DataFrame:
    return df.select("*", *[F.lit(None).cast(c.spark_type).alias(c.column) for c in columns])


def remove_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[ref(c) for c in df.columns if c not in columns])


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[ref(c).alias(names.get(c, c)) for c in df.columns])


def evolve(
    df: DataFrame, cmap: CollectionMap, old: CollectionMap | None = None, keep: Sequence[str] = ()
) -> tuple[DataFrame, list[ColumnChange]]:
    """Bring a table in line with a map: rename, remove, retype and add columns.

    One projection in map order; the table is read once more only if a column
    changes type.  Where a retype is refused the old type stays.  With the map
    the table had before (``old``), columns are matched by the field they come
    from, so one that is called otherwise now keeps its values; without it, by
    name.  Columns in ``keep`` are none of the map's and pass through.
    """
    types = {f.name: ct.column_type_of(f.dataType) for f in df.schema.fields if f.name not in keep}
    names = {c: c for c in types}
    if old is not None:
        names = column_names(old, cmap)
    gone = [c for c in types if c not in names]
    report = [ColumnChange(c, "removed", types[c], None) for c in gone if old is not None]
    report += [ColumnChange(names[c], "renamed", types[c], types[c]) for c in types if c in names and names[c] != c]
    df = rename_columns(remove_columns(df, gone), names)
    have = {names[c]: t for c, t in types.items() if c in names}
    wanted = {c.column: c for c in cmap.details()}
    report += [ColumnChange(c, "removed", t, None) for c, t in have.items() if c not in wanted]
    kept, retyped = retype_all(
        remove_columns(df, [c for c in have if c not in wanted]),
        {c: (have[c], m.type) for c, m in wanted.items() if c in have},
    )
    fresh = [m for c, m in wanted.items() if c not in have]
    report += retyped + [ColumnChange(m.column, "added", None, ct.canonical(m.type)) for m in fresh]
    return add_columns(kept, fresh).select(*[ref(c) for c in wanted], *[ref(c) for c in keep]), report


def column_names(old: CollectionMap, new: CollectionMap) -> dict[str, str]:
    """What each column of the old map is called in the new, by its field."""
    by_source = {c.source: c.column for c in new.details()}
    return {c.column: by_source[c.source] for c in old.details() if c.source in by_source}


def evolve_stored(stored: DataFrame, old: CollectionMap, new: CollectionMap) -> tuple[DataFrame, list[ColumnChange]]:
    """The same for stored rows: the positions go along with their columns."""
    names = column_names(old, new)
    stay = {DELETED, LIVE, *[AT + n for n in names.values()], *[c for c in (CLEARED, FIELDS) if c in stored.columns]}
    keep = [c for c in position_columns(new) if c in stay]
    moved = rename_columns(
        remove_columns(stored, [AT + c.column for c in old.details() if c.column not in names] + [c for c in (CLEARED, FIELDS) if c not in keep]),
        {AT + c: AT + n for c, n in names.items()},
    )
    rows, report = evolve(moved, new, old, keep)
    missing = [f for f in state_schema(new).fields if f.name in position_columns(new) and f.name not in keep]
    rows = rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])
    return rows.select(*[ref(c.column) for c in new.details()], *[ref(c) for c in position_columns(new)]), report


def effective_map(cmap: CollectionMap, report: list[ColumnChange]) -> CollectionMap:
    """The map with the old type wherever a retype was refused, so that new
    data is cast to what the table really holds."""
    old = {r.column: r.old_type for r in report if r.change == "refused"}
    columns = tuple(MappedColumn(c.column, c.source, old.get(c.column, c.type)) for c in cmap.columns)
    return CollectionMap(cmap.collection, cmap.relation, columns, cmap.extra_props)


def backfill(table: DataFrame, docs: DataFrame, cmap: CollectionMap, columns: list[str], key: Keys | None = None) -> DataFrame:
    """Fill newly added columns from the collection, matching rows by key.

    Only the key and these columns are read from the documents.
    """
    key = cmap.key.column if key is None else key
    wanted = tuple(c for c in cmap.columns if c.column in columns or c.column == key)
    values = project(docs, CollectionMap(cmap.collection, cmap.relation, wanted))
    values = values.select(ref(key), *[ref(c).alias(f"_fill_{c}") for c in columns])
    joined = table.join(values, key, "left")
    return joined.select(*[(ref(f"_fill_{c}").alias(c) if c in columns else ref(c)) for c in table.columns])


def report_frame(df: DataFrame, relation: str, report: list[ColumnChange]) -> DataFrame:
    """An evolution report as rows."""
    schema = "relation string, column string, change string, old_type string, new_type string, failures long"
    rows = [(relation, r.column, r.change, r.old_type, r.new_type, r.failures) for r in report]
    return df.sparkSession.createDataFrame(rows, schema)
