"""Folding a change feed into a table.

The folded form of any set of changes is one row per id, a *fold*:

* ``_deleted`` - position of the last delete, null if none
* ``_live``    - position of the last other change, null if none
* ``_changes`` - how many changes went in
* one struct ``<seq, value>`` per mapped column: the last touch and its value
* with leftovers, ``_cleared`` (position of the last change that told the whole
  document) and ``_fields``: the same struct per field that is not mapped or did not
  fit, its value null where the field was taken away

Folds merge by taking, per part, whatever has the higher position.  That makes
the order in which events, tasks or micro-batches are combined irrelevant, and
applying the same events twice harmless.  It also means the heavy lifting is a
plain aggregate: each task reduces its share of a hot id to one row before the
shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F, types as T

from docsync.functions.cast import can_fail
from docsync.functions.naming import EXTRA_COLUMN, literal, quoted, ref
from docsync.operators.mapping import CollectionMap, MappedColumn
from docsync.operators.project import FAILED, cast_fields, failed_sql, leftovers_sql
from docsync.operators.registers import CHANGES, CLEARED, DELETED, FAILURES, FIELDS, FIELDS_TYPE, LIVE, WIDE_MAP, registers, to_fold
from docsync.sources.feed import DELETE, INSERT, REPLACE, UPDATE

# Before a column's name: the position of its last touch, in a stored table.
AT = "_at_"


def _registers(cmap: CollectionMap) -> list[MappedColumn]:
    """Columns that change: all but the key; leftovers are folded by field."""
    return [c for c in cmap.columns if c.column != cmap.key.column]


def touch(changes: DataFrame, cmap: CollectionMap, with_failures: bool = False) -> DataFrame:
    """Typed values of normalised changes, and which columns each one touches.

    Gives ``id, seq, op`` and per column ``_c<i>`` (value) and ``_s<i>`` (the
    change's position if it touches the column, else null).  An insert touches
    the fields it has a value for; an update also those it sets to null or
    removes; a replace touches every mapped column.
    """
    columns = list(cmap.value_columns)
    ready = cast_fields(changes.select("id", "seq", "op", "fields", "removed"), columns, "fields")
    if cmap.extra_props or with_failures:
        ready = ready.selectExpr("*", f"{failed_sql(columns)} AS {FAILED}")

    out = ["id", "seq", "op"]
    for i, c in enumerate(columns):
        removed = f"coalesce(array_contains(removed, {literal(c.source)}), false)"
        touched = (
            f"op = '{REPLACE}' OR (op = '{UPDATE}' AND (_t{i} IS NOT NULL OR {removed})) "
            f"OR (op = '{INSERT}' AND _t{i} <> 'VOID')"
        )
        out.append(f"if({removed}, NULL, _x{i}) AS _c{i}")
        out.append(f"if({touched}, seq, NULL) AS _s{i}")
    if cmap.extra_props:
        # A field taken away, or one that fits now and may not have before, is no leftover any more.
        fits = [
            f"if(op = '{UPDATE}' AND _t{i} IS NOT NULL AND NOT array_contains({FAILED}, {literal(c.source)}), {literal(c.source)}, NULL)"
            for i, c in enumerate(columns)
            if can_fail(c.type)
        ]
        taken = "coalesce(removed, CAST(array() AS ARRAY<STRING>))"
        rest = f"map_filter(coalesce({leftovers_sql('fields', list(cmap.columns), FAILED)}, CAST(map() AS MAP<STRING, VARIANT>)), (k, v) -> NOT array_contains({taken}, k))"
        gone = f"concat({taken}, array_compact(array({', '.join(fits)})))" if fits else taken
        out.append(f"concat(map_entries({rest}), transform({gone}, k -> struct(k AS key, CAST(NULL AS VARIANT) AS value))) AS _leftovers")
    return ready.selectExpr(*out, *([FAILED] if with_failures else []))


def fold(touched: DataFrame, cmap: CollectionMap) -> DataFrame:
    """Touched changes -> fold, one row per id; one shuffle, of partial folds
    (leftovers need two more, by field and by id)."""
    parts = [
        f"struct(max(_s{i}) AS seq, max_by(_c{i}, _s{i}) AS value) AS {quoted(c.column)}"
        for i, c in enumerate(_registers(cmap))
    ]
    cleared = f"max(if(op IN ('{INSERT}', '{REPLACE}'), seq, NULL)) AS {CLEARED}"
    rows = _aggregate(
        touched,
        f"max(if(op = '{DELETE}', seq, NULL)) AS {DELETED}",
        f"max(if(op <> '{DELETE}', seq, NULL)) AS {LIVE}",
        f"count(1) AS {CHANGES}",
        *([f"sum(size({FAILED})) AS {FAILURES}"] if FAILED in touched.columns else []),
        *parts,
        *([cleared] if cmap.extra_props else []),
    )
    return _with_fields(rows, touched.selectExpr("id", "seq", "inline(_leftovers)")) if cmap.extra_props else rows


def _with_fields(rows: DataFrame, entries: DataFrame) -> DataFrame:
    """Folds with the last touch of each leftover field, from (id, seq, key, value)."""
    latest = entries.groupBy("id", "key").agg(F.max_by("value", "seq").alias("value"), F.max("seq").alias("seq"))
    # An entry per field the id's documents ever had.
    fields = latest.groupBy(F.col("id").alias("_of")).agg(
        F.map_from_entries(F.collect_list(F.struct("key", F.struct("seq", "value")))).alias(FIELDS)
    )
    return rows.join(fields, F.col("id") == F.col("_of"), "left").drop("_of")


def _leftovers(base: str) -> str:
    """The leftovers column: what was there, unless deleted or told anew since, and over it the fields touched since."""
    old = f"if({DELETED} IS NULL AND {CLEARED} IS NULL, try_cast({base} AS MAP<STRING, VARIANT>), NULL)"
    since = f"map_filter({FIELDS}, (k, e) -> ({DELETED} IS NULL OR e.seq > {DELETED}) AND ({CLEARED} IS NULL OR e.seq >= {CLEARED}))"
    none = f"CAST(map() AS {FIELDS_TYPE})"
    both = (
        f"map_zip_with(coalesce({old}, CAST(map() AS MAP<STRING, VARIANT>)), coalesce({since}, {none}), "
        "(k, v, e) -> if(e.seq IS NULL, v, e.value))"
    )
    return (
        f"CASE WHEN {DELETED} IS NULL AND {CLEARED} IS NULL AND {FIELDS} IS NULL THEN {base} "
        f"ELSE to_variant_object(map_filter({both}, (k, v) -> v IS NOT NULL)) END"
    )


def _fold_columns(cmap: CollectionMap) -> list[str]:
    return [CLEARED, FIELDS] if cmap.extra_props else []


def _aggregate(df: DataFrame, *sums: str) -> DataFrame:
    return df.groupBy("id").agg(*[F.expr(s) for s in sums])


def is_wide(cmap: CollectionMap) -> bool:
    return len(cmap.value_columns) > WIDE_MAP


def fold_sparse(changes: DataFrame, cmap: CollectionMap) -> DataFrame:
    """The same fold for wide maps, whose changes touch few columns each: by registers.

    Only fields that are there become rows, grouped by id and field, so the
    work grows with what changed and not with the width of the map.  Values
    are cast after folding, once per id and field.
    """
    wanted = None if cmap.extra_props else [c.source for c in cmap.value_columns]
    named = changes if "coll_name" in changes.columns else changes.withColumn("coll_name", F.lit(cmap.collection))
    return to_fold(registers(named, wanted), cmap)


def fold_changes(changes: DataFrame, cmap: CollectionMap, with_failures: bool = False) -> DataFrame:
    """Normalised changes -> fold, in the form that suits the map's width."""
    return fold_sparse(changes, cmap) if is_wide(cmap) else fold(touch(changes, cmap, with_failures), cmap)


def merge_folds(folds: list[DataFrame], cmap: CollectionMap) -> DataFrame:
    """Folds of different batches -> one fold, whatever order they come in."""
    return folds[0] if len(folds) == 1 else merge_fold_rows(reduce(DataFrame.unionByName, folds), cmap)


def merge_fold_rows(both: DataFrame, cmap: CollectionMap) -> DataFrame:
    """Several fold rows of an id -> one."""
    parts = []
    for c in _registers(cmap):
        p = quoted(c.column)
        parts.append(f"struct(max({p}.seq) AS seq, max_by({p}.value, {p}.seq) AS value) AS {p}")
    if cmap.extra_props:
        parts.append(f"max({CLEARED}) AS {CLEARED}")
    rows = _aggregate(
        both, f"max({DELETED}) AS {DELETED}", f"max({LIVE}) AS {LIVE}", f"sum({CHANGES}) AS {CHANGES}", *parts
    )
    if not cmap.extra_props:
        return rows
    entries = both.selectExpr("id", f"inline(map_entries({FIELDS}))").selectExpr("id", "key", "value.seq AS seq", "value.value AS value")
    return _with_fields(rows, entries)


_ALIVE = f"({LIVE} IS NOT NULL AND ({DELETED} IS NULL OR {LIVE} > {DELETED}))"


def _counts(part: str) -> str:
    """Was this column touched after the last delete?"""
    return f"({part}.seq IS NOT NULL AND ({DELETED} IS NULL OR {part}.seq > {DELETED}))"


def rows_of_fold(state: DataFrame, cmap: CollectionMap, keep: tuple[str, ...] = ()) -> DataFrame:
    """The rows a fold makes of an empty table; ``keep`` carries further columns along."""
    out = [*keep, f"id AS {quoted(cmap.key.column)}"]
    for c in _registers(cmap):
        p = quoted(c.column)
        out.append(f"if({_counts(p)}, {p}.value, NULL) AS {p}")
    if cmap.extra_props:
        out.append(f"{_leftovers('CAST(NULL AS VARIANT)')} AS {EXTRA_COLUMN}")
    return state.where(_ALIVE).selectExpr(*out)


def fold_schema(cmap: CollectionMap) -> T.StructType:
    """Schema of a stored fold."""
    long = T.LongType()
    parts = [
        T.StructField(c.column, T.StructType([T.StructField("seq", long), T.StructField("value", c.spark_type)])) for c in _registers(cmap)
    ]
    return T.StructType([
        T.StructField("id", T.StringType()), *[T.StructField(n, long) for n in (DELETED, LIVE, CHANGES)], *parts,
        *[T.StructField(c, _hidden_type(c)) for c in _fold_columns(cmap)],
    ])


def _hidden_type(column: str) -> T.DataType:
    if column != FIELDS:
        return T.LongType()
    return T.MapType(T.StringType(), T.StructType([T.StructField("seq", T.LongType()), T.StructField("value", T.VariantType())]))


# ------------------------------------------------ tables that keep positions
#
# A stored row has beside its values the positions they are from: of the last
# delete, the last other change, and the last touch of each column.  All are null in
# a row that was loaded and never changed: whatever the feed says is newer.  An
# id that was deleted stays as a row that is not alive.  So a table is itself a
# fold with values laid out as columns, and can take changes in any order.


def position_columns(cmap: CollectionMap) -> list[str]:
    return [DELETED, LIVE, *[AT + c.column for c in _registers(cmap)], *_fold_columns(cmap)]


def state_schema(cmap: CollectionMap) -> T.StructType:
    """A table's own columns, then positions."""
    return T.StructType([*cmap.schema().fields, *[T.StructField(c, _hidden_type(c)) for c in position_columns(cmap)]])


def with_positions(rows: DataFrame, cmap: CollectionMap, at: int | None = None) -> DataFrame:
    """Plain rows as stored ones, of one position or of none."""
    stamp = F.lit(at).cast("long")
    hidden = {c: stamp.alias(c) for c in position_columns(cmap)} | {DELETED: F.lit(None).cast("long").alias(DELETED)}
    if cmap.extra_props:
        # Leftovers of a known position become fields of it.
        told = f"transform_values(try_cast({EXTRA_COLUMN} AS MAP<STRING, VARIANT>), (k, v) -> struct(CAST({at} AS BIGINT) AS seq, v AS value))"
        hidden[FIELDS] = F.expr(told if at is not None else f"CAST(NULL AS {FIELDS_TYPE})").alias(FIELDS)
    return rows.select(*[ref(c.column) for c in cmap.details()], *hidden.values())


def alive(stored: DataFrame, cmap: CollectionMap) -> DataFrame:
    """The rows of a stored table, without positions."""
    rows = stored.where(f"{DELETED} IS NULL OR {LIVE} > {DELETED}")
    out = [quoted(c.column) for c in cmap.columns]
    if cmap.extra_props:
        out.append(f"{_leftovers(EXTRA_COLUMN)} AS {EXTRA_COLUMN}")
    return rows.selectExpr(*out)


def settle(stored: DataFrame, state: DataFrame, cmap: CollectionMap, small: bool = False) -> DataFrame:
    """Stored rows + fold -> stored rows: of each part whatever is later.

    Joins as :func:`apply_fold` does, and may be repeated or take folds in any order.
    """
    key, registers = cmap.key.column, _registers(cmap)
    renamed = [f"{quoted(c.column)} AS _p{i}" for i, c in enumerate(registers)]
    renamed += [f"{CLEARED} AS _c", f"{FIELDS} AS _f"] if cmap.extra_props else []
    # Said of both uses below, so that Spark shuffles a fold once for them.
    side = state.where("id IS NOT NULL").selectExpr("id AS _id_new", f"{DELETED} AS _d", f"{LIVE} AS _l", *renamed)

    def merged(joined: DataFrame) -> DataFrame:
        both = joined.selectExpr("*", f"greatest({DELETED}, _d) AS _gone", f"greatest({LIVE}, _l) AS _lives")
        values, positions = [], []
        for i, c in enumerate(registers):
            at, value = quoted(AT + c.column), quoted(c.column)
            newer = f"(_p{i}.seq IS NOT NULL AND ({at} IS NULL OR _p{i}.seq >= {at}))"
            seq = f"if({newer}, _p{i}.seq, {at})"
            # What a delete came after is gone; so are values of unknown position.
            values.append(f"if(_gone IS NULL OR {seq} > _gone, if({newer}, _p{i}.value, {value}), NULL) AS {value}")
            positions.append(f"{seq} AS {at}")
        by_name = dict(zip([c.column for c in registers], values))
        plain = [f"coalesce({quoted(key)}, _id_new) AS {quoted(key)}" if c.column == key else by_name[c.column] for c in cmap.columns]
        if cmap.extra_props:
            none, cleared = f"CAST(map() AS {FIELDS_TYPE})", f"greatest({CLEARED}, _c)"
            later = "if(y.seq IS NOT NULL AND (x.seq IS NULL OR y.seq >= x.seq), y, x)"
            fields = f"map_zip_with(coalesce({FIELDS}, {none}), coalesce(_f, {none}), (k, x, y) -> {later})"
            live = f"(_gone IS NULL OR e.seq > _gone) AND ({cleared} IS NULL OR e.seq >= {cleared})"
            plain.append(f"if(_gone IS NULL AND {cleared} IS NULL, {EXTRA_COLUMN}, NULL) AS {EXTRA_COLUMN}")
            positions += [f"{cleared} AS {CLEARED}", f"if({FIELDS} IS NULL AND _f IS NULL, NULL, map_filter({fields}, (k, e) -> {live})) AS {FIELDS}"]
        return both.selectExpr(*plain, f"_gone AS {DELETED}", f"_lives AS {LIVE}", *positions)

    matches = ref(key) == F.col("_id_new")
    if not small:
        return merged(stored.join(side, matches, "full_outer"))
    changed = merged(stored.join(F.broadcast(side), matches, "left"))
    ids = state.select(F.col("id").alias("_new"))
    known = stored.select(ref(key).alias("_known")).join(F.broadcast(ids), F.col("_known") == F.col("_new"), "left_semi")
    fresh = side.join(known, F.col("_id_new") == F.col("_known"), "left_anti")
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in state_schema(cmap).fields]
    return changed.unionByName(merged(fresh.select("*", *nothing)))


def apply_fold(base: DataFrame, state: DataFrame, cmap: CollectionMap, small: bool = False) -> DataFrame:
    """Current rows + fold -> new rows.

    Normally one full outer join on the key.  With ``small=True`` (the caller
    has checked the fold's size) the base is neither shuffled nor sorted: the
    fold is broadcast to it, and the ids it lacks are found by a second pass
    over its key column alone.
    """
    key = cmap.key.column
    registers = _registers(cmap)
    renamed = [f"{quoted(c.column)} AS _p{i}" for i, c in enumerate(registers)]
    state_side = state.selectExpr("id AS _id_new", DELETED, LIVE, *renamed, *_fold_columns(cmap))
    merged_columns = [f"coalesce({quoted(key)}, _id_new) AS {quoted(key)}"] + [
        f"CASE WHEN {_counts(f'_p{i}')} THEN _p{i}.value WHEN {DELETED} IS NULL THEN {quoted(c.column)} END AS {quoted(c.column)}"
        for i, c in enumerate(registers)
    ]
    if cmap.extra_props:
        merged_columns.append(f"{_leftovers(EXTRA_COLUMN)} AS {EXTRA_COLUMN}")

    def merged(joined: DataFrame) -> DataFrame:
        return joined.where(f"_id_new IS NULL OR {_ALIVE}").selectExpr(*merged_columns)

    base = base.selectExpr(quoted(key), *[quoted(c.column) for c in registers], *([EXTRA_COLUMN] if cmap.extra_props else []))
    matches = ref(key) == F.col("_id_new")
    if not small:
        return merged(base.join(state_side, matches, "full_outer"))

    changed = merged(base.join(F.broadcast(state_side), matches, "left"))
    ids = state.select(F.col("id").alias("_new"))
    known = base.select(ref(key).alias("_known")).join(F.broadcast(ids), F.col("_known") == F.col("_new"), "left_semi")
    fresh = state.join(known, F.col("id") == F.col("_known"), "left_anti")
    return changed.unionByName(rows_of_fold(fresh, cmap))


def apply_changes(base: DataFrame, changes: DataFrame, cmap: CollectionMap, small: bool = False) -> DataFrame:
    """Fold normalised changes into current rows: the whole update in one plan."""
    return apply_fold(base, fold_changes(changes, cmap), cmap, small)


def empty_rows(like: DataFrame, cmap: CollectionMap) -> DataFrame:
    """An empty table for this map."""
    return like.sparkSession.createDataFrame([], cmap.schema())


def merge_updates(changes: DataFrame, cmap: CollectionMap) -> DataFrame:
    """Several updates of one id -> one: values, touched flags, ``merged``.

    ``merged`` tells that more than one update went in.
    """
    updates = changes.where(F.col("op").isin(UPDATE, REPLACE))
    out = ["id"]
    for c in _registers(cmap):
        p = quoted(c.column)
        out += [f"{p}.value AS {p}", f"{p}.seq IS NOT NULL AS {quoted('touched_' + c.column)}"]
    if cmap.extra_props:
        out += [f"{_leftovers('CAST(NULL AS VARIANT)')} AS {EXTRA_COLUMN}", f"{CLEARED} IS NOT NULL OR {FIELDS} IS NOT NULL AS touched_{EXTRA_COLUMN}"]
    return fold_changes(updates, cmap).selectExpr(*out, f"{CHANGES} > 1 AS merged")


def change_errors(changes: DataFrame, cmap: CollectionMap) -> DataFrame:
    """One row per changed value that did not fit: ``(location, message, ts)``."""
    rows = touch(changes, cmap, with_failures=True)
    return rows.select("id", "seq", F.explode_outer(FAILED).alias("_field")).where("_field IS NOT NULL").select(
        F.lit(cmap.relation).alias("location"),
        F.concat_ws(": ", F.lit("value does not fit"), F.col("_field"), F.col("id")).alias("message"),
        F.unix_timestamp().cast("int").alias("ts"),
    )


# Positions per range at the first level of run detection, and ranges of the level
# below per range above it, as powers of two: no window ever holds more than about
# two million rows, whatever the size of the feed.
RUN_LEVELS: tuple[int | None, ...] = (20, 40, None)

_RUN_OF = ["db_name", "coll_name"]
_EDGE = "(_head OR _tail)"


def single_runs(changes: DataFrame) -> DataFrame:
    """Every change as a run of its own, open at both ends."""
    return changes.select(
        *_RUN_OF, "op", F.col("seq").alias("first_seq"), F.col("seq").alias("last_seq"),
        F.lit(1).cast("long").alias("n_changes"), F.lit(True).alias("_head"), F.lit(True).alias("_tail"),
    )


def join_runs(runs: DataFrame, bits: int | None) -> DataFrame:
    """Runs joined up with their neighbours within ranges of 2^bits positions (none: anywhere).

    A range is summed up by its runs, of which only the first (``_head``) and the last
    (``_tail``) can go on in another range.  That is associative: ranges may be joined
    to larger ranges, from their first and last runs alone.  Two runs meet only where
    the left one ends its range and the right one begins the next.
    """
    chunk = F.lit(0).cast("long") if bits is None else F.shiftright("first_seq", bits)
    ranged = runs.withColumn("_chunk", chunk)
    group = [*_RUN_OF, "_chunk"]
    w = Window.partitionBy(*group).orderBy("first_seq")
    meets = (F.lag("op").over(w) == F.col("op")) & F.lag("_tail").over(w) & F.col("_head")
    return (
        ranged.withColumn("_starts", ~F.coalesce(meets, F.lit(False)))
        .withColumn("_first", F.col("_head") & F.lag("op").over(w).isNull())
        .withColumn("_last", F.col("_tail") & F.lead("op").over(w).isNull())
        .withColumn("_run", F.sum(F.col("_starts").cast("int")).over(w))
        .groupBy(*group, "_run", "op")
        .agg(
            F.min("first_seq").alias("first_seq"), F.max("last_seq").alias("last_seq"), F.sum("n_changes").alias("n_changes"),
            F.max("_first").alias("_head"), F.max("_last").alias("_tail"),
        )
        .drop("_chunk", "_run")
    )


def operation_runs(changes: DataFrame, levels: tuple[int | None, ...] = RUN_LEVELS) -> DataFrame:
    """Runs of consecutive equal operations per collection, in feed order.

    Gives ``(db_name, coll_name, op, first_seq, last_seq, n_changes)``.  One
    collection can be the whole feed, so it is never put into one window: a segmented
    scan finds runs within ranges of positions.  Runs inside a range are done and
    leave at once; at most two a range go on to the next level, to be joined up there.
    """
    runs, done = join_runs(single_runs(changes), levels[0]), []
    for bits in levels[1:]:
        done.append(runs.where(~F.expr(_EDGE)))
        runs = join_runs(runs.where(_EDGE), bits)
    return reduce(DataFrame.unionByName, [*done, runs]).select(*_RUN_OF, "op", "first_seq", "last_seq", "n_changes")
