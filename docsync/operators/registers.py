"""Changes as registers: for every field of every document, its last touch.

A register row is told by collection, id and field (``coll_name, id, key``) and holds

* ``seq``, ``value`` - position and raw value of the field's last touch; a null value
  means that the field was taken away
* ``void`` - position of the last insert that held a null for it: for a mapped column that
  is no touch, for leftovers it is one

The row with a null ``key`` tells of the document itself: positions of its last delete
(``_deleted``), of its last other change (``_live``), of its last replace
(``_replaced``), of the last change that told all of it (``_cleared``), and how many
changes, and updates among them, there were.

Registers know nothing of maps.  So one aggregate takes the changes of all collections
together, Spark's own state store can hold it over a stream, and a value is cast once,
after folding, under whatever map is asked for (:func:`to_fold`).  Work grows with the
fields that are there, not with the width of maps.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from docsync.functions.cast import can_fail, variant_cast_sql, variant_failed_sql
from docsync.functions.naming import literal, literals, quoted
from docsync.operators.mapping import CollectionMap, MappedColumn
from docsync.operators.project import cast_fields, cast_values, field_path, has_path
from docsync.sources.feed import DELETE, INSERT, REPLACE, UPDATE

DELETED, LIVE, CHANGES = "_deleted", "_live", "_changes"
CLEARED, FIELDS = "_cleared", "_fields"
REPLACED, UPDATES = "_replaced", "_updates"
# In a fold or registers about to be written: values that did not fit.
FAILURES = "_failures"
FIELDS_TYPE = "MAP<STRING, STRUCT<seq: BIGINT, value: VARIANT>>"

# Maps with more columns than this are folded field by field.
WIDE_MAP = 150

# Up to this many fields asked for, a change is folded as one row, else as a row a field;
# and a document's registers are gathered a column each, else in one variant.
NAMED_FIELDS = 16

BY = ("coll_name", "id", "key")
# Spark sorts by the columns of a grouping in turn, and variants are aggregated in
# sorted rows; names of collections are few, so they come last.
_SORTED_BY = ("id", "key", "coll_name")
_LONGS = ("seq", "void", DELETED, LIVE, REPLACED, CLEARED, CHANGES, UPDATES)
SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in BY]
    + [T.StructField("seq", T.LongType()), T.StructField("value", T.VariantType())]
    + [T.StructField(n, T.LongType()) for n in _LONGS[1:]]
)


def entries(changes: DataFrame, only: Iterable[str] | None = None) -> DataFrame:
    """Normalised changes -> a row for each change and for each field it names."""
    removed = "coalesce(removed, CAST(array() AS ARRAY<STRING>))"
    wanted = "true" if only is None else f"k IN ({literals(only)})"
    whole = "coalesce(try_cast(fields AS MAP<STRING, VARIANT>), CAST(map() AS MAP<STRING, VARIANT>))"
    present = (
        f"transform(map_entries(map_filter({whole}, (k, v) -> {wanted} AND NOT array_contains({removed}, k))), "
        f"e -> struct(e.key AS key, e.value AS value, op = '{INSERT}' AND is_variant_null(e.value) AS empty))"
    )
    taken = f"transform(filter({removed}, k -> {wanted}), k -> struct(k AS key, CAST(NULL AS VARIANT) AS value, false AS empty))"
    itself = "array(struct(CAST(NULL AS STRING) AS key, CAST(NULL AS VARIANT) AS value, false AS empty))"
    return changes.selectExpr("coll_name", "id", "seq", "op", f"inline(concat({itself}, {present}, {taken}))")


def registers(changes: DataFrame, only: Iterable[str] | None = None) -> DataFrame:
    """Changes -> registers, by one aggregate; of a stream too (in update mode).

    With ``only``, of these fields alone; if they are few, changes are not taken apart
    before the aggregate but documents after it.  Failures that changes were given are
    then summed up beside the document itself.
    """
    only = None if only is None else sorted(set(only))
    if only is not None and len(only) <= NAMED_FIELDS and all(map(has_path, only)) and not changes.isStreaming:
        return _registers_of(changes, only)
    rows = entries(changes, only)
    of_field = F.when(F.col("key").isNotNull() & ~F.col("empty"), F.col("seq"))
    change = F.when(F.col("key").isNull(), F.col("seq"))
    op = F.col("op")
    # The order of a stream's keys is part of its checkpoint.
    return rows.groupBy(*(BY if changes.isStreaming else _SORTED_BY)).agg(
        F.max(of_field).alias("seq"),
        F.max_by("value", of_field).alias("value"),
        F.max(F.when(F.col("empty"), F.col("seq"))).alias("void"),
        F.max(F.when(op == DELETE, change)).alias(DELETED),
        F.max(F.when(op != DELETE, change)).alias(LIVE),
        F.max(F.when(op == REPLACE, change)).alias(REPLACED),
        F.max(F.when(op.isin(INSERT, REPLACE), change)).alias(CLEARED),
        F.count(change).alias(CHANGES),
        F.count(F.when(op.isin(UPDATE, REPLACE), change)).alias(UPDATES),
    ).select(*SCHEMA.names)


def _registers_of(changes: DataFrame, fields: list[str]) -> DataFrame:
    """The same for a few fields: a row for each change, grouped by id.

    Variants are aggregated in sorted rows, so how many rows there are decides.
    """
    counted = [FAILURES] if FAILURES in changes.columns else []
    values = [f"try_variant_get(fields, {literal(field_path(f))}, 'variant') AS _v{i}" for i, f in enumerate(fields)]
    taken = [f"coalesce(array_contains(removed, {literal(f)}), false) AS _r{i}" for i, f in enumerate(fields)]
    empty = [f"coalesce(op = '{INSERT}' AND is_variant_null(_v{i}), false) AS _e{i}" for i in range(len(fields))]
    found = changes.selectExpr("coll_name", "id", "seq", "op", *counted, *values, *taken).selectExpr("*", *empty)
    touches = [x for i in range(len(fields)) for x in (
        f"if(_r{i} OR (_v{i} IS NOT NULL AND NOT _e{i}), seq, NULL) AS _s{i}",
        f"if(_r{i}, NULL, _v{i}) AS _c{i}", f"if(_e{i} AND NOT _r{i}, seq, NULL) AS _n{i}",
    )]
    of_fields = [x for i in range(len(fields)) for x in (f"max(_s{i}) AS _s{i}", f"max_by(_c{i}, _s{i}) AS _c{i}", f"max(_n{i}) AS _n{i}")]
    of_change = [
        f"max(if(op = '{DELETE}', seq, NULL)) AS {DELETED}", f"max(if(op <> '{DELETE}', seq, NULL)) AS {LIVE}",
        f"max(if(op = '{REPLACE}', seq, NULL)) AS {REPLACED}", f"max(if(op IN ('{INSERT}', '{REPLACE}'), seq, NULL)) AS {CLEARED}",
        f"count(seq) AS {CHANGES}", f"count(if(op IN ('{UPDATE}', '{REPLACE}'), seq, NULL)) AS {UPDATES}",
        *[f"sum({c}) AS {c}" for c in counted],
    ]
    rows = found.selectExpr("coll_name", "id", "seq", "op", *counted, *touches).groupBy("id", "coll_name").agg(*[F.expr(x) for x in of_fields + of_change])
    names = [*SCHEMA.names[len(BY) - 1:], *counted]
    of_document = {"seq": "CAST(NULL AS BIGINT)", "key": "CAST(NULL AS STRING)", "value": "CAST(NULL AS VARIANT)", "void": "CAST(NULL AS BIGINT)"}
    none = {n: "CAST(NULL AS BIGINT)" for n in (*_LONGS, *counted)} | {CHANGES: "0L", UPDATES: "0L"}
    told = [{n: n for n in names} | of_document]
    told += [none | {"key": literal(f), "seq": f"_s{i}", "value": f"_c{i}", "void": f"_n{i}"} for i, f in enumerate(fields)]
    structs = [f"struct({', '.join(f'{e[n]} AS {n}' for n in names)})" for e in told]
    split = rows.selectExpr("coll_name", "id", f"inline(array({', '.join(structs)}))")
    return split.where("key IS NULL OR seq IS NOT NULL OR void IS NOT NULL").select(*SCHEMA.names, *counted)


def latest(states: DataFrame) -> DataFrame:
    """Rows that one state gave out over time -> each register as it is now.

    Positions only rise, and a state's rows hold all that went before, so the order
    of the rows does not matter and repeated ones do no harm.
    """
    return states.groupBy(*_SORTED_BY).agg(
        F.max("seq").alias("seq"), F.max_by("value", "seq").alias("value"), *[F.max(c).alias(c) for c in _LONGS[1:]]
    ).select(*SCHEMA.names)


def combined(parts: DataFrame, by: tuple[str, ...] = BY) -> DataFrame:
    """Registers of different changes -> one of each."""
    counted = (CHANGES, UPDATES)
    return parts.groupBy(*[c for c in _SORTED_BY if c in by]).agg(
        F.max("seq").alias("seq"), F.max_by("value", "seq").alias("value"),
        *[(F.sum if c in counted else F.max)(c).alias(c) for c in _LONGS[1:]],
    ).select(*by, *SCHEMA.names[len(BY):])


# The last touch of a leftover field: a null that an insert held is one.
_REST = "struct(greatest(seq, void) AS seq, if(coalesce(void > seq, void IS NOT NULL), parse_json('null'), value) AS value)"


def to_fold(
    registers: DataFrame,
    cmap: CollectionMap,
    by: tuple[str, ...] = ("id",),
    since: dict[str, int] | None = None,
    cast: Callable[[MappedColumn, str, str, str], Column | None] | None = None,
) -> DataFrame:
    """Registers of one collection -> fold, one row per id (see ``fold.py``).

    With ``by`` of ``("coll_name", "id")``, of several collections of one map.
    ``since`` gives for fields the position from which on touches of them count.
    ``cast`` makes, from a mapped column and the names of its raw value, of that value's
    type text and of its position, the column's value; none where the map's type says it.
    """
    columns = list(cmap.value_columns)
    if len(columns) > WIDE_MAP and not since and not any(cast(c, "v", "t", "q") is not None for c in columns if cast):
        return _to_wide_fold(registers, cmap, by)
    few = len(columns) <= NAMED_FIELDS
    mapped = f"key IN ({literals(c.source for c in columns)})" if columns else "false"
    known = f"key IN ({literals(c.source for c in cmap.columns)})" if cmap.columns else "false"
    # An entry per field of the map.
    gather = f"to_variant_object(map_from_entries(collect_list(if({mapped} AND seq IS NOT NULL, struct(key, {{0}}), NULL))))"
    sums = [
        f"max({DELETED}) AS {DELETED}", f"max({LIVE}) AS {LIVE}", f"max({REPLACED}) AS {REPLACED}", f"max({CLEARED}) AS {CLEARED}",
        f"sum({CHANGES}) AS {CHANGES}",
    ]
    if few:
        at = [f"if(key = {literal(c.source)}, seq, NULL)" for c in columns]
        sums += [x for i, s in enumerate(at) for x in (f"max({s}) AS _q{i}", f"max_by(value, {s}) AS _f{i}")]
    else:
        sums += [f"{gather.format('value')} AS fields", f"{gather.format('seq')} AS seqs"]
    if cmap.extra_props:
        # And one per field of the id's documents.
        sums.append(f"map_from_entries(collect_list(if(key IS NULL OR {known}, NULL, struct(key, {_REST})))) AS _rest")
    rows = registers.groupBy(*by).agg(*[F.expr(s) for s in sums])
    if few:
        # A field taken away was touched, and reads as null.
        values = [f"if(_q{i} IS NULL, NULL, coalesce(_f{i}, parse_json('null'))) AS _v{i}" for i in range(len(columns))]
        ready = cast_values(rows.selectExpr("*", *values), columns)
    else:
        seqs = [f"try_variant_get(seqs, {literal(field_path(c.source))}, 'bigint') AS _q{i}" for i, c in enumerate(columns)]
        ready = cast_fields(rows, columns, "fields").selectExpr("*", *seqs)
    if cast:
        made = {f"_x{i}": cast(c, f"_v{i}", f"_t{i}", f"_q{i}") for i, c in enumerate(columns)}
        ready = ready.withColumns({n: e for n, e in made.items() if e is not None})
    since = since or {}
    parts, unfit = [], []
    for i, c in enumerate(columns):
        q, replaced = f"_q{i}", REPLACED
        if since.get(c.source) is not None:
            q, replaced = (f"if({x} >= {since[c.source]}, {x}, NULL)" for x in (q, replaced))
        parts.append(
            f"struct(greatest({q}, {replaced}) AS seq, if({q} >= coalesce({replaced}, {q}), _x{i}, NULL) AS value) AS {quoted(c.column)}"
        )
        if can_fail(c.type):
            failed = variant_failed_sql(f"_x{i}", f"_t{i}", c.type)
            unfit.append(f"if(_q{i} IS NULL, NULL, struct({literal(c.source)} AS key, struct(_q{i} AS seq, if({failed}, _v{i}, NULL) AS value) AS value))")
    if not cmap.extra_props:
        return ready.selectExpr(*by, DELETED, LIVE, CHANGES, *parts)
    misfits = f"map_from_entries(array_compact(array({', '.join(unfit)})))" if unfit else f"CAST(map() AS {FIELDS_TYPE})"
    kept = f"map_concat(_rest, {misfits})"
    return ready.selectExpr(*by, DELETED, LIVE, CHANGES, *parts, CLEARED, f"{kept} AS {FIELDS}").selectExpr(
        *by, DELETED, LIVE, CHANGES, *[quoted(c.column) for c in columns], CLEARED, f"if(size({FIELDS}) = 0, NULL, {FIELDS}) AS {FIELDS}"
    )


def _to_wide_fold(registers: DataFrame, cmap: CollectionMap, by: tuple[str, ...]) -> DataFrame:
    """The same for a map of many columns, of which a document has few.

    Each register is cast by itself, before its document's are gathered, so that casts
    are as many as fields that are there.  The gathered values are found by the number
    of their column, one short map for each type.
    """
    columns, types = list(cmap.value_columns), sorted({c.type for c in cmap.value_columns})
    fields = [(c.source, i, types.index(c.type), can_fail(c.type)) for i, c in enumerate(columns)]
    fields += [(c.source, None, None, False) for c in cmap.columns if c.source not in {f[0] for f in fields}]
    known = F.broadcast(registers.sparkSession.createDataFrame(fields, "_source string, _i int, _type int, _can_fail boolean"))
    spark_types = {c.type: c.spark_type.simpleString() for c in columns}
    named = registers.join(known, F.col("key") == F.col("_source"), "left").selectExpr("*", "if(_i IS NULL, NULL, schema_of_variant(value)) AS _t")
    ready = named.selectExpr(
        "*", *[f"CAST(if(_type = {k}, {variant_cast_sql('value', '_t', t)}, NULL) AS {spark_types[t]}) AS _x{k}" for k, t in enumerate(types)]
    )
    sums = [
        f"max({DELETED}) AS {DELETED}", f"max({LIVE}) AS {LIVE}", f"max({REPLACED}) AS {REPLACED}", f"max({CLEARED}) AS {CLEARED}",
        f"sum({CHANGES}) AS {CHANGES}",
        *[f"map_from_entries(collect_list(if(_type = {k} AND seq IS NOT NULL, struct(_i, struct(seq, _x{k} AS value)), NULL))) AS _m{k}" for k in range(len(types))],
    ]
    if cmap.extra_props:
        unfit = " OR ".join(f"(_type = {k} AND {variant_failed_sql(f'_x{k}', '_t', t)})" for k, t in enumerate(types))
        misfit = f"if(_can_fail AND seq IS NOT NULL, struct(key, struct(seq, if({unfit}, value, NULL) AS value)), NULL)"
        sums.append(f"map_from_entries(collect_list(if(key IS NULL, NULL, if(_source IS NULL, struct(key, {_REST}), {misfit})))) AS {FIELDS}")
    rows = ready.groupBy(*by).agg(*[F.expr(s) for s in sums])
    found = rows.selectExpr("*", *[f"try_element_at(_m{types.index(c.type)}, {i}) AS _e{i}" for i, c in enumerate(columns)])
    parts = [
        f"struct(greatest(_e{i}.seq, {REPLACED}) AS seq, if(_e{i}.seq >= coalesce({REPLACED}, _e{i}.seq), _e{i}.value, NULL) AS value) AS {quoted(c.column)}"
        for i, c in enumerate(columns)
    ]
    hidden = [CLEARED, f"if(size({FIELDS}) = 0, NULL, {FIELDS}) AS {FIELDS}"] if cmap.extra_props else []
    return found.selectExpr(*by, DELETED, LIVE, CHANGES, *parts, *hidden)
