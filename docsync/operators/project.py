"""Documents -> typed rows, with leftovers and failures kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from docsync.functions.cast import can_fail, cast_typed, variant_cast_sql, variant_failed_sql
from docsync.functions.naming import EXTRA_COLUMN, literal, literals, quoted, ref
from docsync.operators.mapping import CollectionMap, MappedColumn
from docsync.sources.documents import DOC, is_document_frame

FAILED = "_failed"


def field_path(source: str) -> str:
    """Path of one top-level field, whatever characters its name holds."""
    return f"$['{source}']" if '"' in source else f'$["{source}"]'


def has_path(source: str) -> bool:
    """Can a path tell this field?"""
    return source != "" and not ("'" in source and '"' in source)


def cast_fields(df: DataFrame, columns: list[MappedColumn], doc: str = DOC) -> DataFrame:
    """``df`` with, for each column ``i``, its field ``_v<i>``, the field's type
    text ``_t<i>`` and the cast value ``_x<i>``.

    They are projected one after the other and used by name after, so each is
    worked out once however many branches look at it.
    """
    values = [f"try_variant_get({doc}, {literal(field_path(c.source))}, 'variant') AS _v{i}" for i, c in enumerate(columns)]
    return cast_values(df.selectExpr("*", *values), columns)


def cast_values(df: DataFrame, columns: list[MappedColumn]) -> DataFrame:
    """The same where the fields ``_v<i>`` are there already."""
    schemas = [f"schema_of_variant(_v{i}) AS _t{i}" for i in range(len(columns))]
    results = [
        f"CAST({variant_cast_sql(f'_v{i}', f'_t{i}', c.type)} AS {c.spark_type.simpleString()}) AS _x{i}"
        for i, c in enumerate(columns)
    ]
    return df.selectExpr("*", *schemas).selectExpr("*", *results)


def failed_sql(columns: list[MappedColumn]) -> str:
    """Names of the fields that held a value which did not fit, as an array."""
    flags = [
        f"if({variant_failed_sql(f'_x{i}', f'_t{i}', c.type)}, {literal(c.source)}, NULL)"
        for i, c in enumerate(columns)
        if can_fail(c.type)
    ]
    return f"array_compact(array({', '.join(flags)}))" if flags else "CAST(array() AS ARRAY<STRING>)"


def leftovers_sql(doc: str, columns: list[MappedColumn], failed: str | None = None) -> str:
    """Fields not in the map plus fields that did not fit, as a map."""
    keep = f"k NOT IN ({literals(c.source for c in columns)})" if columns else "true"
    if failed:
        keep += f" OR array_contains({failed}, k)"
    return f"map_filter(try_cast({doc} AS MAP<STRING, VARIANT>), (k, v) -> {keep})"


def project(docs: DataFrame, cmap: CollectionMap, keep: tuple[str, ...] = (), with_failures: bool = False) -> DataFrame:
    """Typed rows of a collection, in map order, one pass, no shuffle.

    ``keep`` carries further columns along (an ordering column, for instance);
    ``with_failures`` adds the names of fields that did not fit.
    """
    columns = list(cmap.columns)
    if not is_document_frame(docs):
        return _project_typed(docs, cmap, keep, with_failures)
    ready = cast_fields(docs, columns).selectExpr("*", f"{failed_sql(columns)} AS {FAILED}")
    out = [f"_x{i} AS {quoted(c.column)}" for i, c in enumerate(columns)]
    if cmap.extra_props:
        out.append(f"to_variant_object({leftovers_sql(DOC, columns, FAILED)}) AS {EXTRA_COLUMN}")
    out += [quoted(k) for k in keep] + ([FAILED] if with_failures else [])
    return ready.selectExpr(*out)


def _project_typed(docs: DataFrame, cmap: CollectionMap, keep: tuple[str, ...], with_failures: bool) -> DataFrame:
    """The same for a typed collection: only the columns asked for are read."""
    nested = [f.name for f in docs.schema.fields if isinstance(f.dataType, T.VariantType)]
    mixed = [c for c in cmap.columns if c.source in nested]
    ready = docs
    if mixed:
        ready = docs.selectExpr("*", *[f"schema_of_variant({quoted(c.source)}) AS _t{i}" for i, c in enumerate(mixed)]).selectExpr(
            "*", *[f"{variant_cast_sql(quoted(c.source), f'_t{i}', c.type)} AS _x{i}" for i, c in enumerate(mixed)]
        )
    values, flags = [], []
    for c in cmap.columns:
        if c in mixed:
            i = mixed.index(c)
            value, failed, may = F.col(f"_x{i}"), F.expr(variant_failed_sql(f"_x{i}", f"_t{i}", c.type)), can_fail(c.type)
        elif c.source in docs.columns:
            k = cast_typed(ref(c.source), docs.schema[c.source].dataType, c.type)
            value, failed, may = k.value, k.failed, k.can_fail
        else:
            value, failed, may = F.lit(None), F.lit(False), False
        values.append(value.cast(c.spark_type).alias(c.column))
        if may:
            flags.append((c.source, failed))
    out = list(values)
    if cmap.extra_props:
        mapped = [c.source for c in cmap.columns]
        rest = [c for c in docs.columns if c not in mapped and c not in keep]
        unfit = [F.when(failed, ref(source).cast("string")).alias(source) for source, failed in flags]
        if rest or unfit:
            # Unmapped columns stay even when null; a mapped one only if it did not fit.
            whole = F.to_variant_object(F.struct(*[ref(c) for c in rest], *unfit)).cast("map<string,variant>")
            extra = F.map_filter(whole, lambda k, v: k.isin(*rest) | ~F.is_variant_null(v))
        else:
            extra = F.create_map().cast("map<string,variant>")
        out.append(F.to_variant_object(extra).alias(EXTRA_COLUMN))
    out += [ref(k) for k in keep]
    if with_failures:
        names = [F.when(failed, F.lit(source)) for source, failed in flags]
        out.append((F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")).alias(FAILED))
    return ready.select(*out)


def cast_errors(docs: DataFrame, cmap: CollectionMap, ts: Column | None = None) -> DataFrame:
    """One error row per value that did not fit: ``(location, message, ts)``."""
    rows = project(docs, cmap, with_failures=True)
    return (
        rows.select(ref(cmap.key.column).alias("_id"), F.explode_outer(FAILED).alias("_field"))
        .where("_field IS NOT NULL")
        .select(
            F.lit(cmap.relation).alias("location"),
            F.concat_ws(": ", F.lit("value does not fit"), F.col("_field"), F.col("_id").cast("string")).alias("message"),
            (ts if ts is not None else F.unix_timestamp()).cast("int").alias("ts"),
        )
    )


def align(df: DataFrame, cmap: CollectionMap) -> DataFrame:
    """Columns in map order: absent ones null, others left out."""
    return df.selectExpr(
        *[
            quoted(f.name) if f.name in df.columns else f"CAST(NULL AS {f.dataType.simpleString()}) AS {quoted(f.name)}"
            for f in cmap.schema().fields
        ]
    )
