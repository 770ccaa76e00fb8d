"""Casting one document value to a column type, with an explicit failure flag.

Values arrive either as VARIANT (schemaless documents, type known per row) or
as ordinary Spark columns (typed collections, type known when planning).  Both
forms follow the same rules; nothing here can fail a job, even under ANSI mode.

The rules for VARIANT are written as SQL text: a map may have hundreds of
columns, and one text per column is built far faster than dozens of calls.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F, types as T

from docsync.functions import types as ct

# Fixed value: texts accepted as a number, with surrounding blanks allowed.
NUMBER = (
    r"^\s*[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?"
    r"|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])\s*$"
)


@dataclass(frozen=True)
class Cast:
    """The cast value and whether a value was present but did not fit."""

    value: Column
    failed: Column
    can_fail: bool = True


def number_of_text(text: Column) -> Column:
    """Double of a numeric text, else null.

    The pattern keeps out spellings only Spark accepts, such as ``1.0d``.
    """
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))


def _python_bool(flag: Column) -> Column:
    return F.when(flag, "True").when(~flag, "False")


def variant_cast_sql(value: str, schema: str, column_type: str) -> str:
    """SQL text casting the VARIANT column ``value``.

    ``schema`` names the column with its ``schema_of_variant`` text, computed
    in an earlier projection so that it is worked out once per value.
    """
    kind = ct.canonical(column_type)

    def get(t: str) -> str:
        return f"try_variant_get({value}, '$', '{t}')"

    numeric = f"({schema} IN ('BIGINT', 'DOUBLE', 'FLOAT') OR {schema} LIKE 'DECIMAL%')"
    text = get("string")
    if kind == ct.TEXT:
        return f"CASE WHEN {schema} = 'BOOLEAN' THEN if({get('boolean')}, 'True', 'False') ELSE {text} END"
    if kind == ct.DOUBLE:
        return (
            f"CASE WHEN {numeric} THEN {get('double')} "
            f"WHEN {schema} = 'STRING' AND {text} RLIKE r'{NUMBER}' THEN try_cast(trim({text}) AS DOUBLE) END"
        )
    if kind == ct.TIMESTAMP:
        return (
            f"CASE WHEN {schema} = 'STRING' THEN try_cast({text} AS TIMESTAMP_NTZ) "
            f"WHEN {schema} IN ('TIMESTAMP', 'TIMESTAMP_NTZ', 'DATE') THEN {get('timestamp_ntz')} END"
        )
    if kind == ct.BOOLEAN:
        return (
            f"CASE WHEN {schema} = 'BOOLEAN' THEN {get('boolean')} WHEN {numeric} THEN {get('double')} <> 0 "
            f"WHEN {schema} = 'STRING' THEN {text} <> '' WHEN {schema} = 'OBJECT<>' THEN false "
            f"WHEN {schema} = 'ARRAY<VOID>' THEN to_json({value}) <> '[]' WHEN {schema} <> 'VOID' THEN true END"
        )
    if kind == ct.JSONB:
        nan = f"{schema} IN ('DOUBLE', 'FLOAT') AND isnan({get('double')})"
        return f"CASE WHEN {schema} <> 'VOID' AND NOT ({nan}) THEN {value} END"
    return "CAST(NULL AS STRING)"


def can_fail(column_type: str) -> bool:
    """Is there any value this type cannot take?"""
    return ct.canonical(column_type) not in (ct.TEXT, ct.BOOLEAN, ct.JSONB)


def variant_failed_sql(result: str, schema: str, column_type: str) -> str:
    """Was there a value that could not be made a ``result`` of?"""
    return f"(coalesce({schema} <> 'VOID', false) AND {result} IS NULL)" if can_fail(column_type) else "false"


def _holds_doubles(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.StructType):
        return any(_holds_doubles(f.dataType) for f in data_type.fields)
    if isinstance(data_type, T.ArrayType):
        return _holds_doubles(data_type.elementType)
    if isinstance(data_type, T.MapType):
        return _holds_doubles(data_type.valueType)
    return isinstance(data_type, (T.DoubleType, T.FloatType))


def without_nan(value: Column, data_type: T.DataType) -> Column:
    """The value with null for every NaN, however deep in arrays, maps and structs.

    Made by recursion over the type; parts that hold no doubles are left as they are.
    """
    if not _holds_doubles(data_type):
        return value
    if isinstance(data_type, T.StructType):
        fields = [without_nan(value.getField(f.name), f.dataType).alias(f.name) for f in data_type.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(data_type, T.ArrayType):
        return F.transform(value, lambda x: without_nan(x, data_type.elementType))
    if isinstance(data_type, T.MapType):
        return F.transform_values(value, lambda k, v: without_nan(v, data_type.valueType))
    return F.when(~F.isnan(value), value)


def cast_typed(value: Column, data_type: T.DataType, column_type: str) -> Cast:
    """Cast an ordinary column whose type is known when planning.

    A VARIANT is not one; its rules are in ``variant_cast_sql``.
    """
    kind = ct.canonical(column_type)
    never = F.lit(False)
    target = ct.spark_type(kind)

    if target is None or isinstance(data_type, T.NullType):
        out = F.lit(None).cast(target or T.StringType())
        return Cast(out, value.isNotNull())

    is_bool = isinstance(data_type, T.BooleanType)
    is_number = isinstance(data_type, T.NumericType)
    is_text = isinstance(data_type, T.StringType)
    is_time = isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType))
    is_nested = isinstance(data_type, (T.StructType, T.ArrayType, T.MapType))

    if kind == ct.TEXT:
        if is_bool:
            return Cast(_python_bool(value), never, False)
        return Cast(F.to_json(value) if is_nested else value.cast("string"), never, False)

    if kind == ct.DOUBLE:
        if is_number:
            return Cast(value.cast("double"), never, False)
        out = number_of_text(value) if is_text else F.lit(None).cast("double")
        return Cast(out, value.isNotNull() & out.isNull())

    if kind == ct.TIMESTAMP:
        if is_time:
            return Cast(value.cast("timestamp_ntz"), never, False)
        out = value.try_cast("timestamp_ntz") if is_text else F.lit(None).cast("timestamp_ntz")
        return Cast(out, value.isNotNull() & out.isNull())

    if kind == ct.BOOLEAN:
        if is_bool:
            return Cast(value, never, False)
        if is_number:
            return Cast(value != 0, never, False)
        if is_text:
            return Cast(value != "", never, False)
        if isinstance(data_type, (T.ArrayType, T.MapType)):
            return Cast(F.when(value.isNotNull(), F.size(value) > 0), never, False)
        return Cast(F.when(value.isNotNull(), F.lit(True)), never, False)

    # jsonb
    if is_nested:
        return Cast(F.to_variant_object(without_nan(value, data_type)), never, False)
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return Cast(F.when(~F.isnan(value), value.cast("variant")), never, False)
    return Cast(value.cast("variant"), never, False)
