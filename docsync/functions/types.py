"""The five column types, how values vote for them, and which may become which."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# The column types a table may have.
BOOLEAN = "boolean"
DOUBLE = "double precision"
TEXT = "text"
TIMESTAMP = "timestamp"
JSONB = "jsonb"
COLUMN_TYPES = (BOOLEAN, DOUBLE, TEXT, TIMESTAMP, JSONB)

SPARK_TYPES: dict[str, T.DataType] = {
    BOOLEAN: T.BooleanType(),
    DOUBLE: T.DoubleType(),
    TEXT: T.StringType(),
    TIMESTAMP: T.TimestampNTZType(),
    JSONB: T.VariantType(),
}

# Conversions of a column that may be attempted, old -> new.
CONVERTIBLE = {
    BOOLEAN: (DOUBLE, JSONB, TIMESTAMP, TEXT),
    DOUBLE: (BOOLEAN, TIMESTAMP, TEXT),
    JSONB: (DOUBLE, TIMESTAMP, TEXT),
    TIMESTAMP: (BOOLEAN, DOUBLE, JSONB, TEXT),
    TEXT: (BOOLEAN, DOUBLE, JSONB, TIMESTAMP),
}

# Spellings that name one and the same column type.
ALIASES = {
    "bool": BOOLEAN,
    "double": DOUBLE,
    "float": DOUBLE,
    "character": TEXT,
    "character varying": TEXT,
    "array": JSONB,
    "timestamp without time zone": TIMESTAMP,
}


def canonical(column_type: str) -> str:
    """Lower-cased type name with spellings of the same type unified."""
    name = column_type.strip().lower()
    return ALIASES.get(name, name)


def same_type(old: str, new: str) -> bool:
    return canonical(old) == canonical(new)


def convertible(old: str, new: str) -> bool:
    """May a column of type ``old`` be tried as ``new``?"""
    return canonical(new) in CONVERTIBLE.get(canonical(old), ())


def spark_type(column_type: str) -> T.DataType | None:
    """Spark type of a column type; None for types that cannot be filled."""
    return SPARK_TYPES.get(canonical(column_type))


def column_type_of(data_type: T.DataType) -> str:
    """Column type of a Spark column, by the same rule as for single values."""
    if isinstance(data_type, T.BooleanType):
        return BOOLEAN
    if isinstance(data_type, T.NumericType):
        return DOUBLE
    if isinstance(data_type, (T.StringType, T.CharType, T.VarcharType)):
        return TEXT
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return TIMESTAMP
    return JSONB


def canonical_column(column_type: Column) -> Column:
    """``canonical`` as a column expression."""
    name = F.lower(F.trim(column_type))
    out = name
    for alias, target in ALIASES.items():
        out = F.when(name == alias, target).otherwise(out)
    return out


def convertible_column(old: Column, new: Column) -> Column:
    """``convertible`` as a column expression over two type names."""
    a, b = canonical_column(old), canonical_column(new)
    out = F.lit(False)
    for source, targets in CONVERTIBLE.items():
        out = out | ((a == source) & b.isin(*targets))
    return out


def is_numeric_schema(schema: Column) -> Column:
    """True for the ``schema_of_variant`` text of a number."""
    return schema.isin("BIGINT", "DOUBLE", "FLOAT") | schema.startswith("DECIMAL")


def type_of_schema(schema: Column) -> Column:
    """Column type a value votes for; null for a null value (no vote).

    ``schema`` is the text ``schema_of_variant`` gives for the value.
    """
    return (
        F.when(schema.isNull() | (schema == "VOID"), F.lit(None).cast("string"))
        .when(schema == "BOOLEAN", BOOLEAN)
        .when(is_numeric_schema(schema), DOUBLE)
        .when(schema == "STRING", TEXT)
        .when(schema.isin("TIMESTAMP", "TIMESTAMP_NTZ", "DATE"), TIMESTAMP)
        .otherwise(JSONB)
    )


def type_of_value(value: Column) -> Column:
    """Column type a variant value votes for."""
    return type_of_schema(F.schema_of_variant(value))
