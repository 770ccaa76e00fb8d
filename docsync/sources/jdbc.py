"""Handing tables to a database through Spark's JDBC writer.

The driver jar and the address come from the user; nothing is bundled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from docsync.functions.naming import ref


def plain_columns(df: DataFrame) -> DataFrame:
    """VARIANT columns as JSON text, which a ``jsonb`` column takes."""
    return df.select(
        *[F.to_json(ref(f.name)).alias(f.name) if isinstance(f.dataType, T.VariantType) else ref(f.name) for f in df.schema.fields]
    )


def write_table(df: DataFrame, url: str, table: str, mode: str = "append", batch: int = 10_000, **options: str) -> None:
    """Write rows in parallel, one connection per partition."""
    plain_columns(df).write.format("jdbc").mode(mode).options(url=url, dbtable=table, batchsize=batch, **options).save()


def read_table(
    spark: SparkSession, url: str, table: str, split: tuple[str, int, int, int] | None = None, **options: str
) -> DataFrame:
    """Read a table; ``split`` is a numeric column, its range and the number of
    parallel readers, without which one task reads everything."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if split:
        column, low, high, parts = split
        reader = reader.options(partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=parts)
    return reader.load()
