"""Which collections exist, and which of the requested ones can be loaded."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from docsync.sources import files

NAME = "collection_name"
NAME_SCHEMA = f"{NAME} string, position int"


def list_catalog(spark: SparkSession, schema: str | None = None) -> DataFrame:
    """Names of the tables and views of a catalog schema."""
    rows = spark.sql("SHOW TABLES" + (f" IN {schema}" if schema else ""))
    return rows.select(F.col("tableName").alias(NAME)).orderBy(NAME)


def list_folder(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """Names of the collections stored as files or folders under ``path``.

    One listing of that folder, however many files the collections consist of.
    """
    found = [n.removesuffix(suffix) for n in files.names(spark, path) if n.endswith(suffix) and n[0] not in "._"]
    return spark.createDataFrame([(n,) for n in found], f"{NAME} string").orderBy(NAME)


def requested(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """The requested names with their position in the request."""
    return spark.createDataFrame([(n, i) for i, n in enumerate(names)], NAME_SCHEMA)


def present(requested_names: DataFrame, existing: DataFrame) -> DataFrame:
    """Requested collections that exist, in the order of the request."""
    return requested_names.join(existing.select(NAME), NAME, "left_semi").orderBy("position")


def missing(requested_names: DataFrame, existing: DataFrame) -> DataFrame:
    """Requested collections that do not exist."""
    return requested_names.join(existing.select(NAME), NAME, "left_anti").orderBy("position")
