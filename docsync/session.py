"""Session settings the operators count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # The last of several equal keys of one object wins, instead of failing.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Projections of wide maps make generated methods too long for the JVM to
    # compile (8000 bytes of bytecode); past that Spark is to fall back to
    # split projections, which it does compile.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a running session; those set there already stay."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) in (None, "65535"):
            spark.conf.set(key, value)
    return spark
