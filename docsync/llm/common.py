"""What the operators of this package share: tables, shared folders, hashed draws."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or
    the warehouse where that is not set (as in tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return root.rstrip("/")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A name no other run uses, below one folder per application."""
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/docsync-llm/{app}/{purpose}-{uuid.uuid4().hex}"


_shipped: set[str] = set()
_BATCH_BYTES, _SPARKS_OWN = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors' Python, once per application.

    The archive is made in the driver's own temporary folder; Spark distributes it.
    Batches are made smaller than Spark makes them, unless the session says otherwise:
    a worker holds a batch, its strings and what is worked out of them at once.
    """
    sc = spark.sparkContext
    if spark.conf.get(_BATCH_BYTES) == _SPARKS_OWN:
        spark.conf.set(_BATCH_BYTES, "16777216b")
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="docsync-"), "docsync_package")
    root, name = os.path.split(package)
    sc.addPyFile(shutil.make_archive(archive, "zip", root, name))
    _shipped.add(sc.applicationId)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage is cut, and executors may go."""
    spark = df.sparkSession
    folder = shared_folder(spark, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def uniform(*parts: Column | str) -> Column:
    """A number in (0, 1) drawn from the parts by MD5: 52 bits, so exact as double."""
    text = F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**52))


def id_text(column: Column) -> Column:
    """An id as text; a null id counts as the text ``null``."""
    return F.coalesce(column.cast("string"), F.lit("null"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once a row.

    A column used inside a lambda is put in its place by the optimizer, and then worked
    out for every element; a lambda's own variable is not.
    """
    return F.get(F.transform(F.array(value), body), 0)


def running(values: Column, most: bool = False) -> Column:
    """The running sums (with ``most``, maxima) of an array of longs.

    Spark has no such function, and gathering them one after the other copies all of
    them for each.  Here blocks of about the root of the length are gathered so, then
    the blocks' last values, and these are added: n^1.5 copies of a long in all.
    """
    none, nothing = F.array().cast("array<bigint>"), F.lit(-(2**63) if most else 0).cast("long")

    def both(a: Column, b: Column) -> Column:
        return F.greatest(a, b) if most else a + b

    def gathered(block: Column) -> Column:
        start = F.struct(nothing.alias("last"), none.alias("all"))
        step = lambda acc, x: F.struct(both(acc["last"], x).alias("last"), F.concat(acc["all"], F.array(both(acc["last"], x))).alias("all"))
        return F.aggregate(block, start, step, lambda acc: acc["all"])

    def placed(blocks: Column) -> Column:
        ends = gathered(F.transform(blocks, lambda b: F.element_at(b, -1)))
        before = let(ends, lambda e: F.concat(F.array(nothing), F.slice(e, F.lit(1), F.size(e) - 1)))
        return F.flatten(F.zip_with(blocks, before, lambda b, o: F.transform(b, lambda x: both(x, o))))

    def of(v: Column) -> Column:
        length = F.ceil(F.sqrt(F.size(v))).cast("int")
        cut = let(length, lambda n: F.transform(F.sequence(F.lit(1), F.size(v), n), lambda i: gathered(F.slice(v, i, n))))
        return F.when(F.size(v) == 0, none).otherwise(let(cut, placed))

    return let(values, of)


#: Code points of a large and a small piece of a text.
LARGE, SMALL = 1 << 18, 1 << 11


def pieces_of(text: Column) -> Column:
    """The text cut into pieces of SMALL code points.

    A substring is found by counting from the text's beginning; taken from its piece
    it costs no more than a piece.  Cutting goes by large pieces first, for the same reason.
    """

    def cut(t: Column, step: int) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.length(t) - 1, F.lit(0)), F.lit(step))
        return F.transform(starts, lambda i: F.substr(t, i + 1, F.lit(step)))

    return let(text, lambda t: F.flatten(F.transform(cut(t, LARGE), lambda large: cut(large, SMALL))))


def part_of(pieces: Column, start: Column, length: Column) -> Column:
    """``length`` code points from ``start`` (from 0) of the text that was cut into ``pieces``."""
    inside = lambda c: F.greatest(start - c * SMALL, F.lit(0))
    some = F.transform(
        F.sequence(F.floor(start / SMALL).cast("int"), F.floor((start + length - 1) / SMALL).cast("int")),
        lambda c: F.substr(F.get(pieces, c), inside(c) + 1, F.least(start + length - c * SMALL, F.lit(SMALL)) - inside(c)),
    )
    return F.when(length > 0, F.array_join(some, "")).otherwise("")
