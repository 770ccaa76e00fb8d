"""Mixing sources to target weights by Poisson replication.

Each source has a rate: the bytes it is to contribute over the bytes it has.
A document is repeated Poisson(rate) times; the count is found by inverting the
distribution at a number hashed from the document, so a rerun, another
partitioning or a lost executor gives the same mixture.  A rate above
``MAX_STEP`` is the sum of several draws, for exp(-rate) not to underflow.

Texts cross the network once, in the final shuffle, which deals copies to
partitions by a hashed key and sorts each partition by it.  Where a source's rate
takes more than ``FEW_STEPS`` draws, a document's draws and its copies are first cut
into ranges, about as many as a range is long, and the ranges dealt to tasks.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from docsync.llm.common import id_text, uniform, written

SEED = "mix-1"
#: The largest mean of a single draw.
MAX_STEP = 16.0
#: Counts considered in a single draw; P(more) at mean 16 is below 2**-60.
MAX_COUNT = 80
#: Draws a document up to which its draws and copies are made in one task.
FEW_STEPS = 8
#: Sources up to which their table (some 700 bytes a source) is broadcast; more are joined by shuffle.
BROADCAST_SOURCES = 10_000


def weight_of(source: Column, weights: Mapping[str | None, float] | None) -> Column:
    """The target weight of a source: as named, 0 if not named; 1 each if nothing is."""
    if weights is None:
        return F.lit(1.0)
    out = F.lit(0.0)
    for name, weight in weights.items():
        if not (weight >= 0 and math.isfinite(weight)):
            raise ValueError("weights are finite and not negative")
        out = F.when(source.eqNullSafe(F.lit(name)), F.lit(float(weight))).otherwise(out)
    return out


def rates(docs: DataFrame, weights: Mapping[str | None, float] | None = None, source_column: str = "source", text_column: str = "text") -> DataFrame:
    """(source, bytes, rate) of every source; one row a source.

    Rates keep the corpus at its size: the weighted bytes sum to what there was.
    An empty or null text counts as one byte.
    """
    size = F.greatest(F.coalesce(F.octet_length(F.col(text_column)), F.lit(0)), F.lit(1)).cast("long")
    by_source = (
        docs.select(F.col(source_column).alias("source"), size.alias("size"))
        .groupBy("source")
        .agg(F.sum("size").alias("bytes"))
        .withColumn("weight", weight_of(F.col("source"), weights))
    )
    by_source = written(by_source, "sources")
    total = by_source.agg(F.sum("bytes").alias("bytes"), F.sum("weight").alias("weight")).first()
    if not total.weight:  # no rows, or nothing is wanted
        return by_source.select("source", "bytes", F.lit(0.0).alias("rate"))
    rate = F.lit(float(total.bytes)) * F.col("weight") / F.lit(total.weight) / F.col("bytes").cast("double")
    return by_source.select("source", "bytes", rate.alias("rate"))


def _cumulative(mean: Column) -> Column:
    """P(count <= k) for k = 0 .. MAX_COUNT of a Poisson distribution."""
    step = lambda acc, k: F.struct(
        (acc["p"] * mean / k).alias("p"),
        (acc["sum"] + acc["p"] * mean / k).alias("sum"),
        F.concat(acc["all"], F.array(acc["sum"] + acc["p"] * mean / k)).alias("all"),
    )
    zero = F.exp(-mean)
    start = F.struct(zero.alias("p"), zero.alias("sum"), F.array(zero).alias("all"))
    ks = F.transform(F.sequence(F.lit(1), F.lit(MAX_COUNT)), lambda k: k.cast("double"))
    return F.aggregate(ks, start, step, lambda acc: acc["all"])


def _drawn(seed: str, first: Column, last: Column) -> Column:
    """The sum of a document's draws from number ``first`` to ``last``."""
    return F.aggregate(
        F.sequence(first, last),
        F.lit(0).cast("long"),
        lambda acc, i: acc + F.size(F.filter("cdf", lambda p: p < uniform(seed, i, F.col("key")))),
    )


def _ranges(df: DataFrame, count: str) -> DataFrame:
    """Rows as often as there are ranges of 0 .. ``count`` - 1, each with its ``first``
    and ``last``, dealt by key and range; a range is as long as the count's root."""
    length = F.ceil(F.sqrt(F.col(count)))
    return (
        df.withColumn("length", length)
        .withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1, F.col("length"))))
        .withColumn("last", F.least(F.col("first") + F.col("length"), F.col(count)) - 1)
        .repartition("key", "first")
    )


def _many(rows: DataFrame, sources: DataFrame, seed: str) -> DataFrame:
    """(row, key, copy) of the rows of ``sources``, drawn and repeated in ranges."""
    at = F.col("from").eqNullSafe(F.col("of"))
    keys = rows.select("from", "key").join(sources, at).select("key", "of", "steps", "cdf").dropDuplicates(["key", "of"])
    drawn = _ranges(keys, "steps").select("key", "of", _drawn(seed, F.col("first") + 1, F.col("last") + 1).alias("n"))
    counts = written(drawn.groupBy("key", "of").agg(F.sum("n").alias("n")).where("n > 0").withColumnRenamed("key", "of_key"), "counts")
    counted = rows.join(counts, at & (F.col("key") == F.col("of_key"))).select("row", "key", "n")
    return _ranges(counted, "n").select("row", "key", F.explode(F.sequence("first", "last")).alias("copy"))


def mix(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
    seed: str = SEED,
) -> DataFrame:
    """Every document as often as drawn, in a global shuffle: ``row`` (the
    document, all its columns), ``copy`` (from 0) and ``shuffle_key``.

    A null source is a source; a null id draws as the text ``null``.  Rows of the
    same id draw alike.  A source of weight 0 goes.  No rows give no rows.
    """
    steps = F.greatest(F.ceil(F.col("rate") / MAX_STEP), F.lit(1))
    per_source = (
        rates(docs, weights, source_column, text_column)
        .withColumn("steps", steps.cast("long"))
        .withColumn("cdf", _cumulative(F.col("rate") / F.col("steps")))
        .select(F.col("source").alias("of"), "steps", "cdf")
    )
    per_source = written(per_source, "rates")
    rows = docs.select(F.struct("*").alias("row"), F.col(source_column).alias("from"), id_text(F.col(id_column)).alias("key"))
    many, few = per_source.where(F.col("steps") > FEW_STEPS), per_source.where(F.col("steps") <= FEW_STEPS)
    if per_source.count() <= BROADCAST_SOURCES:
        many, few = F.broadcast(many), F.broadcast(few)
    copies = (
        rows.join(few, F.col("from").eqNullSafe(F.col("of")))
        .withColumn("n", _drawn(seed, F.lit(1).cast("long"), F.col("steps")))
        .where("n > 0")
        .select("row", "key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy"))
    )
    if not many.isEmpty():
        copies = copies.unionByName(_many(rows, many, seed))
    copies = copies.withColumn("shuffle_key", F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), F.col("key"), F.col("copy"))))
    return copies.select("row", "copy", "shuffle_key").repartition("shuffle_key").sortWithinPartitions("shuffle_key")
