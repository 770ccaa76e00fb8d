"""Connected components of a graph of any size, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from docsync.llm.common import written


def _stars(pairs: DataFrame) -> DataFrame:
    """(u, v) with ``m``, the least of u and its neighbours v.

    The minima are written, so that Spark may split a hub's rows in the join.
    """
    least = written(pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "minima")
    return pairs.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """(v, root) of every vertex of ``edges`` (a, b); root is the least of its component.

    Edges to oneself and repeated edges do no harm; no edges give no rows.  Each
    round keeps at most the edges there were; rounds end when nothing changes.
    """
    now = written(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges"
    )
    state = None
    while True:
        check = now.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x"), F.expr("sum(cast(xxhash64(b, a) as decimal(38)))").alias("s")).first()
        if check == state:
            return now.select(F.col("b").alias("v"), F.col("a").alias("root")).union(
                now.select(F.col("a").alias("v"), F.col("a").alias("root")).distinct()
            )
        state = check
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _stars(both).where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        small = _stars(large.select(F.col("b").alias("u"), F.col("a").alias("v")))
        now = written(
            small.where("v <> m").select(F.col("m").alias("a"), F.col("v").alias("b"))
            .union(small.select(F.col("m").alias("a"), F.col("u").alias("b")))
            .distinct(),
            "edges",
        )
