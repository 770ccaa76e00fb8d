"""What the searches over vectors share: scaled vectors, samples, centroids, exact scores."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from docsync.llm.common import written

#: Centroids are fitted on about so many rows, chosen by a hash: a documented bound,
#: as they decide only how fast a search is, never its result.
SAMPLE_ROWS = 4096
ROUNDS = 6


@dataclass(frozen=True)
class Vectors:
    """Stored rows (row, id, v, norm, and what else was asked for), ``row`` being unique.

    ``v`` holds integers, as floats or doubles; sums of products of two vectors are
    exact in ``exact``, because none of their partial sums exceeds ``largest`` squared.
    """

    rows: DataFrame
    count: int
    dims: int
    largest: float

    @property
    def exact(self) -> type:
        bound = self.largest**2
        return np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64


def stored(rows: DataFrame, scale: int, vector: str, **columns: Column) -> Vectors:
    """The rows that take part, each component floor(scale * x), in a table of their own.

    Null vectors and such with null or non-finite components take no part.  Shorter
    vectors count as filled up with zeros.  Scores must fit a long: vectors longer
    than 2^31 after scaling are refused.
    """
    scaled = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale).cast("double"))
    good = F.col(vector).isNotNull() & F.forall(
        F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    )
    squares = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)
    taking = rows.where(good).select(scaled.alias("v"), *[c.alias(n) for n, c in columns.items()])
    found = taking.select(F.size("v").alias("dims"), F.sqrt(squares).alias("norm")).agg(
        F.count("*").alias("n"), F.max("dims").alias("dims"), F.min("dims").alias("least"), F.max("norm").alias("norm")
    ).first()
    largest = found.norm or 0.0
    if largest >= 2.0**31:
        raise ValueError("a vector is too long for scores in a long")
    dims = found.dims or 0
    kind = "array<float>" if largest**2 < 2**24 else "array<double>"
    filled = F.col("v") if found.least == dims else F.concat("v", F.array_repeat(F.lit(0.0), dims - F.size("v")))
    table = taking.select(
        F.monotonically_increasing_id().alias("row"), *columns, F.sqrt(squares).alias("norm"), filled.cast(kind).alias("v")
    )
    return Vectors(written(table, "vectors"), found.n, dims, largest)


def sampled(vectors: Vectors, wanted: int = SAMPLE_ROWS) -> np.ndarray:
    """About ``wanted`` vectors, or all if fewer, on the driver."""
    share = F.pmod(F.xxhash64("row"), F.lit(1_000_000)) < int(1_000_000 * wanted / max(vectors.count, 1)) + 1
    chosen = vectors.rows if vectors.count <= wanted else vectors.rows.where(share)
    rows = chosen.select("v").limit(2 * wanted).collect()
    return np.array([r.v for r in rows], dtype=np.float64).reshape(len(rows), vectors.dims)


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    squares = (points**2).sum(1)[:, None] + (centres**2).sum(1)[None] - 2 * points @ centres.T
    return np.sqrt(np.maximum(squares, 0))


def centroids(points: np.ndarray, wanted: int, seed: int = 42) -> np.ndarray:
    """At most ``wanted`` centres by Lloyd's rounds over the points given; the first
    ones are drawn by their squared distance to those drawn before."""
    different = np.unique(points, axis=0)
    if len(different) <= wanted:
        return different
    rng = np.random.default_rng(seed)
    chosen = [int(rng.integers(len(different)))]
    apart = np.full(len(different), np.inf)
    while len(chosen) < wanted:
        apart = np.minimum(apart, ((different - different[chosen[-1]]) ** 2).sum(1))
        chosen.append(int(rng.choice(len(different), p=apart / apart.sum())))
    centres = different[chosen]
    for _ in range(ROUNDS):
        own = distances(points, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        n = np.bincount(own, minlength=len(centres))
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def matrix(table: pa.Table | pa.RecordBatch, dims: int, dtype: type = np.float64) -> np.ndarray:
    """Column ``v`` as rows of numbers, without a Python object per row."""
    column = table.column("v")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, dims).astype(dtype, copy=False)


def numbers(table: pa.Table, name: str) -> np.ndarray:
    """An integer column; nulls become the largest long, so they sort last."""
    return table.column(name).combine_chunks().fill_null(2**63 - 1).to_numpy(zero_copy_only=False).astype(np.int64)
