"""Exact nearest vectors by a Voronoi join.

Queries and candidates are grouped by the nearest of a few pivots.  A summary of
each cell (members, radius, norms, its members nearest to the pivot) gives, for each
cell of queries, a score that the k best of any of its queries reach for certain.
A candidate is sent only to the cells of queries where it can reach that score:
first cells are held against cells, then the candidate itself against the cell.
What is left is solved locally, and the local bests are merged.

With p a query cell's pivot, U its radius, r a candidate cell's pivot, s a member at
distance v of r and q a query:  |q.s - p.r| <= |p| v + |r| U + U v,  and
2 q.s = |q|^2 + |s|^2 - |q - s|^2  with  | |q - s| - |p - r| | <= U + v.
A single candidate is bounded by  q.s <= p.s + U |s|.

The pivots come from a bounded sample (``vectors.SAMPLE_ROWS``); they decide how much
is pruned, never the result.  Cells of queries are laid together, neighbours first,
to *solvers* of at most about SOLVER_QUERIES queries; a cell with more is split.
Candidates are dealt by hash to chunks of about CHUNK_ROWS, so a task holds one solver
and one chunk, whatever cell or vector is frequent.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from docsync.llm import vectors
from docsync.llm.common import ship, written
from docsync.llm.vectors import Vectors, matrix, numbers

MAX_PIVOTS = 128
SOLVER_QUERIES = 16384
CHUNK_ROWS = 32768
#: Numbers in one tile of scores.
TILE = 1 << 21

RESULT = "query_id long, rank int, vec_id long, score long"


@dataclass(frozen=True)
class Plan:
    """What each cell of queries needs, from the summaries alone; rows are cells."""

    pivots: np.ndarray
    radius: np.ndarray  # of the queries of a cell; negative where there are none
    reached: np.ndarray  # a score that the k best of each of its queries reach
    needs: np.ndarray  # [query cell, candidate cell]: may a member be needed?
    solvers: list[list[int]]  # of each cell of queries

    def needed(self, cell: int, points: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Which of the points may be among the k best of a query of the cell."""
        return points @ self.pivots[cell] + self.radius[cell] * norms >= self.reached[cell] - slack(self.pivots, norms)


def slack(pivots: np.ndarray, norms: np.ndarray) -> float:
    """More than rounding can take from a bound."""
    largest = max(float(np.abs(pivots).max(initial=0)), float(np.max(norms, initial=0)))
    return 1e-6 * (1 + largest) ** 2 * 1e-3 + 1e-6


def bounds(pivots: np.ndarray, cells: dict[int, dict], near: dict[int, list[float]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(radius, reached, needs) of the cells of queries.

    ``cells`` has for each cell the members' ``far`` and ``norms`` (least, greatest) and
    the queries' ``radius`` and ``query_norms``; ``near`` the k + 1 least distances.
    """
    n = len(pivots)
    lengths = np.sqrt((pivots**2).sum(1))
    apart = vectors.distances(pivots, pivots)
    inner = pivots @ pivots.T
    radius = np.full(n, -1.0)
    reached = np.full(n, -math.inf)
    needs = np.zeros((n, n), dtype=bool)
    for i, own in cells.items():
        if own["radius"] is None:
            continue
        radius[i] = u = own["radius"]
        low, high = own["query_norms"]
        sure: list[float] = []
        for j, other in cells.items():
            for v in near[j]:
                by_inner = inner[i, j] - lengths[i] * v - lengths[j] * u - u * v
                by_distance = (low**2 + other["norms"][0] ** 2 - (apart[i, j] + u + v) ** 2) / 2
                sure.append(max(by_inner, by_distance))
        # The query itself may be one of the members counted, so one more is asked for.
        if len(sure) > k:
            reached[i] = sorted(sure)[-k - 1]
        for j, other in cells.items():
            v = other["far"]
            by_inner = inner[i, j] + lengths[i] * v + lengths[j] * u + u * v
            by_distance = (high**2 + other["norms"][1] ** 2 - max(0.0, apart[i, j] - u - v) ** 2) / 2
            norms = np.array([high, other["norms"][1]])
            needs[i, j] = min(by_inner, by_distance) >= reached[i] - slack(pivots, norms)
    return radius, reached, needs


def laid_together(pivots: np.ndarray, queries: dict[int, int], most: int) -> list[list[int]]:
    """The solvers of each cell: neighbours share one, a cell with many queries has several."""
    out: list[list[int]] = [[] for _ in pivots]
    centre = pivots - pivots.mean(0) if len(pivots) else pivots
    axis = np.linalg.svd(centre, full_matrices=False)[2][0] if centre.size else np.zeros(pivots.shape[1])
    solver, room = 0, most
    for cell in sorted(queries, key=lambda c: (float(centre[c] @ axis), c)):
        n = queries[cell]
        if n > room and room < most:
            solver, room = solver + 1, most
        parts = max(1, math.ceil(n / most))
        out[cell] = list(range(solver, solver + parts))
        if parts > 1:
            solver, room = solver + parts, most
        else:
            room -= n
    return out


def _assigned(stored: Vectors, pivots: np.ndarray) -> DataFrame:
    dims = stored.dims

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = vectors.distances(matrix(batch, dims), pivots)
            cell = apart.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(apart[np.arange(len(cell)), cell])],
                names=[*batch.schema.names, "cell", "dist"],
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stored.rows.schema)
    return stored.rows.mapInArrow(assign, f"{schema}, cell int, dist double")


def best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k greatest of each row; of equal ones the first columns."""
    if scores.shape[1] > k:
        cut = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        row, column = np.nonzero(scores >= cut[:, None])
    else:
        row, column = np.nonzero(np.ones(scores.shape, dtype=bool))
    order = np.lexsort((column, -scores[row, column], row))
    row, column = row[order], column[order]
    first = np.searchsorted(row, row)
    kept = np.arange(len(row)) - first < k
    return row[kept], column[kept]


def _solver(plan: Plan, dims: int, exact: type, k: int):
    def solve(asked: pa.Table, there: pa.Table) -> pa.Table:
        order = np.lexsort((numbers(there, "row"), numbers(there, "id"))) if there.num_rows else np.empty(0, int)
        rows = numbers(there, "row")[order]
        points = matrix(there, dims, exact)[order]
        norms = there.column("norm").to_numpy()[order]
        queries, cells = matrix(asked, dims, exact), asked.column("cell").to_numpy()
        of, taken, scores = [], [], []
        for cell in np.unique(cells):
            mine = np.nonzero(cells == cell)[0]
            needed = np.nonzero(plan.needed(cell, points.astype(np.float64, copy=False), norms))[0]
            if not len(needed):
                continue
            some = points if len(needed) == len(points) else points[needed]
            step = max(1, TILE // len(needed))
            for at in range(0, len(mine), step):
                part = mine[at : at + step]
                score = queries[part] @ some.T
                q, c = best(score, k + 1)  # the query itself may be one
                of.append(part[q])
                taken.append(needed[c])
                scores.append(score[q, c].astype(np.int64))
        if not of:
            return pa.table({"query_row": pa.array([], pa.int64()), "query_id": pa.array([], pa.int64()), "row": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        q, c, s = np.concatenate(of), np.concatenate(taken), np.concatenate(scores)
        others = numbers(asked, "row")[q] != rows[c]
        q, c, s = q[others], c[others], s[others]
        return pa.table(
            {
                "query_row": numbers(asked, "row")[q],
                "query_id": numbers(asked, "id")[q],
                "row": rows[c],
                "vec_id": there.column("id").combine_chunks().take(pa.array(order[c])),
                "score": s,
            }
        )

    return solve


def _planned(cells: DataFrame, is_query: Column, pivots: np.ndarray, k: int, most: int) -> Plan:
    """The summaries (some rows for each of at most MAX_PIVOTS cells) and what follows from them."""
    told = cells.groupBy("cell").agg(
        F.max("dist").alias("far"), F.min("norm").alias("least"), F.max("norm").alias("most"),
        F.max(F.when(is_query, F.col("dist"))).alias("radius"), F.min(F.when(is_query, F.col("norm"))).alias("q_least"),
        F.max(F.when(is_query, F.col("norm"))).alias("q_most"), F.count(F.when(is_query, 1)).alias("queries"),
    )
    summary = {
        r.cell: {"far": r.far, "norms": (r.least, r.most), "radius": r.radius, "query_norms": (r.q_least, r.q_most), "queries": r.queries}
        for r in told.collect()
    }
    nearest = Window.partitionBy("cell").orderBy("dist")
    near: dict[int, list[float]] = {c: [] for c in summary}
    for r in cells.select("cell", "dist", F.row_number().over(nearest).alias("at")).where(F.col("at") <= k + 1).collect():
        near[r.cell].append(r.dist)
    radius, reached, needs = bounds(pivots, summary, near, k)
    solvers = laid_together(pivots, {c: s["queries"] for c, s in summary.items() if s["queries"]}, most)
    return Plan(pivots, radius, reached, needs, solvers)


def _sent(cells: DataFrame, plan: Plan, dims: int) -> DataFrame:
    """Each candidate once for every solver that may need it (column ``solver``)."""
    asking = [i for i, s in enumerate(plan.solvers) if s]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, norms, cell = matrix(batch, dims), batch.column("norm").to_numpy(), batch.column("cell").to_numpy()
            wanted: dict[int, np.ndarray] = {}
            for i in asking:
                may = plan.needs[i][cell]
                if may.any():
                    may &= plan.needed(i, points, norms)
                    for solver in plan.solvers[i]:
                        wanted[solver] = wanted[solver] | may if solver in wanted else may
            for solver, may in wanted.items():
                part = batch.filter(pa.array(may))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(np.full(part.num_rows, solver, np.int32))], names=[*part.schema.names, "solver"]
                )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cells.schema)
    return cells.mapInArrow(send, f"{schema}, solver int")


def nearest(
    rows: DataFrame,
    is_query: Column,
    k: int = 10,
    scale: int = 1024,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    max_pivots: int = MAX_PIVOTS,
    solver_queries: int = SOLVER_QUERIES,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` best, every row but its own being one.

    ``is_query`` is a condition on column ``id``; a null says no.  Scores are integer
    inner products of the scaled vectors; ties go to the smaller id, null ids last.
    Rows that take no part: see ``vectors.stored``.  A repeated row is a query and a
    candidate of its own, so it finds its copies.  No rows give no rows.
    """
    spark = rows.sparkSession
    ship(spark)
    stored = vectors.stored(rows, scale, vector_column, id=F.col(id_column).cast("long"))
    if not stored.count:
        return spark.createDataFrame([], RESULT)
    pivots = vectors.centroids(vectors.sampled(stored), min(max_pivots, math.ceil(math.sqrt(stored.count) / 4)))
    cells = written(_assigned(stored, pivots), "cells")
    asked = F.coalesce(is_query, F.lit(False))
    plan = _planned(cells, asked, pivots, k, solver_queries)
    if not any(plan.solvers):
        return spark.createDataFrame([], RESULT)

    chunks = max(1, math.ceil(stored.count / chunk_rows))
    mixed = F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("int").alias("chunk")
    there = _sent(cells, plan, stored.dims).select("solver", mixed, "row", "id", "norm", "v")
    solvers = F.array(*[F.array(*[F.lit(x) for x in s]).cast("array<int>") for s in plan.solvers])
    own = F.element_at(solvers, F.col("cell") + 1)
    queries = cells.where(asked).select(
        F.element_at(own, (F.pmod(F.xxhash64("row"), F.size(own)) + 1).cast("int")).alias("solver"),
        F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"),
        "row", "id", "cell", "v",
    )
    local = queries.groupBy("solver", "chunk").cogroup(there.groupBy("solver", "chunk")).applyInArrow(
        _solver(plan, stored.dims, stored.exact, k), "query_row long, query_id long, row long, vec_id long, score long"
    )
    ranked = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return (
        local.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
