from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from docsync.llm import vectors, voronoi

SCHEMA = "vec_id long, embedding array<double>, label int"
CLASHING = ["row", "id", "v", "norm", "cell", "dist", "solver", "chunk", "query_row", "score", "rank"]


def frame(spark, rows, parts: int = 3):
    whole = [(*r, *("x" * len(CLASHING))) for r in rows]
    return spark.createDataFrame(whole, SCHEMA + "".join(f", {c} string" for c in CLASHING)).repartition(parts)


def takes_part(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def scaled(v, scale, dims):
    return [math.floor(x * scale) for x in v] + [0] * (dims - len(v))


def slow(rows, k, scale=1024):
    """Plain search; copies of a row are rows of their own."""
    rows = [r for r in rows if takes_part(r[1])]
    dims = max((len(r[1]) for r in rows), default=0)
    whole = [(r[0], scaled(r[1], scale, dims)) for r in rows]
    out = []
    for i, (q, v) in enumerate(whole):
        if q is None or q % 100:
            continue
        scores = [(-sum(a * b for a, b in zip(v, w)), c is None, c or 0, c) for j, (c, w) in enumerate(whole) if j != i]
        out += [(q, n + 1, c, -s) for n, (s, _, _, c) in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def found(spark, rows, k=10, **options):
    got = voronoi.nearest(frame(spark, rows), F.col("id") % 100 == 0, k, **options)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, got.collect()), key=str)


def clustered(rng, n, clusters=12, dims=6, spread=0.01):
    centres = rng.normal(size=(clusters, dims))
    return [(i, [float(x) for x in centres[rng.integers(clusters)] + spread * rng.normal(size=dims)], 0) for i in range(n)]


ODD = [
    (0, [0.5, -0.25], 1), (0, [0.5, -0.25], 1), (100, [0.5, -0.25], 1), (100, [0.1, 0.2], 1), (1, [0.5, -0.25], 1), (2, None, 1), (200, None, 1),
    (3, [None, 1.0], 1), (300, [float("nan"), 1.0], 1), (4, [float("inf"), 0.0], 1), (None, [0.5, -0.25], 1), (None, None, None), (5, [], 1), (400, [], 1),
    (6, [1.0], 2), (7, [0.5, -0.25, 3.0], 2), (-100, [0.3, 0.3, -0.1], 2), (8, [0.0, 0.0], 2), (9, [0.0, -0.0], 2),
]


@pytest.mark.parametrize("k", [1, 3, 30])
def test_odd_rows(spark, k):
    assert found(spark, ODD, k) == slow(ODD, k)


def test_clusters_with_small_solvers_and_chunks(spark):
    rows = clustered(np.random.default_rng(1), 900)
    for many in ({}, {"solver_queries": 2, "chunk_rows": 100, "max_pivots": 12}):
        assert found(spark, [(i * 5, v, n) for i, v, n in rows], 4, **many) == slow([(i * 5, v, n) for i, v, n in rows], 4)


def test_a_vector_of_a_third_of_the_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [0.25, 0.5, -0.5] if i % 3 == 0 else [float(x) for x in rng.normal(size=3)], 0) for i in range(600)]
    assert found(spark, rows, 7, solver_queries=1, chunk_rows=64) == slow(rows, 7)


@pytest.mark.parametrize("size", [1e-3, 40.0, 5e5])
def test_every_kind_of_number(spark, size):
    rng = np.random.default_rng(3)
    rows = [(i * 20, [float(x) for x in size * rng.normal(size=5)], 0) for i in range(80)]
    assert found(spark, rows, 5) == slow(rows, 5)


def test_too_long(spark):
    with pytest.raises(ValueError, match="too long"):
        found(spark, [(0, [1e300], 0)])


def test_empty(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0], 0)]) == []
    assert found(spark, [(100, [1.0], 0)]) == []


def planned(points, queries, pivots, k):
    """The plan from summaries made by hand."""
    apart = vectors.distances(points, pivots)
    cell = apart.argmin(1)
    norms, dist = np.sqrt((points**2).sum(1)), apart.min(1)
    cells, near = {}, {}
    for c in np.unique(cell).tolist():
        m, q = cell == c, (cell == c) & queries
        cells[c] = {
            "far": dist[m].max(), "norms": (norms[m].min(), norms[m].max()), "radius": dist[q].max() if q.any() else None,
            "query_norms": (norms[q].min(), norms[q].max()) if q.any() else (None, None),
        }
        near[c] = sorted(dist[m])[: k + 1]
    radius, reached, needs = voronoi.bounds(pivots, cells, near, k)
    return cell, norms, voronoi.Plan(pivots, radius, reached, needs, [[0]] * len(pivots))


def test_bounds_are_sure_and_prune_clusters():
    rng = np.random.default_rng(4)
    points = np.floor(1024 * np.array([v for _, v, _ in clustered(rng, 2000, clusters=20, spread=0.002)]))
    queries = np.arange(len(points)) % 10 == 0
    cell, norms, plan = planned(points, queries, vectors.centroids(points, 20), 5)
    sent = 0
    for i in np.nonzero(queries)[0]:
        scores = points @ points[i]
        scores[i] = -np.inf
        want = np.sort(scores)[-5]
        assert want >= plan.reached[cell[i]] - 1e-6
        may = plan.needs[cell[i]][cell] & plan.needed(cell[i], points, norms)
        assert may[scores >= want].all()
        sent += may.sum()
    assert sent < 0.2 * queries.sum() * len(points)


def test_solvers():
    pivots = np.array([[0.0], [1.0], [2.0], [3.0]])
    laid = voronoi.laid_together(pivots, {0: 3, 1: 3, 2: 25, 3: 1}, 10)
    assert laid[0] == laid[1] and len(laid[2]) == 3 and len(laid[3]) == 1
    assert not set(laid[2]) & {*laid[0], *laid[3]}


def test_best_breaks_ties_by_column():
    rng = np.random.default_rng(5)
    scores = rng.integers(0, 4, size=(20, 30)).astype(np.float32)
    row, column = voronoi.best(scores, 5)
    for i in range(20):
        assert column[row == i].tolist() == np.lexsort((np.arange(30), -scores[i]))[:5].tolist()
