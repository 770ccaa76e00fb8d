from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from docsync.llm import multi_index, vectors
from tests.llm.test_voronoi import ODD, clustered, scaled, takes_part

SCHEMA = "vec_id long, embedding array<double>, label int"
CLASHING = ["row", "id", "v", "norm", "one", "two", "shard", "block", "anchor", "window", "parts", "n"]


def label():
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


def slow(rows, scale=256):
    whole = []
    rows = [r for r in rows if takes_part(r[1]) and r[2] is not None]
    dims = max((len(r[1]) for r in rows), default=0)
    for i, v, label in rows:
        whole.append((i, scaled(v, scale, dims), (label + 1) % 10 if i is not None and i % 7 == 0 else label))
    out = []
    for at, (a, v, label) in enumerate(whole):
        if a is None or a % 100:
            continue
        told = [(-sum(x * y for x, y in zip(v, w)), c is None, c or 0, c, n) for j, (c, w, n) in enumerate(whole) if j != at]
        told.sort(key=lambda t: t[:3])
        for s, _, _, p, _ in [t for t in told if t[4] == label][:5]:
            fit = [t for t in told if t[4] != label and 30 * -s <= 100 * -t[0] <= 90 * -s][:10]
            out += [(a, p, n + 1, t[3], -s, -t[0]) for n, t in enumerate(fit)]
    return sorted(out, key=str)


def found(spark, rows, **options):
    whole = [(*r, *("x" * len(CLASHING))) for r in rows]
    df = spark.createDataFrame(whole, SCHEMA + "".join(f", {c} string" for c in CLASHING)).repartition(3)
    got = multi_index.mine(df, label(), F.col("id") % 100 == 0, **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, got.collect()), key=str)


def test_odd_rows(spark):
    rows = [*ODD, *[(i, v, None) for i, v, _ in ODD], *[(i, v, 4) for i, v, _ in ODD]]
    assert found(spark, rows) == slow(rows)


@pytest.mark.parametrize("options", [{}, {"shard_rows": 50, "anchors_at_once": 3, "codes": 5}])
def test_clusters(spark, options):
    rng = np.random.default_rng(7)
    rows = [(i * 10, [abs(x) for x in v], int(rng.integers(3))) for i, v, _ in clustered(rng, 400, clusters=30, dims=7, spread=0.2)]
    want = slow(rows)
    assert len(want) > 500 and found(spark, rows, **options) == want


def test_a_vector_and_a_label_of_a_third_of_the_rows(spark):
    rng = np.random.default_rng(8)
    rows = [(i * 5, [0.5, 0.5] if i % 3 == 0 else [float(x) for x in rng.normal(size=2)], 0 if i % 3 < 2 else int(i % 9)) for i in range(300)]
    assert found(spark, rows, shard_rows=40) == slow(rows)


def test_empty(spark):
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0], 1)]) == []
    assert found(spark, [(1, [1.0], 1), (2, [0.5], 2)]) == []


def index_of(points, codes=6):
    half = points.shape[1] // 2
    books = [vectors.centroids(points[:, :half], codes), vectors.centroids(points[:, half:], codes)]
    one, two = (vectors.distances(p, b).argmin(1) for p, b in zip((points[:, :half], points[:, half:]), books))
    return multi_index.Cells(points, one, two, books, np.arange(len(points)))


def test_heap_visits_every_cell_once_by_falling_bounds():
    points = np.floor(100 * np.random.default_rng(9).normal(size=(300, 6)))
    index = index_of(points)
    cells = list(index.cells(points[0]))
    bounds = [b for b, _, _ in cells]
    assert bounds == sorted(bounds, reverse=True)
    assert len({c for _, _, c in cells}) == len(cells) == 36
    for high, low, cell in cells:
        scores = index.points[index.starts[cell] : index.starts[cell + 1]] @ points[0]
        assert all(low - 1e-6 <= s <= high + 1e-6 for s in scores)


def test_certified_windows_end_the_search_early():
    rng = np.random.default_rng(10)
    centres = rng.normal(size=(40, 8))
    points = np.floor(256 * (np.repeat(centres, 50, 0) + 0.01 * rng.normal(size=(2000, 8))))
    index = index_of(points, 16)
    for q in points[::97]:
        index.visited = index.scored = 0
        scores = index.points @ q
        own = int(np.sort(scores)[-1])
        spans = [(None, None, 5), (*multi_index.window_of(own, 30, 90), 10)]
        for (low, high, n), (places, got) in zip(spans, index.search(q, spans)):
            fit = np.nonzero((scores >= (-np.inf if low is None else low)) & (scores <= (np.inf if high is None else high)))[0]
            want = fit[np.lexsort((index.ids[fit], -scores[fit]))][:n]
            assert places.tolist() == want.tolist() and got.tolist() == scores[want].tolist()
    index.scored = 0
    index.search(points[0], [(None, None, 5)])
    assert index.scored < len(points)


def test_window_of():
    for p in range(-50, 51):
        low, high = multi_index.window_of(p, 30, 90)
        for s in range(-60, 61):
            assert (low <= s <= high) == (30 * p <= 100 * s <= 90 * p)
