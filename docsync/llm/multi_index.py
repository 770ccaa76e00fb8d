"""Hard negatives by an inverted multi-index.

Vectors are cut into two halves, each half quantised by a codebook of its own; a pair
of codes is a *cell*.  For an anchor, the halves' centres have scores of their own, and
a cell's members score at most the sum of  centre score + |half| * radius  over its two
halves.  The multi-sequence algorithm visits cells by falling sums from a heap that
holds only the frontier of the two sorted lists of codes.  A search ends when each of
its *windows* (from, to, how many) is certified: no cell left can hold a member that
scores as much as the last one wanted, or reaches the window at all.  Cells wholly
above all windows are visited without scoring.

Rows are dealt to shards of about SHARD_ROWS, each an index in one task's memory under
codebooks common to all; an anchor's bests of the shards are merged.  The positives are
sought in shards of one label, the negatives in shards of all rows, so no label or
vector, however frequent, is one task's.  Codebooks are fitted on a bounded sample
(``vectors.SAMPLE_ROWS``) and decide only how much is visited, never the result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from docsync.llm import vectors
from docsync.llm.common import ship, written
from docsync.llm.vectors import Vectors, matrix, numbers

CODES = 16
SHARD_ROWS = 32768
ANCHORS = 8192
#: Rows gathered from visited cells before they are scored together.
GATHER = 1024

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
#: lowest and highest score (none: open) and how many are wanted.
Span = tuple[int | None, int | None, int]


class Cells:
    """One shard's inverted multi-index: members by cell, and for each code its radius."""

    def __init__(self, points: np.ndarray, first: np.ndarray, second: np.ndarray, books: list[np.ndarray], ids: np.ndarray):
        self.split = books[0].shape[1]
        self.books, codes = books, len(books[1])
        cell = first.astype(np.int64) * codes + second
        self.order = np.lexsort((ids, cell))
        self.points, self.ids = points[self.order], ids[self.order]
        cell = cell[self.order]
        self.starts = np.searchsorted(cell, np.arange(len(books[0]) * codes + 1))
        halves = self.points[:, : self.split], self.points[:, self.split :]
        self.radii = []
        for book, half, code in zip(books, halves, (cell // codes, cell % codes)):
            radius = np.full(len(book), -1.0)  # of codes without members
            np.maximum.at(radius, code, np.sqrt(((half.astype(np.float64) - book[code]) ** 2).sum(1)))
            self.radii.append(radius)
        self.visited = self.scored = 0

    def _lists(self, query: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each half: its codes by falling upper bounds, those bounds, and the lower ones."""
        out = []
        for book, radius, half in zip(self.books, self.radii, (query[: self.split], query[self.split :])):
            there = np.nonzero(radius >= 0)[0]
            score, reach = book[there] @ half, math.sqrt(float(half @ half)) * radius[there]
            by = np.argsort(-(score + reach), kind="stable")
            out.append((there[by], (score + reach)[by], (score - reach)[by]))
        return out

    def cells(self, query: np.ndarray) -> Iterator[tuple[float, float, int]]:
        """(upper bound, lower bound, cell) by falling upper bounds: the multi-sequence heap."""
        (one, high1, low1), (two, high2, low2) = self._lists(query)
        if not len(one) or not len(two):
            return
        heap, seen = [(-(high1[0] + high2[0]), 0, 0)], {(0, 0)}
        while heap:
            bound, i, j = heapq.heappop(heap)
            yield -bound, low1[i] + low2[j], int(one[i]) * len(self.books[1]) + int(two[j])
            for a, b in ((i + 1, j), (i, j + 1)):
                if a < len(one) and b < len(two) and (a, b) not in seen:
                    seen.add((a, b))
                    heapq.heappush(heap, (-(high1[a] + high2[b]), a, b))

    def search(self, query: np.ndarray, spans: list[Span], allowed: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each span (places in ``order``, scores): its first members, by falling
        score, then id.  ``allowed`` says (by place) which members count."""
        wide = query.astype(np.float64)
        slack = 1e-9 * (1 + float(wide @ wide)) + 1e-6
        found = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in spans]
        top = max((math.inf if high is None else high for _, high, _ in spans), default=-math.inf)
        waiting: list[tuple[int, int]] = []
        gathered = 0

        def least(n: int) -> float:
            """What a member must score to matter for span n."""
            low, _, wanted = spans[n]
            floor = -math.inf if low is None else low
            return max(floor, int(found[n][1][wanted - 1])) if len(found[n][1]) >= wanted else floor

        def settle() -> None:
            nonlocal waiting, gathered
            if not waiting:
                return
            places = np.concatenate([np.arange(a, b) for a, b in waiting])
            self.scored += len(places)
            if allowed is not None:
                places = places[allowed[places]]
            scores = (self.points[places] @ query).astype(np.int64)
            for n, (low, high, wanted) in enumerate(spans):
                good = scores >= least(n) if math.isfinite(least(n)) else np.ones(len(scores), bool)
                if high is not None:
                    good &= scores <= high
                place, score = np.concatenate([found[n][0], places[good]]), np.concatenate([found[n][1], scores[good]])
                by = np.lexsort((place, self.ids[place], -score))[:wanted]
                found[n] = place[by], score[by]
            waiting, gathered = [], 0

        for bound, lowest, cell in self.cells(wide):
            if all(bound + slack < least(n) for n in range(len(spans))):
                settle()
                if all(bound + slack < least(n) for n in range(len(spans))):
                    break
            self.visited += 1
            start, end = self.starts[cell], self.starts[cell + 1]
            if end > start and lowest - slack <= top:
                waiting.append((start, end))
                gathered += end - start
                if gathered >= GATHER:
                    settle()
        settle()
        return found


def codebooks(stored: Vectors, codes: int = CODES) -> list[np.ndarray]:
    points = vectors.sampled(stored)
    half = stored.dims // 2
    return [vectors.centroids(points[:, :half], codes), vectors.centroids(points[:, half:], codes)]


def coded(stored: Vectors, books: list[np.ndarray]) -> DataFrame:
    """The stored rows with their codes of both halves (columns ``one`` and ``two``)."""
    dims, half = stored.dims, stored.dims // 2

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = matrix(batch, dims)
            one, two = (vectors.distances(p, b).argmin(1) for p, b in zip((points[:, :half], points[:, half:]), books))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(one.astype(np.int32)), pa.array(two.astype(np.int32))], names=[*batch.schema.names, "one", "two"]
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stored.rows.schema)
    return stored.rows.mapInArrow(code, f"{schema}, one int, two int")


def _index(there: pa.Table, books: list[np.ndarray], dims: int, exact: type) -> Cells:
    return Cells(matrix(there, dims, exact), there.column("one").to_numpy(), there.column("two").to_numpy(), books, numbers(there, "id"))


def _out(found: list[tuple[int, int, np.ndarray, np.ndarray]], there: pa.Table, index: Cells) -> pa.Table:
    """(anchor, window, row, id, score) of all that was found."""
    sizes = [len(f[2]) for f in found]
    places = index.order[np.concatenate([f[2] for f in found])] if found else np.empty(0, np.int64)
    return pa.table(
        {
            "anchor": pa.array(np.repeat([f[0] for f in found], sizes).astype(np.int64)),
            "window": pa.array(np.repeat([f[1] for f in found], sizes).astype(np.int64)),
            "row": pa.array(numbers(there, "row")[places]),
            "id": there.column("id").combine_chunks().take(pa.array(places)),
            "score": pa.array(np.concatenate([f[3] for f in found]).astype(np.int64) if found else np.empty(0, np.int64)),
        }
    )


_FOUND = "anchor long, window long, row long, id long, score long"


def _best(found: DataFrame, by: list[str], n: int) -> DataFrame:
    ranked = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= n)


def window_of(positive_score: int, low: int, high: int) -> tuple[int, int]:
    """Scores s with  low * p <= 100 s <= high * p."""
    return -(-low * positive_score // 100), high * positive_score // 100


def mine(
    rows: DataFrame,
    label: Column,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    codes: int = CODES,
    shard_rows: int = SHARD_ROWS,
    anchors_at_once: int = ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    An anchor's positives are its best other rows of its label; for each of them, the
    negatives are the best rows of other labels that score from ``low`` to ``high``
    hundredths of the positive.  Scores are integer inner products of the scaled
    vectors with the anchor; ties go to the smaller id, null ids last.

    Rows with a null label, and vectors as in ``vectors.stored``, take no part.  A
    repeated row is an anchor and a member of its own.  ``is_anchor`` is a condition on
    column ``id``; a null says no.  No rows give no rows.
    """
    spark = rows.sparkSession
    ship(spark)
    stored = vectors.stored(rows.where(label.isNotNull()), scale, vector_column, id=F.col(id_column).cast("long"), label=label.cast("long"))
    if not stored.count:
        return spark.createDataFrame([], RESULT)
    books, dims, exact = codebooks(stored, codes), stored.dims, stored.exact
    cells = written(coded(stored, books), "cells")
    named = {"anchor": "row", "id": "id", "label": "label", "v": "v"}  # columns of their own, apart from those of ``cells``
    anchors = cells.where(F.coalesce(is_anchor, F.lit(False))).select(*[F.col(c).alias(n) for n, c in named.items()])
    blocks = max(1, math.ceil(anchors.count() / anchors_at_once))
    block = F.pmod(F.xxhash64("anchor"), F.lit(blocks)).cast("int")
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")

    # Positives: shards of one label each.
    parts = F.greatest(F.lit(1), F.ceil(F.col("n") / shard_rows)).cast("int")
    sizes = written(cells.groupBy("label").agg(F.count("*").alias("n")).select("label", parts.alias("parts")), "labels")
    asked = anchors.join(sizes, "label").select(
        "anchor", "id", "label", "v", block.alias("block"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("shard")
    )
    there = cells.join(sizes, "label").select(
        "row", "id", "label", "v", "one", "two", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int").alias("shard")
    ).select("*", every_block)

    def same(ask: pa.Table, members: pa.Table) -> pa.Table:
        index, found = _index(members, books, dims, exact), []
        rows_of = numbers(members, "row")[index.order]
        queries, mine = matrix(ask, dims, exact), numbers(ask, "anchor")
        place = dict(zip(rows_of.tolist(), range(len(rows_of))))
        for query, anchor in zip(queries, mine.tolist()):
            allowed = None
            if anchor in place:
                allowed = np.ones(len(rows_of), bool)
                allowed[place[anchor]] = False
            ((places, scores),) = index.search(query, [(None, None, positives)], allowed)
            found.append((anchor, 0, places, scores))
        return _out(found, members, index)

    keys = ["block", "label", "shard"]
    good = written(
        _best(asked.groupBy(*keys).cogroup(there.groupBy(*keys)).applyInArrow(same, _FOUND), ["anchor"], positives)
        .select("anchor", F.col("id").alias("positive_id"), F.col("row").alias("positive_row"), F.col("score").alias("window")),
        "positives",
    )

    # Negatives: shards of all rows.  An anchor's windows are told by their positives' scores.
    windows = good.groupBy("anchor").agg(F.sort_array(F.collect_set("window")).alias("windows"))
    shards = max(1, math.ceil(stored.count / shard_rows))
    asked = anchors.join(windows, "anchor").select(
        "anchor", "label", "v", "windows", block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    )
    there = cells.select(
        "row", "id", "label", "v", "one", "two", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard"), every_block
    )

    def other(ask: pa.Table, members: pa.Table) -> pa.Table:
        index, found = _index(members, books, dims, exact), []
        labels = numbers(members, "label")[index.order]
        queries = matrix(ask, dims, exact)
        for query, anchor, label_, scores_ in zip(queries, ask["anchor"].to_pylist(), ask["label"].to_pylist(), ask["windows"].to_pylist()):
            spans = [(s, *window_of(s, low, high)) for s in scores_]
            spans = [(s, a, b) for s, a, b in spans if a <= b]
            for (s, _, _), (places, scores) in zip(spans, index.search(query, [(a, b, negatives) for _, a, b in spans], labels != label_) if spans else []):
                found.append((anchor, s, places, scores))
        return _out(found, members, index)

    keys = ["block", "shard"]
    bad = _best(asked.groupBy(*keys).cogroup(there.groupBy(*keys)).applyInArrow(other, _FOUND), ["anchor", "window"], negatives)
    return (
        bad.join(good, ["anchor", "window"])
        .join(anchors.select("anchor", F.col("id").alias("anchor_id")), "anchor")
        .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), F.col("window").alias("positive_score"), F.col("score").alias("negative_score"))
    )
