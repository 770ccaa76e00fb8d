"""SimHash near-duplicates over a Gray-order hierarchical index.

Distinct fingerprints are sorted by Gray rank, in which neighbours differ in few
bits, and cut into ranges of about equal size.  The index is a tree over that order: a node
holds the bits that everything below it shares, as (mask, bits), less those its parent
holds already.  A search adds up, on its way down, how many of these bits
differ, and leaves a whole group as soon as they are more than the radius; at a
fingerprint all bits have been told, so the sum is the distance.

The upper part, over ranges, is made of the ranges' shared bits alone, at most ``MAX_RANGES``
patterns, and is sent to all tasks; it says to which later ranges a fingerprint
goes.  The lower part is built where a range lies, and searched by the range's own fingerprints
and by those sent to it, in batches.  Two near fingerprints meet once: in the range of
the later.  No pairs are kept: a range's links are a forest, and one from outside is
linked once to each tree of it.  Links become components by joins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.types import LongType

from docsync.llm.common import ship, written
from docsync.llm.components import components

SHINGLE = 3
SEED = 42
RADIUS = 2
#: What ``near_groups`` takes beside: words of a shingle, fingerprints of a text, bits by which one of them may differ.
WIDE_SHINGLE, WIDE_COUNT, WIDE_RADIUS = 2, 12, 3
#: Fingerprints below a lowest node, and nodes below another.
LEAF, FAN = 4, 4
#: Fingerprints of a range, unless there would be more than ``MAX_RANGES`` of them.
RANGE, MAX_RANGES = 1 << 16, 1 << 16
#: Searches of one range that one task makes; members go along with each such part.
SEARCHES = 1 << 21
#: Nodes that a search looks at in one step.
_WIDTH = 1 << 20
_CHUNK = 1 << 16


def _mixed(h: np.ndarray, turn: int) -> np.ndarray:
    """Another hash of what ``h`` are hashes of; turn 0 is ``h`` itself."""
    if not turn:
        return h
    h = h + np.uint64(turn * 0x9E3779B97F4A7C15 % 2**64)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def signature(text: str | None, shingle: int, count: int) -> list[int]:
    """``count`` fingerprints of 64 bits, as signed numbers, each by another hash; 0 without words."""
    # bytes.lower() and bytes.split() know ASCII letters and blanks only.
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return [0] * count
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    first, last = starts[:n].tolist(), ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros((count, 64), np.int64)
    for at in range(0, n, _CHUNK):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(first[at : at + _CHUNK], last[at : at + _CHUNK])], np.uint64)
        for turn in range(count):
            bits = np.unpackbits(_mixed(h, turn).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones[turn] += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > n, axis=1, bitorder="little").view(np.int64).ravel().tolist()


def fingerprint(text: str | None) -> int:
    """The 64-bit fingerprint, as a signed number; 0 without words."""
    return signature(text, SHINGLE, 1)[0]


@F.pandas_udf(LongType())
def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([fingerprint(t) for t in texts], dtype="int64")


@F.pandas_udf(T.ArrayType(LongType()))
def signatures(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([[fingerprint(t), *signature(t, WIDE_SHINGLE, WIDE_COUNT)] for t in texts], dtype="object")


def gray_rank(pattern: Column) -> Column:
    """The place of a pattern in Gray order."""
    rank = pattern
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank


class GrayIndex:
    """A tree over entries in Gray order, each given by the AND and the OR of its members.

    ``levels`` lists, from the entries up to the root, how many nodes of a level share a parent,
    and their own bits as (mask, bits).
    """

    def __init__(self, every: np.ndarray, some: np.ndarray, leaf: int = LEAF, fan: int = FAN):
        self.levels = []
        width = leaf
        while True:
            shared = ~(every ^ some)
            if len(every) <= 1:
                self.levels.append((1, shared, every))
                return
            starts = np.arange(0, len(every), width)
            upper = np.bitwise_and.reduceat(every, starts), np.bitwise_or.reduceat(some, starts)
            told = np.repeat(~(upper[0] ^ upper[1]), width)[: len(every)]
            self.levels.append((width, shared & ~told, every))
            (every, some), width = upper, fan

    def search(self, fps: np.ndarray, radius: int, after: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(positions in ``fps``, entries within the radius), in batches of bounded size;
        with ``after`` only entries beyond the one it names for each."""
        if not len(fps) or not len(self.levels[0][1]):
            return
        top = len(self.levels)
        spans = np.cumprod([1, *[width for width, _, _ in self.levels]])
        none = np.zeros(len(fps), np.int64)
        # The root is the only child of a node above it which shares nothing.
        waiting = [(top, np.arange(len(fps)), none, none.astype(np.uint8))]
        while waiting:
            level, who, node, used = waiting.pop()
            if not level:
                yield who, node
                continue
            width, mask, bits = self.levels[level - 1]
            step = max(1, _WIDTH // width)
            if len(who) > step:
                waiting += [(level, who[i : i + step], node[i : i + step], used[i : i + step]) for i in range(0, len(who), step)]
                continue
            child = (node[:, None] * width + np.arange(width)).ravel()
            who, used = np.repeat(who, width), np.repeat(used, width)
            there = child < len(mask)
            child, who, used = child[there], who[there], used[there]
            used = used + np.bitwise_count((fps[who] ^ bits[child]) & mask[child])
            near = used <= radius
            if after is not None:
                near &= (child + 1) * spans[level - 1] - 1 > after[who]
            if near.any():
                waiting.append((level - 1, who[near], child[near], used[near]))


def _join(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Put the trees of ``left`` and ``right`` under one root, the least; ``label`` names roots."""
    while True:
        a, b = label[left], label[right]
        apart = a != b
        if not apart.any():
            return
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label[:] = label[label]


def _sent(uppers: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], radii: list[int]):
    """For fingerprints of a range the later ranges of their turn they may have a near one in."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees = {turn: GrayIndex(every, some) for turn, (_, every, some) in uppers.items()}
        for batch in batches:
            for turn, rows in batch.groupby("turn"):
                names = uppers[turn][0]
                fps, own = rows["fp"].to_numpy().view(np.uint64), np.searchsorted(names, rows["range"].to_numpy())
                for who, entry in trees[turn].search(fps, radii[turn], own):
                    yield pd.DataFrame({"range": names[entry].astype(np.int32), "fp": fps[who].view(np.int64)})

    return run


def _found(radii: list[int], leaf: int):
    """Links (turn, a, b) of rows sorted by (range, part, asks, rank): a range's members, then those sent to it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, held, tree = None, [], None

        def turn():
            return int(cell[0]) % len(radii)

        def built():
            fps = np.concatenate(held)
            tree, label = GrayIndex(fps, fps, leaf), np.arange(len(fps))
            for who, entry in tree.search(fps, radii[turn()], label.copy()):
                _join(label, who, entry)
            return tree, label, fps

        def forest(label, fps):
            below = np.flatnonzero(label != np.arange(len(fps))) if cell[1] == 0 else np.zeros(0, np.int64)
            return pd.DataFrame({"turn": turn(), "a": fps[label[below]].view(np.int64), "b": fps[below].view(np.int64)})

        for batch in batches:
            key = batch[["range", "part", "asks"]].to_numpy().astype(np.int64)
            all_fps = batch["fp"].to_numpy().view(np.uint64)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1), len(key)]
            for at, end in zip(cuts, cuts[1:]):
                if at == end:
                    continue
                this, fps = tuple(key[at, :2]), all_fps[at:end]
                if this != cell:
                    if held and tree is None:
                        yield forest(*built()[1:])
                    cell, held, tree = this, [], None
                if not key[at, 2]:
                    held.append(fps)
                    continue
                if tree is None:
                    tree, label, members = built()
                    yield forest(label, members)
                for who, entry in tree.search(fps, radii[turn()]):
                    once = np.unique(np.stack([who, label[entry]]), axis=1)
                    yield pd.DataFrame({"turn": turn(), "a": members[once[1]].view(np.int64), "b": fps[once[0]].view(np.int64)})
        if held and tree is None:
            yield forest(*built()[1:])

    return run


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links that join all fingerprints of ``fps`` (fp, distinct) which
    differ in at most ``radius`` bits, directly or by way of others."""
    return links_by_turn(fps.select(F.lit(0).alias("turn"), "fp"), [radius]).select("a", "b")


def links_by_turn(fps: DataFrame, radii: list[int]) -> DataFrame:
    """(turn, a, b): as ``links``, for ``fps`` (turn, fp) of several turns beside each other;
    a turn is a place in ``radii``, and only fingerprints of one turn are linked."""
    ship(fps.sparkSession)
    # Ranks are unsigned; with the first bit turned they sort as signed numbers.
    rank = gray_rank(F.col("fp")).bitwiseXOR(F.lit(-(2**63)))
    ranges = max(1, min(MAX_RANGES, -(-fps.count() // RANGE)))
    # Where a partition holds the end of a turn and the beginning of the next, these are two ranges.
    name = (F.spark_partition_id() * len(radii) + F.col("turn")).cast("int")
    members = written(fps.select("turn", "fp").repartitionByRange(ranges, "turn", rank).select("turn", name.alias("range"), "fp"), "ranges")
    # A row a range: no more than partitions and turns.
    shared = members.groupBy("turn", "range").agg(F.bit_and("fp").alias("every"), F.bit_or("fp").alias("some")).toPandas()
    uppers = {
        int(turn): (rows["range"].to_numpy(), rows["every"].to_numpy().view(np.uint64), rows["some"].to_numpy().view(np.uint64))
        for turn, rows in shared.sort_values("range").groupby("turn")
    }
    sent = written(members.mapInPandas(_sent(uppers, radii), "range int, fp long"), "sent")
    parts = sent.groupBy("range").agg(F.ceil(F.count("*") / F.lit(SEARCHES)).cast("int").alias("parts"))
    asking = sent.join(F.broadcast(parts), "range").select(
        "range", F.pmod(F.xxhash64("fp"), "parts").cast("int").alias("part"), F.lit(1).alias("asks"), "fp"
    )
    asked = members.join(F.broadcast(parts), "range", "left").select(
        "range", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"), F.lit(0).alias("asks"), "fp"
    )
    return written(
        asked.union(asking).repartition(ranges + len(radii), "range", "part")
        .sortWithinPartitions("range", "part", "asks", rank)
        .mapInPandas(_found(radii, LEAF), "turn int, a long, b long"),
        "links",
    )


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) of every row.

    ``root`` names the component, ``component_id`` is its least doc_id; a null
    doc_id is never the least unless all are null.  A null, empty or blank text
    has fingerprint 0, which links like any other.  Repeated rows have the same
    fingerprint, hence one component.  No rows give no rows.
    """
    ship(docs.sparkSession)
    rows = written(
        docs.select(
            F.col(id_column).alias("doc_id"), F.xxhash64(F.col(text_column)).alias("text_hash"), fingerprints(F.col(text_column)).alias("fp")
        ),
        "fingerprints",
    )
    return _classed(rows, "fp", links(rows.select("fp").distinct()))


def _classed(rows: DataFrame, key: str, edges: DataFrame) -> DataFrame:
    """``rows`` (doc_id, text_hash, ``key``) with root and component_id."""
    distinct = written(rows.groupBy(key).agg(F.min("doc_id").alias("least_id")), "distinct")
    roots = components(edges).select(F.col("v").alias(key), "root")
    classes = written(distinct.join(roots, key, "left").select(key, "least_id", F.coalesce("root", key).alias("root")), "classes")
    least = written(classes.groupBy("root").agg(F.min("least_id").alias("component_id")), "components")
    named = written(classes.join(least, "root").select(key, "root", "component_id"), "named")
    return rows.join(named, key).select("doc_id", "text_hash", key, "root", "component_id")


def near_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text_hash, mark, root, component_id) of every row, as ``near_duplicates``, but texts
    are linked also where any of ``WIDE_COUNT`` more fingerprints, of ``WIDE_SHINGLE`` words and by independent
    hashes, differ in at most ``WIDE_RADIUS`` bits.  One fingerprint of a copy edited in several
    places often differs in more; that all of them do is rarer.  Odd rows count as there.
    """
    ship(docs.sparkSession)
    rows = written(
        docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(F.col(text_column)).alias("text_hash"), signatures(F.col(text_column)).alias("fps"))
        .withColumn("mark", F.xxhash64("fps")),
        "signatures",
    )
    once = rows.groupBy("mark").agg(F.first("fps").alias("fps"))  # a mark stands for its fingerprints
    tall = written(once.select("mark", F.posexplode("fps").alias("turn", "fp")), "turns")
    # The least mark of a fingerprint stands for it.
    held = written(tall.groupBy("turn", "fp").agg(F.min("mark").alias("least"), F.count("*").alias("marks")), "held")
    shared = held.where("marks > 1").select("turn", "fp", "least")
    edges = tall.join(shared, ["turn", "fp"]).where("mark <> least").select(F.col("least").alias("a"), F.col("mark").alias("b"))
    found = links_by_turn(held.select("turn", "fp"), [RADIUS] + [WIDE_RADIUS] * WIDE_COUNT)
    left, right = (held.select("turn", F.col("fp").alias(x), F.col("least").alias(f"least_{x}")) for x in "ab")
    edges = edges.union(found.join(left, ["turn", "a"]).join(right, ["turn", "b"]).select("least_a", "least_b"))
    return _classed(rows.drop("fps"), "mark", edges)


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", groups=near_duplicates) -> DataFrame:
    """``docs`` with one row of each component that ``groups`` finds: the least id; of rows of that id and
    text the least by all columns in turn, nulls first, so files' order decides nothing."""
    found = groups(docs, id_column, text_column)
    # min() over a struct takes nulls for the least, so ids are told apart from none.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    kept = written(found.groupBy("root").agg(first.alias("k")).select(F.col("k.doc_id").alias("kept_id"), F.col("k.text_hash").alias("kept_hash")), "kept")
    rows = docs.select(F.struct("*").alias("row"), F.col(id_column).alias("kept_id"), F.xxhash64(F.col(text_column)).alias("kept_hash"))

    def in_order(f: T.StructField) -> Column:
        value = F.col("row").getField(f.name)
        # Maps and variants have no order; their text has.
        return F.to_json(F.struct(value)) if re.search("map<|variant", f.dataType.simpleString()) else value

    rows = rows.withColumn("order", F.struct(*[in_order(f).alias(f"c{i}") for i, f in enumerate(docs.schema.fields)]))
    once = rows.groupBy("kept_id", "kept_hash").agg(F.min_by("row", "order").alias("row"))
    same = once["kept_id"].eqNullSafe(kept["kept_id"]) & (once["kept_hash"] == kept["kept_hash"])
    return once.join(kept, same, "left_semi").select("row.*")


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
