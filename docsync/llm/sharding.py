"""Sharding by a hierarchical weighted hash tree.

A row descends from the root through regions and racks to a shard.  At each
level every child draws ``-ln(u) / weight``, ``u`` hashed from the row's id and
the child's name; the smallest draw wins, so a child gets rows in proportion to
its weight, and a child whose weight does not change keeps its draw.

Growth comes in *layers*.  What a growth step adds to a subtree draws on its
own behalf, beside what was there: a region that gains a shard has a second
draw of the added weight.  A row won by an added draw goes down to what was
added; all others stay where they were.  So a new shard takes rows only into
itself (law ``key``), however deep in the tree it stands, and movement is
confined to the subtrees whose weights change.

Nothing but the id and the tree decides; texts are not shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from docsync.llm.common import id_text, uniform, written

LAW = "key"
#: First hex digits of the hash that split a shard for numbering: 256 parts.
PART_DIGITS = 2
#: Copies of a row made in one task.
FEW_COPIES = 1000


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


@dataclass(frozen=True)
class Tree:
    """Layers of leaves: the first is the tree as laid out, each other one a growth step."""

    layers: tuple[tuple[Leaf, ...], ...]

    def __post_init__(self) -> None:
        shards = [leaf.shard for layer in self.layers for leaf in layer]
        if not shards or len(set(shards)) < len(shards):
            raise ValueError("a tree needs shards, each named once")
        if any(not leaf.weight > 0 for layer in self.layers for leaf in layer):
            raise ValueError("weights are positive")

    def grown(self, *leaves: Leaf) -> Tree:
        return Tree((*self.layers, tuple(leaves)))


def balanced_tree(shards: int, regions: int = 4, racks: int = 2) -> Tree:
    """``shards`` equal leaves dealt evenly to ``regions`` of ``racks`` each."""
    nodes = min(regions * racks, shards)
    return Tree((tuple(Leaf(s * nodes // shards // racks, s * nodes // shards, s) for s in range(shards)),))


#: A child of a node: its name, weight, and its own place in the next level
#: (below the racks: the shard's number).
Child = tuple[str, float, int]


def levels(tree: Tree) -> list[list[list[Child]]]:
    """For each level its nodes, each the list of its children; the root is alone."""
    paths = [
        ((f"{number}.{leaf.region}", str(leaf.rack), str(leaf.shard)), leaf)
        for number, layer in enumerate(tree.layers)
        for leaf in layer
    ]
    out, nodes = [], [paths]
    for level in range(3):
        table, below = [], []
        for members in nodes:
            children: dict[tuple, list] = {}
            for path, leaf in members:
                children.setdefault(path[: level + 1], []).append((path, leaf))
            table.append(
                [
                    ("/".join(name), float(sum(leaf.weight for _, leaf in own)), own[0][1].shard if level == 2 else len(below) + i)
                    for i, (name, own) in enumerate(children.items())
                ]
            )
            below.extend(children.values())
        out.append(table)
        nodes = below
    return out


def _draws(children: Column, level: int, key: Column) -> Column:
    return F.transform(
        children,
        lambda c: F.struct((-F.log(uniform(str(level), c["name"], key)) / c["weight"]).alias("draw"), c["below"].alias("below")),
    )


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard of an id; ``key`` is its text."""
    node = F.lit(0)
    for level, table in enumerate(levels(tree)):
        named = F.array(
            *[
                F.array(*[F.struct(F.lit(n).alias("name"), F.lit(w).alias("weight"), F.lit(below).alias("below")) for n, w, below in children])
                for children in table
            ]
        )
        draws = _draws(F.element_at(named, node + 1), level, key)
        node = F.array_min(draws)["below"]
    return node.cast("int")


def shard(
    docs: DataFrame, tree: Tree, grown: Tree | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Every row's shard and its slot there, and its shard in the ``grown`` tree.

    Slots run from 0 without gaps.  A shard is numbered in 256 parts by hash, so
    no task holds a whole shard; equal rows (same id, size, checksum) are counted
    before the shuffle and take neighbouring slots.  A row repeated more than FEW_COPIES
    times is one row until its copies are made, in ranges dealt to tasks.

    A null id is placed as the text ``null``; a null text has no bytes (size 16,
    checksum 0).  Rows that agree in all are interchangeable.  No rows give no rows.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = (
        docs.select(
            F.col(id_column).alias("doc_id"),
            (F.octet_length(text) + 16).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
        )
        .groupBy("doc_id", "size", "text_crc32")
        .agg(F.count("*").alias("copies"))
    )
    key = id_text(F.col("doc_id"))
    placed = rows.select(
        "*",
        shard_of(key, tree).alias("shard"),
        (shard_of(key, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
        F.substring(F.md5(F.concat_ws(":", F.lit("slot"), key, F.col("size").cast("string"), F.col("text_crc32").cast("string"))), 1, PART_DIGITS).alias("part"),
    )
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        placed.groupBy("shard", "part")
        .agg(F.sum("copies").alias("n"))
        .select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    within = (
        Window.partitionBy("shard", "part")
        .orderBy("doc_id", "text_crc32", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    first = placed.withColumn("done", F.coalesce(F.sum("copies").over(within), F.lit(0)))
    numbered = written(
        first.join(parts, ["shard", "part"]).select(
            "doc_id", "size", "text_crc32", "shard", "grown_shard", "copies", (F.col("start") + F.col("done")).alias("slot")
        ),
        "slots",
    )
    few = numbered.where(F.col("copies") <= FEW_COPIES).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"))
    return few.unionByName(_copied(numbered.where(F.col("copies") > FEW_COPIES))).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", (F.col("slot") + F.col("copy")).cast("long").alias("slot"), "grown_shard"
    )


def _copied(rows: DataFrame) -> DataFrame:
    """Rows of many copies, each copy a row (``copy`` from 0): ranges of about the root of
    their number are made first and dealt to tasks, so no array holds them all."""
    length = F.ceil(F.sqrt("copies"))
    ranges = rows.withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, length)))
    last = F.least(F.col("first") + length, F.col("copies")) - 1
    # A number of partitions that is told stays: Spark would join up what looks small before copies are made.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return ranges.repartition(parts, "doc_id", "text_crc32", "first").select("*", F.explode(F.sequence("first", last)).alias("copy")).drop("first")
