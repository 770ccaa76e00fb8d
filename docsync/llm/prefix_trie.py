"""A trie of conversations rebuilt from a common head and their own rest.

A conversation c is rebuilt as the first h turns of its base conversation, then its
own turns after its first h.  No rebuilt text is made.  Turns are told by *reference*:
``ref`` is the least stored row with the same role and text, and these are compared
in full.  A sequence of turns has the fingerprint  sum of (ref + 1) * B^(n - i)  modulo
2^127 - 1; fingerprints are a monoid under  (m, x) . (n, y) = (m + n, x * B^n + y),  so

* a range of sorted turns is summed up in its task, and the few ranges that a
  conversation spans are put together from their summaries: a conversation of any
  length is no one task's;
* the prefix of a rebuilt conversation is its base's head times its own rest, both
  taken from sums over stored turns:  (head - own_h) * B^(at - h) + own_at.

Equal prefixes have equal fingerprints.  The other way round is verified: all members
of a group must end in one ``ref`` and come from one parent group, which by induction
from the root means the same turns.  If a digest or a fingerprint ever stands for two
things, all is done anew with other ones.

Subtree sums need no walk over levels.  A node is represented by its smallest member;
along a conversation, from the depth where it becomes the smallest it stays so.  With
Z(c) the words before that depth, a node's saved words are the sum over members of
max(0, Z(c) - words before the node), and its leaves the members that represent a leaf.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from docsync.llm.common import ship, written

MODULUS = 2**127 - 1
GROUP = 20
HEADS = 4
ATTEMPTS = 8
#: Characters of ids joined up before they are dealt to the node they end at.
CHUNK = 1 << 16
WORD = r"[^\x20\x09-\x0D]+"

KEY = ["depth", "hi", "lo"]
Digest = Callable[[int, Column, Column], Column]


@dataclass(frozen=True)
class Trie:
    """``turns`` (row, conv, turn, role, text, ...) are the stored turns that ``ref`` points
    into; ``members`` (conv, depth, hi, lo, p_hi, p_lo, ref, words, before, length) has a row
    for each prefix of each rebuilt conversation; ``nodes`` a row for each different one."""

    turns: DataFrame
    conversations: DataFrame
    members: DataFrame
    nodes: DataFrame


def content_digest(seed: int, role: Column, text: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.length(role).cast("string"), F.lit(":"), role, F.sha2(text, 256)), 256)


def base_of(seed: int, modulus: int) -> int:
    return int(hashlib.sha256(f"base:{seed}".encode()).hexdigest(), 16) % (modulus - 3) + 2


def joined(left: tuple[int, int, int], right: tuple[int, int, int], base: int, modulus: int) -> tuple[int, int, int]:
    """The monoid: (turns, fingerprint, words) of one sequence after another."""
    return left[0] + right[0], (left[1] * pow(base, right[0], modulus) + right[1]) % modulus, left[2] + right[2]


def _halves(values: list[int]) -> tuple[pa.Array, pa.Array]:
    hi = np.array([v >> 64 for v in values], dtype=np.int64)
    lo = np.array([v & (2**64 - 1) for v in values], dtype=np.uint64).view(np.int64)
    return pa.array(hi), pa.array(lo)


def _whole(batch: pa.RecordBatch, hi: str, lo: str) -> list[int]:
    low = batch.column(lo).to_numpy().view(np.uint64).tolist()
    return [(a << 64) | b for a, b in zip(batch.column(hi).to_pylist(), low)]


def _summed(turns: DataFrame, base: int, modulus: int) -> DataFrame:
    """Every turn with its place ``at``, fingerprint and words so far in its conversation.

    Turns are sorted in ranges; each task sums up its own range.  What goes before a
    range in the conversation that it begins with comes from one summary a range, which
    the driver puts together.
    """
    order = ["conv", "turn", "role", "mark", "row"]
    ranged = turns.select(*order, "ref", "words").repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "ref", "words")

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, conv, at, value, total = TaskContext.get().partitionId(), None, 0, 0, 0
        for batch in batches:
            ats, values, totals = [], [], []
            for c, ref, words in zip(*(batch.column(n).to_pylist() for n in ("conv", "ref", "words"))):
                if c != conv:
                    conv, at, value, total = c, 0, 0, 0
                at, value, total = at + 1, (value * base + ref + 1) % modulus, total + words
                ats.append(at)
                values.append(value)
                totals.append(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(ats), pa.int32()), *batch.columns, pa.array(ats, pa.int64()), *_halves(values), pa.array(totals, pa.int64())],
                names=["part", "conv", "ref", "words", "at", "hi", "lo", "total"],
            )

    schema = "part int, conv long, ref long, words long, at long, hi long, lo long, total long"
    ranges = written(ranged.mapInArrow(local, schema), "ranges")
    ends = ranges.groupBy("part").agg(
        F.min("conv").alias("first"), F.max_by(F.struct("conv", "at", "hi", "lo", "total"), F.struct("conv", "at")).alias("last")
    )
    carried: dict[int, tuple[int, tuple[int, int, int]]] = {}
    last: tuple[int | None, tuple[int, int, int]] = (None, (0, 0, 0))
    for r in sorted(ends.collect(), key=lambda r: r.part):
        own = (r.last.at, (r.last.hi << 64) | (r.last.lo % 2**64), r.last.total)
        if r.first == last[0]:
            carried[r.part] = last
            if r.first == r.last.conv:
                own = joined(last[1], own, base, modulus)
        last = (r.last.conv, own)

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, convs = batch.column("part").to_numpy(), batch.column("conv").to_numpy()
            before = {p: carried[p] for p in np.unique(parts).tolist() if p in carried}
            out = {n: batch.column(n) for n in ("conv", "ref", "words", "at", "hi", "lo", "total")}
            for p, (conv, left) in before.items():
                here = np.nonzero((parts == p) & (convs == conv))[0]
                some = batch.take(pa.array(here))
                right = zip(some.column("at").to_pylist(), _whole(some, "hi", "lo"), some.column("total").to_pylist())
                ats, values, totals = zip(*(joined(left, r, base, modulus) for r in right)) if len(here) else ((), (), ())
                for n, new in zip(("at", "hi", "lo", "total"), (pa.array(ats, pa.int64()), *_halves(list(values)), pa.array(totals, pa.int64()))):
                    old = out[n].to_numpy().copy()
                    old[here] = new.to_numpy()
                    out[n] = pa.array(old)
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    schema = "conv long, ref long, words long, at long, hi long, lo long, total long"
    return ranges.mapInArrow(carry, schema) if carried else ranges.drop("part")


def _rebuilt(summed: DataFrame) -> DataFrame:
    """Each conversation with its base's head, and where its own rest begins."""
    turn = F.struct("at", "hi", "lo", "ref", "words", "total")
    own = written(
        summed.groupBy("conv").agg(
            F.max("at").alias("turns"), F.max("total").alias("words"), F.sort_array(F.collect_list(F.when(F.col("at") < HEADS, turn))).alias("heads")
        ),
        "conversations",
    )
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS).cast("int")
    heads = own.select(F.col("conv").alias("base"), F.col("heads").alias("all"))
    nothing = F.struct(*[F.lit(0).cast("long").alias(f) for f in ("at", "hi", "lo", "ref", "words", "total")])
    last = F.when(F.size("head") > 0, F.element_at("head", -1)).otherwise(nothing)
    skipped = F.when((F.col("h") > 0) & (F.col("turns") >= F.col("h")), F.get("heads", F.col("h") - 1)).otherwise(nothing)
    rest = F.greatest(F.col("turns") - F.col("h"), F.lit(0))
    return written(
        own.select("*", h.alias("h"), (F.col("conv") - F.col("conv") % GROUP).alias("base"))
        .join(heads, "base", "left")
        .withColumn("head", F.coalesce(F.slice("all", 1, F.col("h")), F.array().cast(heads.schema["all"].dataType)))
        .select("conv", "h", "head", last.alias("last"), skipped.alias("skipped"), rest.alias("rest"), "words")
        .select(
            "conv", "h", "head", "last", "skipped", (F.col("last.at") + F.col("rest")).alias("length"),
            (F.col("last.total") + F.when(F.col("rest") > 0, F.col("words") - F.col("skipped.total")).otherwise(0)).alias("words"),
        ),
        "rebuilt",
    )


def _members(summed: DataFrame, rebuilt: DataFrame, base: int, modulus: int) -> DataFrame:
    """A row for each prefix of each rebuilt conversation, the empty one included."""
    zero = F.lit(0).cast("long")
    plain = [zero.alias(n) for n in ("power", "a_hi", "a_lo", "b_hi", "b_lo")]
    root = rebuilt.select("conv", *[zero.alias(n) for n in ("depth", "hi", "lo", "ref", "words", "before")], "length", *plain)
    heads = rebuilt.select("conv", "length", F.explode("head").alias("t")).select(
        "conv", F.col("t.at").alias("depth"), "t.hi", "t.lo", "t.ref", "t.words", (F.col("t.total") - F.col("t.words")).alias("before"), "length", *plain
    )
    own = summed.join(rebuilt.drop("head", "words"), "conv").where(F.col("at") > F.col("h")).select(
        "conv", (F.col("last.at") + F.col("at") - F.col("h")).alias("depth"), "hi", "lo", "ref", "words",
        (F.col("last.total") + F.col("total") - F.col("words") - F.col("skipped.total")).alias("before"), "length",
        (F.col("at") - F.col("h")).alias("power"), F.col("last.hi").alias("a_hi"), F.col("last.lo").alias("a_lo"),
        F.col("skipped.hi").alias("b_hi"), F.col("skipped.lo").alias("b_lo"),
    )
    back = pow(base, -1, modulus)

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, parents = [], []
            whole = zip(_whole(batch, "hi", "lo"), _whole(batch, "a_hi", "a_lo"), _whole(batch, "b_hi", "b_lo"))
            for (own, head, skipped), power, depth, ref in zip(whole, *(batch.column(n).to_pylist() for n in ("power", "depth", "ref"))):
                if head != skipped:
                    own = ((head - skipped) * pow(base, power, modulus) + own) % modulus
                values.append(own)
                parents.append((own - ref - 1) * back % modulus if depth else 0)
            kept = [batch.column(n) for n in ("conv", "depth")]
            yield pa.RecordBatch.from_arrays(
                [*kept, *_halves(values), *_halves(parents), *[batch.column(n) for n in ("ref", "words", "before", "length")]],
                names=["conv", "depth", "hi", "lo", "p_hi", "p_lo", "ref", "words", "before", "length"],
            )

    schema = ", ".join(f"{n} long" for n in ("conv", "depth", "hi", "lo", "p_hi", "p_lo", "ref", "words", "before", "length"))
    return written(root.unionByName(heads).unionByName(own).mapInArrow(combine, schema), "members")


def _nodes(members: DataFrame) -> DataFrame:
    """A row for each group of members; ``sure`` says that they end in one turn and have one parent."""
    one = [F.min(c) == F.max(c) for c in ("ref", "p_hi", "p_lo")]
    return written(
        members.groupBy(*KEY).agg(
            F.count("*").alias("n_convs"), F.min("conv").alias("conv"), F.max("length").alias("longest"),
            F.min("p_hi").alias("p_hi"), F.min("p_lo").alias("p_lo"), F.min("ref").alias("ref"), F.min("words").alias("words"),
            F.min_by("before", "conv").alias("before"), (one[0] & one[1] & one[2]).alias("sure"),
        ),
        "nodes",
    )


def build(
    rows: DataFrame,
    conv_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    modulus: int = MODULUS,
    digest: Digest = content_digest,
) -> Trie:
    """The trie of the rebuilt conversations.

    Turns go by ``turn``, a null one first, then by role and by the SHA-256 of the text;
    null roles and texts are empty; repeated rows are repeated turns.  Rows with a null
    conversation id belong to none and are left out.  No rows give no nodes.
    """
    ship(rows.sparkSession)
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_column, text_column))
    told = rows.where(F.col(conv_column).isNotNull()).select(
        F.monotonically_increasing_id().alias("row"), F.col(conv_column).cast("long").alias("conv"), F.col(turn_column).alias("turn"),
        role.alias("role"), text.alias("text"), F.sha2(text, 256).alias("mark"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    for seed in range(ATTEMPTS):
        turns = written(told.withColumn("digest", digest(seed, F.col("role"), F.col("text"))), "turns")
        same = (F.min("role") == F.max("role")) & (F.min("text") == F.max("text"))
        classes = written(turns.groupBy("digest").agg(F.min("row").alias("ref"), same.alias("same")), "classes")
        if not classes.where("NOT same").isEmpty():
            continue
        base = base_of(seed, modulus)
        summed = _summed(turns.drop("text").join(classes.select("digest", "ref"), "digest"), base, modulus)
        rebuilt = _rebuilt(summed)
        members = _members(summed, rebuilt, base, modulus)
        nodes = _nodes(members)
        if nodes.where("NOT sure").isEmpty():
            return Trie(turns, rebuilt, members, nodes.drop("sure"))
    raise RuntimeError(f"{ATTEMPTS} choices of fingerprints had two things under one fingerprint")


def _ends(members: DataFrame) -> DataFrame:
    """For each node where conversations end, the SHA-256 of their ids, ascending, comma-joined.

    Ids are joined up in sorted ranges, so only texts of CHUNK characters go to the one
    task that hashes a node's ids, and that task holds one batch of them at a time.
    """
    order = [*KEY, "conv"]
    over = members.where("depth = length").select(*order).repartitionByRange(*order).sortWithinPartitions(*order)

    def join_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, ids in batch.groupby(KEY, sort=False)["conv"]:
                ids = ids.tolist()
                step = CHUNK // 20
                out += [(*key, ids[i], ",".join(map(str, ids[i : i + step]))) for i in range(0, len(ids), step)]
            yield pd.DataFrame(out, columns=[*KEY, "first", "ids"])

    texts = over.mapInPandas(join_up, "depth long, hi long, lo long, first long, ids string")
    dealt = texts.repartition(*KEY).sortWithinPartitions(*KEY, "first")

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = None, hashlib.sha256()
        for batch in batches:
            out = []
            for *key, _, ids in batch.itertuples(index=False, name=None):
                if key != now:
                    out += [(*now, state.hexdigest())] if now else []
                    now, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield pd.DataFrame(out, columns=[*KEY, "ends_sha256"])
        if now:
            yield pd.DataFrame([(*now, state.hexdigest())], columns=[*KEY, "ends_sha256"])

    return dealt.mapInPandas(hashed, "depth long, hi long, lo long, ends_sha256 string")


def digest(trie: Trie) -> DataFrame:
    """Every node, told by its smallest member and depth, with its parent, members,
    children, and what its subtree holds."""
    first = trie.nodes.groupBy("conv").agg(F.min("before").alias("z"), F.max((F.col("depth") == F.col("longest")).cast("int")).alias("leaf"))
    told = written(
        trie.conversations.select("conv", "words").join(first, "conv", "left").select(
            "conv", F.coalesce("z", "words").alias("z"), F.coalesce("leaf", F.lit(0)).alias("leaf")
        ),
        "representatives",
    )
    none = F.lit(0).cast("long")
    inside = trie.members.join(told, "conv").select(
        *KEY, F.col("leaf").cast("long").alias("n_leaves"), F.greatest(F.col("z") - F.col("before"), none).alias("saved_tokens"), none.alias("n_children")
    )
    children = trie.nodes.where("depth > 0").select(
        (F.col("depth") - 1).alias("depth"), F.col("p_hi").alias("hi"), F.col("p_lo").alias("lo"),
        none.alias("n_leaves"), none.alias("saved_tokens"), F.lit(1).cast("long").alias("n_children"),
    )
    sums = inside.unionByName(children).groupBy(*KEY).agg(*[F.sum(c).alias(c) for c in ("n_leaves", "saved_tokens", "n_children")])
    parents = trie.nodes.select((F.col("depth") + 1).alias("depth"), F.col("hi").alias("p_hi"), F.col("lo").alias("p_lo"), F.col("conv").alias("parent_conv_id"))
    # The root has no parent: no node is one level above it.
    return (
        trie.nodes.join(sums, KEY)
        .join(_ends(trie.members), KEY, "left")
        .join(parents, ["depth", "p_hi", "p_lo"], "left")
        .select(
            F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        )
    )
