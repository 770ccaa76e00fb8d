"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over the last seven bytes ends a piece wherever it is one less
than a multiple of the block size, so pieces depend on what they hold, not
on where they stand.  A piece's hash gives a character; a fingerprint is
``blocksize:signature:signature at twice the block size``.  The block size is
the smallest of 3 * 2**k that leaves some 64 pieces, halved while there
are too few.  A signature has at most 64 characters: past 63 pieces the
rest of the text is one piece, whole.

Two fingerprints are likened where they have a block size in common: one less
the edit distance of the signatures over their lengths' sum, an exchange being two.

Hashes and distances are worked out in numpy for a batch of documents at once.

``with_next`` gives each document its neighbour in descending order of ids
without a global window: ids alone are dealt to ranges, their texts go to the
range's bucket, the first text of each range also to the range before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from docsync.llm.common import ship

PIECES = 64
LEAST_BLOCK = 3
_WINDOW = 7
#: Bytes hashed at once; a longer text is a batch of its own.
BATCH_BYTES = 1 << 21
#: Documents in a range of ids, about.
RANGE_ROWS = 500
MAX_RANGES = 100_000
_ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_ROLL = np.uint32(0x01000193)
_PIECE = np.uint64(0x9E3779B97F4A7C15)


def _levels(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each byte the largest k for which 3 * 2**k ends a piece there; -1 if none does."""
    wide = data.astype(np.uint32) + np.uint32(1)
    roll = wide.copy()
    factor = _ROLL
    at = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    for back in range(1, _WINDOW):
        part = wide[:-back] * factor
        part[at[back:] < back] = 0  # the window ends at the text's beginning
        roll[back:] += part
        factor = np.uint32(int(factor) * int(_ROLL) & 0xFFFFFFFF)
    roll ^= roll >> np.uint32(15)
    roll *= np.uint32(0x2C1B3C6D)
    roll ^= roll >> np.uint32(13)
    after = roll.astype(np.int64) + 1
    level = np.full(len(data), -1, np.int8)
    third = np.flatnonzero(after % 3 == 0)
    over = after[third] // 3
    level[third] = np.log2((over & -over).astype(np.float64)).astype(np.int8)
    return level


def _signatures(data: np.ndarray, ends: np.ndarray, limits: np.ndarray, owner: np.ndarray, count: int) -> list[bytes]:
    """Signatures from the ends of pieces (positions after them), sorted, of each
    text: ``owner`` names an end's text, ``limits`` is (start, stop) of each text.

    ``ends`` hold at most 63 a text; what remains after the last is a piece too.
    """
    lasts = limits[:, 1]
    all_ends = np.concatenate([ends, lasts])
    all_owners = np.concatenate([owner, np.arange(count)])
    # an end that is the text's own end comes once
    keep = np.concatenate([ends < lasts[owner], np.ones(count, bool)])
    all_ends, all_owners = all_ends[keep], all_owners[keep]
    order = np.lexsort((all_ends, all_owners))
    all_ends, all_owners = all_ends[order], all_owners[order]
    first = np.searchsorted(all_owners, np.arange(count))
    begins = np.concatenate([[0], all_ends[:-1]])
    begins[first] = limits[:, 0]
    empty = all_ends <= begins
    hashes = np.zeros(len(all_ends), np.uint64)
    if len(data):
        # Powers run with a byte's place in its piece, so a piece is hashed alike anywhere.
        sizes = all_ends - begins
        place = np.arange(len(data)) - np.repeat(begins[~empty], sizes[~empty])
        powers = np.ones(int(sizes.max()) + 1, np.uint64)
        powers[1:] = _PIECE
        powers = np.multiply.accumulate(powers)
        mixed = (data.astype(np.uint64) + np.uint64(1)) * powers[place]
        hashes[~empty] = np.add.reduceat(mixed, begins[~empty])
    hashes ^= hashes >> np.uint64(32)
    hashes *= np.uint64(0xD6E8FEB86659FD93)
    letters = _ALPHABET[(hashes >> np.uint64(58)).astype(np.int64)]
    bounds = np.append(first, len(all_ends))
    has = ~empty
    return [letters[a:b][has[a:b]].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]


def _first_ends(positions: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most 63 ends of each text, the first ones."""
    rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
    keep = rank < PIECES - 1
    return positions[keep], owner[keep]


def _batch(texts: list[bytes]) -> list[str]:
    lengths = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts = np.cumsum(lengths) - lengths
    limits = np.stack([starts, starts + lengths], axis=1)
    block = np.ceil(np.log2(np.maximum(1, lengths / (LEAST_BLOCK * PIECES)))).astype(np.int64)
    if len(data):
        level = _levels(data, starts[lengths > 0])
        position = np.flatnonzero(level >= 0)
        owner = np.searchsorted(starts + lengths, position, side="right")
        level = level[position]
        while True:  # fewer than half the pieces: halve the block, unless it is the least
            ends = np.bincount(owner[level >= block[owner]], minlength=len(texts))
            small = (ends < PIECES // 2) & (block > 0)
            if not small.any():
                break
            block[small] -= 1
        fine, coarse = level >= block[owner], level > block[owner]
        one = _signatures(data, *_swap(_first_ends(position[fine] + 1, owner[fine]), limits), len(texts))
        two = _signatures(data, *_swap(_first_ends(position[coarse] + 1, owner[coarse]), limits), len(texts))
    else:
        one = two = [b""] * len(texts)
    return [f"{LEAST_BLOCK << int(b)}:{x.decode()}:{y.decode()}" for b, x, y in zip(block, one, two)]


def _swap(found: tuple[np.ndarray, np.ndarray], limits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return found[0], limits, found[1]


def fingerprints(texts: list[str]) -> list[str]:
    out, held, size = [], [], 0
    for text in texts:
        data = text.encode("utf-8", "surrogatepass")
        if held and size + len(data) > BATCH_BYTES:
            out += _batch(held)
            held, size = [], 0
        held.append(data)
        size += len(data)
    return out + _batch(held) if held else out


def _distances(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Edit distances (insert and delete 1, exchange 2), all pairs of rows at once."""
    n = len(a)
    la, lb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    wa, wb = np.zeros((n, PIECES), np.uint8), np.zeros((n, PIECES), np.uint8)
    for table, rows in ((wa, a), (wb, b)):
        for i, row in enumerate(rows):
            table[i, : len(row)] = np.frombuffer(row, np.uint8)
    # distance = la + lb - 2 * longest common subsequence, bit-parallel: 64 places a word
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    v = np.full(n, full)
    inside = np.arange(PIECES) < la[:, None]
    for j in range(int(lb.max(initial=0))):
        match = np.packbits((wa == wb[:, j : j + 1]) & inside, axis=1, bitorder="little").view(np.uint64)[:, 0]
        u = v & match
        after = (v + u) | (v - u)
        v = np.where(j < lb, after, v)
    mask = np.where(la >= 64, full, (np.uint64(1) << np.minimum(la, 63).astype(np.uint64)) - np.uint64(1))
    common = np.bitwise_count(~v & mask).astype(np.int64)
    return la + lb - 2 * common


def likeness(a: list[str], b: list[str]) -> np.ndarray:
    """How alike fingerprints are, pairwise, 0 to 1; equal ones 1, and 0 where
    no block size is common."""
    left, right = ([x.split(":") for x in s] for s in (a, b))
    out = np.array([float(x == y) for x, y in zip(a, b)])
    pairs: tuple[list, list, list] = ([], [], [])
    for i, (x, y) in enumerate(zip(left, right)):
        if out[i]:
            continue
        p, q = int(x[0]), int(y[0])
        for k, m in ((1, 1), (2, 2)) if p == q else ((2, 1),) if 2 * p == q else ((1, 2),) if p == 2 * q else ():
            if x[k] and y[m]:
                pairs[0].append(i)
                pairs[1].append(x[k].encode())
                pairs[2].append(y[m].encode())
    if pairs[0]:
        total = np.array([len(x) + len(y) for x, y in zip(pairs[1], pairs[2])])
        np.maximum.at(out, pairs[0], 1 - _distances(pairs[1], pairs[2]) / total)
    return out


def edited(text: str, following: str) -> str:
    """The last third's code points replaced by the first as many of the next text."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def with_next(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(bucket, lead, doc_id, text): each bucket's rows in descending order of ids
    form a run; rows with ``lead`` tell the last row of a bucket what comes next.

    Null ids come last, rows of one id by text.  After the last row comes the first.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    ids = rows.select("doc_id")
    ranges = max(1, min(MAX_RANGES, ids.count() // RANGE_ROWS))
    dealt = ids.where("doc_id IS NOT NULL").repartitionByRange(ranges, "doc_id").groupBy(F.spark_partition_id().alias("p"))
    found = dealt.agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).orderBy("least").collect()
    least, most = [r.least for r in found], [r.most for r in found]
    nulls = not ids.where("doc_id IS NULL").isEmpty()
    # Bucket i holds ids from least[i] to most[i]; null ids are bucket -1, below all.
    bounds, tops = (F.from_json(F.lit(str(x)), "array<long>") for x in (least, most))

    def halved(acc, _):
        middle = F.floor((acc["low"] + acc["high"]) / 2).cast("int")
        right = F.element_at(bounds, middle + 1) <= F.col("doc_id")
        return F.struct(F.when(right, middle).otherwise(acc["low"]).alias("low"), F.when(right, acc["high"]).otherwise(middle).alias("high"))

    start = F.struct(F.lit(0).alias("low"), F.lit(len(least)).alias("high"))
    steps = F.sequence(F.lit(1), F.lit(max(1, len(least)).bit_length()))
    searched = F.aggregate(steps, start, lambda acc, i: F.when(acc["high"] - acc["low"] > 1, halved(acc, i)).otherwise(acc), lambda acc: acc["low"])
    lowest = -1 if nulls else 0
    bucket = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(searched) if least else F.lit(-1)
    # A bucket's first row also ends the bucket above it; the very first ends the lowest.
    top = F.col("doc_id").isNull() if not least else F.col("doc_id").isNull() | (F.element_at(tops, F.col("bucket") + 1) == F.col("doc_id"))
    above = F.when(F.col("bucket") == (len(least) - 1 if least else -1), F.lit(lowest)).otherwise(F.col("bucket") + 1)
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("lead"))
    led = F.struct(above.alias("bucket"), F.lit(True).alias("lead"))
    return (
        rows.withColumn("bucket", bucket)
        .withColumn("place", F.explode(F.when(top, F.array(own, led)).otherwise(F.array(own))))
        .select("place.bucket", "place.lead", "doc_id", "text")
    )


_RESULT = "doc_id string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each row beside the next of its bucket; rows come sorted, leads last."""
    held: list[tuple] = []
    for batch in batches:
        new = list(zip(batch["bucket"], batch["lead"], batch["doc_id"], batch["text"]))
        # Of a bucket's leads only the first counts.
        before = held[-1:] + new
        rows = held + [r for p, r in zip(before if held else [None] + new, new) if not (p and p[1] and r[1] and p[0] == r[0])]
        if held and held[-1][1]:
            rows = rows[1:]
        texts = [r[3] for r in rows]
        own = fingerprints(texts)
        pairs = [i for i in range(len(rows) - 1) if not rows[i][1] and rows[i][0] == rows[i + 1][0]]
        changed = [edited(texts[i], texts[i + 1]) for i in pairs]
        marks = fingerprints(changed)
        if pairs:
            yield pd.DataFrame(
                {
                    "doc_id": [rows[i][2] for i in pairs],
                    "n_chars": [len(texts[i]) for i in pairs],
                    "edited_sha256": [hashlib.sha256(c.encode("utf-8", "surrogatepass")).hexdigest() for c in changed],
                    "fingerprint": [own[i] for i in pairs],
                    "edited_fingerprint": marks,
                    "near_edited": likeness([own[i] for i in pairs], marks),
                    "near_next": likeness([own[i] for i in pairs], [own[i + 1] for i in pairs]),
                }
            )
        held = rows[-1:]


def compare_with_next(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every row's fingerprint, and how near it is to its edited text's and the next row's.

    A null text is the empty text, of fingerprint ``3::``.  A null id comes after all
    others.  A row alone is its own next.  No rows give no rows.
    """
    ship(docs.sparkSession)
    placed = with_next(docs, id_column, text_column).withColumn("order", F.col("doc_id"))
    return (
        placed.select("bucket", "lead", F.col("doc_id").cast("string").alias("doc_id"), "text", "order")
        .repartition("bucket")
        .sortWithinPartitions("bucket", "lead", F.desc_nulls_last("order"), "text")
        .drop("order")
        .mapInPandas(_compare, _RESULT)
        .withColumn("doc_id", F.col("doc_id").cast("long"))
    )
