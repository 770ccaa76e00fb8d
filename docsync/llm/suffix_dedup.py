"""Removal of repeated byte strings by bucket refinement of sampled suffixes.

A position starts a repeat if the 200 bytes from it start elsewhere too.  As in
bucket-pointer refinement, suffixes are first put into buckets by their q-gram
(50 bytes), and a bucket is refined by the identifiers of its suffixes' later
offsets: the identifier of 2q bytes is made of those at offsets 0 and q, the one of
4q bytes of those of 2q bytes at 0 and 2q.  Identifiers are hashes, so a
refinement needs no renumbering; a bucket of one suffix is finished and dropped.

Only chosen suffixes are put into buckets at first: of each 200 bytes the
suffix, among the 151 whose q-gram lies inside, with the least identifier.
What is chosen depends on the 200 bytes alone, so equal strings meet in a bucket.
All positions with the same choice form an *interval*.

1. Intervals are dealt by their suffix's bucket.  Within a bucket, intervals of
   equal content from first to last byte are a class: a class of two or more is
   repeated as a whole.  A bucket with a single class is finished.
2. Where a bucket has several classes, one interval of each is cut into blocks of 16
   positions, counted from the suffix, and refined: first to the 185 bytes that all
   positions of a block share (its new bucket), then to the 215 bytes they cover (its class).
3. What several classes share after that is refined to each position's 200 bytes.
4. Repeats are gathered by document and cut out of its bytes.

Equal intervals of one batch of documents become one row before the shuffle, so
any number of copies weighs as much as the number of batches they are in.
Sorted rows are read as a stream; no bucket is held in memory.  Texts are written
once, bucketed by document, and later steps join them without a shuffle.

Strings count as equal if 128 bits (intervals) or 96 bits (positions) of hashes agree.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from docsync.llm.common import ship, written

Q = 50
LENGTH = 4 * Q
#: Suffixes whose q-gram lies in the 200 bytes from a position.
CHOICE = LENGTH - Q + 1
#: Bytes hashed at once: places in a chunk take 21 bits.
CHUNK = 1 << 20
#: Positions refined together.
BLOCK = 16
_BASE = 0x9E3779B97F4A7C15 | 1
_PLACE = np.uint64((1 << 21) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number for each byte; powers of the base and of its inverse."""
    size = 2 * CHUNK + LENGTH + 1
    up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE)), np.multiply.accumulate(up), np.multiply.accumulate(down)


def _sums(data: np.ndarray) -> np.ndarray:
    numbers, up, _ = _tables()
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(numbers[data] * up[: len(data)], out=out[1:])
    return out


def _grams(sums: np.ndarray, length: int) -> np.ndarray:
    """The hash of the string of ``length`` bytes at each place."""
    n = len(sums) - length
    if n <= 0:
        return np.zeros(0, np.uint64)
    return (sums[length:] - sums[:n]) * _tables()[2][:n]


def _refined(ids: np.ndarray, later: np.ndarray) -> np.ndarray:
    """Identifiers of twice the depth, from those of a place and of its later offset."""
    return _mix(ids * np.uint64(3) + _mix(later + np.uint64(1)))


def _pieces(texts: list[bytes]) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """(pieces, text of each, where it begins in it): texts of 200 bytes or more, in
    chunks.  Pieces of a long text share 199 bytes, so each position is in one of them."""
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def flush():
        return [h[2] for h in held], np.array([h[0] for h in held]), np.array([h[1] for h in held])

    for i, text in enumerate(texts):
        for at in range(0, len(text) - LENGTH + 1, CHUNK - LENGTH + 1):
            piece = text[at : at + CHUNK]
            if held and size + len(piece) > CHUNK:
                yield flush()
                held, size = [], 0
            held.append((i, at, piece))
            size += len(piece)
    if held:
        yield flush()


def intervals(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text, first, last, suffix, bucket, content) of all intervals: every position
    that begins 200 bytes of a text is in one."""
    out: list[tuple[np.ndarray, ...]] = []
    for pieces, which, begin in _pieces(texts):
        data = np.frombuffer(b"".join(pieces), np.uint8)
        lengths = np.array([len(p) for p in pieces])
        starts = np.cumsum(lengths) - lengths
        sums = _sums(data)
        ids = _mix(_grams(sums, Q))
        n = len(data) - LENGTH + 1
        key = (ids & ~_PLACE) | np.arange(len(ids), dtype=np.uint64)
        # The least key of CHOICE neighbours: of two blocks, the one's end and the other's beginning.
        blocks = -(-len(key) // CHOICE)
        padded = np.full(blocks * CHOICE, ~np.uint64(0))
        padded[: len(key)] = key
        padded = padded.reshape(blocks, CHOICE)
        ahead = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
        behind = np.minimum.accumulate(padded, axis=1).ravel()
        chosen = (np.minimum(ahead[:n], behind[CHOICE - 1 : CHOICE - 1 + n]) & _PLACE).astype(np.int64)
        piece = np.repeat(np.arange(len(pieces)), lengths)[:n]
        place = np.flatnonzero(np.arange(n) <= (starts + lengths - LENGTH)[piece])
        cut = np.flatnonzero((np.diff(chosen[place]) != 0) | (np.diff(piece[place]) != 0)) + 1
        first, last = place[np.concatenate([[0], cut])], place[np.concatenate([cut - 1, [len(place) - 1]])]
        content = _spanned(sums, first, last + LENGTH)
        p = piece[first]
        shift = begin[p] - starts[p]
        suffix = chosen[first]
        out.append((which[p], first + shift, last + shift, suffix + shift, ids[suffix].view(np.int64), content.view(np.int64)))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else tuple(np.zeros(0, np.int64) for _ in range(6))


def _spanned(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The hash of the bytes from start to stop, their number mixed in."""
    return _mix(_mix((sums[stop] - sums[start]) * _tables()[2][start]) + (stop - start).astype(np.uint64))


def blocks(text: bytes, first: np.ndarray, last: np.ndarray, suffix: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first, last, suffix, bucket, content) of the blocks that intervals of one text touch.

    A block counts positions back from its suffix, so equal strings are cut alike.  One
    that a text's end cuts short has a content of its own, which only an equal text shares.
    """
    low, high = (suffix - last) // BLOCK, (suffix - first) // BLOCK
    number = high - low + 1
    of = np.repeat(np.arange(len(first)), number)
    which = np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number) + low[of]
    suffix, which = np.unique(np.stack([suffix[of], which], axis=1), axis=0).T
    stop_at = suffix - which * BLOCK  # the block's last position, if the text has it
    start_at = stop_at - BLOCK + 1
    own = np.uint64(xxhash.xxh64_intdigest(text))
    out = []
    for base, keep in _bases(text, start_at, stop_at + LENGTH):
        a, b, s = start_at[keep], stop_at[keep], suffix[keep]
        sums = _sums(np.frombuffer(text[base : base + 2 * CHUNK], np.uint8))
        bucket = _mix(_spanned(sums, b - base, a + LENGTH - base) + (s - b).astype(np.uint64))
        whole = (a >= 0) & (b + LENGTH <= len(text))
        inside = _spanned(sums, np.where(whole, a - base, 0), np.where(whole, b + LENGTH - base, 0))
        alone = _mix(_mix(bucket + own) + a.astype(np.uint64))
        content = np.where(whole, inside, alone)
        out.append((np.maximum(a, 0), np.minimum(b, len(text) - LENGTH), s, bucket.view(np.int64), content.view(np.int64)))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else tuple(np.zeros(0, np.int64) for _ in range(5))


def _bases(text: bytes, start: np.ndarray, stop: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Stretches of a text of at most two chunks, and the strings that lie in each."""
    step = np.maximum(start, 0) // CHUNK
    for s in np.unique(step):
        yield int(s) * CHUNK, np.flatnonzero(step == s)


def positions(text: bytes, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, identifier, check) of all positions from firsts to lasts, each once."""
    number = last - first + 1
    place = np.unique(np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number) + np.repeat(first, number))
    out = []
    for base, keep in _bases(text, place, place + LENGTH):
        at = place[keep] - base
        sums = _sums(np.frombuffer(text[base : base + CHUNK + LENGTH], np.uint8))
        down = _tables()[2]
        gram = lambda o: _mix((sums[at + o + Q] - sums[at + o]) * down[at + o])  # noqa: E731, B023
        pairs = [_refined(gram(o), gram(o + Q)) for o in (0, 2 * Q)]
        check = ((sums[at + LENGTH] - sums[at]) * down[at] >> np.uint64(32)).astype(np.uint32).view(np.int32)
        out.append((place[keep], _refined(*pairs).view(np.int64), check))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else tuple(np.zeros(0, np.int64) for _ in range(3))


# ------------------------------------------------------------------ on Spark

#: ``n``: 0 a repeat found (first to last position), 1 an interval, 2 one of several equal ones.
_ROW = "bucket long, content long, n int, id long, th int, first int, last int, suffix int"
_COLUMNS = ["bucket", "content", "n", "id", "th", "first", "last", "suffix"]


def _collapsed(bucket, content, id_, th, first, last, suffix) -> pd.DataFrame:
    """Rows for the shuffle: of equal intervals one (n = 2), all of them found (n = 0)."""
    order = np.lexsort((content, bucket))
    same = (np.diff(bucket[order]) == 0) & (np.diff(content[order]) == 0)
    repeated = np.zeros(len(order), bool)
    repeated[order[1:]] = same
    later = repeated.copy()
    repeated[order[:-1]] |= same
    table = pd.DataFrame(dict(zip(_COLUMNS, (bucket, content, np.where(repeated, 2, 1).astype(np.int32), id_, th, first, last, suffix))))
    found = table[repeated].assign(n=np.int32(0))
    # Found rows go anywhere: each by its own place.
    found["bucket"], found["content"] = found["id"] * 31 + found["first"], 0
    return pd.concat([table[~later], found])


def _whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = [t.encode("utf-8", "surrogatepass") for t in batch["text"]]
        which, first, last, suffix, bucket, content = intervals(texts)
        if len(which):
            yield _collapsed(bucket, content, batch["id"].to_numpy()[which], batch["th"].to_numpy()[which], first, last, suffix)


def _requested(cut):
    """Rows for the intervals asked of each text; ``cut`` takes (text, first, last, suffix)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for id_, th, text, asked in zip(batch["id"], batch["th"], batch["text"], batch["asked"]):
                table = np.array([(a["first"], a["last"], a["suffix"]) for a in asked], np.int64).reshape(-1, 3)
                got = cut(text.encode("utf-8", "surrogatepass"), *table.T)
                n = len(got[0])
                parts.append((np.full(n, id_, np.int64), np.full(n, th, np.int32), *got))
            if parts:
                id_, th, first, last, suffix, bucket, content = (np.concatenate(x) for x in zip(*parts))
                yield _collapsed(bucket, content, id_, th, first, last, suffix)

    return run


def _single(text: bytes, first: np.ndarray, last: np.ndarray, suffix: np.ndarray) -> tuple[np.ndarray, ...]:
    place, ids, check = positions(text, first, last)
    return place, place, place, ids, check.astype(np.int64)


def _refine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by bucket and content: repeats (n = 0), and of buckets with several
    classes one interval of each to be refined (n = 1).  The state is two rows."""
    bucket = content = None
    lone = asked = None  # the class's row if it is alone so far; the bucket's first row if not yet asked for
    several = False
    for batch in batches:
        out: list[tuple] = []
        for row in zip(*(batch[c].tolist() for c in _COLUMNS)):
            b, c, n, *place = row
            if n == 0:
                out.append((0, *place))
                continue
            if b != bucket:
                bucket, content, several = b, c, False
                lone, asked = (place if n == 1 else None), place
            elif c != content:
                content = c
                if not several:
                    several = True
                    out.append((1, *asked))
                out.append((1, *place))
                lone = place if n == 1 else None
            else:
                if lone is not None:
                    out.append((0, *lone))
                    lone = None
                if n == 1:
                    out.append((0, *place))
        if out:
            yield pd.DataFrame(out, columns=_COLUMNS[2:])


_FOUND = "n int, id long, th int, first int, last int, suffix int"


def _dealt(rows: DataFrame, purpose: str) -> DataFrame:
    return written(rows.repartition("bucket").sortWithinPartitions("bucket", "content").mapInPandas(_refine, _FOUND), purpose)


def _cut_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for text, spans in zip(batch["text"], batch["spans"]):
            data = text.encode("utf-8", "surrogatepass")
            if spans is None or not len(spans):
                out.append((len(data), 0, 0, hashlib.sha256(data).hexdigest()))
                continue
            ranges = sorted((s["first"], s["last"] + LENGTH) for s in spans)
            kept, removed, runs, end = hashlib.sha256(), 0, 0, 0
            start, stop = ranges[0]
            for a, b in [*ranges[1:], (len(data) + 1, 0)]:
                if a <= stop:
                    stop = max(stop, b)
                    continue
                kept.update(data[end:start])
                removed, runs, end = removed + stop - start, runs + 1, stop
                start, stop = a, b
            kept.update(data[end:])
            out.append((len(data), removed, runs, kept.hexdigest()))
        result = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])
        yield pd.concat([batch[["doc_id"]].reset_index(drop=True), result], axis=1)


#: Stands for a null id in joins.
_NO_ID = -(1 << 63)


def _stored(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """All texts in a table bucketed by document."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_column), F.lit(""))
    id_ = F.coalesce(F.col(id_column).cast("long"), F.lit(_NO_ID))
    rows = docs.select(id_.alias("id"), F.hash(text).alias("th"), F.col(id_column).cast("string").alias("doc_id"), text.alias("text"))
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = "docsync_texts_" + uuid.uuid4().hex
    # By both columns of the joins to come: Spark asks for all keys to leave a side where it is.
    rows.repartition(count, "id", "th").write.bucketBy(count, "id", "th").saveAsTable(name)
    return spark.table(name)


def _asking(texts: DataFrame, found: DataFrame) -> DataFrame:
    """Texts of which intervals are to be refined, with the intervals."""
    asked = (
        found.where("n = 1")
        .groupBy("id", "th")
        .agg(F.collect_list(F.struct("first", "last", "suffix")).alias("asked"))
    )
    return texts.join(asked, ["id", "th"]).select("id", "th", "text", "asked")


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row.

    A null text is empty; texts of fewer than 200 bytes keep all.  Repeated rows
    repeat each other's strings.  A null id is kept as null.  No rows give no rows.
    """
    ship(docs.sparkSession)
    texts = _stored(docs, id_column, text_column)
    one = _dealt(texts.select("id", "th", "text").mapInPandas(_whole, _ROW), "intervals")
    two = _dealt(_asking(texts, one).mapInPandas(_requested(blocks), _ROW), "blocks")
    three = _dealt(_asking(texts, two).mapInPandas(_requested(_single), _ROW), "positions")
    repeats = one.unionByName(two).unionByName(three).where("n = 0")
    spans = repeats.groupBy("id", "th").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    return (
        texts.join(spans, ["id", "th"], "left")
        .select("doc_id", "text", "spans")
        .mapInPandas(_cut_out, "doc_id string, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
        .withColumn("doc_id", F.col("doc_id").cast("long"))
    )
