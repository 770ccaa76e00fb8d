"""Benchmark decontamination over a distributed positional inverted index.

The index is split by documents, as an index of many shards is: a row a document,
with its postings of every word that some test text has, sorted by term, then
position.  It is built in one pass over the texts and stored in the shared
folder; all else reads the index alone.

How rare a term is comes from the lengths of its posting lists over the whole
corpus.  A window of test words is looked for from its rarest terms: the list of
the rarest is shifted by the term's offset in the window and intersected with
the shifted list of the next rarest; what is left is compared word by word,
from the postings.  Postings are intersected where their document is, so a
term, source or passage that fills a third of the corpus moves nothing.

The test texts are broadcast in blocks of at most ``BLOCK_BYTES``, an index each.

Proximity: an item is *near* a document where the two rarest terms of one of
its windows stand within ``slop`` words of each other, in whatever order.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from docsync.llm.common import ship, written

WINDOW = 13
SLOP = 16
#: Contaminated: hit words times this are at least the document's words.
SHARE = 20
#: UTF-8 bytes of test texts in a broadcast block.
BLOCK_BYTES = 8 << 20
#: Words indexed at once.
BATCH_WORDS = 1 << 20

#: Words of a lower-cased text as bytes: UTF-8 bytes past ASCII are all word
#: characters, so this equals ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` on characters.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    """A-Z lower-cased; bytes.lower() leaves all but ASCII alone."""
    return _WORD.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


@dataclass
class Block:
    """Windows of some test items; words are numbers in ``vocabulary``."""

    vocabulary: dict[bytes, int] = field(default_factory=dict)
    #: By length of window: the windows' words (a row each) and their items.
    windows: dict[int, np.ndarray] = field(default_factory=dict)
    items: dict[int, list[tuple[int, ...]]] = field(default_factory=dict)
    names: list[str] = field(default_factory=list)

    @classmethod
    def of(cls, rows: Iterable[tuple[str, str | None]], window: int = WINDOW) -> Block:
        block, found = cls(), {}
        for number, (name, text) in enumerate(rows):
            block.names.append(name)
            ids = [block.vocabulary.setdefault(w, len(block.vocabulary)) for w in words_of(text)]
            n = min(window, len(ids))
            for i in range(len(ids) - n + 1 if n else 0):
                found.setdefault(n, {}).setdefault(tuple(ids[i : i + n]), set()).add(number)
        for n, by_words in found.items():
            block.windows[n] = np.array(list(by_words), np.int32)
            block.items[n] = [tuple(sorted(x)) for x in by_words.values()]
        return block

    def anchored(self, counts: np.ndarray) -> Searcher:
        """Each window's two rarest places, by the words' counts in the corpus."""
        places = {n: np.argsort(counts[w], axis=1, kind="stable")[:, :2] for n, w in self.windows.items()}
        return Searcher(self, places)


@dataclass
class Searcher:
    block: Block
    places: dict[int, np.ndarray]

    def search(self, ids: np.ndarray, document: np.ndarray, slop: int) -> tuple[np.ndarray, set, set]:
        """Of a batch's words: which are hit, and pairs (document, item) of exact
        and of near matches.  ``ids`` are -1 for words no test text has."""
        hit = np.zeros(len(ids) + 1, np.int32)
        exact: set[tuple[int, int]] = set()
        near: set[tuple[int, int]] = set()
        # Postings: positions sorted by term.
        known = np.flatnonzero(ids >= 0)
        order = known[np.argsort(ids[known], kind="stable")]
        starts = np.searchsorted(ids[order], np.arange(len(self.block.vocabulary) + 1))
        for n, windows in self.block.windows.items():
            place = self.places[n]
            each = np.arange(len(windows))
            rare = windows[each, place[:, 0]]
            have = starts[rare + 1] - starts[rare]
            which = np.repeat(each, have)
            if not len(which):
                continue
            first = np.repeat(starts[rare], have) + np.arange(len(which)) - np.repeat(np.cumsum(have) - have, have)
            position = order[first]
            second = place[which, 1] if n > 1 else place[which, 0]
            second_word = windows[which, second]
            # Proximity: a posting of the second term at most ``slop`` away.  Keys
            # of (term, position) are sorted like the postings themselves.
            size = np.int64(len(ids) + slop + 2)
            keys = ids[order].astype(np.int64) * size + order
            begin = np.searchsorted(document, document[position])
            low = np.searchsorted(keys, second_word * size + np.maximum(position - slop, begin))
            low_ok = low < len(keys)
            reach = np.where(low_ok, keys[np.minimum(low, len(keys) - 1)], -1)
            close = low_ok & (reach // size == second_word) & (reach % size <= position + slop)
            close &= document[np.where(close, reach % size, 0)] == document[position]
            for w, p in zip(which[close], position[close]):
                near.update((int(document[p]), item) for item in self.block.items[n][w])
            # Exact: intersect the offset-adjusted lists, then compare all words.
            start = position - place[which, 0]
            ok = (start >= 0) & (start + n <= len(ids))
            which, start, second, second_word = which[ok], start[ok], second[ok], second_word[ok]
            ok = ids[start + second] == second_word
            which, start = which[ok], start[ok]
            if not len(which):
                continue
            ok = document[start] == document[start + n - 1]
            for i in range(n):
                ok &= ids[start + i] == windows[which, i]
            for w, s in zip(which[ok], start[ok]):
                exact.update((int(document[s]), item) for item in self.block.items[n][w])
            np.add.at(hit, start[ok], 1)
            np.add.at(hit, start[ok] + n, -1)
        return np.cumsum(hit[:-1]) > 0, exact, near


def blocks_of(benchmark: DataFrame, item_column: str = "item_id", text_column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The test items in blocks of bounded size, fetched row by row."""
    rows = benchmark.select(F.col(item_column).cast("string").alias("item"), F.col(text_column).alias("text"))
    held: list[tuple[str, str | None]] = []
    size = 0
    for row in rows.toLocalIterator():
        n = len(row.text.encode("utf-8", "surrogatepass")) if row.text else 0
        if held and size + n > limit:
            yield Block.of(held)
            held, size = [], 0
        held.append((row.item if row.item is not None else "null", row.text))
        size += n
    if held:
        yield Block.of(held)


def build_index(docs: DataFrame, block: Block, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text_hash, n_words, terms, positions) of every row, stored: the
    postings of the block's words, by term."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(block.vocabulary)

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = shared.value.get
        for batch in batches:
            lengths, terms, positions, words = [], [], [], []
            for text in batch.column("text").to_pylist():
                ids = np.array([get(w, -1) for w in words_of(text)], np.int32)
                at = np.flatnonzero(ids >= 0)
                at = at[np.argsort(ids[at], kind="stable")]
                words.append(len(ids))
                lengths.append(len(at))
                terms.append(ids[at])
                positions.append(at.astype(np.int32))
            offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x) if x else np.zeros(0, np.int32))) for x in (terms, positions)]
            columns = [batch.column("doc_id"), batch.column("text_hash"), pa.array(words, pa.int64()), *lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n_words", "terms", "positions"])

    rows = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(F.col(text_column)).alias("text_hash"), F.col(text_column).alias("text"))
    long, ints = T.LongType(), T.ArrayType(T.IntegerType())
    fields = [("doc_id", rows.schema["doc_id"].dataType), ("text_hash", long), ("n_words", long), ("terms", ints), ("positions", ints)]
    return written(rows.mapInArrow(postings, T.StructType([T.StructField(n, kind) for n, kind in fields])), "postings")


def corpus_counts(index: DataFrame, block: Block) -> np.ndarray:
    """The length of each term's posting list over the whole index."""
    size = len(block.vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["word", "n"])

    sums = index.select("terms").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(size, np.int64)
    counts[sums["word"].to_numpy(np.int64)] = sums["n"].to_numpy(np.int64)
    return counts


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2])]


def _search_rows(searcher: Searcher, rows: Iterable[tuple[int, np.ndarray, np.ndarray]], slop: int) -> Iterator[tuple[list, list[str], list[str]]]:
    """Per row of the index (number of words, terms, positions): hit runs, items, near items."""
    names = searcher.block.names

    def batch(lists: list[np.ndarray]):
        lengths = [len(x) for x in lists]
        ids = np.concatenate(lists) if lists else np.zeros(0, np.int32)
        flags, exact, near = searcher.search(ids, np.repeat(np.arange(len(lists)), lengths), slop) if len(ids) else (np.zeros(0, bool), set(), set())
        of: dict[int, list[str]] = {}
        close: dict[int, list[str]] = {}
        for pairs, into in ((exact, of), (near, close)):
            for d, item in pairs:
                into.setdefault(d, []).append(names[item])
        at = 0
        for d, n in enumerate(lengths):
            yield _runs(flags[at : at + n]) if d in of else [], sorted(set(of.get(d, ()))), sorted(set(close.get(d, ())))
            at += n

    held: list[np.ndarray] = []
    size = 0
    for n, terms, positions in rows:
        ids = np.full(n, -1, np.int32)
        ids[positions] = terms
        held.append(ids)
        size += n
        if size >= BATCH_WORDS:
            yield from batch(held)
            held, size = [], 0
    yield from batch(held)


def _searched(index: DataFrame, searcher: Searcher, slop: int) -> DataFrame:
    shared = index.sparkSession.sparkContext.broadcast(searcher)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, positions = batch.column("terms"), batch.column("positions")
            ends = terms.offsets.to_numpy()
            flat = [x.values.to_numpy() for x in (terms, positions)]
            rows = ((n, flat[0][a:b], flat[1][a:b]) for n, a, b in zip(batch.column("n_words").to_pylist(), ends[:-1], ends[1:]))
            found = list(_search_rows(shared.value, rows, slop))
            hits = pa.array([[{"start": a, "stop": b} for a, b in r[0]] for r in found], pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))
            told = [pa.array([r[i] for r in found], pa.list_(pa.string())) for i in (1, 2)]
            columns = [batch.column("doc_id"), batch.column("text_hash"), batch.column("n_words"), hits, *told]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n_words", "hit", "items", "near"])

    kind = index.schema["doc_id"].dataType.simpleString()
    return index.mapInArrow(search, f"doc_id {kind}, text_hash long, n_words long, hit array<struct<start:int,stop:int>>, items array<string>, near array<string>")


def find(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", slop: int = SLOP) -> DataFrame:
    """(doc_id, text_hash, n_words, hit, items, near) of every row: hit runs of
    words, items with occurring windows, near items.

    A null or wordless text has no words and no hits; a null or wordless item has
    no windows.  Repeated items each count; a null item_id is called ``null``.
    Rows repeated are found alike.  Without items, or without documents, nothing is hit.
    """
    found = []
    for block in blocks_of(benchmark):
        index = build_index(docs, block, id_column, text_column)
        found.append(_searched(index, block.anchored(corpus_counts(index, block)), slop))
    if not found:
        index = build_index(docs, Block(), id_column, text_column)
        found.append(_searched(index, Block().anchored(np.zeros(0, np.int64)), slop))
    if len(found) == 1:
        return found[0]
    # Blocks meet by document; rows repeated get their own again.
    keys = ["doc_id", "text_hash"]
    every = reduce(DataFrame.unionByName, found)
    one = every.groupBy(*keys).agg(
        F.max("n_words").alias("n_words"),
        _joined(F.flatten(F.collect_list("hit"))).alias("hit"),
        *[F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("items", "near")],
    )
    one = written(one, "found").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "n_words", "hit", "items", "near")
    rows = found[0].select(*keys)
    same = rows["doc_id"].eqNullSafe(one["_id"]) & (rows["text_hash"] == one["_hash"])
    return rows.join(one, same).drop("_id", "_hash")


def clean(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` without the contaminated ones."""
    found = find(docs, benchmark, id_column, text_column)
    bad = written(found.where(contaminated()).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "contaminated")
    rows = docs.select(F.struct("*").alias("row"), F.col(id_column).alias("doc_id"), F.xxhash64(F.col(text_column)).alias("text_hash"))
    return rows.join(bad, rows["doc_id"].eqNullSafe(bad["_id"]) & (rows["text_hash"] == bad["_hash"]), "left_anti").select("row.*")


def _joined(runs: Column) -> Column:
    """Runs of several blocks: those that meet or overlap become one."""
    return F.aggregate(
        F.array_sort(runs),
        F.array().cast("array<struct<start:int,stop:int>>"),
        lambda acc, r: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["stop"] >= r["start"]),
            F.concat(
                F.slice(acc, F.lit(1), F.size(acc) - 1),
                F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["stop"], r["stop"]).alias("stop"))),
            ),
        ).otherwise(F.concat(acc, F.array(r))),
    )


def n_hit() -> Column:
    return F.aggregate("hit", F.lit(0).cast("long"), lambda acc, r: acc + (r["stop"] - r["start"]))


def contaminated() -> Column:
    return (n_hit() > 0) & (n_hit() * SHARE >= F.col("n_words"))


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id",
        "n_words",
        n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )
