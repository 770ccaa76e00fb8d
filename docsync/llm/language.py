"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of 1 to 3 characters by language: each task sums its
documents' counts in arrays and hands over (language, bucket, count) rows, which
Spark adds up; so what is shuffled is bounded by tasks, languages and buckets.
The matrix of log probabilities, at most ``MAX_LANGUAGES * BUCKETS`` floats, is
broadcast, and documents are scored in numpy batch by batch: only the n-grams a
text has are looked up, and a long text is scored in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from docsync.llm.common import ship

#: Buckets of hashed n-grams; a power of two.
BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
#: More languages than this are refused: the matrix is broadcast (64 MB at most).
MAX_LANGUAGES = 512
#: Characters worked on at once.
BLOCK = 1 << 19
#: Added to every count.
SMOOTHING = 0.5
UNDETERMINED = "und"

_SPACE = 32


@cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _codes(text: str) -> np.ndarray:
    """The text's code points, lower-cased, all that is no letter a space."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(_letters()[codes], codes, np.uint32(_SPACE))


def _buckets(codes: np.ndarray, order: int) -> np.ndarray:
    """The bucket of the n-gram that starts at each position; BUCKETS for blanks."""
    n = len(codes) - order + 1
    h = np.full(n, order, np.uint64)
    blank = np.ones(n, bool)
    for i in range(order):
        part = codes[i : i + n]
        h = (h ^ part) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        blank &= part == _SPACE
    h = (h & np.uint64(BUCKETS - 1)).astype(np.int32)
    h[blank] = BUCKETS
    return h


def _blocks(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(documents, starts, codes): texts in pieces of at most BLOCK characters.

    A piece begins and ends with two spaces, so an n-gram that reaches into the next
    piece is blank.  A long text's pieces share two characters, so none of its
    trigrams is lost; at such a seam those two count twice.
    """
    documents: list[int] = []
    pieces: list[np.ndarray] = []
    held = 0
    edge = np.array([_SPACE, _SPACE], np.uint32)

    def flush():
        starts = np.cumsum([0, *[len(p) for p in pieces[:-1]]])
        return np.array(documents), starts, np.concatenate(pieces)

    for i, text in enumerate(texts):
        if not text:
            continue
        for at in range(0, len(text), BLOCK):
            piece = np.concatenate([edge, _codes(text[max(0, at - 2) : at + BLOCK]), edge])
            if held and held + len(piece) > BLOCK:
                yield flush()
                documents, pieces, held = [], [], 0
            documents.append(i)
            pieces.append(piece)
            held += len(piece)
    if pieces:
        yield flush()


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, group in batch.groupby("lang", sort=False):
            total = counts.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
            for _, _, codes in _blocks(group["text"].tolist()):
                for order in ORDERS:
                    total += np.bincount(_buckets(codes, order), minlength=BUCKETS + 1)
    for lang, total in counts.items():
        seen = np.flatnonzero(total[:BUCKETS])
        yield pd.DataFrame({"lang": lang, "bucket": seen.astype(np.int32), "n": total[seen]})


class Model:
    """Languages and their matrix: a row a bucket, a last row of zeros for blanks."""

    def __init__(self, languages: list[str], log_probability: np.ndarray):
        self.languages, self.log_probability = languages, log_probability


def fit(docs: DataFrame, lang_column: str = "lang", text_column: str = "text") -> Model:
    """Learn from every row whose language is not null.

    Rows with a null or empty text teach that the language exists, no more.
    Priors are equal: how common a language is doesn't sway a prediction.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(lang_column).cast("string").alias("lang"), F.col(text_column).alias("text")).where("lang IS NOT NULL")
    # All languages, those without letters included, before n-grams are counted.
    languages = [r[0] for r in rows.select("lang").distinct().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()]
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    sums = rows.mapInPandas(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = sums.toPandas()  # at most languages times buckets
    counts = np.zeros((BUCKETS, len(languages)))
    if len(got):
        place = {lang: i for i, lang in enumerate(languages)}
        counts[got["bucket"].to_numpy(), got["lang"].map(place).to_numpy()] = got["n"].to_numpy()
    counts += SMOOTHING
    matrix = np.zeros((BUCKETS + 1, max(1, len(languages))), np.float32)
    if languages:
        matrix[:BUCKETS] = np.log(counts / counts.sum(axis=0))
    return Model(languages, matrix)


def _score(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    sums = np.zeros((len(texts), model.log_probability.shape[1]))
    letters = np.zeros(len(texts), bool)
    for documents, starts, codes in _blocks(texts):
        has = np.add.reduceat((codes != _SPACE).astype(np.int64), starts) > 0
        np.logical_or.at(letters, documents, has)
        for order in ORDERS:
            buckets = np.full(len(codes), BUCKETS, np.int32)
            buckets[: len(codes) - order + 1] = _buckets(codes, order)
            np.add.at(sums, documents, np.add.reduceat(model.log_probability[buckets], starts, axis=0, dtype=np.float64))
    if not model.languages:
        letters[:] = False
    best = sums.argmax(axis=1)
    score = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
    names = [model.languages[b] if ok else UNDETERMINED for b, ok in zip(best, letters)]
    return names, np.where(letters, score, 0.0)


def predict(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """(row, lang_pred, score): every row, ``row`` holding all its columns.

    ``und`` with score 0 if the text is null or has no letter, or if nothing was
    learned; else the likeliest language and its posterior probability.  Of equal
    likelihoods the language first by name wins.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            names, score = _score(shared.value, texts.tolist())
            yield pd.DataFrame({"lang_pred": names, "score": score})

    return docs.select(F.struct("*").alias("row"), scored(F.col(text_column)).alias("p")).select("row", "p.lang_pred", "p.score")


def held_out(id_column: Column) -> Column:
    """Whether a document is kept from training: CRC-32 of its id, modulo 4, is 2."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))
