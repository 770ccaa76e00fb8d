"""Small tables and plain replays of the operators."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, extra: bool = False):
    """Documents from (doc_id, text[, lang[, source]]); ``extra`` adds columns
    named like those the operators make."""
    whole = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
    schema = DOCS
    if extra:
        names = ["shard", "slot", "fp", "row", "found", "score", "text_hash", "copy", "blob", "bucket", "id", "th", "key", "n"]
        whole = [(*w, *[str(i) for i in range(len(names))]) for w in whole]
        schema += "".join(f", {n} string" for n in names)
    return spark.createDataFrame(whole, schema).repartition(3)


def words(rng: random.Random, vocabulary: list[str], n: int) -> str:
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def vocabulary(rng: random.Random, n: int = 200, letters: str = "abcdefgé") -> list[str]:
    return ["".join(rng.choice(letters) for _ in range(rng.randint(1, 8))) for _ in range(n)]


ODD = [
    (None, "a b c d e"), (None, None), (1, None), (2, ""), (3, " \t\n"), (4, "x"), (5, "x"), (5, "x"), (6, "\u00e9t\u00e9 \U0001f600 na\u00efve"),
    (7, "Hello World " * 300), (8, "1234 5678 !!"), (9, "\u00e9" * 5000),
]
