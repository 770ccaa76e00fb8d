"""From documents to shards: the stages a corpus goes through.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; its result is written to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from docsync.llm import decontamination, language, mixing, sharding, simhash
from docsync.llm.common import table, written
from docsync.llm.queries import shard_trees


#: A language is told with at least this probability, or the document goes.
LEAST_SCORE = 0.5


def tell_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language can be told; ``und`` and doubtful ones go.

    Null and empty texts, and those without a letter, are ``und``.  Two languages
    equally likely are enough (0.5 each), three are not.  Equal rows stay or go together.
    No rows give no rows.
    """
    model = language.fit(docs.where(~language.held_out(F.col("doc_id"))))
    told = language.predict(docs, model)
    return told.where((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies, the one with the least id.

    Texts that are null or have no words are one group; an id of null is the least
    only among such; of equal rows one stays.  No rows give no rows.
    """
    return simhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which a twentieth or more are passages of the benchmark.

    Null and empty texts have no words and stay; equal rows stay or go together.  No rows give no rows.
    """
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents so that all sources have equal weight, in a global shuffle.

    A null source is a source, a null text is a text of one byte; what repeats are
    whole rows, and a row may be drawn no times.  No rows give no rows.
    """
    return mixing.mix(docs).select("row.*")


def to_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row's shard and slot; null ids and texts and repeated rows get theirs like any other.  No rows give no rows."""
    return sharding.shard(docs, *shard_trees())


STAGES = [
    ("language", tell_language),
    ("near_copies", drop_near_copies),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", to_shards),
]

#: SimHash fingerprints and learned models are beyond SQL; tests/llm compare stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
