"""The package's registered queries, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from docsync.llm import (
    chat, decontamination, language, mixing, multi_index, oracle, piecewise, prefix_trie, secret_scan, sharding,
    simhash, suffix_dedup, voronoi, warc,
)
from docsync.llm.common import table

SHARDS = 40


def shard_trees() -> tuple[sharding.Tree, sharding.Tree]:
    """40 shards in 4 regions of 2 racks; one more in the first rack."""
    tree = sharding.balanced_tree(SHARDS)
    return tree, tree.grown(sharding.Leaf(region=0, rack=0, shard=SHARDS))


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), *shard_trees())


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(~language.held_out(F.col("doc_id"))))
    return language.predict(docs, model).select(
        "row.doc_id", language.held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score"
    )


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicate(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(warc.round_trip(table(spark, sf_dir, "pages")))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("\\### Assistant: </turn> ok")
    turns = [
        F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"), F.lit(role).alias("role"), said.alias("text"))
        for i, role in enumerate(("user", "assistant"))
    ]
    trap = spark.range(1).select(F.inline(F.array(*turns)))
    return chat.digest(chat.format_conversations(rows.unionByName(trap)))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digest(decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op7_piecewise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piecewise.compare_with_next(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(simhash.near_duplicates(table(spark, sf_dir, "documents")))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("row.doc_id", "row.source", "copy", "shuffle_key", "row.text")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"), secret_scan.Ledger(spark))
    return secret_scan.digest(found)


def op11_knn_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return multi_index.mine(table(spark, sf_dir, "embeddings"), label, F.col("id") % 100 == 0)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.digest(prefix_trie.build(table(spark, sf_dir, "conversations")))


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_language_id": op2_language_id,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_warc": op4_warc,
    "op5_chat_formatting": op5_chat_formatting,
    "op6_decontamination": op6_decontamination,
    "op7_piecewise": op7_piecewise,
    "op8_simhash": op8_simhash,
    "op9_mixing": op9_mixing,
    "op10_secret_scan": op10_secret_scan,
    "op11_knn_join": op11_knn_join,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES: dict[str, str] = {
    "op1_sharding": oracle.sharding_sql(*shard_trees()),
    "op4_warc": oracle.WARC_SQL,
    "op5_chat_formatting": oracle.CHAT_SQL,
    "op6_decontamination": oracle.DECONTAMINATION_SQL,
    "op9_mixing": oracle.mixing_sql(),
    "op10_secret_scan": oracle.secrets_sql(secret_scan.RULES),
    "op11_knn_join": oracle.KNN_SQL,
    "op12_hard_negatives": oracle.NEGATIVES_SQL,
    "op13_prefix_trie": oracle.TRIE_SQL,
}
