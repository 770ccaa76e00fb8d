"""Secret scans over an incremental blob ledger.

Every version of a text is a blob named by its SHA-256.  The ledger holds, for
each blob and version of the rules, what was found in it (nothing is an entry
too).  A scan makes the texts distinct inside tasks and then by shuffle, drops
those the ledger has under the rules' version, looks through the rest, appends
them to the ledger, and joins the ledger back to all paths.  So a text is
scanned once for each rules' version, however many paths or commits hold it.

Rules run as regular expressions inside Spark.  Positions come from the pieces
between matches: a match starts after the pieces and matches before it.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docsync.llm.common import running, shared_folder, written

LEDGER_SCHEMA = "blob string, rules string, spans array<struct<kind:string,start:long,end:long>>"


@dataclass(frozen=True)
class Rule:
    """``keep`` counts the characters a match (or its ``group``) needs; every text
    with a match has one of ``hints`` in it, lower-cased."""

    kind: str
    pattern: str
    keep: int
    group: int = 0
    hints: tuple[str, ...] = ()


#: The kinds in the order in which findings are told.  ``{n,}`` is used where
#: dropping short matches afterwards would give the same.
RULES = (
    Rule(
        "assign",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        12,
        1,
        ("passw", "secret", "token", "key"),
    ),
    Rule("access", r"AKIA[A-Z0-9]{14,}", 18, 0, ("akia",)),
    Rule("hex", r"[0-9a-f]{16,}", 16),
)


def rules_version(rules: tuple[Rule, ...]) -> str:
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


SPANS = "array<struct<kind:string,start:long,end:long>>"


def _with_spans(texts: DataFrame, rule: Rule) -> DataFrame:
    """``texts (text, lowered, ...)`` with the rule's findings, in order of position, in a
    column of its kind's name.  Where there are none the rule is not run at all."""
    maybe = F.lit(True)
    if rule.hints:
        maybe = F.lit(False)
        for hint in rule.hints:
            maybe = maybe | F.contains("lowered", F.lit(hint))
    found, text = f"_{rule.kind}", F.col("text")
    pieces = F.zip_with(
        F.zip_with(
            F.split(text, rule.pattern, -1), F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)),
            lambda a, b: F.struct(F.length(a).alias("before"), F.length(b).alias("n")),
        ),
        F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)), lambda m: F.length(m)),
        lambda a, k: F.struct((a["before"] + F.coalesce(a["n"], F.lit(0))).cast("long").alias("size"), a["n"].alias("n"), k.alias("k")),
    )
    none = F.array().cast("array<struct<size:bigint,n:int,k:int>>")
    told = texts.withColumn(found, F.when(maybe & text.rlike(rule.pattern), pieces).otherwise(none))
    ends = running(F.transform(found, lambda p: p["size"]))
    spans = F.transform(
        F.filter(F.zip_with(found, ends, lambda p, end: F.struct(p["n"].alias("n"), p["k"].alias("k"), end.alias("end"))), lambda x: x["k"] >= rule.keep),
        lambda x: F.struct(F.lit(rule.kind).alias("kind"), (x["end"] - x["n"]).alias("start"), x["end"].alias("end")),
    )
    return told.withColumn(rule.kind, spans.cast(SPANS)).drop(found)


def find_spans(texts: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, rules, spans) of each row (blob, text)."""
    told = texts.withColumn("lowered", F.lower("text"))
    for rule in rules:
        told = _with_spans(told, rule)
    return told.select("blob", F.lit(rules_version(rules)).alias("rules"), F.concat(*[F.col(r.kind) for r in rules]).alias("spans"))


class Ledger:
    """Findings by blob and rules' version, in a folder all executors share.

    Each scan appends whole Parquet files by Spark's committer; a scan that is
    repeated after a failure finds its blobs unseen and adds them once more, so
    readers take one entry for each pair.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or shared_folder(spark, "ledger")
        self.started = folder is not None

    def read(self, version: str) -> DataFrame:
        if not self.started:
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return self.spark.read.schema(LEDGER_SCHEMA).parquet(self.folder).where(F.col("rules") == version)

    def append(self, entries: DataFrame) -> None:
        entries.write.mode("append").parquet(self.folder)
        self.started = True


def scan(
    docs: DataFrame,
    ledger: Ledger,
    rules: tuple[Rule, ...] = RULES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, blob, spans) of every row of ``docs``; the ledger learns new blobs.

    A null text is the empty text.  Every row is a path: rows repeated, or with
    null ids, each get their findings.  No rows give no rows.
    """
    version = rules_version(rules)
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column).alias("doc_id"), F.sha2(text, 256).alias("blob"), text.alias("text"))
    new = rows
    if ledger.started:
        # Ids first: of what the ledger knows no text is shuffled.
        ids = rows.select("blob").distinct().join(ledger.read(version).select("blob"), "blob", "left_anti")
        new = rows.join(written(ids, "unseen"), "blob", "left_semi")
    ledger.append(find_spans(new.groupBy("blob").agg(F.first("text").alias("text")), rules))
    # Only blobs with findings need the join; every other path has none.
    # Written, so that Spark may split the paths of a blob that very many share.
    findings = written(ledger.read(version).where(F.size("spans") > 0).dropDuplicates(["blob"]).select("blob", "spans"), "findings")
    empty = F.array().cast("array<struct<kind:string,start:long,end:long>>")
    return rows.select("doc_id", "blob").join(findings, "blob", "left").select("doc_id", "blob", F.coalesce("spans", empty).alias("spans"))


def digest(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts by kind, the digest of all base spans, and the spans as text."""
    kinds = [r.kind for r in rules]
    place = lambda s: F.array_position(F.array(*[F.lit(k) for k in kinds]), s["kind"])
    ordered = F.array_sort(
        F.transform("spans", lambda s: F.struct(s["start"].alias("start"), place(s).alias("order"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    joined = F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in kinds]
    return found.select("doc_id", *counts, F.sha2(joined, 256).alias("base_sha256"), joined.alias("spans"))
