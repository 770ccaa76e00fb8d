"""Tables on plain Parquet: versions, folds waiting on top, and a pointer.

``<root>/<relation>/v=<n>`` holds whole versions of the table and
``<root>/<relation>/folds/...`` folded change batches not yet in that version.
A commit file names the current version, the folds on top of it, and how far
the feed has been taken; readers only ever see what a commit names.  Keeping
folds aside means a micro-batch writes about as much as it changed.  Folds are
merged among themselves (:meth:`TableStore.merge_waiting`); putting them into a
new version (:meth:`TableStore.compact`) is a separate step.

A version keeps the positions its values are from, so no change is ever too
late, and neither batches nor compactions change what a table ends up as.

Catalog tables (one-call wrappers) are at the end.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from docsync.functions.naming import ref
from docsync.functions.types import same_type
from docsync.operators import records
from docsync.operators.fold import (
    DELETED, FAILURES, LIVE, alive, fold_schema, merge_fold_rows, settle, state_schema, with_positions,
)
from docsync.operators.mapping import CollectionMap, make_map
from docsync.operators.registers import SCHEMA, combined, to_fold
from docsync.sources import documents, files

# Folds up to this many bytes on disk are broadcast to the table; past it they
# are joined by shuffle.  Parquet grows several-fold in memory.
BROADCAST_BYTES = 16 * 1024 * 1024
BROADCAST_ROWS = 1_000_000

# Registers of one collection, as they are stored.
REGISTERS = T.StructType([f for f in SCHEMA.fields if f.name != "coll_name"])

# A version is due to be written again once its folds are this share of it.
DUE_SHARE = 0.25


@dataclass(frozen=True)
class FoldFile:
    """A folded batch: ``typed`` under the table's map, or ``registers`` of raw values."""

    path: str
    rows: int
    bytes: int
    form: str = "typed"


@dataclass(frozen=True)
class Commit:
    """What is current for one table.

    ``base_position`` is where the feed was when the table was loaded: changes
    up to there are in what was loaded.
    """

    number: int = 0
    version: int = 0
    base: str | None = None
    buckets: int = 0
    base_position: int | None = None
    position: int | None = None
    folds: tuple[FoldFile, ...] = ()
    batches: dict[str, int] = field(default_factory=dict)
    map: dict | None = None

    def dump(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @staticmethod
    def parse(text: str) -> Commit:
        raw = json.loads(text)
        raw["folds"] = tuple(FoldFile(**f) for f in raw["folds"])
        return Commit(**raw)


def _map_dict(m: CollectionMap) -> dict:
    return {
        "collection": m.collection,
        "relation": m.relation,
        "columns": [[c.column, c.source, c.type] for c in m.columns],
        "extra_props": m.extra_props,
    }


def _map_of(raw: dict) -> CollectionMap:
    return make_map(raw["collection"], raw["relation"], [tuple(c) for c in raw["columns"]], raw["extra_props"])


class TableStore:
    """The tables below one folder of a shared file system.

    ``buckets`` > 0 writes versions bucketed by key.  Folding into such a
    version shuffles only the changes, never the table.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 0, keep_commits: int = 20):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.keep_commits = keep_commits

    # ------------------------------------------------------------- pointers

    def _commits(self, relation: str) -> str:
        return f"{self.root}/{relation}/_commits"

    def commit_of(self, relation: str) -> Commit | None:
        return next(self._newest(relation), None)

    def _parsed(self, path: str) -> Commit | None:
        """The commit in a file; None where a writer died over it."""
        try:
            return Commit.parse(files.read_text(self.spark, path))
        except (ValueError, KeyError, TypeError):
            return None

    def _newest(self, relation: str) -> Iterator[Commit]:
        """Commits from the newest back.  What does not parse was never made."""
        folder = self._commits(relation)
        names = [n for n in files.names(self.spark, folder) if n.endswith(".json")]
        return filter(None, (self._parsed(f"{folder}/{n}") for n in reversed(names)))

    def _put(self, relation: str, commit: Commit) -> Commit:
        folder = self._commits(relation)
        path = f"{folder}/{commit.number:012d}.json"
        dead = files.exists(self.spark, path) and self._parsed(path) is None
        if not files.write_new(self.spark, path, commit.dump(), replacing=dead):
            raise RuntimeError(f"{relation}: another writer made commit {commit.number}")
        old = [n for n in files.names(self.spark, folder) if n.endswith(".json")][: -self.keep_commits]
        for name in old:
            files.delete(self.spark, f"{folder}/{name}")
        return commit

    # -------------------------------------------------------------- reading

    def relations(self) -> list[str]:
        return [n for n in files.names(self.spark, self.root) if not n.startswith("_") and self.exists(n)]

    def exists(self, relation: str) -> bool:
        commit = self.commit_of(relation)
        return commit is not None and commit.map is not None

    def map_of(self, relation: str) -> CollectionMap:
        return _map_of(self.commit_of(relation).map)

    def schema(self, relation: str) -> T.StructType:
        return self.map_of(relation).schema()

    def position(self, relation: str) -> int | None:
        """How far the feed has been taken; None if it never was."""
        commit = self.commit_of(relation)
        return commit.position if commit else None

    def positions(self) -> DataFrame:
        rows = [(r, self.position(r)) for r in self.relations()]
        return self.spark.createDataFrame(rows, records.POSITION_SCHEMA)

    def _base(self, commit: Commit, cmap: CollectionMap) -> DataFrame:
        """The version, positions included; columns its files lack are null."""
        schema = state_schema(cmap)
        if commit.base is None:
            return self.spark.createDataFrame([], schema)
        if not commit.buckets:
            return self.spark.read.schema(schema).parquet(commit.base)
        name = _table_name(commit.base)
        known = self.spark.catalog.tableExists(name)
        if known and self.spark.table(name).schema.names != schema.names:
            # Registered before columns were added; only the entry goes.
            self.spark.sql(f"DROP TABLE {name}")
            known = False
        if not known:
            key = cmap.key.column
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) "
                f"SORTED BY (`{key}`) INTO {commit.buckets} BUCKETS LOCATION '{commit.base}'"
            )
        return self.spark.table(name)

    def _folded(self, folds: tuple[FoldFile, ...], cmap: CollectionMap) -> DataFrame:
        """Waiting folds as one, those of one form read together."""
        paths = {form: [f.path for f in folds if f.form == form] for form in ("typed", "registers")}
        schema, parts = fold_schema(cmap), []
        if paths["typed"]:
            parts.append(self.spark.read.schema(schema).parquet(*paths["typed"]))
        if paths["registers"]:
            rows = self.spark.read.schema(REGISTERS).parquet(*paths["registers"])
            if len(paths["registers"]) > 1:
                rows = combined(rows, ("id", "key"))
            parts.append(to_fold(rows, cmap).select(*schema.names))
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return rows if len(paths["typed"]) + bool(paths["registers"]) == 1 else merge_fold_rows(rows, cmap)

    def read_stored(self, relation: str) -> DataFrame:
        """Current rows with their positions, deleted ids included."""
        commit = self.commit_of(relation)
        cmap = _map_of(commit.map)
        base = self._base(commit, cmap)
        if not commit.folds:
            return base
        return settle(base, self._folded(commit.folds, cmap), cmap, small=_small(commit.folds))

    def read(self, relation: str) -> DataFrame:
        """Current rows: the version with the folds on top applied."""
        return alive(self.read_stored(relation), self.map_of(relation))

    def find(self, relation: str, keys: Iterable[object]) -> DataFrame:
        """Current rows with one of these keys.

        The version and the folds are narrowed before they meet; of the version
        only row groups are read whose Bloom filters may hold a key.  Keys are a
        caller's few; to match a whole frame of keys join it with :meth:`read`.
        """
        keys = list(keys)
        commit = self.commit_of(relation)
        cmap = _map_of(commit.map)
        rows = documents.with_keys(self._base(commit, cmap), keys, cmap.key.column)
        if commit.folds:
            folded = documents.with_keys(self._folded(commit.folds, cmap), keys, "id")
            rows = settle(rows, folded, cmap, small=_small(commit.folds))
        return alive(rows, cmap)

    # -------------------------------------------------------------- writing

    def _write(self, df: DataFrame, path: str, cmap: CollectionMap, spread: bool) -> None:
        key = cmap.key.column
        if not self.buckets:
            df.write.mode("overwrite").options(**key_options(key)).parquet(path)
            return
        # Rows of one bucket must meet in one task, or every task would write
        # a file per bucket; a table folded from a bucketed version already is.
        rows = df.repartition(self.buckets, ref(key)) if spread else df
        name = _table_name(path)
        writer = rows.write.mode("overwrite").options(**key_options(key))
        writer.bucketBy(self.buckets, key).sortBy(key).option("path", path).saveAsTable(name)

    def publish(self, relation: str, df: DataFrame, cmap: CollectionMap, position: int | None = None, spread: bool = True) -> Commit:
        """Write ``df`` as the new version and make it current.

        ``df`` may read the version it replaces: that one is left alone.
        Folds are taken to be part of ``df``.  Rows may have positions; rows
        without are taken as loaded, at ``position`` of the feed if that is given.
        """
        old = self.commit_of(relation) or Commit()
        if LIVE not in df.columns:
            df = with_positions(df, cmap)
        version = old.version + 1
        path = f"{self.root}/{relation}/v={version}-{old.number + 1}"
        self._write(df, path, cmap, spread)
        latest = lambda *p: max((x for x in p if x is not None), default=None)
        return self._put(
            relation,
            replace(old, number=old.number + 1, version=version, base=path, buckets=self.buckets,
                    base_position=latest(old.base_position, position), position=latest(old.position, position),
                    folds=(), map=_map_dict(cmap)),
        )

    def create(self, relation: str, cmap: CollectionMap) -> Commit:
        """An empty table, if there is none."""
        commit = self.commit_of(relation)
        if commit is not None and commit.map is not None:
            return commit
        old = commit or Commit()
        return self._put(relation, Commit(number=old.number + 1, version=old.version, map=_map_dict(cmap)))

    def widen(self, relation: str, cmap: CollectionMap) -> Commit:
        """Columns added, or put in another order: no data is written.

        Files lack the new columns, and read as null there.  Nothing may be
        waiting on top of the version, and no column may go or change.
        """
        old = self.commit_of(relation)
        have = {c.column: c for c in _map_of(old.map).details()}
        kept = {c.column: c for c in cmap.details() if c.column in have}
        if old.folds or len(kept) < len(have) or any(not same_type(have[c].type, k.type) for c, k in kept.items()):
            raise ValueError(f"{relation}: more than added columns")
        return self._put(relation, replace(old, number=old.number + 1, map=_map_dict(cmap)))

    def truncate(self, relations: Iterable[str]) -> None:
        for r in relations:
            commit = self.commit_of(r)
            if commit is not None and commit.map is not None:
                self._put(r, replace(commit, number=commit.number + 1, base=None, buckets=0, folds=()))

    def drop(self, relations: Iterable[str]) -> None:
        for r in relations:
            commit = self.commit_of(r)
            if commit is not None and commit.map is not None:
                self._put(r, Commit(number=commit.number + 1, version=commit.version))

    def reset(self) -> None:
        """Drop every table."""
        self.drop(self.relations())

    def committed(self, relation: str, feed: str, batch_id: int) -> bool:
        commit = self.commit_of(relation)
        return commit is not None and commit.batches.get(feed, -1) >= batch_id

    def add_fold(
        self,
        relation: str,
        state: DataFrame,
        cmap: CollectionMap,
        feed: str,
        batch_id: int,
        before_commit: Callable[[int], None] | None = None,
    ) -> Commit:
        """Lay a folded batch on top of the table; a repeat does nothing.

        ``before_commit`` runs when the fold is written but not yet visible,
        with the number of values that did not fit, if the fold counts them.
        """
        old = self.commit_of(relation) or self.create(relation, cmap)
        if old.batches.get(feed, -1) >= batch_id:
            return old
        path = f"{self.root}/{relation}/folds/feed={feed}/batch={batch_id}"
        state.write.mode("overwrite").parquet(path)
        # Counted from what was written, three columns of it: a batch may be empty.
        failures = F.sum(FAILURES) if FAILURES in state.columns else F.lit(0)
        found = self.spark.read.schema(state.schema).parquet(path).agg(
            F.count(F.lit(1)).alias("rows"), F.max(F.greatest(LIVE, DELETED)).alias("last"), failures.alias("failures")
        ).first()
        rows, last_seq = found["rows"], found["last"]
        if before_commit is not None:
            before_commit(found["failures"] or 0)
        added = FoldFile(path, rows, files.size(self.spark, path))
        known = [p for p in (old.position, last_seq) if p is not None]
        return self._put(
            relation,
            replace(old, number=old.number + 1, folds=old.folds + ((added,) if rows else ()),
                    position=max(known) if known else None, batches={**old.batches, feed: batch_id}),
        )

    def add_registers(self, rows: DataFrame, feed: str, batch_id: int) -> tuple[str, dict[str, tuple[FoldFile, int | None]], int | None]:
        """Write a batch's registers of all collections once, a folder each.

        ``rows`` has a column ``relation``.  Gives the folder, for each relation what
        is in it and the last position, and how many values did not fit (none if
        ``rows`` do not count them); nothing is visible before :meth:`lay` names it.
        """
        # A folder for each attempt: commits may name what an earlier one wrote.
        folder = f"{self.root}/_registers/feed={feed}/batch={batch_id}-{uuid.uuid4().hex}"
        counted = [FAILURES] if FAILURES in rows.columns else []
        rows.select("relation", *REGISTERS.names, *counted).write.partitionBy("relation").parquet(folder)
        written = self.registers_in(folder, *counted).groupBy("relation")
        failed = [F.sum(c).alias("failures") for c in counted]
        found = written.agg(F.count("*").alias("rows"), F.max(F.greatest(LIVE, DELETED)).alias("last"), *failed).collect()
        out = {}
        for r in found:
            path = f"{folder}/relation={r.relation}"
            out[r.relation] = (FoldFile(path, r.rows, files.size(self.spark, path), "registers"), r.last)
        return folder, out, sum(r.failures or 0 for r in found) if counted else None

    def registers_in(self, folder: str, *longs: str) -> DataFrame:
        schema = T.StructType([*REGISTERS.fields, *[T.StructField(c, T.LongType()) for c in longs], T.StructField("relation", T.StringType())])
        return self.spark.read.schema(schema).parquet(folder)

    def lay(self, relation: str, added: FoldFile | None, cmap: CollectionMap, feed: str, batch_id: int, last: int | None) -> Commit:
        """Name a written fold as part of the table; a repeat does nothing."""
        old = self.commit_of(relation)
        if old is None or old.map is None:
            old = self.create(relation, cmap)
        if old.batches.get(feed, -1) >= batch_id:
            return old
        known = [p for p in (old.position, last) if p is not None]
        return self._put(
            relation,
            replace(old, number=old.number + 1, folds=old.folds + ((added,) if added else ()),
                    position=max(known) if known else None, batches={**old.batches, feed: batch_id}),
        )

    def merge_waiting(self, relation: str) -> Commit:
        """Merge the newest folds into one; the version is not looked at.

        Taken are folds from the newest back while each is at most twice what
        was taken before it, so a fold is written again only as often as its size doubles.
        """
        old = self.commit_of(relation)
        taken = size = 0
        for f in reversed(old.folds):
            if taken and f.bytes > 2 * size:
                break
            taken, size = taken + 1, size + f.bytes
        if taken < 2:
            return old
        cmap, path = _map_of(old.map), f"{self.root}/{relation}/folds/feed=merged/batch={old.number + 1}"
        self._folded(old.folds[-taken:], cmap).write.mode("overwrite").parquet(path)
        rows = self.spark.read.schema(fold_schema(cmap)).parquet(path).count()
        one = FoldFile(path, rows, files.size(self.spark, path))
        return self._put(relation, replace(old, number=old.number + 1, folds=(*old.folds[:-taken], one)))

    def due(self, relation: str, share: float = DUE_SHARE) -> bool:
        """Have the waiting folds grown to so large a share of the version?"""
        commit = self.commit_of(relation)
        waiting = sum(f.bytes for f in commit.folds)
        return waiting > 0 and (commit.base is None or waiting >= share * files.size(self.spark, commit.base))

    def compact(self, relation: str, statistics: bool = True, n_files: int | None = None) -> Commit:
        """Write version and folds as one new version, positions included."""
        started = int(time.time())
        commit = self.commit_of(relation)
        cmap = _map_of(commit.map)
        df = self.read_stored(relation)
        if n_files and not self.buckets:
            df = df.repartition(n_files)
        done = self.publish(relation, df, cmap, spread=commit.buckets != self.buckets)
        if statistics:
            rows = self.read(relation).count()
            self.append_service("transfer_stats", stats_row(self.spark, records.ACTION_VACUUM, relation, rows, started))
        return done

    def analyze(self, relation: str) -> bool:
        """Have Spark gather statistics of the version, where the catalog knows it."""
        commit = self.commit_of(relation)
        if commit is None or commit.base is None or not commit.buckets:
            return False
        self._base(commit, _map_of(commit.map))
        analyze_table(self.spark, _table_name(commit.base))
        return True

    def clean(self, relation: str, keep: int = 2) -> list[str]:
        """Remove versions and folds that none of the last commits names.

        What is newer than the last commit may be on its way to the next, and stays.
        """
        recent = list(itertools.islice(self._newest(relation), keep))
        last = recent[0] if recent else Commit()
        live = {c.base for c in recent} | {f.path for c in recent for f in c.folds}
        top = f"{self.root}/{relation}"
        have = [
            f"{top}/{n}" for n in files.names(self.spark, top) if n.startswith("v=") and int(n.rpartition("-")[2]) <= last.number
        ]
        for feed in files.names(self.spark, f"{top}/folds"):
            done = last.number if feed == "feed=merged" else last.batches.get(feed.removeprefix("feed="), -1)
            have += [
                f"{top}/folds/{feed}/{b}"
                for b in files.names(self.spark, f"{top}/folds/{feed}")
                if int(b.rpartition("=")[2]) <= done
            ]
        for feed, done in last.batches.items():
            batches = f"{self.root}/_registers/feed={feed}"
            for b in files.names(self.spark, batches):
                path = f"{batches}/{b}/relation={relation}"
                if b.startswith("batch=") and int(b.removeprefix("batch=").partition("-")[0]) <= done and files.exists(self.spark, path):
                    have.append(path)
        gone = [p for p in have if p not in live]
        for p in gone:
            files.delete(self.spark, p)
        return gone

    # ------------------------------------------------------- service tables

    def _service(self, name: str) -> str:
        return f"{self.root}/_service/{name}"

    def create_service_tables(self) -> None:
        """Audit, errors and statistics, empty, where they are absent."""
        for name, schema in records.SERVICE_SCHEMAS.items():
            if name != "position" and not files.exists(self.spark, self._service(name)):
                self.spark.createDataFrame([], schema).write.mode("append").parquet(f"{self._service(name)}/part=start")

    def append_service(self, name: str, rows: DataFrame, part: str | None = None) -> None:
        """Add service rows; rows of one named part replace an earlier attempt."""
        path = f"{self._service(name)}/part={part or f'at-{time.time_ns()}'}"
        rows.write.mode("overwrite").parquet(path)

    def service(self, name: str) -> DataFrame:
        """A service table; positions come from the commits themselves."""
        if name == "position":
            return self.positions()
        schema = records.SERVICE_SCHEMAS[name]
        if not files.exists(self.spark, self._service(name)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._service(name)).drop("part")


def key_options(key: str) -> dict[str, str]:
    """Parquet options for a table's key: a Bloom filter a row group, as large as its
    keys ask for up to Parquet's 1 MB, in place of a dictionary, which distinct keys outgrow."""
    return {
        f"parquet.bloom.filter.enabled#{key}": "true",
        "parquet.bloom.filter.adaptive.enabled": "true",
        f"parquet.enable.dictionary#{key}": "false",
    }


def _small(folds: Iterable[FoldFile]) -> bool:
    folds = tuple(folds)
    return sum(f.bytes for f in folds) <= BROADCAST_BYTES and sum(f.rows for f in folds) <= BROADCAST_ROWS


def _table_name(path: str) -> str:
    """A name no other path has."""
    return "docsync_" + hashlib.sha256(path.encode()).hexdigest()[:48]


def stats_row(spark: SparkSession, action: str, relation: str, rows: int, started: int) -> DataFrame:
    return spark.createDataFrame([(action, relation, rows, started, int(time.time()))], records.STATS_SCHEMA)


# -------------------------------------------------------------- catalog tables


def quoted(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def create_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(schema)}")


def reset_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"DROP SCHEMA IF EXISTS {quoted(schema)} CASCADE")
    create_schema(spark, schema)


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def table_columns(spark: SparkSession, table: str) -> DataFrame:
    """``(column_name, data_type)`` of a catalog table."""
    rows = [(f.name, f.dataType.simpleString()) for f in spark.table(table).schema.fields]
    return spark.createDataFrame(rows, "column_name string, data_type string")


def create_table(spark: SparkSession, table: str, cmap: CollectionMap) -> None:
    """An empty Parquet table in the catalog, if absent."""
    if not table_exists(spark, table):
        spark.createDataFrame([], cmap.schema()).write.format("parquet").saveAsTable(table)


def truncate_tables(spark: SparkSession, tables: Iterable[str]) -> None:
    for t in tables:
        spark.sql(f"TRUNCATE TABLE {quoted(t)}")


def drop_tables(spark: SparkSession, tables: Iterable[str]) -> None:
    for t in tables:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(t)}")


def add_table_columns(spark: SparkSession, table: str, columns: dict[str, T.DataType]) -> None:
    """Columns added in the catalog; stored files stay as they are."""
    spec = ", ".join(f"{quoted(c)} {t.simpleString()}" for c, t in columns.items())
    spark.sql(f"ALTER TABLE {quoted(table)} ADD COLUMNS ({spec})")


def analyze_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"ANALYZE TABLE {quoted(table)} COMPUTE STATISTICS")
