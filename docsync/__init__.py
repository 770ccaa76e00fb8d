"""Collections of JSON documents as typed tables, kept current from a change feed."""

from docsync.operators.evolve import backfill, evolve, map_changes, map_diff
from docsync.operators.fold import apply_changes, fold_changes, merge_folds, operation_runs
from docsync.operators.mapping import CollectionMap, MappedColumn, infer_map, load_maps, make_map, read_map, write_map
from docsync.operators.project import cast_errors, project
from docsync.plans.snapshot import load_collection, transfer
from docsync.plans.tables import TableStore
from docsync.session import configure
from docsync.streaming.sync import snapshot_and_sync, start_sync

__all__ = [
    "CollectionMap",
    "MappedColumn",
    "TableStore",
    "apply_changes",
    "backfill",
    "cast_errors",
    "configure",
    "evolve",
    "fold_changes",
    "infer_map",
    "load_collection",
    "load_maps",
    "make_map",
    "map_changes",
    "map_diff",
    "merge_folds",
    "operation_runs",
    "project",
    "read_map",
    "snapshot_and_sync",
    "start_sync",
    "transfer",
    "write_map",
]
