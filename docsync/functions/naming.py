"""Names, ids and times: small column expressions used everywhere."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# The key column and the two names of the leftovers column.
KEY_SOURCE = "_id"
KEY_COLUMN = "id"
EXTRA_SOURCE = "extraProps"
EXTRA_COLUMN = "_extra_props"

# Fixed value: how a start time is written.
START_FORMAT = "dd-MM-yy'T'HH:mm:ss"


def ref(name: str) -> Column:
    """Column by exact name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def quoted(name: str) -> str:
    """A column name as SQL text."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A string literal as SQL text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literals(texts: Iterable[str]) -> str:
    return ", ".join(literal(t) for t in texts)


def snake_case(name: Column) -> Column:
    """``firstName`` -> ``first_name``; ``_id`` -> ``id``."""
    split = F.regexp_replace(name, "([A-Z]+)", "_$1")
    return F.regexp_replace(F.lower(split), r"^_+|_+\z", "")


def id_text(value: Column) -> Column:
    """Document ids are always kept as text."""
    return value.cast("string")


def namespace(db: Column, collection: Column) -> Column:
    return F.concat_ws(".", db, collection)


def namespace_database(ns: Column) -> Column:
    return F.substring_index(ns, ".", 1)


def namespace_collection(ns: Column) -> Column:
    """Collection of ``db.coll``; a collection name may itself hold dots."""
    return F.when(F.contains(ns, F.lit(".")), F.substr(ns, F.position(F.lit("."), ns) + 1))


def start_epoch(text: Column) -> Column:
    """``31-12-24T08:30:00`` in the session time zone -> epoch seconds."""
    return F.unix_timestamp(text, START_FORMAT)


def epoch_seconds(ts: Column) -> Column:
    return F.unix_timestamp(ts)
