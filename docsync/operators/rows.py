"""Row changes as functions from DataFrame to DataFrame.

Parquet tables cannot be changed in place, so every operator here takes the
current rows and gives the new ones; a table layer writes them as a new
version.  Keys match through equi-joins.  Which side is shuffled or broadcast
is left to the planner, which knows the sizes; ``small=True`` is for callers
that have measured the incoming side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from docsync.functions.naming import KEY_COLUMN, ref

Keys = str | Sequence[str]


def _keys(key: Keys) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def one_per_key(df: DataFrame, key: Keys, order: str, last: bool = True) -> DataFrame:
    """Last (or first) row per key by ``order``.

    An aggregate, not a window: copies of a hot key collapse inside each task
    before anything is shuffled.
    """
    keys = _keys(key)
    pick = F.max_by if last else F.min_by
    row = F.struct(*[ref(c) for c in df.columns if c not in keys])
    picked = df.groupBy(*[ref(k) for k in keys]).agg(pick(row, ref(order)).alias("_row"))
    return picked.select(*[ref(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns])


def append(base: DataFrame, new: DataFrame) -> DataFrame:
    return base.unionByName(new, allowMissingColumns=True)


def insert_ignore(base: DataFrame, new: DataFrame, key: Keys = KEY_COLUMN, order: str | None = None) -> DataFrame:
    """Add rows whose key is not there yet; the first of several wins.

    Without ``order`` the new rows must have unique keys.
    """
    keys = _keys(key)
    fresh = new if order is None else one_per_key(new, keys, order, last=False)
    fresh = fresh.select(*[ref(c) for c in base.columns])
    return base.unionByName(fresh.join(base.select(*[ref(k) for k in keys]), keys, "left_anti").select(*base.columns))


def upsert(base: DataFrame, new: DataFrame, key: Keys = KEY_COLUMN, order: str | None = None) -> DataFrame:
    """Replace whole rows by key, nulls included; the last of several wins.

    The anti-join needs only the keys of the new rows, so the base is not
    shuffled when those are few enough to be broadcast.
    """
    keys = _keys(key)
    fresh = new if order is None else one_per_key(new, keys, order, last=True)
    fresh = fresh.select(*[ref(c) for c in base.columns])
    # The keys are taken from ``new`` itself: which row of a key wins makes no difference to them.
    return delete_keys(base, new, keys).unionByName(fresh)


def upsert_partial(
    base: DataFrame,
    new: DataFrame,
    touched: dict[str, Column],
    key: Keys = KEY_COLUMN,
    order: str | None = None,
) -> DataFrame:
    """Replace only touched columns; unknown keys become new rows.

    ``touched`` gives, per column, a flag over the columns of ``new``: true
    takes the new value (null too, which is how a field is unset), anything
    else keeps the old one.  Several rows of a key add up in ``order``: each
    column takes its last touch, whichever row that is in.  Without ``order``
    ``new`` has one row per key.
    """
    keys = _keys(key)
    values = [c for c in base.columns if c not in keys]
    flags = [touched.get(c, F.lit(False)).alias(f"_touched_{i}") for i, c in enumerate(values)]
    incoming = [
        (ref(c) if c in new.columns else F.lit(None).cast(base.schema[c].dataType)).alias(f"_new_{i}")
        for i, c in enumerate(values)
    ]
    at = [ref(order).alias("_order")] if order else []
    side = new.select(*[ref(k) for k in keys], *flags, *incoming, *at)
    if order:
        last = []
        for i in range(len(values)):
            when = F.when(F.col(f"_touched_{i}"), F.col("_order"))
            # In a struct, for a null value to count.
            last += [F.max(when).isNotNull().alias(f"_touched_{i}"), F.max_by(F.struct(f"_new_{i}"), when)[f"_new_{i}"].alias(f"_new_{i}")]
        side = side.groupBy(*[ref(k) for k in keys]).agg(*last)
    merged = base.join(side, keys, "full_outer")
    return merged.select(
        *[
            ref(c)
            if c in keys
            else F.when(F.col(f"_touched_{values.index(c)}"), F.col(f"_new_{values.index(c)}"))
            .otherwise(ref(c))
            .alias(c)
            for c in base.columns
        ]
    )


def non_null_touched(columns: Sequence[str], unset: str | None = None) -> dict[str, Column]:
    """Flags of a partial upsert: a null means untouched, unless the column is
    named in the array column ``unset``."""
    return {
        c: ref(c).isNotNull()
        if unset is None
        else ref(c).isNotNull() | F.coalesce(F.array_contains(ref(unset), c), F.lit(False))
        for c in columns
    }


def delete_keys(base: DataFrame, doomed: DataFrame, key: Keys = KEY_COLUMN) -> DataFrame:
    """Remove rows by key.

    A key may be named any number of times: repeats are taken out within each
    task, before they could pile up in one.
    """
    keys = _keys(key)
    once = doomed.select(*[ref(k) for k in keys]).distinct()
    return base.join(once, keys, "left_anti").select(*[ref(c) for c in base.columns])


def key_violations(df: DataFrame, key: Keys = KEY_COLUMN) -> DataFrame:
    """Keys that are null or occur more than once, with their row count."""
    keys = _keys(key)
    missing = F.lit(False)
    for k in keys:
        missing = missing | ref(k).isNull()
    return (
        df.groupBy(*[ref(k) for k in keys])
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where((F.col("n_rows") > 1) | missing)
    )
