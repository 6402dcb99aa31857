"""Applying compacted changes to stored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.schema import CONTROL, DELETED, EVENT_ORDER, EVENT_TIME

MODES = ("coalesce", "replace")


def _check_mode(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")


def _in(col: str) -> Column:
    return F.col(f"incoming.`{col}`")


def _ex(col: str) -> Column:
    return F.col(f"existing.`{col}`")


def merge_state(
    existing: DataFrame,
    compacted: DataFrame,
    keys: Sequence[str],
    mode: str = "coalesce",
    keep_existing: bool = True,
) -> DataFrame:
    """One row per key after the changes; both inputs hold each key at most once.

    ``coalesce``  a NULL in the change keeps the stored value.
    ``replace``   the change is the whole new row.
    ``keep_existing=False`` returns only rows the changes touched; that needs no
    full outer join, and in ``replace`` mode no join at all.
    """
    _check_mode(mode)
    keys = list(keys)
    columns = existing.columns
    measures = [c for c in columns if c not in keys]
    if DELETED not in compacted.columns:
        compacted = compacted.withColumn(DELETED, F.lit(False))
    if not keep_existing:
        live = compacted.filter(~F.col(DELETED))
        if mode == "replace":
            return live.select(*columns)
        joined = live.alias("incoming").join(existing.alias("existing"), keys, "left")
        values = [F.coalesce(_in(c), _ex(c)).alias(c) for c in measures]
        return joined.select(*keys, *values).select(*columns)
    joined = existing.alias("existing").join(compacted.alias("incoming"), keys, "full_outer")
    # The flag rides along the join: deletes need no join of their own.
    joined = joined.filter(~F.coalesce(_in(DELETED), F.lit(False)))
    if mode == "coalesce":
        values = [F.coalesce(_in(c), _ex(c)).alias(c) for c in measures]
    else:
        touched = _in(DELETED).isNotNull()
        values = [F.when(touched, _in(c)).otherwise(_ex(c)).alias(c) for c in measures]
    return joined.select(*keys, *values).select(*columns)


def merge_versioned(
    state: DataFrame, compacted: DataFrame, keys: Sequence[str], mode: str = "replace"
) -> DataFrame:
    """Like :func:`merge_state`, for state that remembers each key's last event.

    Older events lose against newer stored ones, and delete markers stay, so a
    late event cannot bring a deleted key back.
    """
    _check_mode(mode)
    keys = list(keys)
    columns = state.columns
    values = [c for c in columns if c not in keys and c not in CONTROL]
    joined = state.alias("existing").join(
        compacted.select(*columns).alias("incoming"), keys, "full_outer"
    )
    newer = _in(DELETED).isNotNull() & (
        _ex(DELETED).isNull()
        | (F.struct(*[_in(c) for c in EVENT_ORDER]) >= F.struct(*[_ex(c) for c in EVENT_ORDER]))
    )
    taken = {c: _in(c) for c in values}
    if mode == "coalesce":
        taken = {c: F.when(_in(DELETED), _in(c)).otherwise(F.coalesce(_in(c), _ex(c))) for c in values}
    merged = [F.when(F.col("_newer"), taken[c]).otherwise(_ex(c)).alias(c) for c in values]
    merged += [F.when(F.col("_newer"), _in(c)).otherwise(_ex(c)).alias(c) for c in CONTROL]
    return joined.withColumn("_newer", newer).select(*keys, *merged).select(*columns)


def live_rows(state: DataFrame) -> DataFrame:
    """Stored rows without delete markers and control columns."""
    return state.filter(~F.col(DELETED)).drop(*CONTROL)


def without_old_markers(state: DataFrame, batch: DataFrame, keep_ms: int) -> DataFrame:
    """Stored rows without delete markers older than a batch's median event by ``keep_ms``.

    The median, so that no single event with a wrong clock makes markers go.
    """
    middle = batch.agg(F.percentile_approx(EVENT_TIME, 0.5)).first()[0]
    if middle is None:
        return state
    old = F.col(DELETED) & (F.col(EVENT_TIME) < middle - keep_ms)
    return state.filter(~F.coalesce(old, F.lit(False)))


def drop_keys(
    df: DataFrame, removed: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Rows of ``df`` whose key is not in ``removed``.

    Broadcasting is left to the runtime, which measures ``removed`` first.  With
    ``null_safe`` a NULL key part matches a NULL; otherwise it matches nothing.
    """
    keys = list(keys)
    removed = removed.select(*keys).distinct()
    if not null_safe:
        return df.join(removed, keys, "left_anti")
    renamed = removed.select(*[F.col(k).alias(f"_rm_{k}") for k in keys])
    match = F.lit(True)
    for k in keys:
        match = match & df[k].eqNullSafe(renamed[f"_rm_{k}"])
    return df.join(renamed, match, "left_anti")
