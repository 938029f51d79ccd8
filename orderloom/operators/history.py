"""Type-2 history: versions of a row with the time each was valid."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.operators.dedupe import dedupe_first

VALIDITY = ("valid_from", "valid_to", "version_id")


def version_id(keys: Sequence[str | Column], valid_from: Column) -> Column:
    """Stable id of a version: hash of the key columns, told apart and nulls included, and the start in
    microseconds (no time zone in it)."""
    parts = [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    told_apart = [F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]
    return F.sha2(F.concat_ws("|", *told_apart, F.unix_micros(valid_from).cast("string")), 256)


def scd2_start(current: DataFrame, keys: Sequence[str], now: dt.datetime | Column) -> DataFrame:
    """First snapshot: every row is an open version."""
    start = _moment(now)
    return current.select(
        *current.columns,
        start.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        version_id(keys, start).alias("version_id"),
    )


def scd2_changes(
    open_versions: DataFrame,
    current: DataFrame,
    keys: Sequence[str],
    check_cols: Sequence[str],
    now: dt.datetime | Column,
    order_by: Sequence[str | Column] | None = None,
) -> DataFrame:
    """The open versions after this snapshot, and the versions it closed.

    Old and new rows meet in one full outer join on the key (one shuffle); a changed key yields
    both its closed and its new version from that same row. A change is a difference in one of
    ``check_cols``, null against a value included; other columns alone do not make a version, and
    a key missing from ``current`` stays open.
    """
    fresh = current.filter(_all_known(keys))
    if order_by is not None:
        fresh = dedupe_first(fresh, keys, order_by)
    columns = [*current.columns, *VALIDITY]
    start = _moment(now)

    old = open_versions.select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
        F.struct(*[F.col(c) for c in columns]).alias("_old"),
    )
    new = scd2_start(fresh, keys, start).select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
        F.struct(*[F.col(c) for c in columns]).alias("_new"),
    )
    pairs = old.join(new, [f"_key{i}" for i in range(len(keys))], "full")

    is_old, is_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    same = F.lit(True)
    for c in check_cols:
        same = same & F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}"))
    changed = is_old & is_new & ~same
    closed = F.col("_old").withField("valid_to", start)
    kept = F.when(changed, closed).when(is_old, F.col("_old"))
    added = F.when(changed | ~is_old, F.col("_new"))
    return pairs.select(F.explode(F.array_compact(F.array(kept, added))).alias("_row")).select("_row.*")


def scd2_apply(
    history: DataFrame | None,
    current: DataFrame,
    keys: Sequence[str],
    check_cols: Sequence[str],
    now: dt.datetime | Column,
    order_by: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Whole history after this snapshot. Closed versions pass through without a shuffle."""
    if history is None:
        fresh = current.filter(_all_known(keys))
        return scd2_start(fresh if order_by is None else dedupe_first(fresh, keys, order_by), keys, now)
    is_open = F.col("valid_to").isNull()
    changes = scd2_changes(history.filter(is_open), current, keys, check_cols, now, order_by)
    return history.filter(~is_open).unionByName(changes)


def _moment(now: dt.datetime | Column) -> Column:
    return (now if isinstance(now, Column) else F.lit(now)).cast("timestamp")


def _all_known(keys: Sequence[str]) -> Column:
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return known
