"""A stored history that takes snapshots in any order, late ones, repeats and corrections included.

The table holds runs (``operators/sightings.py``) in partitions by the period of ``seen_to``; the moments of all
snapshots are kept beside them, one small file each. ``tables.snapshot_table`` keeps less and is cheaper where snapshots come in order.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.operators.dedupe import dedupe_first
from orderloom.operators.incremental import assert_schema
from orderloom.operators.sightings import SEEN, insert_snapshot, near, versions_of
from orderloom.sources.folders import Folder
from orderloom.sources.tables import (
    current_version, finish_replacing, partition_folder, read_table, replace_partitions, write_table,
)

MOMENTS = "_moments"
PERIOD = "period"
#: Runs that end within the same thirty days are one partition, whatever the time zone.
PERIOD_MICROS = 30 * 24 * 3600 * 1_000_000


def put_snapshot(
    current: DataFrame,
    path: str,
    keys: Sequence[str],
    at: dt.datetime | Column,
    order_by: Sequence[str | Column] | None = None,
) -> None:
    """Add the snapshot taken at ``at``, or put it in place of the one known of that moment.

    Read and rewritten are the partitions with runs that were seen at, or across, its neighbours in time: for the newest snapshot
    the last ones, for a late one those since then. A writer lost on the way has to repeat its snapshot; until then
    its moment is known without what was seen. One writer at a time.
    """
    spark = current.sparkSession
    taken = {PERIOD, *SEEN} & set(current.columns)
    if taken:
        raise ValueError(f"column names the table needs itself: {sorted(taken)}")
    rows = current if order_by is None else dedupe_first(current, keys, order_by)
    moment = at if isinstance(at, Column) else F.lit(at)
    when = spark.range(1).select(F.unix_micros(moment.cast("timestamp"))).first()[0]
    version = current_version(spark, path)
    if version is None:
        nothing = spark.createDataFrame([], rows.schema).select("*", *[F.lit(None).cast("bigint").alias(c) for c in SEEN])
        write_table(_with_period(nothing), path, [PERIOD])
        version = current_version(spark, path)
    finish_replacing(spark, version)
    stored = read_table(spark, path)
    assert_schema(stored.drop(PERIOD, *SEEN).schema, rows.schema)
    moments = _moments(spark, version)
    before = max((m for m in moments if m < when), default=None)
    after = min((m for m in moments if m > when), default=None)
    if when not in moments:
        Folder(spark, version).write_json(f"{MOMENTS}/at={when}/known", when)

    around = stored.filter(near(before, after))
    touched = {r[0] for r in around.select(PERIOD).distinct().collect()}  # a number per partition
    touched |= {m // PERIOD_MICROS for m in (before, when) if m is not None}
    new = insert_snapshot(around.drop(PERIOD), rows, keys, before, when, after)
    others = stored.filter(F.col(PERIOD).isin(sorted(touched)) & ~near(before, after))
    whole = others.select(*stored.columns).unionByName(_with_period(new))
    replace_partitions(whole, version, [PERIOD], [partition_folder(PERIOD, str(p)) for p in sorted(touched)])


def read_versions(spark: SparkSession, path: str, keys: Sequence[str], check_cols: Sequence[str]) -> DataFrame:
    """The type-2 history by ``check_cols`` of all snapshots put so far."""
    return versions_of(read_table(spark, path).drop(PERIOD), keys, check_cols)


def known_moments(spark: SparkSession, path: str) -> list[int]:
    """Moments of all snapshots, in microseconds."""
    version = current_version(spark, path)
    return [] if version is None else _moments(spark, version)


def _moments(spark: SparkSession, version: str) -> list[int]:
    return sorted(int(name.split("=")[1]) for name in Folder(spark, version).folders(MOMENTS))


def _with_period(runs: DataFrame) -> DataFrame:
    return runs.withColumn(PERIOD, F.floor(F.col("seen_to") / PERIOD_MICROS).cast("int"))
