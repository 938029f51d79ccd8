"""Snapshots in any order: what was seen when, and the type-2 history that follows from it.

A *run* says that a key was in every known snapshot from ``seen_from`` to ``seen_to`` (microseconds) with the same
values. Runs are a function of the snapshots alone, whatever the order they came in, and so is the history made of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from orderloom.operators.history import VALIDITY, version_id

SEEN = ("seen_from", "seen_to")


def near(before: int | None, after: int | None) -> Column:
    """Runs that a snapshot between its neighbours ``before`` and ``after`` may change."""
    since = F.lit(True) if before is None else F.col("seen_to") >= before
    until = F.lit(True) if after is None else F.col("seen_from") <= after
    return since & until


def insert_snapshot(
    runs: DataFrame, current: DataFrame, keys: Sequence[str], before: int | None, at: int, after: int | None
) -> DataFrame:
    """The ``near`` runs after a snapshot at moment ``at``, whose neighbours in time are ``before`` and ``after``.

    Runs are cut where the snapshot is; a piece that it repeats grows by it, and two such pieces become one. What was
    known of the same moment is replaced, so a snapshot can come again, corrected or not. A key has a piece on each
    side at most, so one grouping by key decides, combined in the tasks first. Rows without a whole key are left out; of
    several rows of one key the smallest by its columns, in their order, counts.
    """
    places = {c: f"v{i}" for i, c in enumerate(c for c in current.columns if c not in keys)}
    # a key alone is a row too
    values = F.struct(F.lit(0).alias("any"), *[F.col(c).alias(v) for c, v in places.items()]).alias("row")
    none = F.lit(None)
    seen = current.na.drop("any", subset=list(keys)).select(
        *keys, none.alias("_left"), F.struct(values).alias("_here"), none.alias("_right")
    )
    piece = StructType([*current.select(values).schema, *[StructField(c, LongType()) for c in SEEN]])
    left = right = none.cast(piece)
    if before is not None:
        end = F.least(F.col("seen_to"), F.lit(before)).alias("seen_to")
        left = F.when(F.col("seen_from") <= before, F.struct(values, "seen_from", end))
    if after is not None:
        start = F.greatest(F.col("seen_from"), F.lit(after)).alias("seen_from")
        right = F.when(F.col("seen_to") >= after, F.struct(values, start, "seen_to"))
    pieces = runs.select(*keys, left.alias("_left"), none.alias("_here"), right.alias("_right"))
    sides = pieces.unionByName(seen).groupBy(*keys).agg(
        F.first("_left", ignorenulls=True).alias("_left"),
        F.min("_here").alias("_here"),
        F.first("_right", ignorenulls=True).alias("_right"),
    )

    def same(side: str) -> Column:
        known = F.col(side).isNotNull() & F.col("_here").isNotNull()
        return known & F.col(f"{side}.row").eqNullSafe(F.col("_here.row"))

    def run(side: str, start: Column, end: Column) -> Column:
        return F.struct(F.col(f"{side}.row").alias("row"), start.alias("seen_from"), end.alias("seen_to"))

    moment = F.lit(at).cast("bigint")
    end = F.when(same("_right"), F.col("_right.seen_to")).otherwise(moment)
    kept = F.array_compact(
        F.array(
            F.when(
                F.col("_left").isNotNull(),
                run("_left", F.col("_left.seen_from"), F.when(same("_left"), end).otherwise(F.col("_left.seen_to"))),
            ),
            F.when(F.col("_here").isNotNull() & ~same("_left"), run("_here", moment, end)),
            F.when(
                F.col("_right").isNotNull() & ~same("_right"), run("_right", F.col("_right.seen_from"), F.col("_right.seen_to"))
            ),
        )
    )
    found = sides.select(*keys, F.explode(kept).alias("_run"))
    columns = [F.col(f"_run.row.{places[c]}").alias(c) if c in places else F.col(c) for c in current.columns]
    return found.select(*columns, "_run.seen_from", "_run.seen_to")


def versions_of(runs: DataFrame, keys: Sequence[str], check_cols: Sequence[str]) -> DataFrame:
    """The type-2 history: runs of a key that follow each other with equal ``check_cols`` are one version, which holds the
    values of the first. A key missing from snapshots stays as it was last seen. A key has a run per snapshot at most."""
    in_time = Window.partitionBy(*keys).orderBy("seen_from")
    checked = F.struct(F.lit(0), *check_cols)
    starts = runs.withColumn("_same", checked.eqNullSafe(F.lag(checked).over(in_time))).filter(~F.col("_same"))
    following = F.lead("seen_from").over(in_time)
    start = F.timestamp_micros("seen_from")
    return starts.select(
        *[c for c in runs.columns if c not in SEEN],
        start.alias(VALIDITY[0]),
        F.timestamp_micros(following).alias(VALIDITY[1]),
        version_id(keys, start).alias(VALIDITY[2]),
    )
