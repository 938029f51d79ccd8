"""Declared data checks: pass/fail report and failing rows.

A null value passes every check but ``not_null``. ``where`` restricts a check to some rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Collection, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderloom.operators.lookup import orphans
from orderloom.sources.folders import Folder

ROWS_SCHEMA = "_schema"


@dataclass(frozen=True)
class Check:
    """One rule on one column. ``args`` depends on ``kind``; ``scope`` is a SQL row condition."""

    kind: str
    column: str
    args: tuple[Any, ...] = ()
    scope: str | None = None

    def where(self, scope: str) -> Check:
        return replace(self, scope=scope)

    @property
    def name(self) -> str:
        """``kind_column``, with what else tells checks of one kind on one column apart: the parent, the
        bounds, and pattern and scope as digests."""
        parts = [self.kind, self.column]
        if self.kind == "relationships":
            parts.append(str(self.args[0]))
        elif self.kind == "between":
            parts += ["any" if v is None else str(v) for v in self.args]
        elif self.kind == "matches":
            parts.append(_digest(self.args[0]))
        if self.scope is not None:
            parts += ["where", _digest(self.scope)]
        return "_".join(parts)


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()[:8]


def unique(column: str) -> Check:
    return Check("unique", column)


def not_null(column: str) -> Check:
    return Check("not_null", column)


def accepted(column: str, values: Sequence[str]) -> Check:
    return Check("accepted", column, tuple(values))


def relationships(column: str, parent: str, parent_column: str) -> Check:
    """``parent`` names a DataFrame handed to the run as ``parents[parent]``."""
    return Check("relationships", column, (parent, parent_column))


def between(column: str, low, high) -> Check:
    """Inclusive on both ends; numbers or dates. None leaves an end open."""
    return Check("between", column, (low, high))


def matches(column: str, regex: str) -> Check:
    return Check("matches", column, (regex,))


ROW_KINDS = ("not_null", "accepted", "between", "matches")


def row_fails(check: Check) -> Column:
    """Row-level checks as a predicate: true where the row breaks the rule, never null."""
    c = F.col(check.column)
    if check.kind == "not_null":
        broken = c.isNull()
    elif check.kind == "accepted":
        broken = ~c.isin(*check.args)
    elif check.kind == "between":
        low, high = check.args
        broken = F.lit(False)
        if low is not None:
            broken = broken | (c < F.lit(low))
        if high is not None:
            broken = broken | (c > F.lit(high))
    elif check.kind == "matches":
        broken = ~c.rlike(check.args[0])
    else:
        raise ValueError(f"{check.kind} is not a row-level check")
    scoped = broken if check.scope is None else F.expr(check.scope) & broken
    return F.coalesce(scoped, F.lit(False))


def failing(df: DataFrame, check: Check, parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """What a check objects to: rows, or for ``unique`` the repeated keys with their counts."""
    if check.kind in ROW_KINDS:
        return df.filter(row_fails(check))
    scoped = df if check.scope is None else df.filter(check.scope)
    if check.kind == "unique":
        known = scoped.filter(F.col(check.column).isNotNull())
        return known.groupBy(check.column).agg(F.count("*").alias("occurrences")).filter("occurrences > 1")
    if check.kind == "relationships":
        parent, parent_column = check.args
        return orphans(scoped, check.column, parents[parent], parent_column)
    raise ValueError(f"unknown check kind {check.kind!r}")


def run_checks(
    df: DataFrame, checks: Sequence[Check], parents: dict[str, DataFrame] | None = None
) -> DataFrame:
    """One report row per check: ``check, column, failures, passed``.

    ``df`` is evaluated twice at most, however many checks there are: once for all row-level checks
    (one aggregate), once for all checks that compare keys.
    """
    indexed = list(enumerate(checks))
    by_row = [(i, c) for i, c in indexed if c.kind in ROW_KINDS]
    by_key = [(i, c) for i, c in indexed if c.kind not in ROW_KINDS]
    reports = []
    if by_row:
        counts = df.agg(*[F.count_if(row_fails(c)).alias(f"n{i}") for i, c in by_row])
        pairs = [F.struct(F.lit(i).alias("_check"), F.col(f"n{i}").alias("failures")) for i, _ in by_row]
        reports.append(counts.select(F.inline(F.array(*pairs))))
    if by_key:
        reports.append(_key_failures(df, by_key, parents or {}))
    return _report(checks, reports)


class RowCounts:
    """Failures of a table's row-level checks, counted by the tasks that write it: ``write_table(..., counts=...)``.

    The count is the last step before the write, after any shuffle of the layout. Spark takes such a count from a
    partition once, however often lost executors make a task run again, while tasks before a shuffle would be counted
    again. One object serves one write.
    """

    def __init__(self, checks: Sequence[Check]):
        self._checks = [c for c in checks if c.kind in ROW_KINDS]
        self._seen = Observation()

    def watch(self, rows: DataFrame) -> DataFrame:
        """``rows``, counted when they are written."""
        counted = [F.count_if(row_fails(c)).alias(f"n{i}") for i, c in enumerate(self._checks)]
        return rows.observe(self._seen, *counted) if counted else rows

    def failures(self) -> dict[str, int]:
        """Failures by the name of the check, once the write is done."""
        seen = self._seen.get if self._checks else {}
        return {c.name: seen[f"n{i}"] for i, c in enumerate(self._checks)}


def report_written(
    df: DataFrame, checks: Sequence[Check], counted: dict[str, int], parents: dict[str, DataFrame] | None = None
) -> DataFrame:
    """The report of ``run_checks`` for a stored table of which ``counted`` is known from its write.

    Only the columns of ``unique`` and ``relationships`` are read, in one scan; without such checks nothing is.
    """
    indexed = list(enumerate(checks))
    known = [F.struct(F.lit(i).alias("_check"), F.lit(counted[c.name]).cast("bigint").alias("failures"))
             for i, c in indexed if c.kind in ROW_KINDS]
    by_key = [(i, c) for i, c in indexed if c.kind not in ROW_KINDS]
    reports = []
    if known:
        reports.append(df.sparkSession.range(1).select(F.inline(F.array(*known))))
    if by_key:
        reports.append(_key_failures(df, by_key, parents or {}))
    return _report(checks, reports)


def _report(checks: Sequence[Check], found: Sequence[DataFrame]) -> DataFrame:
    """``check, column, failures, passed`` of ``(_check, failures)``."""
    found = reduce(DataFrame.unionByName, found)
    names = F.array(*[F.lit(c.name) for c in checks])
    columns = F.array(*[F.lit(c.column) for c in checks])
    return found.select(
        names[F.col("_check")].alias("check"),
        columns[F.col("_check")].alias("column"),
        "failures",
        (F.col("failures") == 0).alias("passed"),
    )


def _key_failures(df: DataFrame, checks: Sequence[tuple[int, Check]], parents: dict[str, DataFrame]) -> DataFrame:
    """``(_check, failures)`` for ``unique`` and ``relationships`` together.

    Every row gives one (check, key) pair per check; pairs are counted in the tasks before they are
    shuffled, so a hot key is one pair per task. Counts above one are repeated keys, pairs that meet
    no parent key are orphans. A check without pairs fails nowhere.
    """
    pairs = [
        F.struct(
            F.lit(i).alias("_check"),
            (F.col(c.column) if c.scope is None else F.when(F.expr(c.scope), F.col(c.column)))
            .cast("string")
            .alias("_key"),
        )
        for i, c in checks
    ]
    keys = df.select(F.inline(F.array(*pairs))).filter(F.col("_key").isNotNull())
    counted = keys.groupBy("_check", "_key").agg(F.count("*").alias("_rows"))
    known = None
    for i, c in checks:
        if c.kind == "relationships":
            parent, column = c.args
            side = parents[parent].select(
                F.lit(i).alias("_check"), F.col(column).cast(df.schema[c.column].dataType).cast("string").alias("_key")
            )
            known = side if known is None else known.unionByName(side)
    if known is None:
        found = counted.withColumn("_found", F.lit(False))
    else:
        known = known.filter(F.col("_key").isNotNull()).groupBy("_check", "_key").agg(F.lit(True).alias("_found"))
        found = counted.join(known, ["_check", "_key"], "left")
    uniques = [i for i, c in checks if c.kind == "unique"]
    is_unique = F.col("_check").isin(uniques) if uniques else F.lit(False)
    repeated = F.when(F.col("_rows") > 1, 1).otherwise(0)
    lost = F.when(F.col("_found").isNull(), F.col("_rows")).otherwise(0)
    per_check = found.groupBy("_check").agg(
        F.sum(F.when(is_unique, repeated).otherwise(lost)).cast("bigint").alias("failures")
    )
    every = df.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(i) for i, _ in checks])).alias("_check"), F.lit(0).cast("bigint").alias("failures")
    )
    return per_check.unionByName(every).groupBy("_check").agg(F.sum("failures").alias("failures"))


def store_failures(
    df: DataFrame,
    checks: Sequence[Check],
    path: str,
    parents: dict[str, DataFrame] | None = None,
    passed: Collection[str] = (),
) -> list[str]:
    """Write what the checks object to under ``path/check=<name>``; returns the names written.

    Rows failing row-level checks are tagged with every rule they break and written in one pass,
    however many checks there are; ``unique`` and ``relationships`` take one job each. Of checks named in ``passed`` no
    row is looked for, and what an earlier run has stored for them goes.
    """
    spark = df.sparkSession
    by_row = [c for c in checks if c.kind in ROW_KINDS]
    if by_row:
        broken = F.array_compact(F.array(*[F.when(row_fails(c), F.lit(c.name)) for c in by_row]))
        rows = df.withColumn("check", F.explode(broken))
        open_ones = [row_fails(c) for c in by_row if c.name not in passed]
        found = df.filter(reduce(or_, open_ones)).withColumn("check", F.explode(broken)) if open_ones else _none(rows)
        found.write.mode("overwrite").partitionBy("check").parquet(f"{path}/rows")
        Folder(spark, f"{path}/rows").write_json(ROWS_SCHEMA, rows.schema.jsonValue())
    for check in checks:
        if check.kind not in ROW_KINDS:
            found = failing(df, check, parents)
            found = _none(found) if check.name in passed else found
            found.write.mode("overwrite").parquet(f"{path}/{check.name}")
    return [c.name for c in checks]


def _none(df: DataFrame) -> DataFrame:
    """No rows, in the schema of ``df``."""
    return df.sparkSession.createDataFrame([], df.schema)


def read_failures(spark: SparkSession, check: Check, path: str) -> DataFrame:
    """Stored failures of one check; none if it passed."""
    if check.kind in ROW_KINDS:
        return _stored_rows(spark, path).filter(F.col("check") == check.name).drop("check")
    return spark.read.parquet(f"{path}/{check.name}")


def _stored_rows(spark: SparkSession, path: str) -> DataFrame:
    schema = StructType.fromJson(Folder(spark, f"{path}/rows").read_json(ROWS_SCHEMA))
    return spark.read.schema(schema).parquet(f"{path}/rows")


def stored_report(spark: SparkSession, checks: Sequence[Check], path: str) -> DataFrame:
    """The report of ``run_checks`` from what ``store_failures`` has written, without another look at the data."""
    found = None
    if any(c.kind in ROW_KINDS for c in checks):
        found = _stored_rows(spark, path).groupBy("check").agg(F.count("*").alias("failures"))
    for check in checks:
        if check.kind not in ROW_KINDS:
            part = read_failures(spark, check, path).agg(F.count("*").alias("failures"))
            part = part.select(F.lit(check.name).alias("check"), "failures")
            found = part if found is None else found.unionByName(part)
    names = F.array(*[F.struct(F.lit(c.name).alias("check"), F.lit(c.column).alias("column")) for c in checks])
    declared = spark.range(1).select(F.inline(names))
    failures = F.coalesce("failures", F.lit(0).cast("bigint"))
    return declared.join(found, "check", "left").select(
        "check", "column", failures.alias("failures"), (failures == 0).alias("passed")
    )
