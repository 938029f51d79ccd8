"""Results of declared checks on a stored table, brought up to date after loads without another look at the whole table.

Failures of row-level checks are totals by partition. For ``unique`` and ``relationships`` the rows of each key are kept by
partition, sorted by bucket of the key, with a digest of each bucket; failures are kept by bucket and counted again only where
the digest, of the table or of the parent, is another.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.operators.quality import ROW_KINDS, Check, row_fails
from orderloom.sources.tables import current_version, drop_old_versions, read_table, write_table
from orderloom.sources.totals import Totals

#: Buckets of key hashes, as many numbers and digests for each key check come to the driver.
BUCKETS = 1024
FAILURES = "bucket int, mine decimal(38,0), theirs decimal(38,0), failures bigint"


@dataclass(frozen=True)
class StoredTable:
    """Where a table is stored and what it is partitioned by."""

    path: str
    partition_by: Sequence[str] = ()


class KeyCounts:
    """Rows of each key of a stored table, and a digest of each bucket of keys that tells whether it has changed.

    A digest adds up key hashes over all partitions, so a row that only moves to another partition changes none.
    """

    def __init__(self, path: str, table: StoredTable, key: Column, scope: Column, buckets: int):
        bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
        self.table = table
        self.rows = Totals(
            f"{path}/keys",
            table.partition_by,
            {"_bucket": bucket, "_key": key},
            {"_rows": F.lit(1)},
            where=key.isNotNull() & scope,
            sorted_by=["_bucket"],
        )
        hashed = F.xxhash64("_key").cast("decimal(19,0)") * F.col("_rows").cast("decimal(15,0)")
        self.digests = Totals(f"{path}/digests", table.partition_by, {"_bucket": F.col("_bucket")}, {"_digest": hashed})

    def refresh(self, spark: SparkSession) -> list[str]:
        """Returns the partitions of the table that were read."""
        read = self.rows.refresh(spark, self.table.path)
        self.digests.refresh(spark, self.rows.path)
        return read

    def by_bucket(self, spark: SparkSession) -> dict:
        return {r["_bucket"]: r["_digest"] for r in self.digests.read(spark).collect()}

    def of(self, spark: SparkSession, buckets: Sequence[int]) -> DataFrame:
        return self.rows.read(spark, F.col("_bucket").isin(list(buckets)))


@dataclass(frozen=True)
class CheckState:
    """The state of ``checks`` on ``table``, kept under ``path``. ``parents`` says where the tables that ``relationships``
    name are stored."""

    path: str
    table: StoredTable
    checks: Sequence[Check]
    parents: Mapping[str, StoredTable] | None = None
    buckets: int = BUCKETS

    def refresh(self, spark: SparkSession) -> dict[str, list[str]]:
        """Bring the state up to what the tables hold; returns the partitions read for ``rows``, for each key check, and as
        ``<check>.parent`` for its parent. Interrupted, it is made up for by the next one."""
        read = {}
        by_row = self._row_checks()
        if by_row:
            read["rows"] = self._row_totals().refresh(spark, self.table.path)
        for check in self.checks:
            if check.kind in ROW_KINDS:
                continue
            mine, theirs = self._keys(spark, check)
            read[check.name] = mine.refresh(spark)
            if theirs is not None:
                read[f"{check.name}.parent"] = theirs.refresh(spark)
            self._recount(spark, check, mine, theirs)
        return read

    def report(self, spark: SparkSession) -> DataFrame:
        """The report of ``run_checks`` as of the last refresh."""
        by_row = self._row_checks()
        found = self._row_totals().read(spark).first().asDict() if by_row else {}
        failures = {c.name: found[f"n{i}"] or 0 for i, c in enumerate(by_row)}
        for check in self.checks:
            if check.kind not in ROW_KINDS:
                failures[check.name] = sum(n for _, _, n in self._counted(spark, check).values())
        rows = [(c.name, c.column, failures[c.name], failures[c.name] == 0) for c in self.checks]
        return spark.createDataFrame(rows, "check string, column string, failures bigint, passed boolean")

    def _row_checks(self) -> list[Check]:
        return [c for c in self.checks if c.kind in ROW_KINDS]

    def _row_totals(self) -> Totals:
        counts = {f"n{i}": row_fails(c).cast("int") for i, c in enumerate(self._row_checks())}
        return Totals(f"{self.path}/rows", self.table.partition_by, {}, counts)

    def _keys(self, spark: SparkSession, check: Check) -> tuple[KeyCounts, KeyCounts | None]:
        """Key counts of the table and, for ``relationships``, of the parent, whose key is taken in the type of the table's."""
        scope = F.lit(True) if check.scope is None else F.coalesce(F.expr(check.scope), F.lit(False))
        at = f"{self.path}/{check.name}"
        mine = KeyCounts(f"{at}/own", self.table, F.col(check.column).cast("string"), scope, self.buckets)
        if check.kind != "relationships":
            return mine, None
        name, column = check.args
        kind = read_table(spark, self.table.path).schema[check.column].dataType
        key = F.col(column).cast(kind).cast("string")
        return mine, KeyCounts(f"{at}/parent", (self.parents or {})[name], key, F.lit(True), self.buckets)

    def _recount(self, spark: SparkSession, check: Check, mine: KeyCounts, theirs: KeyCounts | None) -> None:
        """Count failures again in buckets with another digest than they were counted with."""
        parent = {} if theirs is None else theirs.by_bucket(spark)
        now = {b: (digest, parent.get(b)) for b, digest in mine.by_bucket(spark).items()}
        known = self._counted(spark, check)
        stale = sorted(b for b, digests in now.items() if known.get(b, (None, None))[:2] != digests)
        if not stale and set(known) == set(now) and current_version(spark, self._failures(check)):
            return
        rows = mine.of(spark, stale)
        if theirs is None:
            broken = F.count_if(F.col("_rows") > 1)
        else:
            there = theirs.of(spark, stale).select("_bucket", "_key", F.lit(True).alias("_there"))
            rows = rows.join(there, ["_bucket", "_key"], "left")
            broken = F.coalesce(F.sum(F.when(F.col("_there").isNull(), F.col("_rows"))), F.lit(0))
        again = {r["_bucket"]: r["n"] for r in rows.groupBy("_bucket").agg(broken.cast("bigint").alias("n")).collect()}
        counted = [(b, *digests, again[b] if b in again else known[b][2]) for b, digests in now.items()]
        write_table(spark.createDataFrame(counted, FAILURES).coalesce(1), self._failures(check))
        drop_old_versions(spark, self._failures(check))

    def _failures(self, check: Check) -> str:
        return f"{self.path}/{check.name}/failures"

    def _counted(self, spark: SparkSession, check: Check) -> dict:
        """Digests and failures by bucket, as they were counted last."""
        if current_version(spark, self._failures(check)) is None:
            return {}
        rows = read_table(spark, self._failures(check)).collect()
        return {r["bucket"]: (r["mine"], r["theirs"], r["failures"]) for r in rows}
