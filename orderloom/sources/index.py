"""Where each key of a stored table is and what its row looked like.

An index lies in ``_index`` inside a table version: one folder for each load, in it one for each bucket of key hashes, with
a row for every key the load wrote: the key's fingerprint, the partition it went to, the content's fingerprint and whether the key
was new. The newest load that names a key is right about it. A load thus finds the old places of its keys, and the rows it
need not write, by reading the buckets of its keys; the table itself is not searched.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.operators.changes import INSERTED, UNCHANGED, UPDATED, fingerprint
from orderloom.sources.folders import Folder

INDEX = "_index"
ABOUT = f"{INDEX}/_about"
#: Loads after which the index is built anew from the table, so that entries of keys that moved on do not pile up.
LOADS = 50
#: Buckets double until each has this many keys at most, up to a number of buckets.
KEYS_PER_BUCKET, MOST_BUCKETS = 100_000, 16_384

_HASH = "struct<a: bigint, b: bigint>"
ENTRY = f"key {_HASH}, place array<string>, content {_HASH}, change string, load int, bucket int"


@dataclass(frozen=True)
class KeyIndex:
    """The index of a table version. ``base`` is the number of the load it was built after."""

    spark: SparkSession
    version: str
    keys: list[str]
    partition_by: list[str]
    ignore: list[str]
    buckets: int
    base: int

    @classmethod
    def of(
        cls,
        spark: SparkSession,
        version: str,
        columns: Sequence[str],
        keys: Sequence[str],
        partition_by: Sequence[str],
        ignore: Sequence[str],
        read: Callable[[], DataFrame],
    ) -> KeyIndex:
        """The index that is there, if it is complete and about these columns; otherwise a new one, for which keys
        and contents of the whole table, as ``read`` gives it, are read once."""
        folder = Folder(spark, version)
        wanted = {"keys": list(keys), "partition_by": list(partition_by), "ignore": sorted(ignore), "columns": sorted(columns)}
        about = folder.read_json(ABOUT) if folder.exists(ABOUT) else {}
        last = about.get("base", 0)
        if about:
            last = max([last, *load_numbers(spark, version)])
            if {k: about[k] for k in wanted} == wanted and last - about["base"] < LOADS:
                return cls(spark, version, *(about[k] for k in ("keys", "partition_by", "ignore", "buckets", "base")))
        folder.delete(INDEX)
        stored = read()
        count, buckets = stored.count(), 1
        while buckets < MOST_BUCKETS and buckets * KEYS_PER_BUCKET < count:
            buckets *= 2
        index = cls(spark, version, list(keys), list(partition_by), sorted(ignore), buckets, last)
        # hashes move once, to the task that writes their bucket
        hashes = index.marked(stored).select("_key", "_place", "_content.*", "_bucket").repartition("_bucket")
        # a key that is there more than once has no content to compare with
        content = F.when(F.count("*") == 1, F.struct(F.max("a").alias("a"), F.max("b").alias("b"))).alias("_content")
        once = hashes.groupBy("_bucket", "_key", "_place").agg(content)
        entries = index.entries(once.withColumn("change", F.lit(INSERTED)))
        entries.write.partitionBy("bucket").parquet(f"{version}/{INDEX}/load={last}")
        folder.write_json(ABOUT, wanted | {"buckets": buckets, "base": last})
        return index

    def next_load(self) -> int:
        return max([self.base, *load_numbers(self.spark, self.version)]) + 1

    def marked(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``_key``, ``_content``, ``_place`` and ``_bucket``."""
        content = [c for c in rows.columns if c not in self.ignore]
        return rows.select(
            "*",
            fingerprint(self.keys).alias("_key"),
            fingerprint(content).alias("_content"),
            F.array(*[F.col(f"`{c}`").cast("string") for c in self.partition_by]).alias("_place"),
        ).withColumn("_bucket", F.pmod("_key.a", F.lit(self.buckets)).cast("int"))

    def entries(self, marked: DataFrame) -> DataFrame:
        return marked.select(
            F.col("_key").alias("key"),
            F.col("_place").alias("place"),
            F.col("_content").alias("content"),
            "change",
            F.col("_bucket").alias("bucket"),
        )

    def read(self, where: Column | None = None) -> DataFrame:
        rows = self.spark.read.schema(ENTRY).option("basePath", f"{self.version}/{INDEX}").parquet(f"{self.version}/{INDEX}")
        return rows if where is None else rows.filter(where)

    def judged(self, marked: DataFrame, buckets: Sequence[int]) -> DataFrame:
        """``marked`` rows, whose keys lie in ``buckets``, with ``change`` and ``_old``, the places where their keys are now."""
        known = self.read(F.col("bucket").isin(list(buckets))).join(
            marked.select(F.col("_key").alias("key")), "key", "left_semi"
        )
        entry = F.struct("load", "place", "content")
        latest = known.groupBy(F.col("key").alias("_key")).agg(F.max("load").alias("_last"), F.collect_list(entry).alias("_all"))
        now = latest.select("_key", F.filter("_all", lambda e: e["load"] == F.col("_last")).alias("_now"))
        same = (
            (F.size("_now") == 1)
            & F.col("_now")[0]["content"].eqNullSafe(F.col("_content"))
            & F.col("_now")[0]["place"].eqNullSafe(F.col("_place"))
        )
        change = F.when(F.col("_now").isNull(), INSERTED).when(same, UNCHANGED).otherwise(UPDATED)
        old = F.coalesce(F.transform("_now", lambda e: e["place"]), F.array().cast("array<array<string>>"))
        return marked.join(now, "_key", "left").select(*marked.columns, change.alias("change"), old.alias("_old"))


def load_numbers(spark: SparkSession, version: str) -> list[int]:
    names = Folder(spark, f"{version}/{INDEX}").folders()
    return [int(name.removeprefix("load=")) for name in names if name.startswith("load=")]


def existing(spark: SparkSession, version: str) -> KeyIndex | None:
    """The index as it was last used, null without one."""
    folder = Folder(spark, version)
    if not folder.exists(ABOUT):
        return None
    about = folder.read_json(ABOUT)
    return KeyIndex(spark, version, *(about[k] for k in ("keys", "partition_by", "ignore", "buckets", "base")))
