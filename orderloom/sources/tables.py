"""Stored tables: full rebuild, incremental upsert, and snapshot history, on plain Parquet.

A table is a folder of versions, ``<path>/v_000001`` and so on. Spark puts ``_SUCCESS`` into a folder
only when the whole write has been committed, so the newest folder with that file *is* the table; a
write that dies half way leaves a folder nobody reads. One writer per table at a time is assumed.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderloom.operators.changes import UNCHANGED, fingerprint
from orderloom.operators.dedupe import dedupe_first
from orderloom.operators.history import VALIDITY, scd2_changes, scd2_start
from orderloom.operators.incremental import assert_schema
from orderloom.operators.quality import RowCounts
from orderloom.operators.upsert import match_keys, upsert
from orderloom.sources.folders import Folder
from orderloom.sources.index import ABOUT, INDEX, KeyIndex, existing, load_numbers

Layout = Callable[[DataFrame], DataFrame]
STAGED = "_staged"
SCHEMA = "_schema"
OPEN_SEGMENT = "open"
#: Rows of a partition that one task merges in an upsert.
SHARE_ROWS = 4_000_000


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def with_loaded_at(df: DataFrame, at: dt.datetime | None = None) -> DataFrame:
    """Stamp rows with the load time."""
    return df.withColumn("loaded_at", (F.current_timestamp() if at is None else F.lit(at)).cast("timestamp"))


# --- layouts --------------------------------------------------------------------------------------
def range_sort(column: str) -> Layout:
    """Cluster by a column: files cover narrow ranges of it, which scans skip by min/max.

    A hash of the row is the second range key: one value with a third of all rows would otherwise
    be one task.
    """

    def arrange(df: DataFrame) -> DataFrame:
        spread = F.xxhash64(*df.columns)
        return df.repartitionByRange(F.col(column), spread).sortWithinPartitions(column)

    return arrange


def balanced(*columns: str) -> Layout:
    """Bring rows of one partition value together for few files; large values are split at run time."""
    return lambda df: df.hint("rebalance", *columns)


def balanced_sorted(partition_by: Sequence[str], *columns: str) -> Layout:
    """The same, and files sorted by ``columns``, of which scans then read the pages they look for."""
    spread = balanced(*partition_by) if partition_by else lambda df: df
    return lambda df: spread(df).sortWithinPartitions(*partition_by, *columns)


# --- full rebuild ---------------------------------------------------------------------------------
def current_version(spark: SparkSession, path: str) -> str | None:
    table = Folder(spark, path)
    done = [v for v in table.folders() if v.startswith("v_") and table.exists(f"{v}/_SUCCESS")]
    return f"{table.path}/{done[-1]}" if done else None


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    layout: Layout | None = None,
    counts: RowCounts | None = None,
) -> DataFrame:
    """Rebuild a table from ``df``, which may read the table itself: the old version stays as it is.

    ``counts`` takes the failures of its checks from the rows as they are written.
    """
    spark = df.sparkSession
    versions = [v for v in Folder(spark, path).folders() if v.startswith("v_")]
    number = int(versions[-1][2:]) + 1 if versions else 1
    rows = (layout or (balanced(*partition_by) if partition_by else lambda d: d))(df)
    rows = rows if counts is None else counts.watch(rows)
    target = f"{path.rstrip('/')}/v_{number:06d}"
    Folder(spark, target).write_json(SCHEMA, rows.schema.jsonValue())
    rows.write.mode("append").partitionBy(*partition_by).parquet(target)
    return spark.read.schema(rows.schema).parquet(target)


def _read_version(spark: SparkSession, version: str, schema: StructType | None = None) -> DataFrame:
    """A version in the given schema, else in the one it was written with."""
    return spark.read.schema(schema or _stored_schema(spark, version)).parquet(version)


def _stored_schema(spark: SparkSession, version: str) -> StructType:
    """The schema a version was written with: folder names alone would turn ``02109`` into a number."""
    folder = Folder(spark, version)
    return StructType.fromJson(folder.read_json(SCHEMA)) if folder.exists(SCHEMA) else spark.read.parquet(version).schema


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Newest complete version, in the schema it was written with unless another is given.

    Reading changes nothing: where a writer was lost between deciding on a swap and finishing it, the
    partitions still waiting beside the table are read in place of the old ones.
    """
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no complete version under {path}")
    table, staged = Folder(spark, version), Folder(spark, f"{version}/{STAGED}")
    plain = _read_version(spark, version, schema)
    if not staged.exists("_ready"):
        return plain
    plan = staged.read_json("_ready")
    waiting = _leaves(staged, plan["depth"])
    kept = [p for p in _leaves(table, plan["depth"]) if p not in {*waiting, *plan["emptied"]}]
    parts = [
        spark.read.schema(plain.schema).option("basePath", at.path).parquet(*[f"{at.path}/{p}" for p in names])
        for at, names in ((table, kept), (staged, waiting))
        if names
    ]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]) if parts else plain.filter("false")


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete all but the newest ``keep`` complete versions; returns the names deleted."""
    table = Folder(spark, path)
    done = [v for v in table.folders() if v.startswith("v_") and table.exists(f"{v}/_SUCCESS")]
    gone = done[: max(len(done) - max(keep, 1), 0)]
    for version in gone:
        table.delete(version)
    return gone


# --- replacing some partitions --------------------------------------------------------------------
def partition_folder(column: str, value: str | None) -> str:
    """``column=value`` as Spark names it; ``value`` is text that Spark has made of it (``cast("string")``)."""
    if value is None or value == "":
        return f"{column}=__HIVE_DEFAULT_PARTITION__"
    special = set("\"#%'*/:=?\\{[]^\x7f") | {chr(i) for i in range(1, 32)}
    return column + "=" + "".join(f"%{ord(ch):02X}" if ch in special else ch for ch in value)


def replace_partitions(
    rows: DataFrame,
    version: str,
    partition_by: Sequence[str],
    touched: Sequence[str] = (),
    entries: DataFrame | None = None,
    load: int = 0,
    layout: Layout | None = None,
) -> None:
    """Put ``rows`` in place of the partitions they belong to; ``touched`` partition folders that
    get no rows are removed. ``entries`` become the index's folder of ``load`` in the same swap.

    Rows are first written beside the table (hidden from readers), which also makes it safe for
    them to come from the table. When all are there, folders are swapped by renames. A driver lost
    during the swap loses nothing: ``finish_replacing`` goes on where it stopped.
    """
    spark = rows.sparkSession
    table, staged = Folder(spark, version), Folder(spark, f"{version}/{STAGED}")
    finish_replacing(spark, version)
    staged.delete()
    (layout or balanced(*partition_by))(rows).write.partitionBy(*partition_by).parquet(staged.path)
    beside = []
    if entries is not None:
        beside.append(f"{INDEX}/load={load}")
        entries.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{staged.path}/{beside[0]}")
    incoming = set(_leaves(staged, len(partition_by)))
    emptied = [p for p in touched if p not in incoming]
    staged.write_json("_ready", {"depth": len(partition_by), "emptied": emptied, "beside": beside})
    finish_replacing(spark, version)


def finish_replacing(spark: SparkSession, version: str) -> None:
    """Complete a swap that was decided on; does nothing if there is none."""
    table, staged = Folder(spark, version), Folder(spark, f"{version}/{STAGED}")
    if not staged.exists("_ready"):
        return
    plan = staged.read_json("_ready")
    table.each(lambda leaf: table.move_in(staged, leaf), _leaves(staged, plan["depth"]))
    table.each(table.delete, plan["emptied"])
    for other in plan.get("beside", []):
        if staged.exists(other):
            table.move_in(staged, other)
    staged.delete()


def _leaves(folder: Folder, depth: int, at: str = "") -> list[str]:
    if depth == 0:
        return [at]
    found = []
    for name in folder.folders(at):
        found += _leaves(folder, depth - 1, f"{at}/{name}" if at else name)
    return found


# --- incremental upsert ---------------------------------------------------------------------------
def upsert_table(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    *,
    order_by: Sequence[str | Column] | None = None,
    old_rows_in: Column | str | None = None,
    full_refresh: bool = False,
    ignore: Sequence[str] = (),
    derive: Layout | None = None,
) -> DataFrame:
    """Upsert ``batch`` into a table, rewriting only the partitions it changes; all of a table without any.

    Changed are partitions that get a new or different row and those holding older rows of such keys: a row whose
    partition value changed must leave its old place. Rows equal to what is stored, ``ignore`` columns apart, change nothing and
    keep the stored values of these columns. Old rows are found by the table's index of keys, of which the buckets of
    the batch's keys are read; the first load that needs one builds it. ``old_rows_in`` instead searches the
    partitions that satisfy it: rows outside are neither looked for nor replaced, every row of the batch counts as changed, and the
    index is given up. The list of touched partitions (one short text each)
    comes to the driver, which swaps them; choose partitions of a size that a load touches thousands of them
    at most. A null key is a key like any other. A first load or ``full_refresh`` writes the whole table.

    ``derive`` makes the rows of the table from those of the batch, each from one and in the same partition; a load of the whole table moves
    them before that, while they are narrow.
    """
    spark = batch.sparkSession
    fresh = batch if order_by is None else dedupe_first(batch, keys, order_by)
    derive = derive or (lambda rows: rows)
    version = None if full_refresh else current_version(spark, path)
    if version is None:
        spread = balanced(*partition_by) if partition_by else lambda rows: rows
        return write_table(fresh, path, partition_by, lambda rows: derive(spread(rows)))
    batch, fresh = derive(batch), derive(fresh)
    finish_replacing(spark, version)
    # without a stored schema the types of partition columns are only guessed from folder names
    assert_schema(_without(_stored_schema(spark, version), partition_by), _without(batch.schema, partition_by))
    if not partition_by:
        return write_table(upsert(_read_version(spark, version), fresh, keys), path)
    if old_rows_in is None:
        _upsert_indexed(fresh, version, keys, partition_by, ignore)
    else:
        _upsert_searched(fresh, version, keys, partition_by, old_rows_in)
    return _read_version(spark, version, batch.schema)


def _upsert_indexed(
    fresh: DataFrame, version: str, keys: Sequence[str], partition_by: Sequence[str], ignore: Sequence[str]
) -> None:
    """The upsert by the index of keys."""
    spark, scratch, changes, seen = fresh.sparkSession, f"{version}/_batch", f"{version}/_changes", Observation()
    index = KeyIndex.of(
        spark, version, fresh.columns, keys, partition_by, ignore, lambda: _read_version(spark, version, fresh.schema)
    )
    # Read twice below: written once, so that a load time or a source that moves on cannot make the reads differ.
    marked = index.marked(fresh)
    marked.observe(seen, F.collect_set("_bucket").alias("buckets")).write.mode("overwrite").parquet(scratch)
    marked = spark.read.schema(marked.schema).parquet(scratch)
    judged = index.judged(marked, sorted(seen.get["buckets"])).filter(F.col("change") != UNCHANGED)
    # read three times below: what is written is searched for in the index once
    judged.write.mode("overwrite").parquet(changes)
    judged = spark.read.schema(judged.schema).parquet(changes)
    # one row per touched partition
    places = judged.select(F.explode(F.array_append("_old", F.col("_place"))).alias("place")).distinct().collect()
    if places:
        leaves = ["/".join(map(partition_folder, partition_by, p["place"])) for p in places]
        merged = _merged_in_place(judged, fresh.columns, version, index, leaves)
        replace_partitions(merged, version, partition_by, leaves, index.entries(judged), index.next_load(), layout=lambda rows: rows)
    for folder in (changes, scratch):
        Folder(spark, folder).delete()


def _upsert_searched(
    fresh: DataFrame, version: str, keys: Sequence[str], partition_by: Sequence[str], old_rows_in: Column | str
) -> None:
    """The upsert with the search for old rows bounded by the caller."""
    spark, scratch = fresh.sparkSession, f"{version}/_batch"
    fresh.write.mode("overwrite").parquet(scratch)
    fresh = spark.read.schema(fresh.schema).parquet(scratch)
    replaced = match_keys(_read_version(spark, version, fresh.schema).filter(old_rows_in), fresh, keys, "left_semi")
    text = [F.col(c).cast("string").alias(c) for c in partition_by]
    places = replaced.select(*text).union(fresh.select(*text)).distinct().collect()  # one row per touched partition
    if places:
        leaves = ["/".join(partition_folder(n, p[n]) for n in partition_by) for p in places]
        Folder(spark, version).delete(ABOUT)  # the index would miss what this load does
        merged = _merged(fresh, version, keys, leaves)
        replace_partitions(merged, version, partition_by, leaves)
    Folder(spark, scratch).delete()


def _merged_in_place(judged: DataFrame, columns: Sequence[str], version: str, index: KeyIndex, leaves: Sequence[str]) -> DataFrame:
    """The rows of the partitions ``leaves`` after the upsert of ``judged``, dealt by partition as they are written.

    Stored rows move once, to the task that writes their partition; the keys that are replaced travel to where the index says they are. A
    partition of over ``SHARE_ROWS`` rows is cut into shares by key. One row per partition comes to the driver for that.
    """
    changed = balanced(*index.partition_by)(judged.select(*columns))
    old = _stored_in(changed, version, leaves)
    if old is None:
        return changed
    place = F.xxhash64(F.transform("_place", lambda p: F.nullif(p, F.lit(""))))  # empty text is read back as null
    sizes = {r["at"]: r["count"] for r in index.marked(old).groupBy(place.alias("at")).count().collect()}
    large, most = [at for at, n in sizes.items() if n > SHARE_ROWS], max(sizes.values(), default=0)
    at = F.when(place.isin(large), F.xxhash64(place, F.pmod("_key.b", F.lit(-(-most // SHARE_ROWS))))).otherwise(place) if large else place
    gone = judged.select("_key", F.explode("_old").alias("_place")).select("_key", at.alias("_at")).repartition("_at")
    dealt = index.marked(old).select(*columns, at.alias("_at")).repartition("_at")
    kept = dealt.withColumn("_key", fingerprint(index.keys)).join(gone, ["_at", "_key"], "left_anti")
    return kept.select(*columns).unionByName(changed)


def _stored_in(like: DataFrame, version: str, leaves: Sequence[str]) -> DataFrame | None:
    """The stored rows of the partitions ``leaves``, null if none of these is there."""
    spark = like.sparkSession
    table = Folder(spark, version)
    there = [f"{version}/{leaf}" for leaf, found in zip(leaves, table.each(table.exists, leaves), strict=True) if found]
    return spark.read.schema(like.schema).option("basePath", version).parquet(*there) if there else None


def _merged(changed: DataFrame, version: str, keys: Sequence[str], leaves: Sequence[str]) -> DataFrame:
    """The rows of the partitions ``leaves`` after the upsert."""
    old = _stored_in(changed, version, leaves)
    return changed if old is None else upsert(old, changed, keys)


# --- what loads have changed ----------------------------------------------------------------------
def last_load(spark: SparkSession, path: str) -> int:
    """Number of the newest load that changed an indexed table; 0 before the first change."""
    version = current_version(spark, path)
    if version is None:
        return 0
    finish_replacing(spark, version)
    return max([0, *load_numbers(spark, version)])


def read_changes(spark: SparkSession, path: str, since: int) -> DataFrame:
    """Rows that loads after number ``since`` have inserted or updated, as they are now, with ``change`` and the ``load``
    that wrote them.

    Only the index's folders of these loads and the partitions they wrote to are read. A key that was
    new since then is ``inserted`` even if a later load changed it again. Numbers from before the index was last built anew are refused: the
    reader has to start over from the whole table.
    """
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no complete version under {path}")
    finish_replacing(spark, version)
    index = existing(spark, version)
    if index is None or since < index.base:
        raise ValueError(f"changes are known from load {0 if index is None else index.base} on, not from {since}")
    stored = read_table(spark, path)
    entries = index.read(F.col("load") > since)
    now = entries.groupBy(F.col("key").alias("_key")).agg(
        F.min_by("change", "load").alias("change"), F.max("load").alias("load"), F.max_by("place", "load").alias("_place")
    )
    leaves = [
        f"{version}/{'/'.join(map(partition_folder, index.partition_by, r['_place']))}"
        for r in now.select("_place").distinct().collect()  # one row per partition written to
    ]
    if not leaves:
        return stored.filter("false").select("*", F.lit("").alias("change"), F.lit(0).alias("load"))
    rows = index.marked(spark.read.schema(stored.schema).option("basePath", version).parquet(*leaves))
    return rows.join(now.drop("_place"), "_key").select(*stored.columns, "change", "load")


def _without(schema: StructType, names: Sequence[str]) -> StructType:
    return StructType([f for f in schema if f.name not in names])


def newest_partition(spark: SparkSession, path: str, column: str) -> DataFrame | None:
    """Rows of the partition with the largest value, null for a table without any.

    The partition is found by folder name, without opening a file, for values that sort as text such
    as dates; its rows come without the partition column. For writers: an interrupted swap is
    completed first.
    """
    version = current_version(spark, path)
    if version is None:
        return None
    finish_replacing(spark, version)
    names = [f for f in Folder(spark, version).folders() if f.startswith(f"{column}=")]
    known = [f for f in names if f != partition_folder(column, None)]
    return spark.read.parquet(f"{version}/{max(known)}") if known else None


# --- snapshot history -----------------------------------------------------------------------------
def snapshot_table(
    current: DataFrame,
    path: str,
    keys: Sequence[str],
    check_cols: Sequence[str],
    now: dt.datetime,
    order_by: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Bring a stored type-2 history up to ``current``.

    Open versions are one partition, the versions closed by each run another, so a run reads and
    rewrites open versions only: its cost follows the dimension, not the length of its history.
    """
    spark = current.sparkSession
    version = current_version(spark, path)
    if version is None:
        fresh = current if order_by is None else dedupe_first(current, keys, order_by)
        known = fresh.na.drop("any", subset=list(keys))
        first = scd2_start(known, keys, now).withColumn("segment", F.lit(OPEN_SEGMENT))
        write_table(first, path, ["segment"])
        return read_history(spark, path)
    finish_replacing(spark, version)
    versions = _read_version(spark, version)
    assert_schema(_without(versions.schema, ("segment", *VALIDITY)), current.schema)
    open_versions = versions.filter(F.col("segment") == OPEN_SEGMENT).drop("segment")
    run = f"closed-{uuid.uuid4().hex}"
    changes = scd2_changes(open_versions, current, keys, check_cols, now, order_by).withColumn(
        "segment", F.when(F.col("valid_to").isNull(), OPEN_SEGMENT).otherwise(run)
    )
    replace_partitions(changes, version, ["segment"], [partition_folder("segment", OPEN_SEGMENT)])
    return read_history(spark, path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path).drop("segment")
