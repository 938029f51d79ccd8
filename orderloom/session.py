"""Session settings the plans rely on, and the shared work folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# A left join on a hot key is split at run time (skewJoin); forcing the split matters for chains of
# joins on one key, where Spark would otherwise keep the skewed partition to save a shuffle. Rows that lie together by one key
# of a join stay there (``lookups_in_place``), instead of being moved because the join has a second key. Shuffle files go once
# what they were made for is done, not when the driver happens to collect garbage: a build takes the disk of its largest step, not
# of all steps. Generated methods that the JVM would only interpret (over 8,000 bytes) are split by operator instead.
SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.session.timeZone": "UTC",
}


# Only settable when a session starts. One query of the marts compiles dozens of generated classes;
# with the usual 100 entries a few queries in turn evict each other's and recompile them every time.
START_DEFAULTS = {"spark.sql.codegen.cache.maxEntries": "2000"}


def apply_scale_defaults(spark: SparkSession) -> SparkSession:
    """Set ``SCALE_DEFAULTS`` where the session says nothing; explicit settings win."""
    chosen = spark.conf.getAll
    for key, value in SCALE_DEFAULTS.items():
        if key not in chosen:
            spark.conf.set(key, value)
    return spark


def local_session(name: str = "orderloom", cores: str | int = "*", **conf: str) -> SparkSession:
    """A single-process session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
    )
    for key, value in {**SCALE_DEFAULTS, **START_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder for written intermediates: ``spark.checkpoint.dir`` of the session.

    A machine-local folder is made only for local masters, where all tasks see the same disk.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    made = tempfile.mkdtemp(prefix="orderloom-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made
