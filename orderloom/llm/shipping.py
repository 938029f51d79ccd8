"""Helpers shared by the operators: workers that can import this package, and files all executors share."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.session import work_dir

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ready(df: DataFrame) -> SparkSession:
    """The session of ``df``, set up so that Python workers started by a local master find this package.

    On a cluster the package is installed or handed over with ``--py-files`` as usual; a path that a
    worker does not have is ignored there.
    """
    spark = df.sparkSession
    paths = spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    if ROOT not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join((paths, ROOT))
    return spark


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the session names in ``spark.checkpoint.dir``."""
    return f"{work_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there, and lost executors cost nothing."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pieces(batches: Iterator[pa.RecordBatch], size: int = 4 << 20, text: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``size`` bytes of ``text``, one row at least, so that temporary
    arrays stay bounded whatever the length of the texts."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(text).cast(pa.binary())).to_pylist()
        first = total = 0
        for i, n in enumerate(lengths):
            n = n or 0
            if i > first and total + n > size:
                yield batch.slice(first, i - first)
                first, total = i, 0
            total += n
        if first < batch.num_rows:
            yield batch.slice(first)


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each value; null is empty."""
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]


def set_aside(df: DataFrame, names: set[str]) -> tuple[DataFrame, list[Column]]:
    """``df`` with the columns of these names renamed out of the way, and the expressions that bring back all its columns."""
    renamed: dict[str, str] = {}
    for c in df.columns:
        if c in names:
            new = f"_{c}"
            while new in df.columns or new in renamed.values():
                new = f"_{new}"
            renamed[c] = new
    return df.withColumnsRenamed(renamed), [F.col(f"`{renamed.get(c, c)}`").alias(c) for c in df.columns]
