"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedupe_first(
    df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[str | Column]
) -> DataFrame:
    """First row per ``keys`` in ``order_by`` order; null keys form a group of their own.

    ``order_by`` must be a total order within a key, else which of two ties survives is open.
    The rank filter lets Spark cut every task's rows to one per key *before* the shuffle
    (WindowGroupLimit), so a key with a third of all rows costs one row per task, not one big task.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
