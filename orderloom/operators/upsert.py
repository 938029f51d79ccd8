"""Replace by key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.operators.dedupe import dedupe_first


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Target rows without a successor in ``batch``, plus the batch.

    With ``order_by`` the batch is first cut to the first row per key; without it the batch must
    hold each key once. A null is a key value like any other. Applying one batch twice gives the
    same table as applying it once.
    """
    fresh = batch if order_by is None else dedupe_first(batch, keys, order_by)
    return match_keys(target, fresh, keys, "left_anti").unionByName(fresh)


def match_keys(rows: DataFrame, other: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Rows with (``left_semi``) or without (``left_anti``) a partner of equal keys, nulls being equal."""
    a, b = rows.alias("a"), other.select(*keys).alias("b")
    same = reduce(and_, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    return a.join(b, same, how).select(*rows.columns)
