"""What is new since the last load."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class SchemaChangedError(ValueError):
    """A batch does not have the columns of the table it goes into."""


def high_water_mark(target: DataFrame, column: str):
    """Largest loaded value, null for an empty target. One aggregate over one column."""
    return target.agg(F.max(column)).first()[0]


def newer_than(
    df: DataFrame, column: str, mark, *, inclusive: bool = False, lookback_days: int = 0, undated: bool = False
) -> DataFrame:
    """Rows past ``mark``; all rows if there is no mark.

    The mark is a literal, so the filter reaches the scan (partition pruning, row-group skipping).
    ``inclusive`` picks up late rows of the marked day, ``lookback_days`` re-reads changed older
    ones, ``undated`` keeps rows without a value, which no mark can tell from new ones; all are
    safe in front of an upsert by key.
    """
    if mark is None:
        return df
    start = mark - dt.timedelta(days=lookback_days) if lookback_days else mark
    new = F.col(column) >= F.lit(start) if inclusive else F.col(column) > F.lit(start)
    return df.filter(new | F.col(column).isNull() if undated else new)


def incremental_filter(df: DataFrame, column: str, target: DataFrame | None, **options) -> DataFrame:
    """Rows of ``df`` newer than anything in ``target`` (None: not loaded yet, so all rows)."""
    if target is None:
        return df
    return newer_than(df, column, high_water_mark(target, column), **options)


def assert_schema(target: StructType, batch: StructType) -> None:
    """Fail unless both have the same column names and types; order and nullability may differ."""
    have = {f.name: f.dataType for f in target}
    come = {f.name: f.dataType for f in batch}
    problems = [f"missing {n}" for n in have if n not in come]
    problems += [f"new {n}" for n in come if n not in have]
    problems += [
        f"{n} was {have[n].simpleString()}, is {come[n].simpleString()}"
        for n in have
        if n in come and have[n] != come[n]
    ]
    if problems:
        raise SchemaChangedError("; ".join(problems))
