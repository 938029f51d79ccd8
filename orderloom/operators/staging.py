"""One-select staging of a raw frame, and its quarantine."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.mapping import flag


@dataclass(frozen=True)
class Staging:
    """How one raw table is cleaned.

    ``columns`` are all outputs, each computed from raw columns in a single ``select``, so that an
    output may carry the name of a raw column without shadowing it. ``typed`` names the outputs that
    come from a cast or a parse, with the raw column each one reads; where an output goes on from
    there (null to zero, zero to null), ``parsed`` holds what the parse alone gave. ``key`` is the raw
    column whose null rows are not staged but rejected (None stages all rows).
    """

    columns: Mapping[str, Column]
    typed: Mapping[str, str] = field(default_factory=dict)
    parsed: Mapping[str, Column] = field(default_factory=dict)
    key: str | None = None

    def rows(self, raw: DataFrame) -> DataFrame:
        kept = raw if self.key is None else raw.filter(F.col(self.key).isNotNull())
        return kept.select(*[column.alias(name) for name, column in self.columns.items()])

    def rejected(self, raw: DataFrame) -> DataFrame:
        """Raw rows with text that could not be read, plus ``rejected_columns`` naming the outputs; and rows without
        a key, which no staged table has, under ``missing_<key>``.

        Blank text is a missing value, not a rejected one.
        """
        reasons = {
            name: flag((F.trim(F.col(source)) != "") & self.parsed.get(name, self.columns[name]).isNull())
            for name, source in self.typed.items()
        }
        if self.key is not None:
            reasons[f"missing_{self.key}"] = F.col(self.key).isNull()
        # the names are put together for rejected rows only
        names = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in reasons.items()]))
        return raw.filter(reduce(or_, reasons.values())).withColumn("rejected_columns", names)
