"""Totals of a stored table that are brought up to date by reading the partitions that loads have changed.

What is added up is kept for each group *and* partition of the table, in a table of its own with the same partitions. A
partition whose files are others than at the last refresh is added up anew and takes the place of what was kept of it, so
nothing is subtracted, any writer of the table will do, and a refresh that was interrupted or is repeated does no harm.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.sources.folders import Folder
from orderloom.sources.tables import (
    balanced_sorted,
    current_version,
    drop_old_versions,
    finish_replacing,
    read_table,
    replace_partitions,
    write_table,
)

ABOUT = "_about"


@dataclass(frozen=True)
class Totals:
    """Totals kept under ``path`` of a table partitioned by ``partition_by``.

    ``by`` names the groups; ``sums``, ``least`` and ``greatest`` what is summed up and of what the smallest and the largest
    value is kept. Nulls count for nothing, and a group of nothing but nulls has null. Only rows with ``where`` are looked at.
    Files are sorted by the groups ``sorted_by``, for readers of some groups.
    """

    path: str
    partition_by: Sequence[str]
    by: Mapping[str, Column]
    sums: Mapping[str, Column] = field(default_factory=dict)
    least: Mapping[str, Column] = field(default_factory=dict)
    greatest: Mapping[str, Column] = field(default_factory=dict)
    where: Column | None = None
    sorted_by: Sequence[str] = ()

    def __post_init__(self):
        names = [c.lower() for part in (self.partition_by, self.by, self.sums, self.least, self.greatest) for c in part]
        twice = sorted({n for n in names if names.count(n) > 1})
        if twice:
            raise ValueError(f"names of partitions, groups and totals must differ: {', '.join(twice)}")

    def refresh(self, spark: SparkSession, table: str) -> list[str]:
        """Bring the totals up to what ``table`` holds now; returns the partition folders that were read, ``""`` for a table
        without partitions.

        Everything is read the first time, after a rebuild of the table and when the totals are defined otherwise than they
        were. The names of the table's files come to the driver, as they do for any scan of it. One refresh at a time.
        """
        source = current_version(spark, table)
        if source is None:
            raise FileNotFoundError(f"no complete version under {table}")
        finish_replacing(spark, source)
        stored = read_table(spark, table)
        now, about = self._leaves(stored), {"source": source, "definition": self._definition()}
        kept = current_version(spark, self.path)
        seen = self._seen(spark, kept, about)
        layout = balanced_sorted(self.partition_by, *self.sorted_by) if self.sorted_by else None
        if seen is None:
            write_table(self._added_up(stored), self.path, self.partition_by, layout)
            changed = sorted(now)
        else:
            finish_replacing(spark, kept)
            changed = sorted(leaf for leaf, digest in now.items() if seen.get(leaf) != digest)
            gone = [leaf for leaf in seen if leaf not in now]
            if not changed and not gone:
                return []
            paths = [f"{source}/{leaf}" if leaf else source for leaf in changed]
            rows = spark.read.schema(stored.schema).option("basePath", source).parquet(*paths) if paths else stored.filter("false")
            Folder(spark, kept).delete(ABOUT)  # a refresh lost from here on is made up for by a whole one
            if self.partition_by:
                replace_partitions(self._added_up(rows), kept, self.partition_by, [*changed, *gone], layout=layout)
            else:
                write_table(self._added_up(rows), self.path, layout=layout)
        drop_old_versions(spark, self.path)
        kept = current_version(spark, self.path)
        Folder(spark, kept).write_json(ABOUT, about | {"seen": now})
        return changed

    def read(self, spark: SparkSession, groups: Column | None = None) -> DataFrame:
        """The totals of each group, or of those ``groups`` is true for, as of the last refresh."""
        kept = read_table(spark, self.path)
        kept = kept if groups is None else kept.filter(groups)
        names = [*self.sums, *self.least, *self.greatest]
        return kept.groupBy(*[F.col(f"`{n}`") for n in self.by]).agg(*self._merged({n: F.col(f"`{n}`") for n in names}))

    def _merged(self, values: Mapping[str, Column]) -> list[Column]:
        kinds = ((F.sum, self.sums), (F.min, self.least), (F.max, self.greatest))
        return [merge(values[n]).alias(n) for merge, names in kinds for n in names]

    def _added_up(self, rows: DataFrame) -> DataFrame:
        chosen = rows if self.where is None else rows.filter(self.where)
        groups = [*[F.col(f"`{c}`") for c in self.partition_by], *[c.alias(n) for n, c in self.by.items()]]
        return chosen.groupBy(*groups).agg(*self._merged({**self.sums, **self.least, **self.greatest}))

    def _definition(self) -> list:
        parts = [[[n, str(c)] for n, c in part.items()] for part in (self.by, self.sums, self.least, self.greatest)]
        return [list(self.partition_by), *parts, str(self.where)]

    def _seen(self, spark: SparkSession, kept: str | None, about: dict) -> dict[str, str] | None:
        """Digests of the partitions as they were read last, null if totals must be made anew."""
        if kept is None or not Folder(spark, kept).exists(ABOUT):
            return None
        was = Folder(spark, kept).read_json(ABOUT)
        return was["seen"] if {k: was[k] for k in about} == about else None

    def _leaves(self, stored: DataFrame) -> dict[str, str]:
        """A digest of the file names of each partition folder; Spark never writes two files of one name."""
        files: dict[str, list[str]] = {}
        depth = len(self.partition_by)
        for path in stored.inputFiles():
            *folders, name = unquote(path).split("/")
            files.setdefault("/".join(folders[len(folders) - depth :]), []).append(name)
        return {leaf: hashlib.sha256("\n".join(sorted(names)).encode()).hexdigest()[:32] for leaf, names in files.items()}
