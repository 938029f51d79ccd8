"""A few folder operations on whatever file system a path belongs to."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

#: Requests to a store at a time.
AT_ONCE = 16


class Folder:
    """Existence, listing, delete and rename through Hadoop's file system client."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self.path = path.rstrip("/")
        self._fs = self._at().getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, child: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{child}" if child else self.path)

    def exists(self, child: str = "") -> bool:
        return self._fs.exists(self._at(child))

    def folders(self, child: str = "") -> list[str]:
        """Names of visible sub-folders; like Spark, ``_x=1`` is a partition and no hidden folder."""
        if not self.exists(child):
            return []
        entries = self._fs.listStatus(self._at(child))
        names = [e.getPath().getName() for e in entries if e.isDirectory()]
        return sorted(n for n in names if "=" in n or not n.startswith(("_", ".")))

    @staticmethod
    def each(do: Callable[[str], object], names: Sequence[str]) -> list:
        """``do`` for all names, several at a time: a store takes its time to answer."""
        with ThreadPoolExecutor(AT_ONCE) as pool:
            return list(pool.map(do, names))

    def delete(self, child: str = "") -> None:
        self._fs.delete(self._at(child), True)

    def move_in(self, other: Folder, child: str) -> None:
        """Take ``child`` over from ``other``, in place of our own."""
        self.delete(child)
        target = self._at(child)
        self._fs.mkdirs(target.getParent())
        if not self._fs.rename(other._at(child), target):
            raise OSError(f"could not move {other.path}/{child} to {self.path}")

    def write_json(self, child: str, value) -> None:
        """Write beside, then rename: the file is there whole or not at all."""
        beside = self._at(child + ".part")
        stream = self._fs.create(beside, True)
        stream.write(bytearray(json.dumps(value).encode()))
        stream.close()
        if not self._fs.rename(beside, self._at(child)):
            raise OSError(f"could not write {self.path}/{child}")

    def read_json(self, child: str):
        stream = self._fs.open(self._at(child))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
