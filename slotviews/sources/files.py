"""The table's file system as seen by Hadoop: listings bounded by a slot window."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


class Files:
    """File-system calls of the driver; never used on anything that grows with rows."""

    def __init__(self, spark: SparkSession, location: str):
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(location).getFileSystem(conf)

    def glob(self, pattern: str) -> list[str]:
        found = self._fs.globStatus(self._path(pattern))
        return [status.getPath().toString() for status in found or ()]

    def data_files(self, pattern: str) -> list[tuple[str, int]]:
        """Paths and sizes of the files that match, or that matching folders hold; names that start with ``_`` or ``.`` are hidden."""
        found = []
        for status in self._fs.globStatus(self._path(pattern)) or ():
            inside = self._fs.listStatus(status.getPath()) if status.isDirectory() else [status]
            found += [(one.getPath().toString(), one.getLen()) for one in inside if one.isFile() and one.getPath().getName()[0] not in "_."]
        return sorted(found)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def mkdirs(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def rename(self, source: str, target: str) -> bool:
        return self._fs.rename(self._path(source), self._path(target))

    def touch(self, path: str) -> None:
        self._fs.create(self._path(path), True).close()

    def each(self, call: Callable[[str], object], items: Iterable[str]) -> list:
        """Calls side by side: a call is mostly waiting for the file system."""
        with ThreadPoolExecutor(max_workers=16) as pool:
            return list(pool.map(call, items))

    def children(self, path: str) -> Iterable[str]:
        return [status.getPath().toString() for status in self._fs.listStatus(self._path(path))]
