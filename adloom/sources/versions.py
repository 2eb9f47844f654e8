"""Tables that are replaced without a moment in which they are gone (SNK-3, SNK-6, SNK-8).

Below a table's path, ``data/`` holds one folder per version and ``versions/`` one small file per version that
names its folder. A new version is written beside the old one and counts from the moment its file is there; that
file is created last and never overwritten, so of two writers that start from one version the second fails. A
write that dies leaves a folder nobody points to, and readers stay with what they had. Nothing is renamed, so
this holds on object stores too. Files are reached through Spark's file systems, never by local paths.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class StaleVersionError(RuntimeError):
    """Somebody else has replaced the table since this writer looked at it."""


class VersionedTable:
    """The table at ``path``. ``format`` and ``options`` are those of Spark's readers and writers."""

    def __init__(self, spark: SparkSession, path: str, format: str = "parquet", **options: str):
        self.spark, self.path, self.format, self.options = spark, path.rstrip("/"), format, options
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        root = self._hadoop.Path(self.path)
        self._fs = root.getFileSystem(spark._jsc.hadoopConfiguration())

    # --- pointers ------------------------------------------------------------------------------------
    def _numbers(self) -> list[int]:
        folder = self._hadoop.Path(f"{self.path}/versions")
        if not self._fs.exists(folder):
            return []
        return sorted(int(s.getPath().getName()) for s in self._fs.listStatus(folder) if s.getPath().getName().isdigit())

    def _pointed(self, number: int) -> str | None:
        """Folder of a version; none if its pointer was not written to the end."""
        pointer = self._hadoop.Path(f"{self.path}/versions/{number}")
        stream = self._fs.open(pointer)
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return f"{self.path}/data/{text[:-1]}" if text.endswith("\n") else None

    def version(self) -> int:
        """Number of the current version, 0 if there is none."""
        return next((n for n in reversed(self._numbers()) if self._pointed(n)), 0)

    def current(self) -> str | None:
        """Folder of the current version."""
        number = self.version()
        return self._pointed(number) if number else None

    def _point(self, number: int, name: str) -> None:
        pointer = self._hadoop.Path(f"{self.path}/versions/{number}")
        try:
            stream = self._fs.create(pointer, False)
        except Py4JJavaError as error:
            if "AlreadyExists" in str(error.java_exception) or "already exists" in str(error.java_exception):
                raise StaleVersionError(f"version {number} of {self.path} is taken") from error
            raise
        stream.write(bytearray(f"{name}\n", "utf-8"))
        stream.close()

    # --- rows ----------------------------------------------------------------------------------------
    def read(self, schema: T.StructType | None = None) -> DataFrame:
        """Rows of the current version; without any, no rows of ``schema``."""
        folder = self.current()
        if folder is None:
            if schema is None:
                raise FileNotFoundError(f"{self.path} has no version")
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.format(self.format).options(**self.options)
        return (reader.schema(schema) if schema is not None else reader).load(folder)

    def replace(self, rows: DataFrame, after: int | None = None) -> int:
        """Make ``rows`` the new version, which may well be computed from the current one.

        ``after`` is the version they were computed from (the current one, if not given).
        """
        return self.replace_by(lambda folder: rows.write.format(self.format).options(**self.options).save(folder), after)

    def replace_by(self, write: Callable[[str], None], after: int | None = None) -> int:
        """As :meth:`replace`, for a version that ``write`` puts into the folder it is given."""
        known = max(self._numbers(), default=0)
        if after is not None and after != self.version():
            raise StaleVersionError(f"{self.path} is at version {self.version()}, not {after}")
        name = f"{known + 1}-{uuid.uuid4().hex}"
        write(f"{self.path}/data/{name}")
        self._point(known + 1, name)
        return known + 1

    def clean(self, keep: int = 2) -> int:
        """Delete all but the last ``keep`` versions, and folders that failed writes left; gives the number of folders.

        Not to be run while somebody writes, or reads a version that goes.
        """
        numbers = self._numbers()
        kept = [n for n in numbers if self._pointed(n)][-keep:]
        names = {self._pointed(n).rsplit("/", 1)[1] for n in kept}
        gone = 0
        data = self._hadoop.Path(f"{self.path}/data")
        for status in self._fs.listStatus(data) if self._fs.exists(data) else []:
            if status.getPath().getName() not in names:
                gone += bool(self._fs.delete(status.getPath(), True))
        for n in numbers:
            if kept and n < kept[0]:
                self._fs.delete(self._hadoop.Path(f"{self.path}/versions/{n}"), False)
        return gone


def current_path(spark: SparkSession, path: str) -> str:
    """Where the rows of a table lie: in its current version, or at ``path`` itself if it has no versions."""
    return VersionedTable(spark, path).current() or path
