"""A stored table replaced as a whole: written beside, checked, then switched.

Below the table's folder lie version folders and one small pointer file that
names the current one. A load writes a new version, runs its check on the
written rows and only then replaces the pointer; a load that fails or is
refused leaves the pointer, and with it the old rows, as they were. Readers
resolve the pointer once, so a table being replaced is never seen half done.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

POINTER = "_current"  # names starting with _ are not data to Spark


class Folder:
    """Small files and folders on the table's own file system, by listing and renaming."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _at(self, *below: str):
        return self._path("/".join([self.path, *below]))

    def read(self, name: str) -> str | None:
        """Text of a small file, or None."""
        if not self._files.exists(self._at(name)):
            return None
        stream = self._files.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Replace a small file: written beside and renamed over it in one step where the file system can."""
        jvm = self.spark._jvm
        beside = self._at(f"{name}.{uuid.uuid4().hex}")
        stream = self._files.create(beside)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._at(name).toUri(), self._files.getConf())
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context.rename(self._files.makeQualified(beside), self._files.makeQualified(self._at(name)), options)

    def remove(self, *below: str) -> None:
        self._files.delete(self._at(*below), True)

    def folders(self) -> list[str]:
        if not self._files.exists(self._at()):
            return []
        return sorted(s.getPath().getName() for s in self._files.listStatus(self._at()) if s.isDirectory())


class VersionedTable:
    """``path`` holds version folders and the pointer to the current one."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.folder = Folder(spark, path)

    def current(self) -> str | None:
        """Folder of the current version, or None before the first load."""
        name = self.folder.read(POINTER)
        return f"{self.folder.path}/{name}" if name else None

    def new_version(self) -> str:
        return f"{self.folder.path}/version-{uuid.uuid4().hex[:12]}"

    def switch(self, version: str) -> None:
        self.folder.write(POINTER, version.rpartition("/")[2])

    def load(self, df: DataFrame, check: Callable[[DataFrame], None] | None = None) -> DataFrame:
        """Write ``df`` as a new version, ``check`` the written rows, switch to it; the new rows.

        An error on the way removes the unfinished version and is passed on.
        """
        version = self.new_version()
        try:
            df.write.parquet(version)
            rows = self.spark.read.schema(df.schema).parquet(version)
            if check is not None:
                check(rows)
        except BaseException:
            self.folder.remove(version.rpartition("/")[2])
            raise
        self.switch(version)
        return rows

    def read(self, schema: StructType | None = None) -> DataFrame:
        at = self.current()
        if at is None:
            raise ValueError(f"{self.folder.path} has not been loaded yet")
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(at)

    def forget(self) -> None:
        """Remove all versions but the current one; to be run when no reader of an old one is left."""
        name = self.folder.read(POINTER)
        for old in self.folder.folders():
            if old.startswith("version-") and old != name:
                self.folder.remove(old)
