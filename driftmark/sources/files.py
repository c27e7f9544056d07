"""Small metadata files in a folder of any Hadoop file system, and listing for readers outside the JVM."""

from __future__ import annotations

import json
import os
import uuid
from typing import Any

from pyspark.sql import SparkSession

TEMPORARY = "_temporary-"


class Folder:
    """A folder with exclusive creation, which is what a commit needs.

    A file is written under a temporary name and then given its own, which fails where that is taken: a reader
    sees all of it or nothing, and a writer that dies leaves a temporary file that nobody reads. On the local
    file system a hard link excludes, on HDFS the rename does. Object stores whose rename overwrites give no
    exclusion: there one writer at a time is needed.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.root = root.rstrip("/")
        jvm = spark._jvm
        assert jvm is not None
        self._path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()  # type: ignore[attr-defined]
        self._fs = self._path(self.root).getFileSystem(self._conf)
        self._jvm, self._gateway = jvm, spark.sparkContext._gateway

    def exists(self, name: str = "") -> bool:
        return bool(self._fs.exists(self._path(f"{self.root}/{name}" if name else self.root)))

    def names(self) -> list[str]:
        if not self.exists():
            return []
        found = (s.getPath().getName() for s in self._fs.listStatus(self._path(self.root)))
        return sorted(n for n in found if not n.startswith(TEMPORARY))

    def create(self, name: str, value: Any) -> bool:
        """Write JSON to a file that must not exist; False where another writer was first."""
        temporary = self._path(f"{self.root}/{TEMPORARY}{uuid.uuid4().hex}")
        out = self._fs.create(temporary, False)
        out.write(bytearray(json.dumps(value, sort_keys=True).encode()))
        out.close()
        try:
            return self._name(temporary, self._path(f"{self.root}/{name}"))
        finally:
            self._fs.delete(temporary, False)

    def _name(self, temporary: Any, final: Any) -> bool:
        if str(self._fs.getUri().getScheme()) == "file":
            try:
                os.link(temporary.toUri().getPath(), final.toUri().getPath())
            except FileExistsError:
                return False
            return True
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self._gateway.new_array(rename, 1)
        how[0] = rename.NONE
        try:
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self._conf).rename(temporary, final, how)
        except Exception as e:  # py4j wraps the Java exception
            if "FileAlreadyExists" in str(e) or "already exists" in str(e):
                return False
            raise
        return True

    def load(self, name: str) -> Any:
        stream = self._fs.open(self._path(f"{self.root}/{name}"))
        try:
            return json.loads(str(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def remove(self, name: str = "") -> None:
        self._fs.delete(self._path(f"{self.root}/{name}" if name else self.root), True)
