"""Small files (logs, flow ids) on any file system that Spark reaches, and an exclusive create."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


_own_dirs: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where that is unset (tests), a local one of this process."""
    where = spark.conf.get("spark.checkpoint.dir", "") or ""
    if where:
        return where.rstrip("/")
    if not _own_dirs:
        _own_dirs.append("file://" + tempfile.mkdtemp(prefix="tidemark-"))
        atexit.register(shutil.rmtree, _own_dirs[0].removeprefix("file://"), ignore_errors=True)
    return _own_dirs[0]


class Files:
    """Hadoop's file system interface, as far as a table's log needs it."""

    def __init__(self, spark: SparkSession):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self.conf)

    def exists(self, path: str) -> bool:
        return self._fs(path).exists(self._path(path))

    def make(self, path: str) -> None:
        self._fs(path).mkdirs(self._path(path))

    def remove(self, path: str) -> None:
        self._fs(path).delete(self._path(path), True)

    def names(self, path: str) -> dict[str, int]:
        """File and folder names below path with their sizes; empty if there is no such folder."""
        if not self.exists(path):
            return {}
        return {s.getPath().getName(): s.getLen() for s in self._fs(path).listStatus(self._path(path))}

    def size(self, uri: str) -> int:
        path = self.jvm.org.apache.hadoop.fs.Path(self.jvm.java.net.URI(uri))
        return path.getFileSystem(self.conf).getFileStatus(path).getLen()

    def read(self, path: str) -> str:
        stream = self._fs(path).open(self._path(path))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        stream = self._fs(path).create(self._path(path), True)
        stream.write(bytearray(text.encode()))
        stream.close()

    def rename(self, old: str, new: str) -> None:
        if not self._fs(old).rename(self._path(old), self._path(new)):
            raise OSError(f"{old} could not be renamed")

    def create_once(self, path: str, text: str) -> bool:
        """Writes a whole file under a name that must be new; False if someone else was first.

        The text goes to a name of its own first, so a half-written file is never
        seen. On a local disk a hard link takes the name, elsewhere a rename that
        doesn't overwrite.
        """
        temporary = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
        self.write(temporary, text)
        try:
            if self._fs(path).getScheme() == "file":
                os.link(self._path(temporary).toUri().getPath(), self._path(path).toUri().getPath())
                return True
            context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(path).toUri(), self.conf)
            none = self.jvm.java.lang.reflect.Array.newInstance(self.jvm.org.apache.hadoop.fs.Options.Rename, 1)
            none[0] = self.jvm.org.apache.hadoop.fs.Options.Rename.NONE
            context.rename(self._path(temporary), self._path(path), none)
            return True
        except FileExistsError:
            return False
        except Exception as e:
            if "FileAlreadyExists" in str(e):
                return False
            raise
        finally:
            if self.exists(temporary):
                self.remove(temporary)
