"""Small driver-side file operations on whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Storage:
    """File system access through the session's Hadoop configuration; metadata only, no data."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _open(self, path: str):
        hadoop_path = self._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self._conf), hadoop_path

    def absolute(self, path: str, encoded: bool = False) -> str:
        """``path`` from the root of its file system, without scheme; URL-``encoded`` on request."""
        fs, hadoop_path = self._open(path)
        uri = fs.makeQualified(hadoop_path).toUri()
        return uri.getRawPath() if encoded else uri.getPath()

    def exists(self, path: str) -> bool:
        fs, hadoop_path = self._open(path)
        return fs.exists(hadoop_path)

    def make_dirs(self, path: str) -> None:
        fs, hadoop_path = self._open(path)
        fs.mkdirs(hadoop_path)

    def delete(self, path: str) -> None:
        fs, hadoop_path = self._open(path)
        fs.delete(hadoop_path, True)

    def names(self, path: str) -> list[str]:
        """Names directly below ``path``; none when it does not exist."""
        fs, hadoop_path = self._open(path)
        if not fs.exists(hadoop_path):
            return []
        return [status.getPath().getName() for status in fs.listStatus(hadoop_path)]

    def read_text(self, path: str) -> str:
        fs, hadoop_path = self._open(path)
        stream = fs.open(hadoop_path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def rename(self, source: str, target: str) -> bool:
        """Move a file or directory within its file system; False when ``target`` exists."""
        fs, old = self._open(source)
        _, new = self._open(target)
        if fs.exists(new):
            return False
        fs.mkdirs(new.getParent())
        return fs.rename(old, new)

    def create_text(self, path: str, text: str) -> bool:
        """Write a new file in one step; False when ``path`` exists already.

        A finished draft is renamed, so no reader sees half a file. Where a rename to an existing name fails, as on
        HDFS, one of two writers loses; object stores without such a rename are no place for snapshot tables.
        """
        fs, hadoop_path = self._open(path)
        fs, draft = self._open(f"{path}.{self._jvm.java.util.UUID.randomUUID().toString()}.tmp")
        stream = fs.create(draft, True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        if not fs.exists(hadoop_path) and fs.rename(draft, hadoop_path):
            return True
        fs.delete(draft, False)
        return False
