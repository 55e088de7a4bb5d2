"""The few file-system calls needed, through Hadoop so that they work on any shared storage."""

from __future__ import annotations

from pyspark.sql import SparkSession


# Schemes of stores without directories.
OBJECT_STORES = ("s3", "s3a", "gs", "oss", "cosn", "obs", "wasb", "wasbs")


class Fs:
    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(path).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(path))]

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def delete_at_end(self, path: str) -> None:
        """Remove a folder when the session's JVM ends."""
        self._fs.deleteOnExit(self._path(path))

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        stream = self._fs.create(self._path(path), True)
        try:
            stream.write(text.encode("utf-8"))
        finally:
            stream.close()

    def create_new(self, path: str, temporary: str, text: str) -> None:
        """Write a file that must not exist yet and that appears with all its content.

        An object store shows an object only once it is complete; a file system does not, so
        there the text is written elsewhere and renamed.
        """
        if self._fs.getScheme() in OBJECT_STORES:
            stream = self._fs.create(self._path(path), False)
            try:
                stream.write(text.encode("utf-8"))
            finally:
                stream.close()
            return
        self.write_text(temporary, text)
        try:
            self.rename_new(temporary, path)
        except Exception:
            self.delete(temporary)
            raise

    def rename_new(self, source: str, target: str) -> None:
        """Rename that fails if the target exists."""
        hadoop = self._jvm.org.apache.hadoop.fs
        src, dst = (self._fs.makeQualified(self._path(p)) for p in (source, target))
        context = hadoop.FileContext.getFileContext(src.toUri(), self._conf)
        context.rename(src, dst, self._gateway.new_array(hadoop.Options.Rename, 0))
