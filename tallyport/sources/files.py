"""Folders and small files on any storage that Spark reads, through its own file systems."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Storage:
    """The file system that holds `root`."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def matching(self, pattern: str) -> dict[str, int]:
        """Paths below the root that match a glob, relative to it, with the time each was changed."""
        found = self.fs.globStatus(self.path(pattern)) or []
        depth = pattern.count("/") + 1
        return {
            "/".join(status.getPath().toString().rsplit("/", depth)[-depth:]): status.getModificationTime() for status in found
        }

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a file that must not be there yet, whole or not at all; False if another writer was first."""
        draft = self.path(f"{name}.{self.jvm.java.util.UUID.randomUUID().toString()}.draft")
        stream = self.fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.conf)
        keep = self.jvm.java.lang.reflect.Array.newInstance(self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            context.rename(draft, self.path(name), keep)
            return True
        except Py4JJavaError as error:
            self.fs.delete(draft, False)
            if "FileAlreadyExistsException" in error.java_exception.toString():
                return False
            raise

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)
