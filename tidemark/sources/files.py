"""Small files beside the data (manifests, commit records) in whatever store Spark writes to."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """The few file operations that manifests need, by the Hadoop file system of each path."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway

    def _at(self, path: str):
        target = self._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self._conf), target

    def names(self, path: str) -> list[str]:
        """Names in a folder, without those that start with a dot or an underscore; none if it is not there."""
        fs, target = self._at(path)
        if not fs.exists(target):
            return []
        found = [s.getPath().getName() for s in fs.listStatus(target)]
        return sorted(n for n in found if not n.startswith((".", "_")))

    def exists(self, path: str) -> bool:
        fs, target = self._at(path)
        return fs.exists(target)

    def read(self, path: str) -> str:
        fs, target = self._at(path)
        stream = fs.open(target)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Write a whole file under a name that nobody has taken; False if it is taken.

        The text is written beside it first and then renamed, so that no reader sees a part of it; the rename
        fails if the name is taken in between.
        """
        fs, target = self._at(path)
        if fs.exists(target):
            return False
        beside = self._jvm.org.apache.hadoop.fs.Path(f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
        stream = fs.create(beside, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self._conf)
        options = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(fs.makeQualified(beside), fs.makeQualified(target), options)
        except Py4JJavaError as e:
            fs.delete(beside, False)
            if "FileAlreadyExistsException" not in e.java_exception.toString():
                raise
            return False
        return True

    def delete(self, path: str) -> None:
        fs, target = self._at(path)
        fs.delete(target, True)
