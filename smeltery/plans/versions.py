"""Numbered versions of a table: small JSON files that appear whole and at most once per number."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_SUFFIX = ".json"


class VersionTakenError(RuntimeError):
    """Another writer has put this version in place."""


def locate(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


class Versions:
    """The versions below a folder, newest last.

    A version is written under a name of its own and then put in place by a step
    that fails when the number is taken: a rename that does not overwrite, or a
    hard link on a local disk. Stores without such a step (plain object stores)
    need one writer at a time. Only the driver reads and writes these files.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _path(self, number: int) -> str:
        return f"{self.folder}/{number:020d}{_SUFFIX}"

    def numbers(self) -> list[int]:
        files, location = locate(self.spark, self.folder)
        if not files.exists(location):
            return []
        names = [status.getPath().getName() for status in files.listStatus(location)]
        return sorted(int(n.removesuffix(_SUFFIX)) for n in names if n.endswith(_SUFFIX) and n[0].isdigit())

    def read(self, number: int) -> dict:
        files, location = locate(self.spark, self._path(number))
        stream = files.open(location)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def newest(self) -> dict | None:
        numbers = self.numbers()
        return self.read(numbers[-1]) if numbers else None

    def last(self, n: int) -> list[dict]:
        """The last ``n`` versions, newest first."""
        return [self.read(number) for number in reversed(self.numbers()[-n:])] if n > 0 else []

    def put(self, number: int, content: Mapping) -> None:
        """Make ``content`` version ``number``; of several writers one succeeds and the others fail."""
        files, draft = locate(self.spark, f"{self.folder}/_{uuid.uuid4().hex}")
        target = self.spark._jvm.org.apache.hadoop.fs.Path(self._path(number))
        out = files.create(draft, False)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        try:
            self._place(files.resolvePath(draft), target)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                raise VersionTakenError(f"version {number} of {self.folder} is taken") from None
            raise
        finally:
            files.delete(draft, False)

    def _place(self, draft, target) -> None:
        jvm = self.spark._jvm
        if draft.toUri().getScheme() == "file":
            folder = jvm.java.nio.file.Paths.get(draft.getParent().toUri())
            jvm.java.nio.file.Files.createLink(folder.resolve(target.getName()),
                                               jvm.java.nio.file.Paths.get(draft.toUri()))
            return
        conf = self.spark._jsc.hadoopConfiguration()
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        none = self.spark.sparkContext._gateway.new_array(rename, 0)
        target = jvm.org.apache.hadoop.fs.Path(draft.getParent(), target.getName())
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(draft, target, none)
