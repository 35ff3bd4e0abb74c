"""A numbered log of small JSON entries: an entry appears whole or not at all, and each number once."""

from __future__ import annotations

import json
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession


class CommitConflict(RuntimeError):
    """Somebody else has committed since this run looked; nothing of this run is visible, it can be repeated."""


class CommitLog:
    """``<path>/<number>.json``. An entry is written under another name and renamed, which fails if the number is taken."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.files = self._path(self.path).getFileSystem(self._conf)

    def _path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def numbers(self) -> list[int]:
        """All numbers, ascending: one listing of the folder."""
        if not self.files.exists(self._path(self.path)):
            return []
        names = [s.getPath().getName() for s in self.files.listStatus(self._path(self.path))]
        return sorted(int(n[: -len(".json")]) for n in names if n.endswith(".json"))

    def read(self, number: int) -> dict:
        stream = self.files.open(self._path(f"{self.path}/{number:020}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def newest(self) -> tuple[int, dict] | None:
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else None

    def put(self, number: int, entry: dict) -> None:
        """Add an entry; ``CommitConflict`` if its number is taken."""
        self.files.mkdirs(self._path(self.path))
        draft, final = self._path(f"{self.path}/.{uuid.uuid4().hex}.draft"), self._path(f"{self.path}/{number:020}.json")
        stream = self.files.create(draft, False)
        stream.write(bytearray(json.dumps(entry).encode()))
        stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.files.getUri(), self._conf)
        no_overwrite = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self.files.makeQualified(draft), self.files.makeQualified(final), no_overwrite)
        except Exception as e:
            self.files.delete(draft, False)
            if isinstance(e, PySparkException) or "FileAlreadyExistsException" not in str(e):
                raise
            raise CommitConflict(f"entry {number} of {self.path} is taken") from None

    def remove(self, folder: str) -> None:
        self.files.delete(self._path(folder), True)

    def folders(self, path: str) -> list[str]:
        """Names in a folder."""
        if not self.files.exists(self._path(path)):
            return []
        return [s.getPath().getName() for s in self.files.listStatus(self._path(path))]
