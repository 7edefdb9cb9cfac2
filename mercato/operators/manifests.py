"""Numbered JSON files in a folder, each put in place whole by one rename."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import SparkSession


class Conflict(Exception):
    """The number is taken already."""


class Manifests:
    """On any Hadoop file system; the state is what the file with the highest number says."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        self._hadoop = spark._jvm.org.apache.hadoop
        self._conf = spark._jsc.hadoopConfiguration()
        self.fs = self._path().getFileSystem(self._conf)

    def _path(self, name: str = ""):
        return self._hadoop.fs.Path(os.path.join(self.folder, name) if name else self.folder)

    def numbers(self) -> list[int]:
        if not self.fs.exists(self._path()):
            return []
        names = [f.getPath().getName() for f in self.fs.listStatus(self._path())]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self, number: int) -> dict:
        stream = self.fs.open(self._path(f"{number:010d}.json"))
        try:
            return json.loads(bytes(self._hadoop.io.IOUtils.readFullyToByteArray(stream)))
        finally:
            stream.close()

    def commit(self, number: int, payload: dict) -> None:
        """Fails with ``Conflict``, and changes nothing, where the number is taken."""
        draft, final = self._path(f"_draft-{uuid.uuid4().hex}"), self._path(f"{number:010d}.json")
        self.fs.mkdirs(self._path())
        out = self.fs.create(draft, True)
        out.write(bytearray(json.dumps(payload, indent=1).encode()))
        out.close()
        self._rename(draft, final)

    def _rename(self, draft, final) -> None:
        kinds = getattr(self._hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(kinds, 1)
        options[0] = kinds.NONE
        try:
            self._hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self._conf).rename(draft, final, options)
        except Exception as e:
            if "FileAlreadyExists" in str(e):
                self.fs.delete(draft, False)
                raise Conflict(f"{final.getName()} of {self.folder} is there already") from e
            raise

    def remove(self, number: int) -> None:
        self.fs.delete(self._path(f"{number:010d}.json"), False)
