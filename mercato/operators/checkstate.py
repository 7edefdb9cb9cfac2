"""Mergeable check metrics (Q3, Q4, Q8-Q12, Q14): a check run again scans new files only.

A global-aggregate check is a sum over rows, so it is also a sum over files.  The
metrics of each data file of a table are kept beside it, in a log of parts
(``mercato.streaming.deltas``): a refresh lists the folder, scans the files that it
doesn't know, adds one row for each of them, and marks files that are gone.  The
metrics of the table are the sums over its present files, whatever refresh
brought them.

A file is known by path, size and time of change, so a day that is written anew is
scanned anew.  The definitions of the metrics are part of what is known: when a rule
changes, all files are scanned once more.
"""

from __future__ import annotations

import hashlib
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.operators.materialize import materialize
from mercato.streaming.deltas import DeltaState

MONEY = "decimal(38,2)"
_FILE = ["file", "size", "changed"]
_LAST = ["refresh", "present", "values"]


def _latest(parts: DataFrame) -> DataFrame:
    """The last row of each file, under one set of definitions."""
    last = F.max_by(F.struct(*_LAST), "refresh").alias("last")
    return parts.groupBy("spec", *_FILE).agg(last).select("spec", *_FILE, *[f"last.{c}" for c in _LAST])


class CheckState:
    """Metrics of a Parquet table that grows by files, kept under ``root``.

    ``metrics`` are aggregates that add up over files: counts and sums.  A sum
    over no value is NULL in a file and adds nothing.  ``schema`` is the table's,
    partition columns included.  One refresh of a state runs at a time; of two,
    one fails with ``Conflict`` and can be run again.
    """

    def __init__(self, spark: SparkSession, root: str, folder: str, schema: T.StructType, metrics: dict[str, Column]) -> None:
        self.spark, self.folder, self.schema, self.metrics = spark, folder.rstrip("/"), schema, metrics
        self.log = DeltaState(spark, root, _latest)
        defined = "\n".join(f"{name}: {self._defined(e)}" for name, e in sorted(metrics.items()))
        self.spec = hashlib.sha256(defined.encode()).hexdigest()

    def _defined(self, metric: Column) -> str:
        return metric._jc.toString() if hasattr(metric, "_jc") else str(metric)

    def listing(self) -> DataFrame:
        """file, size and time of change of the table's data files; no file is opened."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(self.folder)
        meta = F.col("_metadata")
        return files.select(meta.file_path.alias("file"), meta.file_size.alias("size"), meta.file_modification_time.alias("changed"))

    def known(self) -> DataFrame | None:
        """The files whose metrics are kept and that were there at the last refresh."""
        parts = self.log.read()
        return None if parts is None else _latest(parts.where(F.col("spec") == self.spec)).where("present").drop("present")

    def scan(self, files: list[str]) -> DataFrame:
        """The rows of some files, partition columns included."""
        return self.spark.read.schema(self.schema).option("basePath", self.folder).parquet(*files)

    def refresh(self) -> int:
        """Takes in new files and files that are gone; the number of this refresh, 0 if nothing changed."""
        there, known = materialize(self.listing(), "file-listing"), self.known()
        fresh = there if known is None else there.join(known, _FILE, "left_anti")
        gone = None if known is None else known.join(there, _FILE, "left_anti")
        # names of new files reach the driver, as those of every scan do
        new = [unquote(r["file"]) for r in fresh.select("file").collect()]
        if not new and (gone is None or gone.isEmpty()):
            return 0
        number = max(self.log.manifests.numbers(), default=0) + 1
        stamp = [F.lit(self.spec).alias("spec"), *_FILE, F.lit(number).alias("refresh")]
        parts = []
        if new:
            values = F.create_map(*[x for name in self.metrics for x in (F.lit(name), F.col(name))])
            per_file = (self.scan(new).groupBy(F.col("_metadata.file_path").alias("file"))
                        .agg(*[e.cast(MONEY).alias(name) for name, e in self.metrics.items()])
                        .select("file", values.alias("values")))
            # a file without rows is known too, with no values
            parts.append(fresh.join(per_file, "file", "left").select(*stamp, F.lit(True).alias("present"), "values"))
        if gone is not None:
            parts.append(gone.select(*stamp, F.lit(False).alias("present"), F.lit(None).cast(f"map<string,{MONEY}>").alias("values")))
        self.log.append(parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]), number)
        return number

    def merged(self, since: int = 0) -> DataFrame:
        """metric, value: sums over the present files, or over those that refresh ``since`` and later ones brought."""
        known = self.known()
        if known is None:
            raise FileNotFoundError(f"no refresh of the metrics of {self.folder} yet")
        value = F.explode("values").alias("metric", "value")
        sums = known.where(F.col("refresh") >= since).select(value).groupBy("metric").agg(F.sum("value").cast(MONEY).alias("value"))
        return self._of_no_row().join(sums, "metric", "left").select("metric", F.coalesce("value", "neutral").alias("value"))

    def _of_no_row(self) -> DataFrame:
        """metric, neutral: what a table without rows has, 0 for counts and NULL for sums."""
        one = self.spark.createDataFrame([], self.schema).agg(*[e.cast(MONEY).alias(name) for name, e in self.metrics.items()])
        pairs = [x for name in self.metrics for x in (F.lit(name), F.col(name))]
        return one.select(F.stack(F.lit(len(self.metrics)), *pairs).alias("metric", "neutral"))
