"""Mergeable state as a log of parts (G5 stream): a batch writes what it brings.

A micro-batch appends one part with its own sums.  Parts of one level are merged
into one of the next level when there are ``FANOUT`` of them, so a row is
written again once a level: what a batch writes follows its own size, and over
all batches a row is written about log(batches) / log(FANOUT) + 1 times, where
rewriting the state would write all of it each time.

The parts that hold after a batch are named by a manifest with the batch's
number, put in place by one rename: readers see whole batches only.  A batch
that is run again before its manifest is there writes the same part again; one
that is run again after it does nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from mercato.operators.manifests import Manifests

#: Parts of a level that are merged, and manifests (with their parts) kept for readers.
FANOUT, KEPT = 8, 2


class DeltaState:
    def __init__(self, spark: SparkSession, root: str, merge: Callable[[DataFrame], DataFrame]) -> None:
        """``merge`` reduces rows of several parts to the rows of one."""
        self.spark, self.root, self.merge = spark, root.rstrip("/"), merge
        self.manifests = Manifests(spark, f"{self.root}/_manifests")

    def parts(self, number: int | None = None) -> list[dict]:
        """``name`` and ``level`` of the parts after a batch (the last one)."""
        numbers = self.manifests.numbers()
        return self.manifests.read(numbers[-1] if number is None else number)["parts"] if numbers else []

    def read(self, parts: list[dict] | None = None) -> DataFrame | None:
        """All rows of the parts, not merged; None if there are none."""
        parts = self.parts() if parts is None else parts
        frames = [self.spark.read.parquet(f"{self.root}/{p['name']}") for p in parts]
        return reduce(DataFrame.unionByName, frames) if frames else None

    def append(self, batch: DataFrame, number: int) -> None:
        numbers = self.manifests.numbers()
        if number in numbers:
            return  # run again after it was committed
        before = [n for n in numbers if n < number]
        parts = self.parts(before[-1]) if before else []
        parts = [*parts, self._write(batch, number, 0)]
        level = 0
        while len(same := [p for p in parts if p["level"] == level]) >= FANOUT:
            merged = self._write(self.merge(self.read(same)), number, level + 1)
            parts = [*[p for p in parts if p["level"] != level], merged]
            level += 1
        self.manifests.commit(number, {"parts": parts})
        self._expire([*before, number])

    def _write(self, df: DataFrame, number: int, level: int) -> dict:
        name = f"part-{number:010d}-{level}"
        df.write.mode("overwrite").parquet(f"{self.root}/{name}")
        return {"name": name, "level": level}

    def _expire(self, numbers: list[int]) -> None:
        kept = {p["name"] for n in numbers[-KEPT:] for p in self.parts(n)}
        path, fs = self.spark._jvm.org.apache.hadoop.fs.Path, self.manifests.fs
        for n in numbers[:-KEPT]:
            self.manifests.remove(n)
        for name in [f.getPath().getName() for f in fs.listStatus(path(self.root))]:
            if name.startswith("part-") and name not in kept and int(name.split("-")[1]) <= numbers[-1]:
                fs.delete(path(f"{self.root}/{name}"), True)
