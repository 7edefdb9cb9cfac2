"""What the operators share: table access, word pattern, written cuts.

Operators never rely on the caller's column names beyond those passed in:
they select what they need under names of their own, so extra columns of any
name do no harm.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.operators.materialize import materialize

__all__ = ["ARROW_ROWS", "WORD", "held_out", "in_buckets", "materialize", "python_tasks", "table", "with_columns", "word_count"]

#: A word: a run of anything but space and the controls TAB..CR.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows and bytes in one Arrow batch sent to Python, whichever is reached first.
#: Texts can be long, so batches are far smaller than Spark's default of 10,000 rows and 64 MB.
ARROW_ROWS = 512
ARROW_BYTES = 8 << 20

#: Hash buckets of keys, for a filter that can be broadcast at any size of input.
BUCKETS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def python_tasks(spark: SparkSession) -> None:
    """Prepare the session for Python tasks: bounded batches, and this package on the executors."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    context = spark.sparkContext
    if not any("mercato-package" in str(f) for f in context._python_includes):
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        target = os.path.join(tempfile.mkdtemp(prefix="mercato-"), "mercato-package.zip")
        with zipfile.ZipFile(target, "w") as z:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        z.write(path, os.path.relpath(path, os.path.dirname(package)))
        context.addPyFile(target)


def in_buckets(frame: DataFrame, wanted: DataFrame, keys: list[str], how: str = "left_semi") -> DataFrame:
    """Rows of ``frame`` whose hash bucket of ``keys`` is (left_anti: isn't) in use by ``wanted``.

    A filter before a join, so that the join moves few rows that match nothing.
    What is broadcast is bounded: ``BUCKETS`` integers at most.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
    used = wanted.select(bucket.alias("mercato_used")).distinct()
    return (frame.withColumn("mercato_bucket", bucket)
            .join(F.broadcast(used), F.col("mercato_bucket") == F.col("mercato_used"), how).drop("mercato_bucket"))


def with_columns(frame: DataFrame, fields: str, make: Callable[[pa.RecordBatch], list[pa.Array]]) -> DataFrame:
    """``frame`` and the columns that ``make`` gives for each Arrow batch of it.

    All Python steps of this package run as ``mapInArrow``: one kind of task,
    so one set of worker processes, with one set of tables, on each executor.
    """
    schema = T.StructType([*frame.schema.fields, *T.StructType.fromDDL(fields).fields])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, *make(b)], names)

    return frame.mapInArrow(run, schema)


def word_count(text: Column) -> Column:
    """Words of a text; null and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """crc32 of the id's text falls in ``fold`` of ``folds``; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(True))
