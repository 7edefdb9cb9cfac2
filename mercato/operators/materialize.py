"""Cut lineage by writing a DataFrame under the shared checkpoint folder.

Used before operators that need several passes over the same input (the
distributed rank counts, samples and numbers its input): the input is
computed once, written as Parquet under ``spark.checkpoint.dir`` (a shared
file system on a cluster; read from the session, never a machine-local
folder) and read back.  A lost executor then recomputes from these files,
not from the raw sources.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from mercato.session import scratch_path


def materialize(df: DataFrame, name: str = "stage", partition_by: Sequence[str] = ()) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return (spark.read.schema(df.schema) if partition_by else spark.read).parquet(path)
