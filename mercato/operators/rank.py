"""Row numbering without a single-partition window (W1, W2) and top-N (O2).

``row_number() OVER (ORDER BY x)`` plans ``Exchange SinglePartition``: every
row goes through one task.  ``row_number_scalable`` gives the identical
numbering with the work spread over range buckets of the sort key:

1. rows are range-partitioned by the *total* order (partition columns first,
   tie-break included, so a sort value shared by a third of all rows is still
   split) into as many buckets as the row count asks for, and written with
   their bucket number; Spark samples the splitters;
2. rows are counted per (partition, bucket) and the counts summed up: the
   offset of each bucket;
3. rows are numbered inside (partition, bucket) and the offset is added.

The bucket number is a stored column, so retries and re-planning cannot
change it, and the result does not depend on the splitters.  There is no cap
on buckets, and no other plan for small inputs.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.operators.materialize import materialize

# An order item: column name with direction, e.g. ("receita", False) = DESC.
# Null ordering follows Spark's defaults: ASC NULLS FIRST, DESC NULLS LAST.
OrderItem = tuple[str, bool]


def _sort_cols(order: Sequence[OrderItem]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if asc else F.col(c).desc_nulls_last() for c, asc in order]


def plain_row_number(df: DataFrame, order: Sequence[OrderItem], partition_by: Sequence[str] = (),
                     name: str = "rank") -> DataFrame:
    """The textbook window (single partition when ``partition_by`` is empty)."""
    w = Window.partitionBy(*partition_by).orderBy(*_sort_cols(order))
    return df.withColumn(name, F.row_number().over(w))


def row_number_scalable(df: DataFrame, order: Sequence[OrderItem],
                        partition_by: Sequence[str] = (), name: str = "rank",
                        rows_per_bucket: int = 250_000, rows: int | None = None) -> DataFrame:
    """``row_number() OVER (PARTITION BY partition_by ORDER BY order)`` as BIGINT.

    ``order`` must be a total order inside each partition (end it with a
    unique key), otherwise row numbers of ties are arbitrary, as with the
    plain window.  ``rows``: the number of rows, where it is known.
    """
    keys = list(partition_by)
    buckets = max(2, math.ceil((df.count() if rows is None else rows) / rows_per_bucket))
    sort = [F.col(c).asc_nulls_first() for c in keys] + _sort_cols(order)
    dealt = materialize(df.repartitionByRange(buckets, *sort).withColumn("_bucket", F.spark_partition_id()),
                        "rank-buckets")
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # at most buckets + partitions rows
    offsets = materialize(
        dealt.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
        .select(*[F.col(c).alias(f"_o_{c}") for c in keys], F.col("_bucket").alias("_o_bucket"),
                F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")), "rank-offsets")
    here = F.col("_bucket") == F.col("_o_bucket")
    for c in keys:
        here &= F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*_sort_cols(order))
    return (dealt.withColumn("_inside", F.row_number().over(inside)).join(offsets, here)
            .select(*df.columns, (F.col("_inside") + F.col("_offset")).cast("bigint").alias(name)))


def add_ranks(df: DataFrame, specs: Sequence[tuple], **kw) -> DataFrame:
    """Several row numbers over one input, which is computed and counted once.

    specs: (name, order, partition_by) tuples.
    """
    out = materialize(df, "rank-input")
    rows = out.count()
    for name, order, partition_by in specs:
        out = row_number_scalable(out, order, partition_by, name=name, rows=rows, **kw)
    return out


def top_n(df: DataFrame, order: Sequence[OrderItem], n: int) -> DataFrame:
    """O2: first ``n`` rows by ``order`` (planned as TakeOrderedAndProject:
    per-partition top-n, then a merge of n x partitions rows)."""
    return df.orderBy(*_sort_cols(order)).limit(n)
