"""Deterministic deduplication by key.

``dropDuplicates(keys)`` keeps an arbitrary survivor, so two runs can publish
different rows.  Here the survivor is the row with the greatest tuple
``(order columns..., remaining columns...)`` - e.g. the latest timestamp, then
the largest other values; NULL sorts lowest.  It is one ``groupBy`` with a
``max(struct)`` aggregate: Spark combines map-side (partial aggregation), so
a key holding a third of all rows is reduced inside each map task before the
shuffle and never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per ``keys``; survivor = max of (order..., other columns...).

    Output keeps ``df``'s column order.  NULL keys form one group, as in
    ``dropDuplicates``.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranked = list(order) + rest
    if not ranked:
        return df.select(*keys).distinct()
    survivor = F.max(F.struct(*[F.col(c) for c in ranked])).alias("_s")
    out = df.groupBy(*keys).agg(survivor)
    return out.select(*[F.col(k) if k in keys else F.col(f"_s.{k}").alias(k) for k in df.columns])


def duplicate_key_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of key values occurring more than once (one row)."""
    return (df.groupBy(*keys).count().filter(F.col("count") > 1)
            .agg(F.count(F.lit(1)).alias("duplicated_keys")))
