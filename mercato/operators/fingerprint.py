"""Reconciliation by fingerprints (Q9): where two tables differ, level by level.

The fingerprint of a set of rows is their number and the sums of two 64-bit
hashes of each row: it depends on the rows and on how often each stands, not on
their order or on how they are dealt.  Two tables are compared by one small row
a group (a day), and only groups that differ are read again, by key, so naming
the rows that differ costs little more than learning that there are some.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.operators.materialize import materialize

LEFT_ONLY, RIGHT_ONLY, DIFFERENT = "only left", "only right", "different"


def _hashes(columns: Sequence[str]) -> tuple[Column, Column]:
    """Two hashes of a row.  NULLs count: a NULL's place among the columns is hashed too."""
    # a bit a column tells which are NULL, as NULLs leave a hash as it is
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(*columns, nulls), F.xxhash64(F.lit(7), nulls, *reversed(columns))


def fingerprints(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row for each group: its number of rows and two sums that can't overflow."""
    h1, h2 = _hashes(columns)
    wide = lambda h: F.sum(h.cast("decimal(20,0)"))
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), wide(h1).alias("h1"),
                               wide(h2).alias("h2"))


def _all(conditions) -> Column:
    return reduce(Column.__and__, conditions)


def differing_groups(left: DataFrame, right: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Groups whose rows differ: ``by``, what differs, and both numbers of rows."""
    def side(df: DataFrame, sign: int) -> DataFrame:
        h1, h2 = _hashes(columns)
        return df.select(*[F.col(k).alias(f"_by{i}") for i, k in enumerate(by)], F.lit(sign).alias("_sign"), h1.alias("_h1"), h2.alias("_h2"))
    # one grouping of both sides, the right one's hashes with a minus: no join of two groupings, which would be shuffled again
    signed = lambda h: F.sum(F.col(h).cast("decimal(20,0)") * F.col("_sign"))
    g = side(left, 1).unionByName(side(right, -1)).groupBy(*[f"_by{i}" for i in range(len(by))]).agg(
        F.count_if(F.col("_sign") == 1).alias("_l"), F.count_if(F.col("_sign") == -1).alias("_r"), signed("_h1").alias("_d1"), signed("_h2").alias("_d2"))
    equal = (F.col("_l") == F.col("_r")) & (F.col("_d1") == 0) & (F.col("_d2") == 0)
    return g.where(~equal).select(
        *[F.col(f"_by{i}").alias(k) for i, k in enumerate(by)],
        F.when(F.col("_r") == 0, LEFT_ONLY).when(F.col("_l") == 0, RIGHT_ONLY).otherwise(DIFFERENT).alias("difference"),
        F.col("_l").alias("left_rows"), F.col("_r").alias("right_rows"))


def differing_keys(left: DataFrame, right: DataFrame, by: Sequence[str], keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Keys whose rows differ, found only in the groups that do.

    The differing groups are a written table (a row for each of them), so both
    sides are read once for the groups and, where they differ, once more.
    """
    groups = materialize(differing_groups(left, right, by, columns).select(*[F.col(c).alias(f"_g_{c}") for c in by]), "differing-groups")

    def inside(df: DataFrame) -> DataFrame:
        return df.join(groups, _all(F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in by), "left_semi")
    return differing_groups(inside(left), inside(right), [*by, *keys], columns)
