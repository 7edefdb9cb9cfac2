"""Distinct counts that can be merged (A8): sketch columns kept per cell.

An exact distinct count of a cell says nothing about two cells together.  A
HyperLogLog sketch of the cell's values does: the union of two sketches is the
sketch of both cells' values, so day, week and channel figures come from the
cells alone, in any order, without the rows.  A sketch has a bounded size
(2^LG_K bytes, less while it has seen few values).

The relative standard error of an estimate is 1.04 / sqrt(2^LG_K) = 0.8 %; up
to some thousand values the sketch keeps them all and is almost exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 14


def sketch_cells(df: DataFrame, by: Sequence[str], value: str, name: str = "sketch", lg_k: int = LG_K) -> DataFrame:
    """One row a cell with the sketch of its values; NULL values are not counted."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(value, lg_k).alias(name))


def merge_cells(cells: DataFrame, by: Sequence[str | Column], name: str = "sketch") -> DataFrame:
    """Coarser cells from finer ones, still with a sketch each."""
    return cells.groupBy(*by).agg(F.hll_union_agg(name).alias(name))


def estimate(name: str = "sketch") -> Column:
    """The distinct values of a cell, as a BIGINT."""
    return F.hll_sketch_estimate(name)
