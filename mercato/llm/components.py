"""Connected components of a large graph, by alternating large and small stars.

Every round links each node's larger neighbours to its smallest one, then the
smaller ones to the smallest, until nothing changes; what is left are stars
around each component's smallest node.  All rounds are joins and grouped
minima over edge tables written to the shared folder: no edge, node or
component reaches the driver, only a count and a checksum a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import materialize


def _sum_of(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return r.n, r.x


def _relinked(pairs: DataFrame, keep) -> DataFrame:
    """(u, v) -> every kept v (and u) with the smallest of u and its neighbours."""
    least = materialize(pairs.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least")), "least")
    joined = pairs.join(least, "u")
    return keep(joined).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b) longs -> node, label: the smallest node of its component.

    Only nodes with an edge to another node are returned.
    """
    edges = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    before = _sum_of(edges)
    while before[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = materialize(_relinked(both, lambda j: j.filter("v > u").select(F.col("v").alias("a"), F.col("least").alias("b"))), "large-star")
        small = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        edges = materialize(_relinked(small, lambda j: j.select(F.explode(F.array("u", "v")).alias("a"), F.col("least").alias("b"))), "small-star")
        if (now := _sum_of(edges)) == before:
            break
        before = now
    hubs = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(hubs.select("node", F.col("node").alias("label")))
