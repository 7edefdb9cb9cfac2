"""Hard negatives against brute force, and the bounds against exact products."""

import math

import numpy as np
import pytest
from pyspark.sql import types as T

from mercato.llm import hard_negatives as H
from mercato.llm.common import python_tasks

VECTORS = T.StructType([T.StructField("id", T.LongType()), T.StructField("label", T.IntegerType()), T.StructField("vector", T.ArrayType(T.FloatType()))]
                       + [T.StructField(c, T.StringType()) for c in ("q", "lane", "grp", "x", "ids", "score", "nth", "bands")])


def brute_force(rows, every, positives=5, negatives=5):
    usable = [(i, lab, [math.floor(256 * float(np.float32(x))) for x in v]) for i, lab, v in rows
              if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    anchors = {}
    for i, lab, q in usable:
        if i % every == 0 and (i not in anchors or (q, lab) < anchors[i]):
            anchors[i] = (q, lab)
    out = []
    for a, (q, lab) in anchors.items():
        scored = [(-sum(x * y for x, y in zip(q, p, strict=False)), i, other) for i, other, p in usable if i != a]
        for s, pos, _ in sorted(r for r in scored if r[2] == lab)[:positives]:
            band = sorted((t, i) for t, i, other in scored if other != lab and 80 * -s <= 100 * -t <= 100 * -s)[:negatives]
            out += [(a, pos, n, i, -s, -t) for n, (t, i) in enumerate(band, 1)]
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    unit = lambda v: [float(x) for x in np.float32(v / np.linalg.norm(v))]
    centres = rng.normal(size=(4, 20))
    out = [(i, int(rng.integers(4)), unit(centres[rng.integers(4)] + rng.normal(size=20))) for i in range(700)]
    same = unit(centres[0])
    out += [(700 + i, i % 2, same) for i in range(300)]  # a hot vector: ties everywhere
    out += [out[10]] * 2 + [(10, 3, same)] * 3  # repeated rows, and a repeated id with another vector
    out += [(None, 1, same), (2000, None, same), (2010, 1, None), (2020, 1, [0.1, None]), (2030, 1, [float("nan")]), (2040, 1, [float("inf")])]
    out += [(2050, 1, same[:7]), (2060, 1, [*same, 3.0, -2.0]), (2070, 2, []), (2080, 77, same)]  # unequal lengths; a label of one row
    return out


@pytest.mark.parametrize(("block_rows", "group"), [(4096, 2048), (40, 7)])
def test_mine_as_brute_force(spark, rows, block_rows, group):
    python_tasks(spark)
    frame = spark.createDataFrame([(*r, *("x",) * 8) for r in rows], VECTORS).repartition(5)
    got = H.mine(frame, every=10, block_rows=block_rows, group=group)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == sorted(brute_force(rows, 10))


def test_empty_table(spark):
    python_tasks(spark)
    assert H.mine(spark.createDataFrame([], VECTORS)).count() == 0
    assert H.mine(spark.createDataFrame([(1, 1, [0.5], *("x",) * 8)], VECTORS)).count() == 0  # no anchor


def test_bounds_hold_and_get_closer():
    rng = np.random.default_rng(1)
    x, q = rng.integers(-200, 200, (300, 64)), rng.integers(-200, 200, (1, 64))
    exact, before = (x @ q[0]).astype(float), np.inf
    slack = 1 + H.SLACK * np.sqrt((x**2).sum(axis=1).max() * (q**2).sum())
    for (n, m, d), (_, qm, qd) in zip(H.summaries(x), H.summaries(q), strict=True):
        middle, spread = n * (m.astype(float) @ qm[0]), d.astype(float) @ qd[0] + slack
        assert (abs(exact - middle) <= spread).all()
        assert spread.mean() < before
        before = spread.mean()


def test_large_components_are_scored_in_whole_numbers():
    x = np.array([[2**31, 3] + [0] * 14], np.int64)
    block = H.Block(np.array([1]), np.array([0]), x, H.summaries(x))
    assert block.scores(np.array([0]), x[0]).tolist() == [2**62 + 9]
