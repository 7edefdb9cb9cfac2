import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm import bitsliced, mixing
from mercato.llm.common import python_tasks


def brute_top(rows, queries, k):
    q = {i: [int(np.floor(256 * float(x))) for x in v] for i, v in rows}
    out = []
    for i in queries:
        scored = sorted((-sum(a * b for a, b in zip(q[i], v, strict=False)), j) for j, v in q.items() if j != i)[:k]
        out += [(i, n, j, -s) for n, (s, j) in enumerate(scored, 1)]
    return sorted(out)


def test_top_k(spark):
    python_tasks(spark)
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(300, 6)).round(2)
    vectors[40:140] = vectors[40]  # a third are the same vector
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(300, [1.0, 2.0]), (301, [0.0] * 6), (302, [-5.5, 3.25, 900.0, 0.1, -0.1, 7.0, 1.0])]  # unequal lengths
    bad = [(400, None), (401, [1.0, None]), (402, [float("nan")] * 6), (403, [float("inf")] * 6), (None, [1.0] * 6)]
    df = spark.createDataFrame(rows + bad, "id long, vector array<double>").repartition(5).withColumn("slot", F.lit("x"))
    got = sorted(map(tuple, bitsliced.top_k(df, df.filter("id % 20 = 0 or id > 299"), k=5, block_rows=64).collect()))
    assert got == brute_top(rows, [i for i, _ in rows if i % 20 == 0 or i > 299], 5)
    few = df.filter("id in (20, 21, 22)")
    assert sorted(map(tuple, bitsliced.top_k(few, few.filter("id = 20"), k=5).collect())) == brute_top([rows[i] for i in (20, 21, 22)], [20], 5)
    assert bitsliced.top_k(df.limit(0), df.limit(0)).count() == 0


def test_repeated_vectors(spark):
    df = spark.createDataFrame([(1, [1.0]), (1, [1.0]), (2, [2.0]), (2, [2.0])], "id long, vector array<double>")
    got = sorted(map(tuple, bitsliced.top_k(df, df.filter("id = 1"), k=5).collect()))
    assert got == [(1, 1, 2, 131072), (1, 2, 2, 131072)]


def test_select_top_stops_at_the_boundary():
    scores = np.array([3, 7, 7, 1, 7, 0])
    slices = [np.array([int("".join("1" if s >> b & 1 else "0" for s in scores[::-1]), 2)], np.uint64) for b in range(3)]
    every = np.array([0b111111], np.uint64)
    assert sorted(bitsliced.select_top(slices, every, 2, 6)) == [1, 2]
    assert sorted(bitsliced.select_top(slices, every, 4, 6)) == [0, 1, 2, 4]
    assert sorted(bitsliced.select_top(slices, every, 9, 6)) == [0, 1, 2, 3, 4, 5]


def filled(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    total, full, target = share * sum(sizes.values()), set(), {}
    while True:
        rest = total - sum(cap * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        target = {s: cap * sizes[s] if s in full else rest * w[s] / sum(w[x] for x in open_) for s in names}
        over = {s for s in open_ if target[s] > cap * sizes[s] + 1e-9}
        if not over:
            return target
        full |= over


@pytest.mark.parametrize("seed", range(4))
def test_mix(spark, seed):
    rng = random.Random(seed)
    sources = ["b", "a", None, "é", "hot"][: 2 + seed]
    rows = [(i, "hot" if rng.random() < 0.4 and "hot" in sources else rng.choice(sources), rng.choice([0, 1, 5, 40, rng.randint(1, 300), None])) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, source string, size long").withColumn("s", F.lit(1)).withColumn("b", F.lit(2))
    got = mixing.mix(df.repartition(3)).collect()
    again = mixing.mix(df.repartition(7)).collect()
    assert sorted((r.id, r.taken) for r in got) == sorted((r.id, r.taken) for r in again)
    sizes = {s: sum(n or 0 for _, x, n in rows if x == s) for s in {x for _, x, _ in rows}}
    target = filled(sizes)
    assert len(got) == len(rows)
    for s in sizes:
        mine = [r for r in got if r.source == s]
        assert all(r.source_size == sizes[s] and abs(r.target - target[s]) < 1e-6 for r in mine)
        assert abs(sum(r.taken for r in mine) - target[s]) <= max((r.size for r in mine), default=0) / 2 + 1e-6
        assert all(r.taken in (0, r.size, 2 * r.size) for r in mine)


def test_mix_edge_cases(spark):
    schema = "id long, source string, size long"
    assert mixing.mix(spark.createDataFrame([], schema)).count() == 0
    empty = mixing.mix(spark.createDataFrame([(1, "a", 0), (2, "b", None)], schema)).collect()
    assert [(r.taken, r.source_size, r.target) for r in empty] == [(0, 0, 0.0)] * 2
    same = mixing.mix(spark.createDataFrame([(7, "a", 10)] * 3 + [(None, "a", 10)], schema)).collect()
    assert len({r.taken for r in same if r.id == 7}) == 1


def test_mix_refines_until_one_row_is_left(spark):
    df = spark.range(3000).select("id", F.lit("a").alias("source"), F.lit(3).cast("long").alias("size")).union(
        spark.range(3000, 3100).select("id", F.lit("b"), F.lit(1).cast("long")))
    for bits in (4, 12):  # few bits: many levels
        got = mixing.mix(df, bits=bits).groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("x")).collect()
        assert all(abs(r.t - r.x) <= 1.5 for r in got)


def test_mix_splits_rows_that_share_an_id(spark):
    rows = [(7 if i % 2 else None, "a", 10, f"text {i}") for i in range(200)] + [(i, "b", 10, f"text {i}") for i in range(200)]
    df = spark.createDataFrame(rows + [(1000, "b", 10, "copy")] * 3, "id long, source string, size long, key2 string")
    got = mixing.mix(df.repartition(3), weights=(3, 1), share=0.4).collect()
    again = mixing.mix(df.repartition(5), weights=(3, 1), share=0.4).collect()
    assert sorted((str(r.id), r.source, r.taken) for r in got) == sorted((str(r.id), r.source, r.taken) for r in again)
    taken = sum(r.taken for r in got if r.source == "a")
    assert abs(taken - next(r.target for r in got if r.source == "a")) <= 5
    assert len({r.taken for r in got if r.id == 1000}) == 1
