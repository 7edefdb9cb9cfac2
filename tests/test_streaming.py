"""Structured Streaming sales-by-time: equals the batch aggregate; a restart
from the checkpoint processes only new files (no double counting)."""

import os

import pytest
from pyspark.sql import functions as F

from mercato.operators.manifests import Manifests
from mercato.plans import marts
from mercato.streaming import sales_by_time as S
from mercato.streaming.deltas import DeltaState

SF = "/root/testdata/sf0.001"


def _to_sales(ev):
    return ev.select(F.col("ts").alias("data_venda"), F.col("event_type").alias("canal_venda"),
                     F.col("user_id").cast("string").alias("id_cliente"),
                     F.lit(1).cast("bigint").alias("quantidade"),
                     F.col("value").cast("decimal(10,2)").alias("receita"))


def rows(df):
    return sorted(map(tuple, df.collect()))


def batch(sales):
    return rows(marts.sales_by_time(sales.withColumn("data", F.to_date("data_venda")).withColumn("hora", F.hour("data_venda"))))


def test_stream_equals_batch_and_resumes(spark, tmpdir_path):
    events = spark.read.parquet(os.path.join(SF, "events.parquet"))
    src = os.path.join(tmpdir_path, "in")
    first, second = events.where("event_id % 2 = 0"), events.where("event_id % 2 = 1")
    first.write.parquet(os.path.join(src, "part1"))
    ckpt, table = os.path.join(tmpdir_path, "ckpt"), os.path.join(tmpdir_path, "table")
    schema = events.schema

    got1 = S.run(spark, src + "/*", schema, _to_sales, ckpt, table)
    assert rows(got1) == batch(_to_sales(first))

    second.write.parquet(os.path.join(src, "part2"))
    got2 = S.run(spark, src + "/*", schema, _to_sales, ckpt, table)   # resumes from the checkpoint
    assert rows(got2) == batch(_to_sales(events))

    got3 = S.run(spark, src + "/*", schema, _to_sales, ckpt, table)   # nothing new: unchanged
    assert rows(got3) == rows(got2)


def written(root):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet"))


def test_a_batch_run_again_changes_nothing(spark, tmpdir_path, monkeypatch):
    events = _to_sales(spark.read.parquet(os.path.join(SF, "events.parquet")))
    state = DeltaState(spark, os.path.join(tmpdir_path, "state"), S.merged)
    halves = [S.buyer_totals(events.where(F.col("receita") < 50)), S.buyer_totals(events.where(F.col("receita") >= 50))]
    state.append(halves[0], 0)
    with monkeypatch.context() as m:      # killed after the part is written, before it is named
        m.setattr(Manifests, "commit", lambda self, *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            state.append(halves[1], 1)
    assert rows(S.cells(S.merged(state.read()))) == batch(events.where(F.col("receita") < 50))
    for _ in range(2):                    # again, as after a failure, and once more after it was committed
        state.append(halves[1], 1)
    assert [p["level"] for p in state.parts()] == [0, 0]
    assert rows(S.cells(S.merged(state.read()))) == batch(events)


def test_what_a_batch_writes_follows_its_size(spark, tmpdir_path):
    # enough rows that the few KB that any Parquet file has don't matter
    events = _to_sales(spark.read.parquet("/root/testdata/sf0.01/events.parquet"))
    root = os.path.join(tmpdir_path, "state")
    state = DeltaState(spark, root, S.merged)
    state.append(S.buyer_totals(events).coalesce(1), 0)
    large, sizes = written(root), []
    small = S.buyer_totals(events.where("id_cliente = '7'")).coalesce(1)
    for epoch in range(1, 7):
        before = written(root)
        state.append(small, epoch)
        sizes.append(written(root) - before)
    assert max(sizes) < large / 4          # the state before stays as it is
    state.append(small, 7)                 # eight parts of one level: merged into one of the next
    assert [p["level"] for p in state.parts()] == [1]
    for epoch in range(8, 12):
        state.append(small, epoch)
    assert [p["level"] for p in state.parts()] == [1, 0, 0, 0, 0]
    total = S.cells(S.merged(state.read())).agg(F.sum("total_vendas")).first()[0]
    assert total == events.count() + 11 * events.where("id_cliente = '7'").count()
    assert len([n for n in os.listdir(root) if n.startswith("part-")]) == 5   # older parts are gone
