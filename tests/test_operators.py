"""Operators on their own: dedup, distributed rank, substring semi join,
expectations, typed ingest."""

import random
from datetime import datetime as dt
from decimal import Decimal as D

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from mercato.operators.dedup import dedup_latest, duplicate_key_count
from mercato.operators.expect import FAIL, WARN, ExpectationFailed, Rule, check_observed, routed
from mercato.operators.joins import contains_other_value, group_count_over
from mercato.operators.rank import plain_row_number, row_number_scalable, top_n


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# --- dedup ---------------------------------------------------------------------

def test_dedup_latest_is_deterministic(spark):
    df = spark.createDataFrame([
        ("a", dt(2024, 1, 1), "x"), ("a", dt(2024, 2, 1), "y"), ("a", dt(2024, 2, 1), "z"),
        (None, dt(2024, 1, 1), "n1"), (None, dt(2024, 1, 2), "n2"), ("b", None, "q"), ("b", dt(2020, 1, 1), "p"),
    ], "k string, t timestamp_ntz, v string")
    out = {r.k: r for r in dedup_latest(df, ["k"], ["t"]).collect()}
    assert out["a"].v == "z"                 # latest time, then largest other value
    assert out[None].v == "n2"               # NULL keys form one group
    assert out["b"].v == "p"                 # NULL time sorts lowest
    assert dedup_latest(df, ["k"], ["t"]).columns == ["k", "t", "v"]


def test_duplicate_key_count(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), ("c",), ("c",)], "k string")
    assert duplicate_key_count(df, ["k"]).first()[0] == 2


# --- distributed rank ------------------------------------------------------------

def _rank_frame(spark, values, ids=None):
    ids = ids or [f"id{i:05d}" for i in range(len(values))]
    return spark.createDataFrame(list(zip(ids, values, [f"c{i % 3}" for i in range(len(values))])),
                                 "id string, v decimal(20,2), cat string")


def _check_rank(spark, values, partition_by=(), rows_per_bucket=7):
    df = _rank_frame(spark, values)
    order = [("v", False), ("id", True)]
    a = rows(row_number_scalable(df, order, partition_by, rows_per_bucket=rows_per_bucket))
    b = rows(plain_row_number(df, order, partition_by))
    assert a == b


def test_rank_scalable_equals_window_with_hot_value(spark):
    random.seed(3)
    # a third of the rows share one value, plus NULLs and other ties
    values = [D("100.00")] * 70 + [None] * 10 + [D(random.randint(0, 50)) for _ in range(130)]
    random.shuffle(values)
    _check_rank(spark, values)
    _check_rank(spark, values, partition_by=["cat"])


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5)), min_size=1, max_size=60),
       st.integers(1, 9))
def test_rank_scalable_property(spark, ints, per_bucket):
    values = [None if i is None else D(i) for i in ints]
    _check_rank(spark, values, rows_per_bucket=per_bucket)
    _check_rank(spark, values, partition_by=["cat"], rows_per_bucket=per_bucket)


def test_rank_scalable_has_no_single_partition_exchange(spark):
    df = _rank_frame(spark, [D(i % 13) for i in range(300)])
    out = row_number_scalable(df, [("v", False), ("id", True)], rows_per_bucket=50)
    assert dict(out.dtypes)["rank"] == "bigint"
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert "SinglePartition" in plain_row_number(df, [("v", False), ("id", True)]) \
        ._jdf.queryExecution().executedPlan().toString()


def test_rank_of_many_buckets(spark):
    """One value shared by all rows is still split over the buckets."""
    df = spark.range(6000).selectExpr("format_string('id%05d', id) AS id", "CAST(1 AS DECIMAL(20,2)) AS v")
    out = row_number_scalable(df, [("v", False), ("id", True)], rows_per_bucket=200)
    got = out.orderBy("rank").select("id", "rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 6001)) and [r.id for r in got] == sorted(r.id for r in got)


def test_top_n_ties_by_id(spark):
    df = _rank_frame(spark, [D(5), D(9), D(9), D(1)])
    assert [r.id for r in top_n(df, [("v", False), ("id", True)], 2).collect()] == ["id00001", "id00002"]


# --- joins -------------------------------------------------------------------

def test_contains_other_value_literal_semantics(spark):
    df = spark.createDataFrame([
        ("p1", "Fone ACME bolt", "Acme"), ("p2", "Cabo 100% cobre", "100%"), ("p3", "x_y", "Zed"),
        ("p4", "Caixa zed", None), ("p5", None, "Bolt"), ("p6", "plain", "Bolt"), ("p7", "Nada", "a_b"),
    ], "id string, name string, brand string")
    hits = {r.id for r in contains_other_value(df, ["id"], "name", "brand", df, "brand").collect()}
    # p1 cites Bolt; p4 cites Zed (own brand NULL never equals); '%' and '_' are literal
    assert hits == {"p1"}
    df2 = df.union(spark.createDataFrame([("p8", "aXb", "z")], df.schema))
    hits2 = {r.id for r in contains_other_value(df2, ["id"], "name", "brand", df2, "brand").collect()}
    assert "p8" not in hits2   # brand 'a_b' does not match 'aXb' (no LIKE wildcard)


def test_contains_other_value_matches_nested_loop(spark):
    random.seed(5)
    words = ["red", "bolt", "ring", "acme", "re", "ol", "big"]
    data = [(f"p{i}", " ".join(random.choice(words) for _ in range(3)), random.choice(words + [None]))
            for i in range(80)]
    df = spark.createDataFrame(data, "id string, name string, brand string")
    got = {r.id for r in contains_other_value(df, ["id"], "name", "brand", df, "brand").collect()}
    brands = {b for _, _, b in data if b is not None}
    want = {i for i, n, b in data if b is not None and any(m != b and m.lower() in n.lower() for m in brands)}
    assert got == want


def test_group_count_over_null_keys(spark):
    df = spark.createDataFrame([("a", "n"), ("b", "n"), ("c", None), ("d", None), ("e", "m")], "id string, g string")
    got = {r.id: r.n for r in group_count_over(df, ["g"]).collect()}
    assert got == {"a": 2, "b": 2, "c": 2, "d": 2, "e": 1}


# --- expectations ------------------------------------------------------------

def test_null_counts_as_violation_and_fail_rules_raise(spark):
    df = spark.createDataFrame([(1,), (0,), (None,)], "q int")
    present = [Rule("present", "q IS NOT NULL", WARN)]
    rules = [Rule("positive", "q > 0", FAIL), *present]
    observed, obs = routed(df, rules, "t")
    observed.collect()
    assert (obs.get["_rows"], obs.get["positive"], obs.get["present"]) == (3, 2, 1)
    with pytest.raises(ExpectationFailed):
        check_observed(obs, rules)
    assert check_observed(obs, present)["present"] == 1


# --- typed ingest ----------------------------------------------------------------

def test_csv_roundtrip_strict_and_lenient(spark, tmpdir_path):
    from mercato.schemas import BRONZE
    from mercato.sources import ingest
    path = f"{tmpdir_path}/vendas"
    good = [("sal_1", "2025-12-20 10:00:00", "cus_1", "prd_1", "ecommerce", "2", "10.5")]
    bad = [("sal_2", "not a time", "cus_1", "prd_1", "ecommerce", "x", "1.0")]
    cols = [f.name for f in BRONZE["vendas"].fields]
    spark.createDataFrame(good + bad, ", ".join(f"{c} string" for c in cols)).coalesce(1) \
        .write.option("header", "true").csv(path)
    text = ingest.read_csv_text(spark, path, cols)
    with pytest.raises(Exception):
        ingest.typed(text, BRONZE["vendas"], strict=True)[0].collect()
    ok, rejects = ingest.typed(text, BRONZE["vendas"], strict=False)
    assert [r.id_venda for r in ok.collect()] == ["sal_1"]
    rej = rejects.collect()
    assert len(rej) == 1 and set(rej[0].rejected_columns) == {"data_venda", "quantidade"}


def test_csv_columns_by_name(spark, tmpdir_path):
    from mercato.sources import ingest
    for name, header in [("reordered", "b,a"), ("extra", "a,x,b"), ("missing", "a,x")]:
        values = {"a": "1", "b": "2", "x": "3"}
        spark.createDataFrame([(",".join(values[c] for c in header.split(",")),)], "value string").coalesce(1) \
            .union(spark.createDataFrame([], "value string")).write.text(f"{tmpdir_path}/{name}-body")
        lines = [header] + [r.value for r in spark.read.text(f"{tmpdir_path}/{name}-body").collect()]
        spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(f"{tmpdir_path}/{name}")
    for name in ("reordered", "extra"):
        assert [tuple(r) for r in ingest.read_csv_text(spark, f"{tmpdir_path}/{name}", ["a", "b"]).collect()] == [("1", "2")]
    with pytest.raises(Exception, match="b"):
        ingest.read_csv_text(spark, f"{tmpdir_path}/missing", ["a", "b"])


def test_lenient_ingest_stores_rejects(spark, tmpdir_path):
    from mercato.schemas import BRONZE
    from mercato.sources import ingest
    data = f"{tmpdir_path}/data"
    good = {"clientes": ("cus_1", "a", "SP", "Brasil", "2024-01-01 00:00:00"),
            "produtos": ("prd_1", "x", "c", "m", "10.0", "2024-01-01 00:00:00"),
            "vendas": ("sal_1", "2025-01-01 00:00:00", "cus_1", "prd_1", "ecommerce", "1", "10.0"),
            "preco_competidores": ("prd_1", "A", "9.0", "2026-01-11 10:00:00")}
    bad = {"clientes": ("cus_2", "b", "SP", "Brasil", "yesterday")}
    for t, row in good.items():
        cols = [f.name for f in BRONZE[t].fields]
        spark.createDataFrame([row, *([bad[t]] if t in bad else [])], ", ".join(f"{c} string" for c in cols)).coalesce(1) \
            .write.option("header", "true").csv(f"{data}/{t}.csv")
    counts = ingest.ingest_csv(spark, data, database="bronze_lenient", strict=False)
    assert counts["clientes"] == 1 and counts["clientes_rejects"] == 1 and counts["vendas_rejects"] == 0
    rejects = spark.table("bronze_lenient.clientes_rejects").collect()
    assert [(r.id_cliente, r.data_cadastro, list(r.rejected_columns)) for r in rejects] == [("cus_2", "yesterday", ["data_cadastro"])]


def test_comment_with_quotes(spark):
    from mercato.schemas import S, schema
    from mercato.sources import ingest
    ingest.create_namespace(spark, "bronze_quotes")
    ingest.create_table(spark, "bronze_quotes.t", schema(("a", S, "the customer's \\ 'id'")))
    assert spark.table("bronze_quotes.t").schema["a"].metadata["comment"] == "the customer's \\ 'id'"


# --- session ---------------------------------------------------------------------

def test_a_cluster_must_name_a_shared_folder(spark):
    from mercato import session

    class Conf(dict):
        def set(self, k, v):
            self[k] = v

    class Fake:
        conf = Conf({"spark.master": "yarn"})
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Fake())
    Fake.conf["spark.master"] = "local[2]"
    assert session.checkpoint_dir(Fake()) == session.checkpoint_dir(Fake())


def test_configure_raises_when_results_would_differ():
    from mercato import session

    class Stubborn:
        class conf:
            get = staticmethod(lambda k, d=None: "Europe/Berlin" if "timeZone" in k else "true")
            set = staticmethod(lambda k, v: None)
    with pytest.raises(RuntimeError, match="timeZone"):
        session.configure(Stubborn())


def test_money_overflow_raises(spark):
    from mercato.functions.columns import money
    df = spark.createDataFrame([(123456789012.34,)], "p double")
    with pytest.raises(Exception):
        df.select(money("p")).collect()


def test_ingest_into_declared_table(spark, tmpdir_path):
    from mercato.schemas import BRONZE
    from mercato.sources import ingest
    data = f"{tmpdir_path}/data"
    rows = {"clientes": [("cus_1", "Sr. a", "SP", "Brasil", "2024-01-01 00:00:00")],
            "produtos": [("prd_1", "x", "c", "m", "10.0", "2024-01-01 00:00:00")],
            "vendas": [("sal_1", "2025-01-01 00:00:00", "cus_1", "prd_1", "ecommerce", "1", "10.0")],
            "preco_competidores": [("prd_1", "A", "9.0", "2026-01-11 10:00:00")]}
    for t, r in rows.items():
        cols = [f.name for f in BRONZE[t].fields]
        spark.createDataFrame(r, ", ".join(f"{c} string" for c in cols)).coalesce(1) \
            .write.option("header", "true").csv(f"{data}/{t}.csv")
    counts = ingest.ingest_csv(spark, data, database="bronze_test")
    assert counts == {"clientes": 1, "produtos": 1, "vendas": 1, "preco_competidores": 1}
    again = ingest.ingest_csv(spark, data, database="bronze_test")      # re-runnable overwrite
    assert again == counts and spark.table("bronze_test.vendas").count() == 1
    assert spark.table("bronze_test.vendas").schema["quantidade"].dataType.simpleString() == "bigint"
