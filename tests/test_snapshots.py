"""Versioned publish: repeatable, whole for every reader, killed between steps; routed rows."""

import json
import os

import pytest
from pyspark.sql import functions as F

from mercato.operators import expect
from mercato.operators.expect import ExpectationFailed, Rule
from mercato.operators.manifests import Conflict, Manifests
from mercato.plans import quality, questions, silver, snapshots
from mercato.plans.lakehouse import Lakehouse, published_testdata
from mercato.plans.queries import QUERIES
from mercato.session import CLEANUP, shuffles_removed
from tests import fixtures as X

CLEAN = [r for r in X.CUSTOMERS if r[0] != "cus_6"]


def lake(spark, customers=CLEAN, sales=X.SALES):
    return Lakehouse.from_tables(spark, {
        "clientes": X.customers(spark, customers), "produtos": X.products(spark, X.PRODUCTS),
        "vendas": X.sales(spark, sales), "preco_competidores": X.prices(spark, X.PRICES)})


SHORT = CLEAN[:-1], X.SALES[:-1]   # the other state: without cus_5, and without sale 6


def state(opened):
    """What tells one published state from the other in three tables."""
    return opened.customers.count(), opened.sales_detail.count(), opened.customer_segments.count()


OLD, NEW = (5, 6, 5), (4, 5, 4)


class Killed(BaseException):
    """Stands for the end of the driver: nothing after it runs, clean-up included."""


def test_publish_twice_query_and_publish_again(spark, tmpdir_path):
    lh = lake(spark)
    lh.publish(tmpdir_path)
    assert lh.sales.count() == 6 and lh.sales_detail.count() == 6        # the object doesn't hang on what it wrote
    lh.publish(tmpdir_path)
    lh.publish(database="snap_twice")
    assert lh.quality_scorecard.count() == 7
    opened = lh.opened(tmpdir_path)
    assert opened.published_version.startswith("00000002-")
    assert questions.tier_share(lh.opened(database="snap_twice"), "VIP").count() == 1
    assert {r.all_passed for r in quality.report(opened).collect()} == {True}


def test_a_reader_keeps_its_version(spark, tmpdir_path):
    lake(spark).publish(tmpdir_path)
    first = lake(spark).opened(tmpdir_path)
    lake(spark, *SHORT).publish(tmpdir_path)
    assert state(first) == OLD and state(lake(spark).opened(tmpdir_path)) == NEW
    assert state(lake(spark).opened(tmpdir_path, version=1)) == OLD
    for _ in range(2):
        lake(spark).publish(tmpdir_path, keep=2)
    assert snapshots.FolderStore(spark, tmpdir_path).numbers() == [3, 4]
    assert len(os.listdir(f"{tmpdir_path}/versions")) == 2


def test_opened_needs_no_scan_for_its_schema(spark, tmpdir_path):
    lake(spark).publish(tmpdir_path)
    opened = lake(spark).opened(tmpdir_path)
    assert opened.sales_detail.schema["receita"].metadata == {"comment": "revenue"}
    assert "regras_violadas" not in opened.sales.columns and "destino" not in opened.sales.columns


FOLDER_STEPS = [("write", 3), ("write", 10), ("_rename", 1), ("expire", 1)]


@pytest.mark.parametrize(("step", "nth"), FOLDER_STEPS)
def test_killed_between_any_two_steps_in_a_folder(spark, tmpdir_path, monkeypatch, step, nth):
    lake(spark).publish(tmpdir_path)
    calls = []
    cls = {"expire": snapshots.FolderStore, "_rename": Manifests}.get(step, snapshots.FolderVersion)
    real = getattr(cls, step)

    def killed(self, *args, **kw):
        calls.append(step)
        if len(calls) == nth:
            raise Killed
        return real(self, *args, **kw)
    with monkeypatch.context() as m:
        m.setattr(cls, step, killed)
        m.setattr(snapshots.FolderVersion, "discard", lambda self: None)
        with pytest.raises(Killed):
            lake(spark, *SHORT).publish(tmpdir_path)
    assert state(lake(spark).opened(tmpdir_path)) == (NEW if step == "expire" else OLD)
    lake(spark, *SHORT).publish(tmpdir_path)
    assert state(lake(spark).opened(tmpdir_path)) == NEW
    lake(spark).publish(tmpdir_path)
    assert len(os.listdir(f"{tmpdir_path}/versions")) == 2   # what the killed run left is gone


@pytest.mark.parametrize(("step", "nth"), [("write", 10), ("_switch", 1), ("expire", 1)])
def test_killed_between_any_two_steps_in_a_catalog(spark, monkeypatch, step, nth):
    db = f"snap_{step}_{nth}".lower()
    lake(spark).publish(database=db)
    calls = []
    cls = snapshots.CatalogStore if step == "expire" else snapshots.CatalogVersion
    real = getattr(cls, step)

    def killed(self, *args, **kw):
        calls.append(step)
        if len(calls) == nth:
            raise Killed
        return real(self, *args, **kw)
    with monkeypatch.context() as m:
        m.setattr(cls, step, killed)
        m.setattr(snapshots.CatalogVersion, "discard", lambda self: None)
        with pytest.raises(Killed):
            lake(spark, *SHORT).publish(database=db)
    by_name = tuple(spark.table(f"{db}.{t}").count() for t in ("silver_clientes", "gold_sales_detail", "gold_customer_segments"))
    assert by_name == state(lake(spark).opened(database=db)) == (NEW if step == "expire" else OLD)
    lake(spark, *SHORT).publish(database=db)
    by_name = tuple(spark.table(f"{db}.{t}").count() for t in ("silver_clientes", "gold_sales_detail", "gold_customer_segments"))
    assert by_name == state(lake(spark).opened(database=db)) == NEW
    lake(spark, *SHORT).publish(database=db, keep=1)
    assert spark.sql(f"SHOW PARTITIONS {db}.gold_sales_detail_versions").count() == 1   # what the killed run left is gone


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(files) if (name := f.getName()).startswith("shuffle_")}


def test_a_publish_leaves_no_shuffle_files(spark, tmpdir_path):
    """They stayed until the JVM collected the plans: all shuffles of a publish, or of two, were on disk at once."""
    before, setting = shuffle_files(spark), spark.conf.get(CLEANUP, None)
    lake(spark).publish(tmpdir_path)
    lake(spark).publish(tmpdir_path)
    assert shuffle_files(spark) <= before
    assert spark.conf.get(CLEANUP, None) == setting
    again = lake(spark).opened(tmpdir_path).sales.groupBy("id_cliente").count()
    assert len(again.collect()) == len(again.collect()) == 4   # outside, a DataFrame may run twice


SF = "/root/testdata/sf0.001"


def test_loads_of_the_checks_are_written_without_a_shuffle(spark, monkeypatch):
    """Every row of the wide table went through a shuffle by year, all of a year to one task."""
    published_testdata(spark, SF)

    def shuffled(self, *args):
        raise AssertionError("rows are dealt anew")
    monkeypatch.setattr(type(spark.range(0)), "repartition", shuffled)
    rows = QUERIES["dq_by_load"](spark, SF).where("metric = 'rows'").orderBy("carga").collect()
    total = published_testdata(spark, SF).sales_detail.count()
    assert [r.linhas_lidas for r in rows][:2] == [rows[0].value, total - rows[0].value] and rows[1].value == rows[2].value == total


def test_given_figures_leave_no_shuffle_files(spark):
    published_testdata(spark, SF)
    before = shuffle_files(spark)
    QUERIES["given_figures"](spark, SF)   # counts in the sources while it is built
    assert shuffle_files(spark) <= before


def test_shuffle_files_go_where_blocks_overlap(spark):
    first, second = shuffles_removed(spark), shuffles_removed(spark)
    setting = spark.conf.get(CLEANUP, None)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(CLEANUP) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(CLEANUP, None) == setting


ORPHANS = [*X.SALES, ("sal_7", None, "cus_1", "prd_1", "ecommerce", 1, 5.0), ("sal_8", X.T0, None, "prd_2", None, 2, 5.0),
           ("sal_9", X.T0, "cus_404", None, "ecommerce", None, 5.0), ("sal_10", None, None, None, None, None, None)]


def test_published_gold_equals_gold_from_the_sources(spark, tmpdir_path):
    """The published tables are made by other plans than the lazy ones; rows without time, customer, product or price too."""
    lh = lake(spark, X.CUSTOMERS, ORPHANS)
    lh.publish(tmpdir_path, enforce=False)
    lh.publish(database="snap_same", enforce=False)
    for opened in (lh.opened(tmpdir_path), lh.opened(database="snap_same")):
        for name in ["sales", *Lakehouse.GOLD]:
            mine, theirs = getattr(lh, name), getattr(opened, name)
            assert theirs.columns == mine.columns
            assert sorted(map(str, theirs.collect())) == sorted(map(str, mine.collect())), name


def test_columns_beside_a_table_are_not_of_it(spark, tmpdir_path):
    lh = lake(spark)
    lh.publish(tmpdir_path)
    opened = lh.opened(tmpdir_path)
    assert opened.sales.columns == silver.SALES_COLUMNS
    assert opened.quarantined["sales"].columns == [*silver.SALES_COLUMNS, "regras_violadas"]
    where = opened.sales.inputFiles()[0]
    assert set(silver.PRODUCT_DIMS) < set(spark.read.parquet(where).columns)


def test_the_wide_table_of_a_publish_shuffles_each_sale_twice(spark, tmpdir_path, monkeypatch):
    """Once to its customer and once to its day, without columns that follow from others of the sale."""
    plans, real = {}, snapshots.FolderVersion.write

    def kept(self, df, name, *args):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return real(self, df, name, *args)
    monkeypatch.setattr(snapshots.FolderVersion, "write", kept)
    lake(spark).publish(tmpdir_path)
    wide = plans["gold.sales_detail"]
    assert wide.count("SortMergeJoin") == 1 and "hashpartitioning(id_produto" not in wide
    to_days = wide.index("rangepartitioning(")
    assert all(wide.index(f"AS {c}#") < to_days for c in ("receita", "dia_semana", "hora"))   # plans are printed from the end
    vendas = plans["silver.vendas"]
    assert vendas.index("AS receita#") < vendas.index("SortMergeJoin")
    # the rows of the distinct count hold their key only
    assert "partial_count(distinct" not in plans["gold.sales_by_time"]
    assert any("hashpartitioning(data" in line and "id_cliente" in line for line in plans["gold.sales_by_time"].splitlines())


def test_a_failing_run_leaves_what_is_published(spark, tmpdir_path):
    lake(spark).publish(tmpdir_path)
    lake(spark).publish(database="snap_fail")
    before = {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(tmpdir_path) for f in fs}
    for where in ({"root": tmpdir_path}, {"database": "snap_fail"}):
        with pytest.raises(ExpectationFailed):
            lake(spark, X.CUSTOMERS).publish(**where)          # a customer without a region
    after = {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(tmpdir_path) for f in fs}
    assert before == after
    assert spark.table("snap_fail.silver_clientes").where("regiao IS NULL").count() == 0
    assert spark.sql("SHOW PARTITIONS snap_fail.silver_clientes_versions").count() == 1


def test_two_publishes_from_one_version_conflict(spark, tmpdir_path, monkeypatch):
    lake(spark).publish(tmpdir_path)
    real = snapshots.FolderVersion.commit

    def late(self, metrics):
        with monkeypatch.context() as m:
            m.setattr(snapshots.FolderVersion, "commit", real)
            lake(spark, *SHORT).publish(tmpdir_path)           # another run is faster
        return real(self, metrics)
    with monkeypatch.context() as m:
        m.setattr(snapshots.FolderVersion, "commit", late)
        with pytest.raises(Conflict):
            lake(spark).publish(tmpdir_path)
    assert state(lake(spark).opened(tmpdir_path)) == NEW


def test_a_view_reads_one_version_only(spark):
    lake(spark).publish(database="snap_prune")
    lake(spark, *SHORT).publish(database="snap_prune")
    files = {f for f in spark.table("snap_prune.gold_sales_detail").select(F.input_file_name().alias("f")).distinct().toPandas()["f"]}
    assert files and all("lake_version=00000002-" in f for f in files)
    plan = spark.table("snap_prune.gold_sales_detail")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(lake_version" in plan and "Subquery" not in plan


def test_metrics_and_layers(spark, tmpdir_path):
    metrics = lake(spark).publish(tmpdir_path)
    assert metrics["vendas"]["produto_cadastrado"] == 1
    assert metrics["vendas"]["venda_depois_do_cadastro"] == 3
    assert metrics["vendas"]["venda_nao_antecede_cadastro"] == 1
    assert metrics["preco_competidores"]["preco_plausivel"] == 1
    store = snapshots.FolderStore(spark, tmpdir_path)
    assert store.manifest()["metrics"] == metrics and len(store.manifest()["schemas"]) == 10
    assert lake(spark).opened(tmpdir_path).quality_scorecard.count() == 7
    json.dumps(store.manifest())


# --- routed rows --------------------------------------------------------------

BAD_SALES = [*X.SALES, ("sal_7", X.T0, "cus_1", "prd_1", "ecommerce", 0, 5.0), ("sal_8", X.T0, "cus_1", "prd_1", "ecommerce", 2, None)]


@pytest.mark.parametrize("where", ["folder", "catalog"])
def test_quarantined_rows_are_kept_apart_with_their_rules(spark, tmpdir_path, where):
    target = {"root": tmpdir_path} if where == "folder" else {"database": "snap_quarantine"}
    lh = lake(spark, X.CUSTOMERS, BAD_SALES)
    metrics = lh.publish(**target, quarantine=True)
    opened = lh.opened(**target)
    assert metrics["vendas"]["_quarantined"] == 2 and metrics["clientes"]["_quarantined"] == 1
    assert opened.sales.count() == 6 and opened.sales_detail.count() == 6 and opened.customers.count() == 5
    aside = opened.quarantined["sales"].withColumn("regras", expect.broken_rules(dict((a, r) for _, a, r in lh.SILVER)["sales"]))
    broken = {r.id_venda: set(r.regras) for r in aside.collect()}
    assert set(broken) == {"sal_7", "sal_8"} and all(broken.values())
    if where == "catalog":
        assert spark.table("snap_quarantine.silver_vendas_quarantine").count() == 2


def test_a_table_of_quarantined_rows_only_is_empty(spark, tmpdir_path):
    lh = lake(spark, [X.CUSTOMERS[-1]])
    lh.publish(tmpdir_path, quarantine=True)
    assert lh.opened(tmpdir_path).customers.count() == 0 and lh.opened(tmpdir_path).quarantined["customers"].count() == 1


def test_rules_are_evaluated_once_a_row_in_one_scan(spark, tmpdir_path):
    rules = [Rule("positive", "q > 0"), Rule("small", "q < 10", expect.WARN), Rule("known", "s IS NOT NULL")]
    spark.createDataFrame([(1, "a"), (0, "b"), (50, "c"), (-1, None), (None, None)], "q int, s string").write.parquet(f"{tmpdir_path}/in")
    df, obs = expect.routed(spark.read.parquet(f"{tmpdir_path}/in"), rules, "once", set_aside=True)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("> 0)") == 1 and optimized.count("< 10)") == 1
    df.write.partitionBy(expect.ROUTE).parquet(f"{tmpdir_path}/out")
    assert obs.get == {"_rows": 5, "_quarantined": 3, "positive": 3, "small": 2, "known": 2}
    back = spark.read.parquet(f"{tmpdir_path}/out").withColumn("broken", expect.broken_rules(rules))
    got = {(r.q, r.destino, tuple(r.broken)) for r in back.collect()}
    assert got == {(1, "good", ()), (0, "quarantine", ("positive",)), (50, "good", ("small",)),
                   (-1, "quarantine", ("positive", "known")), (None, "quarantine", ("positive", "small", "known"))}
