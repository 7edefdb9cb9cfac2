"""Mergeable check metrics: same figures as one scan, from new files only."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mercato.operators.checkstate import CheckState
from mercato.operators.manifests import Conflict
from mercato.plans import quality
from mercato.plans.lakehouse import Lakehouse
from tests import fixtures as X

SCHEMA = "id int, v decimal(10,2), data date"


def metrics():
    return {"rows": F.count(F.lit(1)), "missing": F.count_if(F.col("v").isNull()), "total": F.sum("v")}


def add(spark, folder, day, values, mode="append"):
    rows = [(i, None if v is None else Decimal(v), date(2024, 1, day)) for i, v in enumerate(values)]
    (spark.createDataFrame(rows, SCHEMA).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("data").parquet(folder))


def state(spark, tmp, other=None):
    schema = spark.createDataFrame([], SCHEMA).schema
    return CheckState(spark, f"{tmp}/state", f"{tmp}/a table", schema, other or metrics())


def whole(spark, s):
    row = spark.read.schema(s.schema).parquet(s.folder).agg(*[e.cast("decimal(38,2)").alias(n) for n, e in s.metrics.items()]).first()
    return row.asDict()


def figures(s, **kw):
    return {r["metric"]: r["value"] for r in s.merged(**kw).collect()}


@pytest.fixture()
def scanned(monkeypatch):
    """The files that each scan of new files lists in its plan."""
    seen, scan = [], CheckState.scan

    def watched(self, files):
        df = scan(self, files)
        seen.append(df.inputFiles())
        return df
    monkeypatch.setattr(CheckState, "scan", watched)
    return seen


def test_a_day_added_reads_that_day_only(spark, tmpdir_path, scanned):
    s = state(spark, tmpdir_path)
    add(spark, s.folder, 1, ["1.50", None, "-2"])
    add(spark, s.folder, 2, ["10"])
    assert s.refresh() == 1 and figures(s) == whole(spark, s) == {"rows": 4, "missing": 1, "total": Decimal("9.50")}
    add(spark, s.folder, 3, ["7", "8"])
    assert s.refresh() == 2
    assert scanned[1] and all("data=2024-01-03" in f for f in scanned[1])
    assert figures(s) == whole(spark, s) == {"rows": 6, "missing": 1, "total": Decimal("24.50")}
    assert figures(s, since=2)["rows"] == 2
    assert s.refresh() == 0 and len(scanned) == 2           # nothing new: nothing scanned


def test_days_written_anew_and_days_removed(spark, tmpdir_path, scanned):
    s = state(spark, tmpdir_path)
    for day in (1, 2, 3):
        add(spark, s.folder, day, ["1", "2"])
    s.refresh()
    add(spark, s.folder, 2, ["5", None, None], "overwrite")
    s.refresh()
    assert all("data=2024-01-02" in f for f in scanned[1])
    assert figures(s) == whole(spark, s) == {"rows": 7, "missing": 2, "total": 11}
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{s.folder}/data=2024-01-01")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    assert s.refresh() == 3 and len(scanned) == 2           # files that are gone cost no scan
    assert figures(s) == whole(spark, s) == {"rows": 5, "missing": 2, "total": 8}


def test_many_loads_merge_their_parts(spark, tmpdir_path):
    s = state(spark, tmpdir_path)
    for day in range(1, 10):
        add(spark, s.folder, day, [str(day)])
        s.refresh()
    assert figures(s) == whole(spark, s) == {"rows": 9, "missing": 0, "total": 45}
    assert len(s.log.parts()) < 8                            # merged, not one part a load


def test_a_changed_rule_scans_all_files_once(spark, tmpdir_path, scanned):
    s = state(spark, tmpdir_path)
    add(spark, s.folder, 1, ["1"])
    add(spark, s.folder, 2, ["-1"])
    s.refresh()
    wider = state(spark, tmpdir_path, {**metrics(), "missing": F.count_if(F.col("v").isNull() | (F.col("v") < 0))})
    assert wider.refresh() == 2 and len(scanned[1]) == 2 and figures(wider)["missing"] == 1
    assert state(spark, tmpdir_path).refresh() == 0          # the first definitions are still known


def test_empty_files_and_tables_without_rows(spark, tmpdir_path, scanned):
    s = state(spark, tmpdir_path)
    spark.createDataFrame([], "id int, v decimal(10,2)").coalesce(1).write.parquet(f"{s.folder}/data=2024-01-01")
    with pytest.raises(FileNotFoundError):
        s.merged()
    s.refresh()
    assert figures(s) == {"rows": 0, "missing": 0, "total": None}
    assert s.refresh() == 0 and len(scanned) == 1            # a file without rows is known as well


def test_a_run_that_dies_before_its_manifest_changes_nothing(spark, tmpdir_path, monkeypatch):
    s = state(spark, tmpdir_path)
    add(spark, s.folder, 1, ["1"])
    s.refresh()
    add(spark, s.folder, 2, ["2"])

    def dies(number, payload):
        raise Conflict("killed")
    with monkeypatch.context() as m:
        m.setattr(s.log.manifests, "commit", dies)
        with pytest.raises(Conflict):
            s.refresh()
    assert figures(s)["rows"] == 1
    assert s.refresh() == 2 and figures(s) == whole(spark, s)


def test_families_read_the_state(spark, tmpdir_path):
    lh = Lakehouse.from_tables(spark, {
        "clientes": X.customers(spark, X.CUSTOMERS), "produtos": X.products(spark, X.PRODUCTS),
        "vendas": X.sales(spark, X.SALES), "preco_competidores": X.prices(spark, X.PRICES)})
    lh.publish(f"{tmpdir_path}/lake", enforce=False)
    plain, kept = lh.opened(f"{tmpdir_path}/lake"), lh.opened(f"{tmpdir_path}/lake")
    states = {}
    for t in ("sales_detail", "customer_segments"):
        getattr(plain, t).write.parquet(f"{tmpdir_path}/{t}")
        states[t] = quality.check_state(kept, t, f"{tmpdir_path}/{t}", f"{tmpdir_path}/state-{t}")
    quality.profiles_from(kept, states)
    for family in (quality.not_null, quality.recompute, quality.segment_bounds, quality.domain, quality.row_preservation):
        assert sorted(map(tuple, family(kept).collect()), key=str) == sorted(map(tuple, family(plain).collect()), key=str)
