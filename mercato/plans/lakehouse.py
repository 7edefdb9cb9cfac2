"""The ordered build: bronze -> silver -> gold, lazily, one object per run.

``Lakehouse`` memoises each table's DataFrame so a query that needs the
catalog twice plans one lineage.  ``publish`` writes every table into a new
version (silver first, re-read for gold) with the expectation counters
observed on the write itself, and names the version as the current one only
after every fail-set rule has held (``snapshots``).
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato import params as P
from mercato.operators import expect
from mercato.operators.joins import require_unique
from mercato.operators.materialize import materialize
from mercato.plans import marts, silver, snapshots
from mercato.session import scratch_path, shuffles_removed
from mercato.sources import testdata


class Lakehouse:
    def __init__(self, spark: SparkSession, bronze: dict[str, DataFrame],
                 states, params: P.Params = P.DEFAULT_PARAMS):
        self.spark = spark
        self.bronze = bronze
        self._states = states      # DataFrame, or a function building it on first use
        self.params = params

    @cached_property
    def states(self) -> DataFrame:
        return self._states() if callable(self._states) else self._states

    # --- constructors -------------------------------------------------------
    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str,
                      params: P.Params = P.TESTDATA_PARAMS) -> "Lakehouse":
        return cls(spark, testdata.bronze(spark, sf_dir), lambda: testdata.state_lookup(spark, sf_dir), params)

    @classmethod
    def from_tables(cls, spark: SparkSession, bronze: dict[str, DataFrame],
                    params: P.Params = P.DEFAULT_PARAMS) -> "Lakehouse":
        return cls(spark, bronze, silver.states_table(spark, params), params)

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str = "bronze",
                     params: P.Params = P.DEFAULT_PARAMS) -> "Lakehouse":
        """The four bronze tables read by name from ``database``."""
        from mercato.schemas import BRONZE
        return cls.from_tables(spark, {t: spark.read.table(f"{database}.{t}") for t in BRONZE}, params)

    # --- silver -------------------------------------------------------------
    @cached_property
    def customers(self) -> DataFrame:
        return silver.clean_customers(self.bronze["clientes"], self.states)

    @cached_property
    def catalog(self) -> DataFrame:
        return silver.product_catalog(self.bronze["produtos"], self.params)

    # Dimensions that whole fact tables are joined to are written first: a
    # skewed join partition is split only if its other side is a plain scan
    # behind its shuffle, and both dimensions end in an aggregate.
    # The write fails on a repeated key, so no star join can multiply sales.
    @cached_property
    def catalog_written(self) -> DataFrame:
        return materialize(require_unique(self.catalog, ["id_produto"], "vendas -> produtos"), "catalog")

    @cached_property
    def customers_written(self) -> DataFrame:
        return materialize(require_unique(self.customers, ["id_cliente"], "vendas -> clientes"), "customers")

    @cached_property
    def segments_written(self) -> DataFrame:
        revenue = marts.customer_revenue(self.customers, silver.with_derived(self.sales_written), self.params)
        # what the wide table takes from it; the other totals are not computed
        return materialize(require_unique(revenue.select(*marts.SEGMENT_COLUMNS), ["id_cliente"], "vendas -> segmentos"), "customer-revenue")

    # The wide table needs the sales twice, for the customers' revenue and for
    # itself: they are deduplicated once, and written.
    @cached_property
    def sales_written(self) -> DataFrame:
        return materialize(silver.sales_rows(self.bronze["vendas"]), "sales")

    @cached_property
    def sales_for_detail(self) -> DataFrame:
        """Written sales plus the catalog's columns, without what is derived from them."""
        return silver.sales_enriched(self.sales_written, self.catalog_written, with_product=True)

    @cached_property
    def sales_base(self) -> DataFrame:
        """Silver sales without the product registry (no join)."""
        return silver.sales_base(self.bronze["vendas"])

    @cached_property
    def sales_with_product(self) -> DataFrame:
        """Silver sales plus the catalog's descriptive columns (one join, before what a sale's own columns give)."""
        rows = silver.sales_enriched(silver.sales_rows(self.bronze["vendas"]), self.catalog_written, with_product=True)
        return silver.with_derived(rows).select(*silver.SALES_COLUMNS, *silver.PRODUCT_DIMS)

    @cached_property
    def sales(self) -> DataFrame:
        return self.sales_with_product.select(*silver.SALES_COLUMNS)

    @cached_property
    def prices(self) -> DataFrame:
        return silver.competitor_prices(self.bronze["preco_competidores"], self.catalog_written, self.params)

    # --- gold ---------------------------------------------------------------
    @cached_property
    def sales_by_time(self) -> DataFrame:
        return marts.sales_by_time(self.sales_base)

    @cached_property
    def sales_by_product(self) -> DataFrame:
        return marts.sales_by_product(self.sales_base, self.catalog)

    @cached_property
    def product_revenue(self) -> DataFrame:
        """sales_by_product without the two ranks (for questions that do not
        need them: no ranking jobs)."""
        return marts.sales_by_product(self.sales_base, self.catalog, ranked=False)

    @cached_property
    def customer_revenue(self) -> DataFrame:
        return marts.customer_revenue(self.customers, self.sales_base, self.params)

    @cached_property
    def customer_segments(self) -> DataFrame:
        return marts.customer_segments(self.customers, self.sales_base, self.params)

    @cached_property
    def sales_detail(self) -> DataFrame:
        return marts.sales_detail(self.sales_for_detail, self.catalog, self.customers, self.params,
                                  segments=self.segments_written)

    @cached_property
    def price_position(self) -> DataFrame:
        return marts.price_position(self.catalog, self.prices, self.sales_base)

    @cached_property
    def quality_scorecard(self) -> DataFrame:
        from mercato.plans import scorecard
        return scorecard.fused(self)

    # --- publishing ---------------------------------------------------------
    SILVER = [("clientes", "customers", silver.CUSTOMER_RULES),
              ("produtos", "catalog", silver.PRODUCT_RULES),
              ("vendas", "sales", silver.SALES_RULES),
              ("preco_competidores", "prices", silver.COMPETITOR_RULES)]
    GOLD = ["sales_by_time", "sales_by_product", "customer_segments", "sales_detail",
            "price_position", "quality_scorecard"]

    KEYS = {"customers": ["id_cliente"], "catalog": ["id_produto"]}

    # Silver sales are written from their join to the catalog, whose columns
    # stand in the same files, outside the table, for the wide table of the
    # same publish: in the order of the join they take little, and the wide
    # table is spared a second shuffle of every sale by its product.
    BESIDE = {"sales": ("sales_with_product", silver.PRODUCT_DIMS)}

    # tables written bucketed by the customer key in catalog mode: the wide
    # sales table's customer join then reads both sides co-located.  That join
    # cannot split a hot customer; publish without buckets if there is one.
    BUCKETED = {"sales": "id_cliente", "customer_segments": "id_cliente"}

    def publish(self, root: str | None = None, enforce: bool = True, database: str | None = None,
                buckets: int | None = None, quarantine: bool = False, keep: int = 2) -> dict:
        """Write silver (with expectations) and gold as a new version, then make it the current one.

        Either under the folder ``root`` or in the catalog's ``database``; with
        ``buckets`` the silver sales and the customer segments are bucketed and
        sorted by ``id_cliente`` into the same number of buckets.

        Nothing of the versions before is touched, and readers see the new one
        only when all of it is written and has passed (``snapshots``).  A
        violated fail-set rule raises, unless ``enforce`` is off; with
        ``quarantine`` the rows that violate one are set aside instead, and
        silver and gold hold the others.  The last ``keep`` versions stay.
        Silver is re-read before gold is built, which cuts the lineage.
        Returns the counters of every silver table.
        """
        store = self._store(root, database)
        version = store.begin(buckets)
        try:
            with shuffles_removed(self.spark):   # every table of a publish is written once
                metrics = self._write_all(version, enforce, quarantine)
            version.commit(metrics)
        finally:
            if not version.committed:
                version.discard()
        store.expire(keep)
        return metrics

    def _store(self, root: str | None, database: str | None) -> snapshots.FolderStore | snapshots.CatalogStore:
        if (root is None) == (database is None):
            raise ValueError("name a folder or a database")
        return snapshots.FolderStore(self.spark, root) if database is None else snapshots.CatalogStore(self.spark, database)

    def _write_all(self, version, enforce: bool, quarantine: bool) -> dict:
        """Tables that need nothing of each other are written at the same time."""
        metrics, build = {}, self._with({})

        def write_silver(table: str, attr: str, rules) -> DataFrame:
            source, beside = self.BESIDE.get(attr, (attr, []))
            df = getattr(build, source)
            if attr in self.KEYS:   # what facts are joined to has one row a key
                df = require_unique(df, self.KEYS[attr], f"silver.{table}")
            df, obs = expect.routed(df, rules, f"silver_{table}", quarantine)
            written = version.write(df, f"silver.{table}", self.BUCKETED.get(attr), beside)
            metrics[table] = expect.check_observed(obs, rules, quarantine) if enforce or quarantine else obs.get
            return written

        def write_gold(name: str) -> DataFrame:
            if name == "sales_detail":
                # Clustered by date, min/max skipping on `data`; the sale id
                # splits a day over as many tasks as its volume asks for.  What a
                # sale's own columns give is added behind the shuffle
                rows = marts.sales_detail_rows(build.sales_for_detail, build.catalog, build.segments_written)
                rows = rows.repartitionByRange(F.to_date("data_venda"), "id_venda")
                df = marts.sales_detail_columns(rows).sortWithinPartitions("data")
            elif name == "sales_by_time":
                df = marts.sales_by_time(build.sales_base, written=True)
            else:
                df = getattr(build, name)
            return version.write(df, f"gold.{name}", self.BUCKETED.get(name))

        dimensions, facts = self.SILVER[:2], self.SILVER[2:]
        for tables in (dimensions, facts):   # facts join the written catalog
            done = self._together([partial(write_silver, *t) for t in tables])
            build.__dict__.update({attr: df for (_, attr, _), df in zip(tables, done, strict=True)})
            build.__dict__.update(catalog_written=build.catalog, customers_written=build.customers)
        # gold reads the written silver sales; dimensions are joined from their files
        build.__dict__.update(sales_with_product=build.sales, sales_base=build.sales, sales_for_detail=version.whole("silver.vendas"))
        first = [g for g in self.GOLD if g != "sales_detail"]
        build.__dict__.update(zip(first, self._together([partial(write_gold, g) for g in first]), strict=True))
        # the wide table joins the written segments
        build.__dict__["customer_revenue"] = build.__dict__["segments_written"] = build.customer_segments
        write_gold("sales_detail")
        return metrics

    def _together(self, tasks: list) -> list:
        """Results of driver threads that each run their own Spark jobs."""
        with ThreadPoolExecutor(len(tasks)) as pool:
            return [f.result() for f in [pool.submit(inheritable_thread_target(self.spark)(t)) for t in tasks]]

    def _with(self, tables: dict) -> "Lakehouse":
        out = Lakehouse(self.spark, self.bronze, self._states, self.params)
        for attr, df in tables.items():
            out.__dict__[attr] = df
        return out

    def opened(self, root: str | None = None, database: str | None = None, version: int | str | None = None) -> "Lakehouse":
        """A lakehouse whose silver and gold tables are those of one published
        version (the current one by default), whatever is published meanwhile:
        checks and questions scan them instead of recomputing the pipeline."""
        store = self._store(root, database)
        manifest = store.manifest(version)
        if manifest is None:
            raise FileNotFoundError(f"nothing is published under {root or database}")
        tables = {attr: store.table(manifest, f"silver.{table}") for table, attr, _ in self.SILVER}
        tables.update(sales_with_product=tables["sales"], sales_base=tables["sales"],
                      catalog_written=tables["catalog"], customers_written=tables["customers"])
        tables.update({name: store.table(manifest, f"gold.{name}") for name in self.GOLD})
        tables.update(quarantined={attr: store.table(manifest, f"silver.{table}", expect.QUARANTINE) for table, attr, _ in self.SILVER},
                      published_version=manifest["version"])
        return self._with(tables)

    def materialized(self, enforce: bool = False) -> "Lakehouse":
        """Publish under the shared checkpoint folder and open the result."""
        root = scratch_path(self.spark, f"lake-{uuid.uuid4().hex}")
        self.publish(root, enforce=enforce)
        return self.opened(root)


_PUBLISHED: dict[tuple[str, str], tuple[str, Lakehouse]] = {}


def published_testdata(spark: SparkSession, sf_dir: str, anew: bool = False) -> Lakehouse:
    """The lakehouse of a folder of test tables, published once per
    application and opened for every check; its files go when the driver ends.
    It is published again when a file of the folder has changed, or ``anew``."""
    key, files = (spark.sparkContext.applicationId, sf_dir), testdata.fingerprint(spark, sf_dir)
    if anew or key not in _PUBLISHED or _PUBLISHED[key][0] != files:
        _PUBLISHED[key] = files, Lakehouse.from_testdata(spark, sf_dir).materialized()
    return _PUBLISHED[key][1]
