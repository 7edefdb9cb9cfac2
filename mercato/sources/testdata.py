"""Adapter: the driver's TPC-H-ish test tables -> the four bronze source shapes.

Deterministic, column-wise derivations only (each output row comes from
input rows; nothing is invented), so the same mapping can be written in any
SQL engine for an independent check.  The mapping deliberately produces the
cases the pipeline has to handle:

* customers <- customer (+ nation/region as the state lookup): state code is
  typed padded and lower-case (' n7 '); 5 of 8 customers carry a courtesy
  title; customers of the BUILDING segment are typed twice, the second time
  with a later registration (deduplication case).
* products <- part: category = p_brand, brand = p_type (names contain type
  words, so some names cite another brand); creation dates spread over
  1995-2000, so some sales precede the product.
* sales <- all lineitem lines, with their order where there is one: one sale per
  (order, line number); the test data repeats some (order, line) pairs with
  different contents, which the silver layer deduplicates.  One line in 50
  sells a product id that no catalog holds ("unregistered product").  Hour of day and
  channel are derived from the keys and the order priority; unit price is
  the line's cents integer-divided by the quantity.
* competitor prices <- all lineitem lines, with their part where there is one:
  seven competitors by supplier, a price of 40-120 % of ours, collection time =
  ship date as text.
* events: used directly as a second sales stream (event type = channel).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.operators.joins import by_shuffle

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

# Declared schemas of the test tables (read without a schema-inference job).
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
              "props string",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Names, sizes and times of the files of the tables, by a listing alone."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs, out = hadoop(sf_dir).getFileSystem(spark._jsc.hadoopConfiguration()), []
    for name in TABLES:
        found = fs.globStatus(hadoop(f"{sf_dir}/{name}.parquet")) or []
        for top in found:
            for f in (fs.listStatus(top.getPath()) if top.isDirectory() else [top]):
                out.append(f"{f.getPath().getName()} {f.getLen()} {f.getModificationTime()}")
    return "\n".join(sorted(out))


def state_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation -> (estado, nome_estado, regiao); 25 rows at every scale."""
    n = read(spark, sf_dir, "nation")
    r = read(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey, "left")
            .select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("estado"),
                    F.col("n_name").alias("nome_estado"), F.col("r_name").alias("regiao")))


def bronze_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    title = (F.when(k % 8 == 0, "Sr. ").when(k % 8 == 1, "Sra. ").when(k % 8 == 2, "Srta. ")
             .when(k % 8 == 3, "Dr. ").when(k % 8 == 4, "Dra. ").otherwise(""))
    base = c.select(
        F.concat(F.lit("cus_"), k.cast("string")).alias("id_cliente"),
        F.concat(title, F.lit("cliente "), F.lower("c_mktsegment"), F.lit(" "),
                 k.cast("string")).alias("nome_cliente"),
        F.concat(F.lit(" n"), F.col("c_nationkey").cast("string"), F.lit(" ")).alias("estado"),
        F.lit("Brasil").alias("pais"),
        (F.lit("2020-01-01").cast("date") + (k % 1000).cast("int")).cast("timestamp_ntz")
        .alias("data_cadastro"),
        k.alias("_k"),
        F.col("c_mktsegment").alias("_seg"),
    )
    # customers of the BUILDING segment were typed a second time, one hour later
    again = (base.where(F.col("_seg") == "BUILDING")
             .withColumn("data_cadastro", F.col("data_cadastro") + F.make_dt_interval(F.lit(0), F.lit(1))))
    return base.unionByName(again).drop("_k", "_seg")


def bronze_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        F.concat(F.lit("prd_"), k.cast("string")).alias("id_produto"),
        F.concat(F.col("p_name"), F.when(F.col("p_size") % 3 == 0, F.lit("  "))
                 .otherwise(F.lit(""))).alias("nome_produto"),
        F.col("p_brand").alias("categoria"),
        F.col("p_type").alias("marca"),
        F.col("p_retailprice").alias("preco_atual"),
        (F.lit("1995-01-01").cast("date") + ((k * 7) % 2000).cast("int"))
        .cast("timestamp_ntz").alias("data_criacao"))


def _cents(c) -> F.Column:
    return F.round(F.col(c) * 100).cast("bigint")


def bronze_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    # what comes from one table alone is computed before the join, as whole
    # numbers where it can be: the shuffles carry that and no other columns
    qty = F.col("l_quantity").cast("bigint")
    li = read(spark, sf_dir, "lineitem").select(
        qty.alias("quantidade"), F.floor(_cents("l_extendedprice") / qty).alias("_cents"), "l_linenumber", "l_partkey", "l_orderkey")
    o = read(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "ecommerce")
        .when(F.col("o_orderpriority").isNotNull(), "loja_fisica").alias("canal_venda"), "o_orderdate", "o_custkey", "o_orderkey")
    j = li.join(by_shuffle(o), li.l_orderkey == o.o_orderkey, "left")  # a line without its order stays, as an orphan
    hour = ((F.col("l_orderkey") * 5 + F.col("l_linenumber") * 3) % 24).cast("int")
    return j.select(
        F.concat(F.lit("sal_"), F.col("l_orderkey").cast("string"), F.lit("_"),
                 F.col("l_linenumber").cast("string")).alias("id_venda"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), hour)).alias("data_venda"),
        F.concat(F.lit("cus_"), F.col("o_custkey").cast("string")).alias("id_cliente"),
        F.concat(F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 50 == 0, "prd_x").otherwise("prd_"),
                 F.col("l_partkey").cast("string")).alias("id_produto"),
        "canal_venda", "quantidade",
        (F.col("_cents").cast("double") / 100).alias("preco_unitario"),
    )


def bronze_competitor_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    pct = 40 + (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 81
    li = read(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % 7).alias("_competitor"), pct.alias("_pct"), "l_shipdate", "l_partkey")
    p = read(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    j = li.join(by_shuffle(p), li.l_partkey == p.p_partkey, "left")  # a line without its part stays, without a price
    cents = F.floor(_cents("p_retailprice") * F.col("_pct") / 100)
    return j.select(
        F.concat(F.lit("prd_"), F.col("l_partkey").cast("string")).alias("id_produto"),
        F.concat(F.lit("comp_"), F.col("_competitor").cast("string")).alias("nome_concorrente"),
        (cents.cast("double") / 100).alias("preco_concorrente"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("data_coleta"),
    )


def event_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a sales stream: event type = channel, user = customer,
    value = revenue of one unit."""
    e = read(spark, sf_dir, "events")
    return e.select(
        F.concat(F.lit("evt_"), F.col("event_id").cast("string")).alias("id_venda"),
        F.col("ts").alias("data_venda"),
        F.concat(F.lit("usr_"), F.col("user_id").cast("string")).alias("id_cliente"),
        F.col("event_type").alias("canal_venda"),
        F.lit(1).cast("bigint").alias("quantidade"),
        F.col("value").cast("decimal(10,2)").alias("receita"),
    )


class LazyTables(dict):
    """name -> DataFrame, each built on first access (a query that needs
    one source does not pay for planning the others)."""

    def __init__(self, builders: dict):
        super().__init__()
        self._builders = builders

    def __missing__(self, name):
        df = self[name] = self._builders[name]()
        return df


def bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return LazyTables({
        "clientes": lambda: bronze_customers(spark, sf_dir),
        "produtos": lambda: bronze_products(spark, sf_dir),
        "vendas": lambda: bronze_sales(spark, sf_dir),
        "preco_competidores": lambda: bronze_competitor_prices(spark, sf_dir),
    })
