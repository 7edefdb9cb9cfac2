"""Registered queries: name -> f(spark, sf_dir) -> DataFrame.

Every query runs over the whole test tables (through the adapter in
``mercato.sources.testdata``) and returns a DataFrame.  Written dimensions,
rank buckets and published tables are jobs that run while it is built.
Column names equal the oracle's (``oracle.queries``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato import params as P
from mercato.operators.dedup import dedup_latest
from mercato.operators.joins import by_shuffle, group_count_over
from mercato.operators.rank import add_ranks
from mercato.plans import scorecard
from mercato.plans.lakehouse import Lakehouse, published_testdata
from mercato.sources import testdata

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def lake(spark: SparkSession, sf_dir: str) -> Lakehouse:
    return Lakehouse.from_testdata(spark, sf_dir)


# --- sources / silver --------------------------------------------------------

@query
def bronze_typed_ingest(spark, sf_dir):
    """The sales source as header CSV text (written once under the
    shared checkpoint folder), read back with inference off, projected by
    declared name and cast to the declared types."""
    import uuid

    from mercato.schemas import BRONZE
    from mercato.session import scratch_path
    from mercato.sources import ingest
    path = scratch_path(spark, f"csv-vendas-{uuid.uuid4().hex}")
    ingest.export_csv(testdata.bronze_sales(spark, sf_dir), path)
    schema = BRONZE["vendas"]
    text = ingest.read_csv_text(spark, path, [f.name for f in schema.fields])
    return ingest.typed(text, schema, strict=True)[0]


@query
def declared_table_load(spark, sf_dir):
    """All four sources as CSV, loaded into declared, commented tables
    of a namespace; the rows that each load counted."""
    import uuid

    from mercato.schemas import BRONZE
    from mercato.session import scratch_path
    from mercato.sources import ingest
    run = uuid.uuid4().hex
    data = scratch_path(spark, f"csv-{run}")
    bronze = testdata.bronze(spark, sf_dir)
    for t in BRONZE:
        ingest.export_csv(bronze[t], f"{data}/{t}.csv")
    counts = ingest.ingest_csv(spark, data, database=f"mercato_load_{run}")
    spark.sql(f"DROP DATABASE mercato_load_{run} CASCADE")
    return spark.createDataFrame(sorted(counts.items()), "tabela string, linhas bigint")


@query
def csv_malformed_lines(spark, sf_dir):
    """The sales source as CSV text in which some lines lack a field,
    some have one more and some hold a word for a number, read leniently: every
    sale with what was wrong with its line, from the loaded rows and the rejects."""
    import uuid

    from mercato.schemas import BRONZE
    from mercato.session import scratch_path
    from mercato.sources import ingest
    schema = BRONZE["vendas"]
    names = [f.name for f in schema.fields]
    order = F.split("id_venda", "_")[1].cast("bigint")
    text = {n: F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names}
    text["quantidade"] = F.when(order % 83 == 2, "many").otherwise(text["quantidade"])
    whole = F.concat_ws(",", *text.values())
    line = (F.when(order % 97 == 0, F.concat_ws(",", *list(text.values())[:-1]))
            .when(order % 89 == 1, F.concat(whole, F.lit(",more"))).otherwise(whole))
    path = scratch_path(spark, f"csv-ragged-{uuid.uuid4().hex}")
    # one column whose name is the header line: each file gets the header and the lines as they are
    (testdata.bronze_sales(spark, sf_dir).select(line.alias(",".join(names)))
     .write.mode("overwrite").option("header", "true").option("sep", "\u0001").csv(path))
    good, rejects = ingest.typed(ingest.read_csv_text(spark, path, names, strict=False), schema, strict=False)
    broken = F.col("rejected_line").isNotNull()
    return good.select("id_venda", F.lit("nenhum").alias("problema")).unionByName(rejects.select(
        F.when(broken, F.split("rejected_line", ",")[0]).otherwise(F.col("id_venda")).alias("id_venda"),
        F.when(broken, F.when(F.size(F.split("rejected_line", ",")) > len(names), "campos a mais").otherwise("campos a menos"))
        .otherwise(F.concat_ws(" ", "rejected_columns")).alias("problema")))


@query
def snapshot_history(spark, sf_dir):
    """The lake published twice by one object; rows of every table in
    each version, read from that version while both are kept."""
    import uuid

    from mercato.session import scratch_path
    lh, root = lake(spark, sf_dir), scratch_path(spark, f"lake-{uuid.uuid4().hex}")
    for _ in range(2):
        lh.publish(root, enforce=False, keep=2)
    parts = []
    for version in (1, 2):
        opened = lh.opened(root, version=version)
        parts += [getattr(opened, attr).agg(F.lit(version).alias("versao"), F.lit(f"{layer}.{name}").alias("tabela"), F.count(F.lit(1)).alias("linhas"))
                  for layer, name, attr in [*(("silver", t, a) for t, a, _ in lh.SILVER), *(("gold", g, g) for g in lh.GOLD)]]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query
def routed_rows(spark, sf_dir):
    """Silver tables routed by their rules in one write each; rows, and
    rows that break each rule, among the good ones and among those set aside."""
    from mercato.operators import expect
    from mercato.operators.materialize import materialize
    lh, out = lake(spark, sf_dir), None
    for table, attr, rules in lh.SILVER:
        df, _ = expect.routed(getattr(lh, attr), rules, f"routed_{table}", set_aside=True)
        back = materialize(df.select(expect.MASK, expect.ROUTE), f"routed-{table}", partition_by=[expect.ROUTE])
        figures = [("linhas", F.count(F.lit(1))), *((r.name, F.count_if(expect.breaks(rules, [r]))) for r in rules)]
        one = back.groupBy(expect.ROUTE).agg(*[c.alias(f"n{i}") for i, (_, c) in enumerate(figures)]).select(
            F.lit(f"silver.{table}").alias("tabela"), expect.ROUTE,
            F.stack(F.lit(len(figures)), *[x for i, (n, _) in enumerate(figures) for x in (F.lit(n), F.col(f"n{i}"))]).alias("regra", "linhas"))
        out = one if out is None else out.unionByName(one)
    return out


@query
def enforced_relationships(spark, sf_dir):
    """Every sale joined to its customer and its product by declared
    many-to-one joins, which fail on a repeated key; sales and revenue by region and category."""
    from mercato.operators.joins import declared_join
    lh = lake(spark, sf_dir)
    s = lh.sales_base.select("id_cliente", "id_produto", "receita")
    s = declared_join(s, by_shuffle(lh.customers.select("id_cliente", "regiao")), "id_cliente", "vendas -> clientes")
    s = declared_join(s, by_shuffle(lh.catalog.select("id_produto", "categoria")), "id_produto", "vendas -> produtos")
    return s.groupBy("regiao", "categoria").agg(F.count(F.lit(1)).alias("vendas"), F.sum("receita").cast("decimal(20,2)").alias("receita"))


@query
def distinct_rollups(spark, sf_dir):
    """Distinct customers by day, week and channel, estimated from the
    sketches of the day x hour x channel cells alone, beside the exact count."""
    from mercato.operators import sketches
    from mercato.operators.materialize import materialize
    sales = lake(spark, sf_dir).sales_base.select("data", "hora", "canal_venda", "id_cliente")
    cells = materialize(sketches.sketch_cells(sales, ["data", "hora", "canal_venda"], "id_cliente"), "distinct-cells")
    levels = {"dia": F.col("data").cast("string"), "semana": F.date_trunc("week", "data").cast("date").cast("string"), "canal": F.col("canal_venda")}
    keyed = lambda df: df.withColumn("k", F.explode(F.array(*[F.struct(F.lit(n).alias("nivel"), c.alias("chave")) for n, c in levels.items()])))
    rolled = sketches.merge_cells(keyed(cells).select("k.*", "sketch"), ["nivel", "chave"]).select(
        "nivel", "chave", sketches.estimate().alias("estimados"))
    exact = keyed(sales).groupBy("k").agg(F.count_distinct("id_cliente").alias("clientes")).select("k.*", "clientes")
    both = exact.join(rolled, exact["nivel"].eqNullSafe(rolled["nivel"]) & exact["chave"].eqNullSafe(rolled["chave"]), "left")
    return both.select(exact["nivel"], exact["chave"], "clientes",
                       F.coalesce(F.abs(F.col("estimados") - F.col("clientes")) <= 0.05 * F.col("clientes"), F.lit(False)).alias("perto"))


@query
def reconcile_days(spark, sf_dir):
    """Q9: silver sales against a copy of them in which some sales are missing,
    some have another quantity and some stand twice: the days and sales that
    differ, found by fingerprints of days and then of the sales of those days."""
    from mercato.operators import fingerprint
    from mercato.operators.materialize import materialize
    columns = ["id_venda", "data_venda", "id_cliente", "id_produto", "canal_venda", "quantidade", "receita"]
    # both sides are read twice: deduplicated once, and written
    sales = materialize(lake(spark, sf_dir).sales_base.select("data", *columns), "reconciled-sales")
    order = F.split("id_venda", "_")[1].cast("bigint")
    copy = (sales.where(order % 1009 != 0)
            .withColumn("quantidade", F.col("quantidade") + F.when(order % 1013 == 1, 1).otherwise(0))
            .withColumn("_", F.explode(F.array_repeat(F.lit(0), F.when(order % 1019 == 2, 2).otherwise(1)))).drop("_"))
    return fingerprint.differing_keys(sales, copy, ["data"], ["id_venda"], columns)


@query
def given_figures(spark, sf_dir):
    """Q1/Q2: headline figures of gold against given values, exactly; the given
    ones are counted in the source tables, one of them is made wrong."""
    from mercato.plans import quality
    from mercato.session import shuffles_removed
    with shuffles_removed(spark):
        ids = testdata.bronze_sales(spark, sf_dir).agg(F.count_distinct("id_venda")).first()[0]
        customers = testdata.read(spark, sf_dir, "customer").agg(F.count_distinct("c_custkey")).first()[0]
    return quality.expected_values(published_testdata(spark, sf_dir), {"total_vendas": ids, "total_clientes": customers + 1})


@query
def dq_by_load(spark, sf_dir):
    """Q3/Q4/Q10-Q12/Q14 merged: the wide table's metrics after each of three
    loads (the sales before 1996, the others, the year 1996 written anew with
    the same rows), and the rows that each run of the checks had to read."""
    import uuid

    from mercato.plans import quality
    from mercato.session import scratch_path
    run = uuid.uuid4().hex
    folder = scratch_path(spark, f"detail-{run}")
    lh = published_testdata(spark, sf_dir)
    year = F.year("data")
    detail = lh.sales_detail.withColumn("ano", year)
    state = quality.check_state(lh, "sales_detail", folder, scratch_path(spark, f"check-state-{run}"), detail.schema)
    before = F.coalesce(year < 1996, F.lit(False))
    results = []
    for load, (rows, mode) in enumerate([(before, "append"), (~before, "append"), (year == 1996, "overwrite")], 1):
        # the published table is clustered by date: a file of it has few years, so they are written apart without a shuffle
        (detail.where(rows).write.mode(mode).option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
         .partitionBy("ano").parquet(folder))
        number = state.refresh()
        read = state.merged(since=number).where("metric = 'rows'").first()["value"]
        results.append(state.merged().select(F.lit(load).alias("carga"), "metric", "value", F.lit(read).cast("bigint").alias("linhas_lidas")).collect())
    return spark.createDataFrame([r for rows in results for r in rows], "carga int, metric string, value decimal(38,2), linhas_lidas bigint")


@query
def published_tables(spark, sf_dir):
    """Rows of every silver and gold table, counted in the published files."""
    lh = published_testdata(spark, sf_dir)
    parts = [getattr(lh, attr).agg(F.lit(f"{layer}.{name}").alias("tabela"), F.count(F.lit(1)).alias("linhas"))
             for layer, name, attr in [*(("silver", t, a) for t, a, _ in lh.SILVER), *(("gold", g, g) for g in lh.GOLD)]]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query
def inline_states(spark, sf_dir):
    """Customers per state of the inline lookup; customer n lives in
    state n modulo the number of states, as the test tables have other states."""
    from mercato.plans import silver
    codes = F.array(*[F.lit(s[0]) for s in P.BRAZIL_STATES])
    c = testdata.read(spark, sf_dir, "customer").select(
        F.get(codes, F.pmod("c_custkey", F.lit(len(P.BRAZIL_STATES))).cast("int")).alias("estado"))
    return (c.join(silver.states_table(spark), "estado", "left")
            .groupBy("estado", "nome_estado", "regiao").agg(F.count(F.lit(1)).alias("clientes")))


@query
def dedup_sales(spark, sf_dir):
    """One bronze sale per id; survivor = latest time, then largest values."""
    return dedup_latest(testdata.bronze_sales(spark, sf_dir), ["id_venda"], ["data_venda"])


@query
def clean_customers(spark, sf_dir):
    return lake(spark, sf_dir).customers


@query
def product_catalog(spark, sf_dir):
    return lake(spark, sf_dir).catalog


@query
def price_band_case(spark, sf_dir):
    """Products per price band with the band's price range."""
    return lake(spark, sf_dir).catalog.groupBy("faixa_preco").agg(
        F.count(F.lit(1)).alias("produtos"), F.min("preco_atual").alias("preco_min"),
        F.max("preco_atual").alias("preco_max"))


@query
def sales_enriched(spark, sf_dir):
    return lake(spark, sf_dir).sales


@query
def weekday_map(spark, sf_dir):
    """Weekday number -> label, with the sales of each weekday."""
    return lake(spark, sf_dir).sales_base.groupBy("dia_semana_num", "dia_semana").agg(
        F.count(F.lit(1)).alias("total_vendas"))


@query
def unregistered_sales(spark, sf_dir):
    """Sales of products missing from the catalog."""
    return (lake(spark, sf_dir).sales.where(~F.col("produto_cadastrado"))
            .select("id_venda", "id_produto", "quantidade", "receita"))


@query
def early_sales(spark, sf_dir):
    """P10: sales made before the product's creation time."""
    return (lake(spark, sf_dir).sales.where(F.col("venda_antes_do_cadastro"))
            .select("id_venda", "id_produto", "data_venda", "receita"))


@query
def competitor_prices(spark, sf_dir):
    return lake(spark, sf_dir).prices


# --- gold ---------------------------------------------------------------------

@query
def sales_by_time(spark, sf_dir):
    return lake(spark, sf_dir).sales_by_time


@query
def sales_by_time_events(spark, sf_dir):
    """G5 over the events table (event type as channel, value as revenue)."""
    from mercato.plans import marts
    ev = testdata.event_sales(spark, sf_dir).withColumn("data", F.to_date("data_venda")) \
        .withColumn("hora", F.hour("data_venda"))
    return marts.sales_by_time(ev)


@query
def sales_by_time_stream(spark, sf_dir):
    """G5 maintained by Structured Streaming over the events files (the whole
    table, distinct customers included; checkpoint and versions under the
    shared checkpoint folder)."""
    import os
    import uuid

    from mercato.session import scratch_path
    from mercato.streaming import sales_by_time as S
    schema = spark.read.parquet(os.path.join(sf_dir, "events.parquet")).schema
    run_id = uuid.uuid4().hex

    def to_sales(ev):
        return ev.select(F.col("ts").alias("data_venda"), F.col("event_type").alias("canal_venda"),
                         F.concat(F.lit("usr_"), F.col("user_id").cast("string")).alias("id_cliente"),
                         F.lit(1).cast("bigint").alias("quantidade"),
                         F.col("value").cast("decimal(10,2)").alias("receita"))
    return S.run(spark, sf_dir, schema, to_sales, scratch_path(spark, f"stream-ckpt-{run_id}"),
                 scratch_path(spark, f"stream-table-{run_id}"), glob="events.parquet")


@query
def sales_by_product(spark, sf_dir):
    return lake(spark, sf_dir).sales_by_product


@query
def rank_global(spark, sf_dir):
    """Every sale numbered by revenue (desc, id asc) without a
    single-partition window (range buckets of 20k rows)."""
    sales = lake(spark, sf_dir).sales_base.select("id_venda", "receita")
    return add_ranks(sales, [("posicao", [("receita", False), ("id_venda", True)], [])],
                     rows_per_bucket=20_000)


@query
def rank_in_category(spark, sf_dir):
    """Products numbered by revenue inside their category."""
    prod = lake(spark, sf_dir).product_revenue.select("id_produto", "categoria", "receita")
    return add_ranks(prod, [("posicao", [("receita", False), ("id_produto", True)], ["categoria"])],
                     rows_per_bucket=500)


@query
def customer_segments(spark, sf_dir):
    return lake(spark, sf_dir).customer_segments


@query
def sales_detail(spark, sf_dir):
    return lake(spark, sf_dir).sales_detail


@query
def price_position(spark, sf_dir):
    return lake(spark, sf_dir).price_position


# --- scorecard pieces -----------------------------------------------------------

@query
def brand_mismatch_exists(spark, sf_dir):
    """Products whose name cites another brand."""
    return scorecard.brand_mismatch(lake(spark, sf_dir).catalog).select(
        "id_produto", "nome_produto", "marca")


@query
def same_name_window(spark, sf_dir):
    """Per product, how many products share its name."""
    cat = lake(spark, sf_dir).catalog.select("id_produto", "nome_produto")
    return group_count_over(cat, ["nome_produto"], "mesmo_nome")


@query
def thin_competition_having(spark, sf_dir):
    """Products with fewer competitor prices than expected."""
    return scorecard.thin_competition(lake(spark, sf_dir).prices, P.TESTDATA_PARAMS.expected_competitors) \
        .withColumnRenamed("n", "total_concorrentes")


@query
def quality_scorecard(spark, sf_dir):
    return lake(spark, sf_dir).quality_scorecard


@query
def quality_scorecard_union(spark, sf_dir):
    """The seven single-rule aggregates stacked with UNION ALL."""
    return scorecard.union_form(lake(spark, sf_dir))


@query
def orphan_anti_join(spark, sf_dir):
    """Sales whose customer or product is missing from its registry."""
    lh = lake(spark, sf_dir)
    s = lh.sales_base.select("id_venda", "id_cliente", "id_produto")
    no_customer = s.join(by_shuffle(lh.customers_written.select("id_cliente")), "id_cliente", "left_anti") \
        .select("id_venda", F.lit("cliente").alias("registro"), F.col("id_cliente").alias("chave"))
    no_product = s.join(by_shuffle(lh.catalog_written.select("id_produto")), "id_produto", "left_anti") \
        .select("id_venda", F.lit("produto").alias("registro"), F.col("id_produto").alias("chave"))
    return no_customer.unionByName(no_product)


# --- data-quality checks (results as DataFrames) ---------------------------------

def _register_quality():
    """Checks run over the published tables, as a quality suite does: the
    pipeline is written once per application and every check family scans
    those files."""
    from mercato.plans import quality

    def make(fn):
        return lambda spark, sf_dir: fn(published_testdata(spark, sf_dir))
    for name, fn in quality.FAMILIES.items():
        q = make(fn)
        q.__name__, q.__doc__ = name, fn.__doc__
        QUERIES[name] = q
    QUERIES["dq_report"] = make(quality.report)
    QUERIES["dq_report"].__doc__ = quality.report.__doc__


_register_quality()


# --- business questions ------------------------------------------------------------

def _register_questions():
    from mercato.plans import questions as K
    names = ["ticket_by_segment", "tier_share", "revenue_region_category", "above_market_by_status",
             "avg_ticket", "weekday_avg_per_day", "buyers_in_period", "channel_ranking",
             "category_vs_market", "period_totals", "dearer_than_all", "suspicious_by_category",
             "top10_customers", "top10_products", "daily_revenue", "hourly_revenue",
             "segment_distribution", "revenue_by_region", "price_class_distribution", "pricing_kpis"]

    def make(fn):
        return lambda spark, sf_dir: fn(lake(spark, sf_dir))
    for name in names:
        fn = getattr(K, name)
        q = make(fn)
        q.__name__, q.__doc__ = name, fn.__doc__
        QUERIES[name] = q

    def daily_revenue_filtered(spark, sf_dir):
        """K15 with the dashboard's filters: one year of one channel, per day."""
        return K.daily_revenue(lake(spark, sf_dir), "1996-01-01", "1996-12-31", "ecommerce")
    QUERIES["daily_revenue_filtered"] = daily_revenue_filtered

    def vip_share(spark, sf_dir):
        """VIP customers and their share of revenue."""
        return K.tier_share(lake(spark, sf_dir), P.SEG_VIP)
    QUERIES["vip_share"] = vip_share

    def vip_by_channel(spark, sf_dir):
        """VIP customers' sales, revenue and buyers per channel (per-sale table)."""
        return K.segment_by_channel(lake(spark, sf_dir), P.SEG_VIP)
    QUERIES["vip_by_channel"] = vip_by_channel


_register_questions()
