"""Business questions over the gold tables.

Each function takes a ``Lakehouse`` and returns a DataFrame; averages of a
ratio are always ratios of sums (never a mean of means), distinct customers
are recounted from the per-sale table (never added across cells), rankings
break ties by id.  Where the published question orders its answer (O1),
the same ``orderBy`` is kept: on an aggregated answer it is a small
range-partitioned sort, never a single-partition one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato import params as P
from mercato.operators.rank import plain_row_number, top_n


def _ratio(num, den, scale: int = 2):
    """ROUND(num / den, scale); NULL (not an error) when den = 0."""
    return F.round(F.try_divide(num, den), scale)


def ticket_by_segment(lh) -> DataFrame:
    """K1: customers, sales, revenue and ticket per segment."""
    return lh.customer_revenue.groupBy("segmento_cliente").agg(
        F.count(F.lit(1)).alias("clientes"),
        F.sum("total_compras").alias("vendas"),
        F.sum("receita").cast("decimal(20,2)").alias("receita"),
        _ratio(F.sum("receita"), F.sum("total_compras")).cast("decimal(20,2)").alias("ticket_medio")) \
        .orderBy(F.col("receita").desc(), "segmento_cliente")


def tier_share(lh, tier: str = P.SEG_TOP) -> DataFrame:
    """A segment's customers, revenue and % of all revenue (1 decimal),
    in one pass with filtered aggregates."""
    in_tier = F.col("segmento_cliente") == tier
    tier_rev = F.sum(F.when(in_tier, F.col("receita")))
    return lh.customer_revenue.agg(
        F.lit(tier).alias("segmento_cliente"),
        F.count_if(in_tier).alias("clientes"),
        tier_rev.cast("decimal(20,2)").alias("receita"),
        _ratio(tier_rev * 100, F.sum("receita"), 1).cast("decimal(10,1)").alias("pct_receita"))


def revenue_region_category(lh) -> DataFrame:
    """K3: revenue by customer region x product category (per-sale table)."""
    return lh.sales_detail.groupBy("regiao", "categoria").agg(
        F.sum("receita").cast("decimal(20,2)").alias("receita")) \
        .orderBy("regiao", F.col("receita").desc(), "categoria")


def above_market_by_status(lh) -> DataFrame:
    """K4: products above the market mean, confirmed vs to be confirmed."""
    status = F.when(F.col("possui_preco_suspeito"), P.STATUS_TO_CONFIRM).otherwise(P.STATUS_CONFIRMED)
    return (lh.price_position.where(F.col("diferenca_pct_vs_media") > 0)
            .groupBy(status.alias("situacao")).agg(F.count(F.lit(1)).alias("produtos"))
            .orderBy("situacao"))


def avg_ticket(lh) -> DataFrame:
    """K5: ticket = SUM(revenue) / SUM(sales) per channel, from the time table."""
    return lh.sales_by_time.groupBy("canal_venda").agg(
        F.sum("receita").cast("decimal(20,2)").alias("receita"),
        F.sum("total_vendas").alias("total_vendas"),
        _ratio(F.sum("receita"), F.sum("total_vendas")).cast("decimal(20,2)").alias("ticket_medio"))


def weekday_avg_per_day(lh) -> DataFrame:
    """K6: mean revenue per occurring day, per weekday (not the total), best first."""
    return lh.sales_by_time.groupBy("dia_semana_num", "dia_semana").agg(
        F.sum("receita").cast("decimal(20,2)").alias("receita"),
        F.count_distinct("data").alias("dias"),
        _ratio(F.sum("receita"), F.count_distinct("data")).cast("decimal(20,2)").alias("receita_media_dia")) \
        .orderBy(F.col("receita_media_dia").desc_nulls_last(), "dia_semana_num")


def buyers_in_period(lh) -> DataFrame:
    """K7: distinct buyers per year, recounted from the silver sales (no join)."""
    return lh.sales_base.groupBy(F.year("data").alias("ano")).agg(
        F.count_distinct("id_cliente").alias("compradores"),
        F.count(F.lit(1)).alias("vendas"))


def segment_by_channel(lh, segment: str = P.SEG_VIP) -> DataFrame:
    """Cross-domain example: what a segment's customers buy per channel
    (sales, revenue, distinct buyers), from the per-sale table."""
    return (lh.sales_detail.where(F.col("segmento_cliente") == segment)
            .groupBy("canal_venda").agg(
                F.lit(segment).alias("segmento_cliente"),
                F.count(F.lit(1)).alias("vendas"),
                F.sum("receita").cast("decimal(20,2)").alias("receita"),
                F.count_distinct("id_cliente").alias("compradores")))


def channel_ranking(lh) -> DataFrame:
    """K8: channels by revenue, with sales and ticket."""
    agg = lh.sales_by_time.groupBy("canal_venda").agg(
        F.sum("receita").cast("decimal(20,2)").alias("receita"),
        F.sum("total_vendas").alias("total_vendas"))
    # one row per channel: the plain window numbers a handful of rows
    return plain_row_number(agg, [("receita", False), ("canal_venda", True)], name="posicao")


def category_vs_market(lh) -> DataFrame:
    """K9: per category, mean % difference to the market mean and counts."""
    return lh.price_position.groupBy("categoria").agg(
        F.count(F.lit(1)).alias("produtos"),
        F.round(F.avg("diferenca_pct_vs_media"), 2).cast("decimal(19,2)").alias("diferenca_media_pct"),
        F.count_if(F.col("diferenca_pct_vs_media") > 0).alias("acima_da_media"))


def period_totals(lh) -> DataFrame:
    """Revenue, sales, units and distinct buyers of the whole period,
    overall and per channel (buyers recounted, not added).

    One pass over the silver sales to a row per channel and buyer; the rollup
    adds those up for each channel and for all.
    """
    buyers = lh.sales_base.groupBy("canal_venda", "id_cliente").agg(
        F.sum("receita").alias("r"), F.count(F.lit(1)).alias("n"), F.sum("quantidade").alias("q"))
    label = F.when(F.grouping("canal_venda") == 1, "todos").otherwise(F.col("canal_venda"))
    return buyers.rollup("canal_venda").agg(
        label.alias("canal"), F.sum("r").cast("decimal(20,2)").alias("receita"), F.sum("n").alias("total_vendas"),
        F.sum("q").alias("itens_vendidos"), F.count_distinct("id_cliente").alias("compradores")) \
        .select(F.col("canal").alias("canal_venda"), "receita", "total_vendas", "itens_vendidos", "compradores")


def dearer_than_all(lh) -> DataFrame:
    """Products priced above every competitor."""
    return (lh.price_position.where(F.col("classificacao_preco") == P.CLASS_ABOVE_ALL)
            .select("id_produto", "nome_produto", "categoria", "nosso_preco",
                    "preco_maximo_concorrentes", "possui_preco_suspeito"))


def suspicious_by_category(lh) -> DataFrame:
    """Monitored products with a suspicious price, per category and total."""
    pp = lh.price_position
    s = F.col("possui_preco_suspeito")
    per = pp.groupBy("categoria").agg(F.count(F.lit(1)).alias("produtos"),
                                      F.count_if(s).alias("suspeitos"))
    total = pp.agg(F.lit("TOTAL").alias("categoria"), F.count(F.lit(1)).alias("produtos"),
                   F.count_if(s).alias("suspeitos"))
    return per.unionByName(total)


def top10_customers(lh, n: int = 10) -> DataFrame:
    """The n customers with the highest revenue (ties by id)."""
    return top_n(lh.customer_revenue.select("id_cliente", "nome_cliente", "segmento_cliente", "receita"),
                 [("receita", False), ("id_cliente", True)], n)


def top10_products(lh, n: int = 10) -> DataFrame:
    """The n products with the highest revenue (ties by id)."""
    return top_n(lh.product_revenue.select("id_produto", "nome_produto", "categoria", "receita"),
                 [("receita", False), ("id_produto", True)], n)


def _window(df: DataFrame, start=None, end=None, channel=None) -> DataFrame:
    """Dashboard filters: period [start, end] on ``data`` and one channel
    (pushed down to the scan when the table is stored)."""
    if start is not None:
        df = df.where(F.col("data") >= F.lit(start))
    if end is not None:
        df = df.where(F.col("data") <= F.lit(end))
    if channel is not None:
        df = df.where(F.col("canal_venda") == channel)
    return df


def daily_revenue(lh, start=None, end=None, channel=None) -> DataFrame:
    """Revenue and sales per day and channel (optional period/channel)."""
    return _window(lh.sales_by_time, start, end, channel).groupBy("data", "canal_venda").agg(
        F.sum("receita").cast("decimal(20,2)").alias("receita"),
        F.sum("total_vendas").alias("total_vendas"))


def hourly_revenue(lh, start=None, end=None, channel=None) -> DataFrame:
    """Revenue and sales per hour of day and channel (optional filters)."""
    return _window(lh.sales_by_time, start, end, channel).groupBy("hora", "canal_venda").agg(
        F.sum("receita").cast("decimal(20,2)").alias("receita"),
        F.sum("total_vendas").alias("total_vendas"))


def segment_distribution(lh) -> DataFrame:
    """Customers and revenue per segment."""
    return lh.customer_revenue.groupBy("segmento_cliente").agg(
        F.count(F.lit(1)).alias("clientes"), F.sum("receita").cast("decimal(20,2)").alias("receita"))


def revenue_by_region(lh) -> DataFrame:
    """Customers and revenue per region."""
    return lh.customer_revenue.groupBy("regiao").agg(
        F.count(F.lit(1)).alias("clientes"), F.sum("receita").cast("decimal(20,2)").alias("receita"))


def price_class_distribution(lh) -> DataFrame:
    """Monitored products per price class, with suspicious ones."""
    return lh.price_position.groupBy("classificacao_preco").agg(
        F.count(F.lit(1)).alias("produtos"), F.count_if("possui_preco_suspeito").alias("suspeitos"))


def pricing_kpis(lh) -> DataFrame:
    """Monitored products, mean % difference to the market, and alerts:
    products dearer than every competitor, and with a suspicious price."""
    return lh.price_position.agg(
        F.count(F.lit(1)).alias("monitorados"),
        F.round(F.avg("diferenca_pct_vs_media"), 2).cast("decimal(19,2)").alias("diferenca_media_pct"),
        F.count_if(F.col("classificacao_preco") == P.CLASS_ABOVE_ALL).alias("mais_caros_que_todos"),
        F.count_if("possui_preco_suspeito").alias("com_preco_suspeito"))
