"""Gold analytical tables.

Per-key tables aggregate the sales by the key *before* they join the
dimension (the dimension key is unique after deduplication, so the results are
the same as join-then-group, but one row per key crosses the join instead of
one row per sale, and a hot key is combined before it is shuffled).  The wide
per-sale table joins every sale to written dimensions.  Ranks use the distributed row number (no single-partition
window); ties are broken by the id, ascending.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato import params as P
from mercato.functions import columns as C
from mercato.operators.joins import by_shuffle
from mercato.operators.rank import add_ranks
from mercato.plans import silver
from mercato.schemas import GOLD, conform


def sales_by_time(sales: DataFrame, written: bool = False) -> DataFrame:
    """One row per day x hour x channel.  Weekday columns depend on the
    date only, so they are derived after the aggregate (3 grouping keys).

    A distinct count sends a row of every cell and customer through a shuffle.
    Of ``written`` sales, which can be scanned twice, that row holds its key
    only, and the sums of the cells are made beside it.
    """
    cell = ["data", "hora", "canal_venda"]
    sums = {"total_vendas": F.count(F.lit(1)), "itens_vendidos": F.sum("quantidade"), "receita": F.sum("receita")}
    if written:
        customers = sales.select(*cell, "id_cliente").distinct().groupBy(*cell).agg(F.count("id_cliente").alias("clientes_unicos"))
        parts = sales.groupBy(*cell).agg(*[e.alias(n) for n, e in sums.items()]).unionByName(customers, allowMissingColumns=True)
        agg = parts.groupBy(*cell).agg(*[F.sum(n).alias(n) for n in [*sums, "clientes_unicos"]])
    else:
        agg = sales.groupBy(*cell).agg(*[e.alias(n) for n, e in sums.items()], F.count_distinct("id_cliente").alias("clientes_unicos"))
    out = agg.withColumn("dia_semana_num", F.dayofweek("data")) \
             .withColumn("dia_semana", C.weekday_name(F.col("dia_semana_num")))
    return conform(out, GOLD["sales_by_time"])


def _per_product(sales: DataFrame) -> DataFrame:
    return sales.groupBy("id_produto").agg(
        F.count(F.lit(1)).alias("total_vendas"),
        F.sum("quantidade").alias("itens_vendidos"),
        F.sum("receita").alias("receita"),
        C.round_avg("receita").alias("ticket_medio"),
    )


def sales_by_product(sales: DataFrame, catalog: DataFrame, ranked: bool = True) -> DataFrame:
    """One row per product sold, unregistered ones labelled, 2 ranks.

    Sales are grouped first and join the catalog once; a product that finds
    none is unregistered.
    """
    dims = catalog.select("id_produto", "nome_produto", "categoria", "marca", "faixa_preco",
                          F.lit(True).alias("produto_cadastrado"))
    out = (_per_product(sales).join(by_shuffle(dims), on="id_produto", how="left")
           .withColumn("produto_cadastrado", C.null_false("produto_cadastrado"))
           .withColumn("nome_produto", F.coalesce("nome_produto", F.lit(P.UNREGISTERED_NAME)))
           .withColumn("categoria", F.coalesce("categoria", F.lit(P.UNREGISTERED_LABEL)))
           .withColumn("marca", F.coalesce("marca", F.lit(P.UNREGISTERED_LABEL))))
    if ranked:
        order = [("receita", False), ("id_produto", True)]
        out = add_ranks(out, [("ranking_receita", order, []),
                              ("ranking_na_categoria", order, ["categoria"])])
    else:
        out = out.withColumn("ranking_receita", F.lit(None)).withColumn("ranking_na_categoria", F.lit(None))
    return conform(out, GOLD["sales_by_product"])


def customer_revenue(customers: DataFrame, sales: DataFrame, p: P.Params = P.DEFAULT_PARAMS) -> DataFrame:
    """Per customer (including never-bought ones) totals and segment, unranked."""
    per = sales.groupBy("id_cliente").agg(
        F.count("id_venda").alias("total_compras"),
        F.sum("receita").alias("receita"),
        C.round_avg("receita").alias("ticket_medio"),
        F.min("data").alias("primeira_compra"),
        F.max("data").alias("ultima_compra"),
    )
    out = (customers.select("id_cliente", "nome_cliente", "estado", "nome_estado", "regiao")
           .join(by_shuffle(per), on="id_cliente", how="left")
           .withColumn("total_compras", F.coalesce("total_compras", F.lit(0)).cast("bigint"))
           .withColumn("receita", F.coalesce("receita", F.lit(0).cast("decimal(20,2)"))))
    return out.withColumn("segmento_cliente", C.segment("receita", p))


def customer_segments(customers: DataFrame, sales: DataFrame, p: P.Params = P.DEFAULT_PARAMS) -> DataFrame:
    """One row per customer with revenue, segment and revenue rank."""
    out = add_ranks(customer_revenue(customers, sales, p),
                    [("ranking_receita", [("receita", False), ("id_cliente", True)], [])])
    return conform(out, GOLD["customer_segments"])


#: What the wide per-sale table takes from its customers, and from the sales themselves.
SEGMENT_COLUMNS = ["id_cliente", "nome_cliente", "estado", "regiao", "segmento_cliente"]
SALE_COLUMNS = ["data_venda", "quantidade", "preco_unitario", "produto_cadastrado", "venda_antes_do_cadastro",
                "canal_venda", "id_produto", "id_cliente", "id_venda"]
# Joined rows are shuffled in this order: numbers and texts of few values first.
# They and their places in a row repeat from row to row, which is what shuffle
# compression finds.
ROW_COLUMNS = [*SALE_COLUMNS[:6], "faixa_preco", "segmento_cliente", "estado", "regiao", "categoria", "marca", "nome_produto",
               "id_produto", "id_cliente", "nome_cliente", "id_venda"]


def sales_detail(sales: DataFrame, catalog: DataFrame, customers: DataFrame,
                 p: P.Params = P.DEFAULT_PARAMS, segments: DataFrame | None = None) -> DataFrame:
    """One row per sale with product, customer, region and segment.

    Only the segment label is needed from the customer table, so the
    unranked per-customer revenue is joined (no rank computed for nothing).
    """
    seg = segments if segments is not None else customer_revenue(customers, sales, p)
    return sales_detail_columns(sales_detail_rows(sales, catalog, seg))


def sales_detail_rows(sales: DataFrame, catalog: DataFrame, segments: DataFrame) -> DataFrame:
    """The joins of the wide table, with no column that follows from others of the row: what is shuffled."""
    # customer join first: when sales and segments are bucketed by id_cliente
    # it needs no shuffle; the product join follows
    carried = [c for c in silver.PRODUCT_DIMS if c in sales.columns]
    own = sales.select(*[c for c in ROW_COLUMNS if c in SALE_COLUMNS or c in carried])
    out = own.join(by_shuffle(segments.select(*SEGMENT_COLUMNS)), on="id_cliente", how="left")
    if not carried:   # product columns not carried from the registry join
        out = out.join(by_shuffle(catalog.select("id_produto", *silver.PRODUCT_DIMS)), on="id_produto", how="left")
    return out.select(*ROW_COLUMNS)


def sales_detail_columns(rows: DataFrame) -> DataFrame:
    """Every column of the wide table, of joined rows."""
    out = silver.with_derived(rows).withColumns({
        "nome_produto": F.coalesce("nome_produto", F.lit(P.UNREGISTERED_NAME)),
        "categoria": F.coalesce("categoria", F.lit(P.UNREGISTERED_LABEL)),
        "marca": F.coalesce("marca", F.lit(P.UNREGISTERED_LABEL))})
    return conform(out, GOLD["sales_detail"])


def market(prices: DataFrame) -> DataFrame:
    """A13 first CTE: one row per product with market statistics."""
    return prices.groupBy("id_produto").agg(
        C.round_avg("preco_concorrente").alias("preco_medio_concorrentes"),
        F.min("preco_concorrente").alias("preco_minimo_concorrentes"),
        F.max("preco_concorrente").alias("preco_maximo_concorrentes"),
        F.count(F.lit(1)).alias("total_concorrentes"),
        F.bool_or("preco_suspeito").alias("possui_preco_suspeito"),
    )


def price_position(catalog: DataFrame, prices: DataFrame, sales: DataFrame) -> DataFrame:
    """Our price against the market, one row per monitored product."""
    sold = sales.groupBy("id_produto").agg(F.sum("receita").alias("receita"),
                                           F.sum("quantidade").alias("itens_vendidos"))
    own = catalog.select("id_produto", "nome_produto", "categoria", "marca",
                         F.col("preco_atual").alias("nosso_preco"))
    out = (own.join(by_shuffle(market(prices)), on="id_produto", how="inner")
           .join(by_shuffle(sold), on="id_produto", how="left")
           .withColumn("diferenca_pct_vs_media", C.pct_diff("nosso_preco", "preco_medio_concorrentes"))
           .withColumn("diferenca_pct_vs_minimo", C.pct_diff("nosso_preco", "preco_minimo_concorrentes"))
           .withColumn("classificacao_preco",
                       C.price_class("nosso_preco", "preco_medio_concorrentes",
                                     "preco_minimo_concorrentes", "preco_maximo_concorrentes"))
           .withColumn("receita", F.coalesce("receita", F.lit(0).cast("decimal(20,2)")))
           .withColumn("itens_vendidos", F.coalesce("itens_vendidos", F.lit(0).cast("bigint"))))
    return conform(out, GOLD["price_position"])
