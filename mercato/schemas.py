"""Declared table schemas (bronze sources, gold contracts) and ``conform``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, TS, D, L, I, B, DBL = (T.StringType(), T.TimestampNTZType(), T.DateType(), T.LongType(),
                          T.IntegerType(), T.BooleanType(), T.DoubleType())


def M(p: int, s: int = 2) -> T.DecimalType:
    return T.DecimalType(p, s)


def schema(*cols) -> T.StructType:
    """cols: (name, type, comment)."""
    return T.StructType([T.StructField(n, t, True, {"comment": c}) for n, t, c in cols])


# --- bronze -----------------------------------------------------------------
BRONZE = {
    "clientes": schema(
        ("id_cliente", S, "customer id"), ("nome_cliente", S, "name as typed, may carry a title"),
        ("estado", S, "state code as typed"), ("pais", S, "country"),
        ("data_cadastro", TS, "registration time")),
    "produtos": schema(
        ("id_produto", S, "product id"), ("nome_produto", S, "product name"),
        ("categoria", S, "category"), ("marca", S, "brand"),
        ("preco_atual", DBL, "current price"), ("data_criacao", TS, "creation time")),
    "vendas": schema(
        ("id_venda", S, "sale id"), ("data_venda", TS, "sale time"),
        ("id_cliente", S, "customer id"), ("id_produto", S, "product id"),
        ("canal_venda", S, "ecommerce or loja_fisica"), ("quantidade", L, "units"),
        ("preco_unitario", DBL, "unit price")),
    "preco_competidores": schema(
        ("id_produto", S, "product id"), ("nome_concorrente", S, "competitor"),
        ("preco_concorrente", DBL, "competitor price"), ("data_coleta", S, "collection time as text")),
}

# --- gold contracts ---------------------------------------------------------
GOLD = {
    "sales_by_time": schema(
        ("data", D, "sale date"), ("dia_semana", S, "weekday label"),
        ("dia_semana_num", I, "1 = Sunday ... 7 = Saturday"), ("hora", I, "hour 0-23"),
        ("canal_venda", S, "channel"), ("total_vendas", L, "sales"),
        ("itens_vendidos", L, "units"), ("receita", M(20), "revenue"),
        ("clientes_unicos", L, "distinct customers in the cell; never add across rows")),
    "sales_by_product": schema(
        ("id_produto", S, "product id"), ("nome_produto", S, "name or unregistered label"),
        ("categoria", S, "category"), ("marca", S, "brand"), ("faixa_preco", S, "price band"),
        ("produto_cadastrado", B, "product is in the catalog"), ("total_vendas", L, "sales"),
        ("itens_vendidos", L, "units"), ("receita", M(20), "revenue"),
        ("ticket_medio", M(11), "mean revenue per sale"),
        ("ranking_receita", I, "1 = highest revenue"),
        ("ranking_na_categoria", I, "1 = highest revenue in the category")),
    "customer_segments": schema(
        ("id_cliente", S, "customer id"), ("nome_cliente", S, "clean name"),
        ("estado", S, "state code"), ("nome_estado", S, "state name"), ("regiao", S, "region"),
        ("total_compras", L, "sales"), ("receita", M(20), "revenue, 0 if none"),
        ("ticket_medio", M(11), "mean revenue per sale"),
        ("primeira_compra", D, "first sale date"), ("ultima_compra", D, "last sale date"),
        ("segmento_cliente", S, "VIP / TOP_TIER / REGULAR"),
        ("ranking_receita", I, "1 = highest revenue")),
    "sales_detail": schema(
        ("id_venda", S, "sale id"), ("data_venda", TS, "sale time"), ("data", D, "sale date"),
        ("dia_semana", S, "weekday label"), ("dia_semana_num", I, "weekday number"),
        ("hora", I, "hour"), ("canal_venda", S, "channel"), ("id_produto", S, "product id"),
        ("nome_produto", S, "product name"), ("categoria", S, "category"), ("marca", S, "brand"),
        ("faixa_preco", S, "price band"), ("produto_cadastrado", B, "in catalog"),
        ("id_cliente", S, "customer id"), ("nome_cliente", S, "customer name"),
        ("estado", S, "state code"), ("regiao", S, "region"), ("segmento_cliente", S, "segment"),
        ("quantidade", L, "units"), ("preco_unitario", M(10), "unit price"),
        ("receita", M(10), "revenue"), ("venda_antes_do_cadastro", B, "sold before creation")),
    "price_position": schema(
        ("id_produto", S, "product id"), ("nome_produto", S, "name"), ("categoria", S, "category"),
        ("marca", S, "brand"), ("nosso_preco", M(10), "our price"),
        ("preco_medio_concorrentes", M(11), "rounded market mean"),
        ("preco_minimo_concorrentes", M(10), "market minimum"),
        ("preco_maximo_concorrentes", M(10), "market maximum"),
        ("total_concorrentes", L, "competitor prices"),
        ("diferenca_pct_vs_media", M(19), "% vs rounded mean"),
        ("diferenca_pct_vs_minimo", M(18), "% vs minimum"),
        ("classificacao_preco", S, "price class"),
        ("possui_preco_suspeito", B, "some competitor below the suspicion threshold"),
        ("receita", M(20), "revenue, 0 if never sold"), ("itens_vendidos", L, "units, 0 if never sold")),
    "quality_scorecard": schema(
        ("regra", S, "rule"), ("tabela", S, "silver table"), ("severidade", S, "severity"),
        ("linhas_afetadas", L, "rows hit"), ("receita_afetada", M(20), "revenue hit; NULL if n/a")),
}

GOLD_KEYS = {
    "sales_by_product": ["id_produto"],
    "customer_segments": ["id_cliente"],
    "sales_detail": ["id_venda"],
    "price_position": ["id_produto"],
    "sales_by_time": ["data", "hora", "canal_venda"],
}


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Project to the contract's columns, in order, cast to the declared
    types and tagged with the column comments (S10)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata)
                       for f in contract.fields])
