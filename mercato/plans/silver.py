"""Silver layer (G1-G4): clean, deduplicate, enrich and flag the sources.

Each builder is a pure function of DataFrames; the expectation rule sets
that guard each table are declared next to it (``*_RULES``) and applied by
``mercato.plans.lakehouse`` when the table is published.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato import params as P
from mercato.functions import columns as C
from mercato.operators.dedup import dedup_latest
from mercato.operators.expect import Rule
from mercato.operators.joins import by_shuffle, lookup_join

CUSTOMER_RULES, PRODUCT_RULES, SALES_RULES, COMPETITOR_RULES = (
    [Rule(*r) for r in P.SILVER_EXPECTATIONS[t]] for t in ("clientes", "produtos", "vendas", "preco_competidores"))


def states_table(spark: SparkSession, p: P.Params = P.DEFAULT_PARAMS) -> DataFrame:
    """The inline state lookup (27 rows by default)."""
    return spark.createDataFrame(p.states, "estado string, nome_estado string, regiao string")


def clean_customers(bronze: DataFrame, states: DataFrame) -> DataFrame:
    """G1: dedup -> trim -> strip title -> initcap -> state code -> lookup."""
    d = dedup_latest(bronze, ["id_cliente"], ["data_cadastro"])
    out = d.withColumns({"nome_original": F.trim("nome_cliente"),
                         "nome_cliente": C.clean_person_name(F.trim("nome_cliente")),
                         "estado": C.state_code("estado")})
    out = lookup_join(out, states, on="estado", how="left")
    return out.select("id_cliente", "nome_original", "nome_cliente", "estado", "nome_estado",
                      "regiao", "pais", "data_cadastro")


def product_catalog(bronze: DataFrame, p: P.Params = P.DEFAULT_PARAMS) -> DataFrame:
    """Dedup -> trim name -> money price -> price band."""
    d = dedup_latest(bronze, ["id_produto"], ["data_criacao"])
    return d.withColumns({"nome_produto": F.trim("nome_produto"),
                          "preco_atual": C.money("preco_atual"),
                          "faixa_preco": C.price_band(C.money("preco_atual"), p)})


SALES_COLUMNS = ["id_venda", "data_venda", "id_cliente", "id_produto", "canal_venda", "quantidade",
                 "preco_unitario", "receita", "data", "hora", "dia_semana_num", "dia_semana",
                 "produto_cadastrado", "venda_antes_do_cadastro", "venda_depois_do_cadastro"]
PRODUCT_DIMS = ["nome_produto", "categoria", "marca", "faixa_preco"]


def sales_base(bronze: DataFrame) -> DataFrame:
    """G3 without the registry: dedup -> money -> revenue -> calendar.  What
    needs no product column (time, customers, periods) reads this and joins
    nothing."""
    return with_derived(sales_rows(bronze))


def sales_rows(bronze: DataFrame) -> DataFrame:
    """The deduplicated sales with the columns that the source has, in the order
    in which shuffles compress them best: what repeats from row to row first."""
    d = dedup_latest(bronze, ["id_venda"], ["data_venda"])
    return d.select("data_venda", "quantidade", C.money("preco_unitario").alias("preco_unitario"), "canal_venda",
                    "id_produto", "id_cliente", "id_venda")


def with_derived(rows: DataFrame) -> DataFrame:
    """Revenue and calendar of each sale, from its own columns: added after joins, they are not shuffled."""
    return rows.withColumns({"receita": C.line_revenue("quantidade", "preco_unitario"), **C.calendar("data_venda")})


def sales_enriched(base: DataFrame, catalog: DataFrame, with_product: bool = False) -> DataFrame:
    """Base sales -> registry join -> flags.

    ``with_product`` keeps the catalog's descriptive columns from the same
    registry join, so a wide per-sale table does not join the catalog a
    second time (one fact-side join instead of two).  ``catalog`` should be a
    written table: AQE splits the sales of a hot product only if no aggregate
    stands between the catalog's shuffle and the join.
    """
    extra = PRODUCT_DIMS if with_product else []
    registry = catalog.select("id_produto", F.lit(True).alias("produto_cadastrado"), "data_criacao", *extra)
    t, created = F.col("data_venda"), F.col("data_criacao")
    registered = C.null_false("produto_cadastrado")
    out = (base.join(by_shuffle(registry), on="id_produto", how="left")
           .withColumns({"produto_cadastrado": registered,
                         "venda_antes_do_cadastro": C.null_false(t < created),
                         "venda_depois_do_cadastro": C.null_false(registered & (t >= created))}))
    return out.select(*[c for c in SALES_COLUMNS if c in out.columns], *extra)


def competitor_prices(bronze: DataFrame, catalog: DataFrame, p: P.Params = P.DEFAULT_PARAMS) -> DataFrame:
    """Dedup -> money -> parse time -> own price -> suspicious flag."""
    d = dedup_latest(bronze, ["id_produto", "nome_concorrente"], ["data_coleta"])
    own = catalog.select("id_produto", "preco_atual")
    out = (d.withColumns({"preco_concorrente": C.money("preco_concorrente"),
                          "data_coleta": F.to_timestamp_ntz("data_coleta")})
           .join(by_shuffle(own), on="id_produto", how="left")
           .withColumn("preco_suspeito",
                       C.is_suspicious("preco_concorrente", "preco_atual", p.suspicious_pct)))
    return out.select("id_produto", "nome_concorrente", "preco_concorrente", "data_coleta",
                      "preco_suspeito")
