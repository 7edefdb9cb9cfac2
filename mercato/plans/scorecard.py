"""Quality scorecard (G10): seven rules, one row each.

``rule_*`` functions are the single rules (each a one-row global
aggregate); ``union_form`` stacks them as the published table does (U1,
seven scans).  ``fused`` computes the same rows with one aggregate per
source table (sales once, competitor prices once, products once, customers
once) and unpivots with ``stack`` - no cross join, no single-row broadcast
tricks.  A rule with no matching row yields count 0 and a NULL revenue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato import params as P
from mercato.operators.joins import contains_other_value

MONEY_SUM = "decimal(20,2)"


def _lit_rule(rule) -> list:
    return [F.lit(rule[0]).alias("regra"), F.lit(rule[1]).alias("tabela"),
            F.lit(rule[2]).alias("severidade")]


def _one(df: DataFrame, rule, cond=None, revenue: bool = False) -> DataFrame:
    """Count (and revenue) of the rows satisfying ``cond`` - one row always."""
    src = df.where(cond) if cond is not None else df
    rev = F.sum("receita") if revenue else F.lit(None)
    return src.agg(*_lit_rule(rule), F.count(F.lit(1)).alias("linhas_afetadas"),
                   rev.cast(MONEY_SUM).alias("receita_afetada"))


def brand_mismatch(catalog: DataFrame) -> DataFrame:
    """Products whose name cites another brand (J8, literal substring)."""
    return contains_other_value(catalog, ["id_produto"], "nome_produto", "marca",
                                catalog, "marca")


def shared_name_counts(catalog: DataFrame) -> DataFrame:
    """Per name: how many products carry it (NULL names form one group)."""
    return catalog.groupBy("nome_produto").agg(F.count(F.lit(1)).alias("mesmo_nome"))


def thin_competition(prices: DataFrame, expected: int) -> DataFrame:
    """Products with fewer than ``expected`` competitor prices (HAVING)."""
    return (prices.groupBy("id_produto").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") < expected))


def title_cond():
    return F.col("nome_original").rlike(P.SCORECARD_TITLE_PATTERN)


def rule_unregistered(sales): return _one(sales, P.RULE_UNREGISTERED, ~F.col("produto_cadastrado"), True)
def rule_early_sale(sales): return _one(sales, P.RULE_EARLY_SALE, F.col("venda_antes_do_cadastro"), True)
def rule_suspicious(prices): return _one(prices, P.RULE_SUSPICIOUS, F.col("preco_suspeito"))
def rule_brand(catalog): return _one(brand_mismatch(catalog), P.RULE_BRAND)


def rule_same_name(catalog):
    shared = shared_name_counts(catalog).where(F.col("mesmo_nome") > 1)
    return shared.agg(*_lit_rule(P.RULE_SAME_NAME),
                      F.coalesce(F.sum("mesmo_nome"), F.lit(0)).cast("bigint").alias("linhas_afetadas"),
                      F.lit(None).cast(MONEY_SUM).alias("receita_afetada"))


def rule_thin(prices, expected: int = 4): return _one(thin_competition(prices, expected), P.RULE_THIN)
def rule_title(customers): return _one(customers, P.RULE_TITLE, title_cond())


def union_form(lh) -> DataFrame:
    parts = [rule_unregistered(lh.sales), rule_early_sale(lh.sales), rule_suspicious(lh.prices),
             rule_brand(lh.catalog), rule_same_name(lh.catalog),
             rule_thin(lh.prices, lh.params.expected_competitors), rule_title(lh.customers)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _stack(agg: DataFrame, rows: list) -> DataFrame:
    """rows: (rule, count column, revenue column or None) -> one row each."""
    items = []
    for rule, n, rev in rows:
        items += [F.lit(rule[0]), F.lit(rule[1]), F.lit(rule[2]), F.col(n).cast("bigint"),
                  (F.col(rev) if rev else F.lit(None)).cast(MONEY_SUM)]
    expr = F.stack(F.lit(len(rows)), *items).alias(
        "regra", "tabela", "severidade", "linhas_afetadas", "receita_afetada")
    return agg.select(expr)


def fused(lh) -> DataFrame:
    """One aggregate per source table, unpivoted; same rows as ``union_form``."""
    s = lh.sales
    unreg, early = ~F.col("produto_cadastrado"), F.col("venda_antes_do_cadastro")
    sales_agg = s.agg(
        F.count_if(unreg).alias("n1"), F.sum(F.when(unreg, F.col("receita"))).alias("r1"),
        F.count_if(early).alias("n2"), F.sum(F.when(early, F.col("receita"))).alias("r2"))
    per_product = lh.prices.groupBy("id_produto").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("preco_suspeito").alias("susp"))
    price_agg = per_product.agg(
        F.coalesce(F.sum("susp"), F.lit(0)).alias("n3"),
        F.count_if(F.col("n") < lh.params.expected_competitors).alias("n6"))
    cat = lh.catalog
    names = shared_name_counts(cat)
    brand_part = brand_mismatch(cat).agg(F.count(F.lit(1)).alias("n4"))
    name_part = names.agg(F.coalesce(F.sum(F.when(F.col("mesmo_nome") > 1, F.col("mesmo_nome"))),
                                     F.lit(0)).alias("n5"))
    cust_agg = lh.customers.agg(F.count_if(title_cond()).alias("n7"))
    return (_stack(sales_agg, [(P.RULE_UNREGISTERED, "n1", "r1"), (P.RULE_EARLY_SALE, "n2", "r2")])
            .unionByName(_stack(price_agg, [(P.RULE_SUSPICIOUS, "n3", None), (P.RULE_THIN, "n6", None)]))
            .unionByName(_stack(brand_part, [(P.RULE_BRAND, "n4", None)]))
            .unionByName(_stack(name_part, [(P.RULE_SAME_NAME, "n5", None)]))
            .unionByName(_stack(cust_agg, [(P.RULE_TITLE, "n7", None)])))
