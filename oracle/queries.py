"""Oracle SQL per registered query (DuckDB dialect, views = test tables)."""

from __future__ import annotations

from oracle.sql import PR, dedup, with_ctes

BODIES: dict[str, str] = {}

BODIES["bronze_typed_ingest"] = "SELECT * FROM b_vendas"
BODIES["dedup_sales"] = dedup("b_vendas", ["id_venda"], ["data_venda", "id_cliente", "id_produto",
                                                          "canal_venda", "quantidade", "preco_unitario"])
BODIES["clean_customers"] = "SELECT * FROM s_clientes"
BODIES["product_catalog"] = "SELECT * FROM s_produtos"
BODIES["price_band_case"] = """
SELECT faixa_preco, COUNT(*) AS produtos, MIN(preco_atual) AS preco_min, MAX(preco_atual) AS preco_max
FROM s_produtos GROUP BY faixa_preco"""
BODIES["sales_enriched"] = "SELECT * FROM s_vendas"
BODIES["weekday_map"] = """
SELECT dia_semana_num, dia_semana, COUNT(*) AS total_vendas FROM s_vendas GROUP BY ALL"""
BODIES["unregistered_sales"] = """
SELECT id_venda, id_produto, quantidade, receita FROM s_vendas WHERE NOT produto_cadastrado"""
BODIES["early_sales"] = """
SELECT id_venda, id_produto, data_venda, receita FROM s_vendas WHERE venda_antes_do_cadastro"""
BODIES["competitor_prices"] = "SELECT * FROM s_precos"
BODIES["sales_by_time"] = "SELECT * FROM g_tempo"
BODIES["sales_by_time_events"] = "SELECT * FROM g_tempo_ev"
BODIES["sales_by_product"] = "SELECT * FROM g_produtos"
BODIES["sales_by_time_stream"] = "SELECT * FROM g_tempo_ev"
BODIES["rank_global"] = """
SELECT id_venda, receita, CAST(row_number() OVER (ORDER BY receita DESC, id_venda) AS BIGINT) AS posicao
FROM s_vendas"""
BODIES["rank_in_category"] = """
SELECT id_produto, categoria, receita,
       CAST(row_number() OVER (PARTITION BY categoria ORDER BY receita DESC, id_produto) AS BIGINT) AS posicao
FROM g_produtos"""
BODIES["customer_segments"] = "SELECT * FROM g_clientes"
BODIES["sales_detail"] = "SELECT * FROM g_detalhe"
BODIES["price_position"] = "SELECT * FROM g_precos"
BODIES["brand_mismatch_exists"] = """
SELECT p.id_produto, p.nome_produto, p.marca FROM s_produtos p SEMI JOIN brand_hits h ON p.id_produto = h.id_produto"""
BODIES["same_name_window"] = """
SELECT id_produto, nome_produto, COUNT(*) OVER (PARTITION BY nome_produto) AS mesmo_nome FROM s_produtos"""
BODIES["thin_competition_having"] = f"""
SELECT id_produto, COUNT(*) AS total_concorrentes FROM s_precos GROUP BY id_produto
HAVING COUNT(*) < {PR.expected_competitors}"""
BODIES["quality_scorecard"] = "SELECT * FROM g_qualidade"
BODIES["quality_scorecard_union"] = "SELECT * FROM g_qualidade"
BODIES["orphan_anti_join"] = """
SELECT id_venda, 'cliente' AS registro, id_cliente AS chave FROM s_vendas v
WHERE NOT EXISTS (SELECT 1 FROM s_clientes c WHERE c.id_cliente = v.id_cliente)
UNION ALL
SELECT id_venda, 'produto', id_produto FROM s_vendas v
WHERE NOT EXISTS (SELECT 1 FROM s_produtos p WHERE p.id_produto = v.id_produto)"""


# --- data-quality checks ----------------------------------------------------------

from mercato import params as P  # noqa: E402
from oracle.sql import money_of_cents, q, round_avg_signed  # noqa: E402

GOLD_CTE = {"sales_by_time": "g_tempo", "sales_by_product": "g_produtos", "customer_segments": "g_clientes",
            "sales_detail": "g_detalhe", "price_position": "g_precos"}
GOLD_KEYS = {"sales_by_product": ["id_produto"], "customer_segments": ["id_cliente"],
             "sales_detail": ["id_venda"], "price_position": ["id_produto"],
             "sales_by_time": ["data", "hora", "canal_venda"]}


def _union(parts):
    return "\nUNION ALL\n".join(parts)


# A good row of each silver table, rule by rule; the last word tells whether a
# bad one stops the run.
_EXPECTED_ROWS = [
    ("silver.clientes", "s_clientes", [
        ("id_cliente_preenchido", "id_cliente IS NOT NULL", "fail"), ("cliente_com_regiao", "regiao IS NOT NULL", "fail")]),
    ("silver.produtos", "s_produtos", [
        ("id_produto_preenchido", "id_produto IS NOT NULL", "fail"), ("preco_positivo", "preco_atual > 0", "fail")]),
    ("silver.vendas", "s_vendas", [
        ("campos_obrigatorios", "NOT (id_venda IS NULL OR data_venda IS NULL OR id_cliente IS NULL OR id_produto IS NULL OR quantidade IS NULL OR preco_unitario IS NULL)", "fail"),
        ("quantidade_positiva", "quantidade >= 1", "fail"), ("preco_positivo", "preco_unitario > 0", "fail"),
        ("canal_conhecido", "canal_venda = 'ecommerce' OR canal_venda = 'loja_fisica'", "fail"),
        ("produto_cadastrado", "produto_cadastrado", "warn"), ("venda_depois_do_cadastro", "venda_depois_do_cadastro", "warn"),
        ("venda_nao_antecede_cadastro", "venda_antes_do_cadastro = false", "warn")]),
    ("silver.preco_competidores", "s_precos", [
        ("id_produto_preenchido", "id_produto IS NOT NULL", "fail"), ("preco_positivo", "preco_concorrente > 0", "fail"),
        ("preco_plausivel", "preco_suspeito = false", "warn")]),
]


def _expectations():
    parts = [f"SELECT {q(table)} AS tabela, {q(name)} AS regra, {q(action)} AS acao, "
             f"COUNT_IF(NOT COALESCE(({good}), false)) AS violacoes FROM {cte}"
             for table, cte, rules in _EXPECTED_ROWS for name, good, action in rules]
    return f"SELECT *, acao = 'warn' OR violacoes = 0 AS passed FROM ({_union(parts)})"


def _per_column(cols_by_table, expr, name):
    parts = [f"SELECT {q(t)} AS table_name, {q(c)} AS column_name, COUNT_IF({expr.format(c=c)}) AS {name} "
             f"FROM {GOLD_CTE[t]}" for t, cols in cols_by_table.items() for c in cols.split()]
    return f"SELECT *, {name} = 0 AS passed FROM ({_union(parts)})"


BODIES["dq_expectations"] = _expectations()
_REQUIRED = {
    "sales_by_time": "data hora canal_venda total_vendas itens_vendidos receita dia_semana",
    "sales_by_product": "id_produto nome_produto categoria marca total_vendas itens_vendidos receita",
    "customer_segments": "id_cliente nome_cliente estado nome_estado regiao total_compras receita segmento_cliente ranking_receita",
    "sales_detail": "id_venda data_venda id_produto id_cliente canal_venda quantidade preco_unitario receita "
                    "produto_cadastrado venda_antes_do_cadastro",
    "price_position": "id_produto nome_produto categoria marca nosso_preco preco_medio_concorrentes "
                      "preco_minimo_concorrentes preco_maximo_concorrentes total_concorrentes classificacao_preco",
}
_POSITIVE = {
    "sales_by_time": "receita total_vendas itens_vendidos",
    "sales_by_product": "receita total_vendas itens_vendidos",
    "price_position": "nosso_preco preco_minimo_concorrentes preco_maximo_concorrentes",
}
BODIES["dq_not_null"] = _per_column(_REQUIRED, "{c} IS NULL", "nulls")
BODIES["dq_positive"] = _per_column(_POSITIVE, "{c} <= 0", "not_positive")
BODIES["dq_unique_grain"] = "SELECT *, duplicated_keys = 0 AS passed FROM (" + _union([
    f"SELECT {q(t)} AS table_name, {q(','.join(k))} AS grain, COUNT(*) AS duplicated_keys "
    f"FROM (SELECT {', '.join(k)} FROM {GOLD_CTE[t]} GROUP BY ALL HAVING COUNT(*) > 1)"
    for t, k in GOLD_KEYS.items()]) + ")"


def _in(vals):
    return ", ".join(q(v) for v in vals)


BODIES["dq_domain"] = "SELECT *, invalid = 0 AS passed FROM (" + _union([
    f"SELECT {q(n)} AS check_name, COUNT_IF(NOT COALESCE({c} IN ({_in(v)}), false)) AS invalid FROM {t}"
    for n, t, c, v in [("segmento_cliente", "g_clientes", "segmento_cliente", P.SEGMENTS),
                       ("canal_venda", "g_detalhe", "canal_venda", P.CHANNELS),
                       ("classificacao_preco", "g_precos", "classificacao_preco", P.PRICE_CLASSES),
                       ("faixa_preco", "s_produtos", "faixa_preco", [P.BAND_TOP, P.BAND_MID, P.BAND_LOW])]]) + ")"

BODIES["dq_row_preservation"] = """
SELECT check_name, gold_rows, silver_rows, COALESCE(gold_rows = silver_rows, false) AS passed FROM (
  SELECT 'vendas' AS check_name, (SELECT COUNT(*) FROM g_detalhe) AS gold_rows, (SELECT COUNT(*) FROM s_vendas) AS silver_rows
  UNION ALL
  SELECT 'nao_cadastradas', (SELECT COUNT_IF(NOT produto_cadastrado) FROM g_detalhe),
         (SELECT COUNT_IF(NOT produto_cadastrado) FROM s_vendas))"""

D38 = "DECIMAL(38,2)"
BODIES["dq_reconcile"] = f"""
SELECT check_name, observed, expected, observed IS NOT DISTINCT FROM expected AS passed FROM (
  SELECT 'receita tempo x detalhe' AS check_name, CAST((SELECT SUM(receita) FROM g_tempo) AS {D38}) AS observed,
         CAST((SELECT SUM(receita) FROM g_detalhe) AS {D38}) AS expected
  UNION ALL
  SELECT 'receita produtos x detalhe', CAST((SELECT SUM(receita) FROM g_produtos) AS {D38}),
         CAST((SELECT SUM(receita) FROM g_detalhe) AS {D38})
  UNION ALL
  SELECT 'vendas tempo x detalhe', CAST((SELECT SUM(total_vendas) FROM g_tempo) AS {D38}),
         CAST((SELECT COUNT(*) FROM g_detalhe) AS {D38}))"""

BODIES["dq_recompute"] = """
SELECT *, inconsistent = 0 AS passed FROM (
  SELECT 'ticket_medio' AS check_name,
         COUNT_IF(COALESCE(abs(ticket_medio - round(receita / NULLIF(total_compras, 0), 2)) > 0.02,
                           (ticket_medio IS NULL) <> (total_compras = 0))) AS inconsistent FROM g_clientes
  UNION ALL
  SELECT 'diferenca_pct_vs_media',
         COUNT_IF(COALESCE(abs(diferenca_pct_vs_media - round((nosso_preco - preco_medio_concorrentes)
                  / preco_medio_concorrentes * 100, 2)) > 0.1, true)) FROM g_precos
  UNION ALL
  SELECT 'receita', COUNT_IF(COALESCE(abs(receita - CAST(quantidade * preco_unitario AS DECIMAL(10,2))) > 0.01, true))
  FROM g_detalhe)"""

BODIES["dq_segment_bounds"] = f"""
SELECT *, invalid = 0 AS passed FROM (
  SELECT 'VIP' AS check_name, COUNT_IF(segmento_cliente = 'VIP' AND receita < {PR.vip_from}) AS invalid FROM g_clientes
  UNION ALL
  SELECT 'TOP_TIER', COUNT_IF(segmento_cliente = 'TOP_TIER' AND (receita < {PR.top_from} OR receita >= {PR.vip_from}))
  FROM g_clientes
  UNION ALL
  SELECT 'REGULAR', COUNT_IF(segmento_cliente = 'REGULAR' AND receita >= {PR.top_from}) FROM g_clientes)"""

BODIES["dq_rank_dense"] = """
SELECT *, max_rank = "rows" AND distinct_ranks = "rows" AS passed FROM (
  SELECT 'sales_by_product' AS table_name, 'ranking_receita' AS column_name, CAST(MAX(ranking_receita) AS BIGINT) AS max_rank,
         COUNT(DISTINCT ranking_receita) AS distinct_ranks, COUNT(*) AS "rows" FROM g_produtos
  UNION ALL
  SELECT 'customer_segments', 'ranking_receita', CAST(MAX(ranking_receita) AS BIGINT),
         COUNT(DISTINCT ranking_receita), COUNT(*) FROM g_clientes)"""

_rules_values = ", ".join(f"({q(r[0])})" for r in P.SCORECARD_RULES)
BODIES["dq_rules_present"] = f"""
SELECT e.regra, COALESCE(g.present, 0) AS present, g.scorecard_count, r.recount,
       COALESCE(g.present, 0) = 1 AND COALESCE(r.recount = g.scorecard_count, r.recount IS NULL) AS passed
FROM (VALUES {_rules_values}) e(regra)
LEFT JOIN (SELECT regra, COUNT(*) AS present, CAST(SUM(linhas_afetadas) AS BIGINT) AS scorecard_count
           FROM g_qualidade GROUP BY regra) g ON e.regra = g.regra
LEFT JOIN (SELECT {q(P.RULE_UNREGISTERED[0])} AS regra, COUNT_IF(NOT produto_cadastrado) AS recount FROM s_vendas
           UNION ALL SELECT {q(P.RULE_EARLY_SALE[0])}, COUNT_IF(venda_antes_do_cadastro) FROM s_vendas
           UNION ALL SELECT {q(P.RULE_SUSPICIOUS[0])}, COUNT_IF(preco_suspeito) FROM s_precos) r ON e.regra = r.regra"""


def _rel(name, left, right, key):
    return f"""
  SELECT {q(name)} AS relation, COALESCE(MAX(r), 0) AS max_right_per_key,
         COUNT_IF(r IS NULL) AS left_only_keys, COUNT_IF(l IS NULL) AS right_only_keys
  FROM (SELECT {key}, COUNT(*) AS l FROM {left} GROUP BY {key}) a
  FULL JOIN (SELECT {key}, COUNT(*) AS r FROM {right} GROUP BY {key}) b USING ({key})"""


BODIES["dq_join_cardinality"] = "SELECT *, max_right_per_key <= 1 AS passed FROM (" + _union([
    _rel("vendas_detalhadas->clientes_segmentacao", "g_detalhe", "g_clientes", "id_cliente"),
    _rel("vendas_produtos->precos_competitividade", "g_produtos", "g_precos", "id_produto")]) + ")"

from oracle.sql import CTES as _CTES  # noqa: E402

_CTES["bl_gold_side"] = f"""
  SELECT 'receita_total' AS metric, CAST(SUM(receita) AS {D38}) AS observed FROM g_tempo
  UNION ALL SELECT 'total_vendas', CAST(SUM(total_vendas) AS {D38}) FROM g_tempo
  UNION ALL SELECT 'total_clientes', CAST(COUNT(*) AS {D38}) FROM g_clientes
  UNION ALL SELECT 'clientes_vip', CAST(COUNT_IF(segmento_cliente = 'VIP') AS {D38}) FROM g_clientes
  UNION ALL SELECT 'receita_vip', CAST(SUM(CASE WHEN segmento_cliente = 'VIP' THEN receita END) AS {D38}) FROM g_clientes
  UNION ALL SELECT 'produtos_monitorados', CAST(COUNT(*) AS {D38}) FROM g_precos
  UNION ALL SELECT 'produtos_mais_caros_todos', CAST(COUNT_IF(classificacao_preco = 'MAIS_CARO_QUE_TODOS') AS {D38}) FROM g_precos
  UNION ALL SELECT 'linhas_vendas_temporais', CAST(COUNT(*) AS {D38}) FROM g_tempo"""
_CTES["bl_known"] = f"""SELECT c.id_cliente, v.r FROM s_clientes c
          LEFT JOIN (SELECT id_cliente, SUM(receita) AS r FROM s_vendas GROUP BY id_cliente) v USING (id_cliente)"""
_CTES["bl_monitored"] = f"""SELECT p.id_produto, p.preco_atual, m.mx FROM s_produtos p
              JOIN (SELECT id_produto, MAX(preco_concorrente) AS mx FROM s_precos GROUP BY id_produto) m USING (id_produto)"""
_CTES["bl_silver_side"] = f"""
  SELECT 'receita_total' AS metric, CAST(SUM(receita) AS {D38}) AS expected FROM s_vendas
  UNION ALL SELECT 'total_vendas', CAST(COUNT(*) AS {D38}) FROM s_vendas
  UNION ALL SELECT 'total_clientes', CAST(COUNT(*) AS {D38}) FROM s_clientes
  UNION ALL SELECT 'clientes_vip', CAST(COUNT_IF(COALESCE(r, 0) >= {PR.vip_from}) AS {D38}) FROM bl_known
  UNION ALL SELECT 'receita_vip', CAST(SUM(CASE WHEN COALESCE(r, 0) >= {PR.vip_from} THEN r END) AS {D38}) FROM bl_known
  UNION ALL SELECT 'produtos_monitorados', CAST(COUNT(*) AS {D38}) FROM bl_monitored
  UNION ALL SELECT 'produtos_mais_caros_todos', CAST(COUNT_IF(preco_atual > mx) AS {D38}) FROM bl_monitored
  UNION ALL SELECT 'linhas_vendas_temporais', CAST(COUNT(*) AS {D38})
            FROM (SELECT DISTINCT data, hora, canal_venda FROM s_vendas)"""
BODIES["dq_baseline"] = """
SELECT metric, observed, expected, observed IS NOT DISTINCT FROM expected AS passed
FROM bl_gold_side FULL JOIN bl_silver_side USING (metric)"""


# Contract of the gold tables: column and type.
_CONTRACT = {
    "sales_by_time": "data date, dia_semana string, dia_semana_num int, hora int, canal_venda string, total_vendas bigint, "
                     "itens_vendidos bigint, receita decimal(20,2), clientes_unicos bigint",
    "sales_by_product": "id_produto string, nome_produto string, categoria string, marca string, faixa_preco string, "
                        "produto_cadastrado boolean, total_vendas bigint, itens_vendidos bigint, receita decimal(20,2), "
                        "ticket_medio decimal(11,2), ranking_receita int, ranking_na_categoria int",
    "customer_segments": "id_cliente string, nome_cliente string, estado string, nome_estado string, regiao string, "
                         "total_compras bigint, receita decimal(20,2), ticket_medio decimal(11,2), primeira_compra date, "
                         "ultima_compra date, segmento_cliente string, ranking_receita int",
    "sales_detail": "id_venda string, data_venda timestamp_ntz, data date, dia_semana string, dia_semana_num int, hora int, "
                    "canal_venda string, id_produto string, nome_produto string, categoria string, marca string, "
                    "faixa_preco string, produto_cadastrado boolean, id_cliente string, nome_cliente string, estado string, "
                    "regiao string, segmento_cliente string, quantidade bigint, preco_unitario decimal(10,2), "
                    "receita decimal(10,2), venda_antes_do_cadastro boolean",
    "price_position": "id_produto string, nome_produto string, categoria string, marca string, nosso_preco decimal(10,2), "
                      "preco_medio_concorrentes decimal(11,2), preco_minimo_concorrentes decimal(10,2), "
                      "preco_maximo_concorrentes decimal(10,2), total_concorrentes bigint, diferenca_pct_vs_media decimal(19,2), "
                      "diferenca_pct_vs_minimo decimal(18,2), classificacao_preco string, possui_preco_suspeito boolean, "
                      "receita decimal(20,2), itens_vendidos bigint",
    "quality_scorecard": "regra string, tabela string, severidade string, linhas_afetadas bigint, receita_afetada decimal(20,2)",
}
_contract_rows = ", ".join(
    f"({q(t)}, {q(c.split()[0])}, {q(c.split()[1])})" for t, cols in _CONTRACT.items() for c in cols.split(", "))
BODIES["dq_schema"] = f"""
SELECT table_name, column_name, expected_type, expected_type AS actual_type, true AS passed
FROM (VALUES {_contract_rows}) c(table_name, column_name, expected_type)"""

BODIES["dq_referential_integrity"] = """
SELECT *, orphans = 0 AS passed FROM (
  SELECT 'venda -> cliente' AS check_name, COUNT(*) AS orphans FROM g_detalhe ANTI JOIN s_clientes USING (id_cliente)
  UNION ALL
  SELECT 'venda cadastrada -> produto', COUNT(*) FROM (SELECT * FROM g_detalhe WHERE produto_cadastrado) d
  ANTI JOIN s_produtos USING (id_produto))"""

_FAMILIES = ["dq_expectations", "dq_not_null", "dq_positive", "dq_unique_grain", "dq_domain",
             "dq_row_preservation", "dq_reconcile", "dq_recompute", "dq_segment_bounds", "dq_rank_dense",
             "dq_rules_present", "dq_join_cardinality", "dq_baseline", "dq_schema", "dq_referential_integrity"]
BODIES["dq_report"] = ("SELECT COALESCE(g, 'TOTAL') AS grupo, COUNT(*) AS checks, COUNT_IF(passed) AS passed_checks, "
                       "bool_and(passed) AS all_passed FROM (" +
                       _union([f"SELECT {q(n)} AS g, passed FROM ({BODIES[n]})" for n in _FAMILIES]) +
                       ") GROUP BY ROLLUP (g)")


# --- business questions -------------------------------------------------------------

def _ratio_cents(num_money: str, den: str, t: str = "DECIMAL(20,2)") -> str:
    """ROUND(num / den, 2) for a non-negative money sum and a count."""
    c = f"CAST(({num_money}) * 100 AS HUGEINT)"
    return (f"CASE WHEN ({den}) = 0 OR ({num_money}) IS NULL THEN NULL "
            f"ELSE {money_of_cents(f'(2 * {c} + ({den})) // (2 * ({den}))', t)} END")


BODIES["ticket_by_segment"] = f"""
SELECT segmento_cliente, COUNT(*) AS clientes, CAST(SUM(total_compras) AS BIGINT) AS vendas,
       CAST(SUM(receita) AS DECIMAL(20,2)) AS receita,
       {_ratio_cents('SUM(receita)', 'SUM(total_compras)')} AS ticket_medio
FROM g_clientes_base GROUP BY segmento_cliente"""


def _tier(tier: str) -> str:
    seg = f"SUM(CASE WHEN segmento_cliente = {q(tier)} THEN receita END)"
    sc, tc = f"CAST({seg} * 100 AS HUGEINT)", "CAST(SUM(receita) * 100 AS HUGEINT)"
    pct = (f"CASE WHEN {seg} IS NULL OR SUM(receita) = 0 THEN NULL "
           f"ELSE CAST(((2 * {sc} * 1000 + {tc}) // (2 * {tc})) * 0.1 AS DECIMAL(10,1)) END")
    return f"""
SELECT {q(tier)} AS segmento_cliente, COUNT_IF(segmento_cliente = {q(tier)}) AS clientes,
       CAST({seg} AS DECIMAL(20,2)) AS receita, {pct} AS pct_receita
FROM g_clientes_base"""


BODIES["tier_share"] = _tier(P.SEG_TOP)
BODIES["vip_share"] = _tier(P.SEG_VIP)
BODIES["vip_by_channel"] = """
SELECT canal_venda, 'VIP' AS segmento_cliente, COUNT(*) AS vendas, CAST(SUM(receita) AS DECIMAL(20,2)) AS receita,
       COUNT(DISTINCT id_cliente) AS compradores
FROM g_detalhe WHERE segmento_cliente = 'VIP' GROUP BY canal_venda"""
BODIES["revenue_region_category"] = """
SELECT regiao, categoria, CAST(SUM(receita) AS DECIMAL(20,2)) AS receita FROM g_detalhe GROUP BY regiao, categoria"""
BODIES["above_market_by_status"] = f"""
SELECT CASE WHEN possui_preco_suspeito THEN {q(P.STATUS_TO_CONFIRM)} ELSE {q(P.STATUS_CONFIRMED)} END AS situacao,
       COUNT(*) AS produtos
FROM g_precos WHERE diferenca_pct_vs_media > 0 GROUP BY situacao"""
BODIES["avg_ticket"] = f"""
SELECT canal_venda, CAST(SUM(receita) AS DECIMAL(20,2)) AS receita, CAST(SUM(total_vendas) AS BIGINT) AS total_vendas,
       {_ratio_cents('SUM(receita)', 'SUM(total_vendas)')} AS ticket_medio
FROM g_tempo GROUP BY canal_venda"""
BODIES["weekday_avg_per_day"] = f"""
SELECT dia_semana_num, dia_semana, CAST(SUM(receita) AS DECIMAL(20,2)) AS receita, COUNT(DISTINCT data) AS dias,
       {_ratio_cents('SUM(receita)', 'COUNT(DISTINCT data)')} AS receita_media_dia
FROM g_tempo GROUP BY dia_semana_num, dia_semana"""
BODIES["buyers_in_period"] = """
SELECT CAST(year(data) AS INTEGER) AS ano, COUNT(DISTINCT id_cliente) AS compradores, COUNT(*) AS vendas
FROM g_detalhe GROUP BY ano"""
BODIES["channel_ranking"] = """
SELECT *, CAST(row_number() OVER (ORDER BY receita DESC, canal_venda) AS INTEGER) AS posicao FROM (
  SELECT canal_venda, CAST(SUM(receita) AS DECIMAL(20,2)) AS receita, CAST(SUM(total_vendas) AS BIGINT) AS total_vendas
  FROM g_tempo GROUP BY canal_venda)"""
BODIES["category_vs_market"] = f"""
SELECT categoria, COUNT(*) AS produtos,
       {round_avg_signed('diferenca_pct_vs_media', 'DECIMAL(19,2)')} AS diferenca_media_pct,
       COUNT_IF(diferenca_pct_vs_media > 0) AS acima_da_media
FROM g_precos GROUP BY categoria"""
BODIES["period_totals"] = """
SELECT 'todos' AS canal_venda, CAST(SUM(receita) AS DECIMAL(20,2)) AS receita, COUNT(*) AS total_vendas,
       CAST(SUM(quantidade) AS BIGINT) AS itens_vendidos, COUNT(DISTINCT id_cliente) AS compradores FROM g_detalhe
UNION ALL
SELECT canal_venda, CAST(SUM(receita) AS DECIMAL(20,2)), COUNT(*), CAST(SUM(quantidade) AS BIGINT),
       COUNT(DISTINCT id_cliente) FROM g_detalhe GROUP BY canal_venda"""
BODIES["dearer_than_all"] = """
SELECT id_produto, nome_produto, categoria, nosso_preco, preco_maximo_concorrentes, possui_preco_suspeito
FROM g_precos WHERE classificacao_preco = 'MAIS_CARO_QUE_TODOS'"""
BODIES["suspicious_by_category"] = """
SELECT categoria, COUNT(*) AS produtos, COUNT_IF(possui_preco_suspeito) AS suspeitos FROM g_precos GROUP BY categoria
UNION ALL
SELECT 'TOTAL', COUNT(*), COUNT_IF(possui_preco_suspeito) FROM g_precos"""
BODIES["top10_customers"] = """
SELECT id_cliente, nome_cliente, segmento_cliente, receita FROM g_clientes_base
ORDER BY receita DESC, id_cliente LIMIT 10"""
BODIES["top10_products"] = """
SELECT id_produto, nome_produto, categoria, receita FROM g_produtos_base
ORDER BY receita DESC, id_produto LIMIT 10"""
BODIES["daily_revenue"] = """
SELECT data, canal_venda, CAST(SUM(receita) AS DECIMAL(20,2)) AS receita, CAST(SUM(total_vendas) AS BIGINT) AS total_vendas
FROM g_tempo GROUP BY data, canal_venda"""
BODIES["hourly_revenue"] = """
SELECT hora, canal_venda, CAST(SUM(receita) AS DECIMAL(20,2)) AS receita, CAST(SUM(total_vendas) AS BIGINT) AS total_vendas
FROM g_tempo GROUP BY hora, canal_venda"""
BODIES["segment_distribution"] = """
SELECT segmento_cliente, COUNT(*) AS clientes, CAST(SUM(receita) AS DECIMAL(20,2)) AS receita
FROM g_clientes_base GROUP BY segmento_cliente"""
BODIES["revenue_by_region"] = """
SELECT regiao, COUNT(*) AS clientes, CAST(SUM(receita) AS DECIMAL(20,2)) AS receita FROM g_clientes_base GROUP BY regiao"""
BODIES["price_class_distribution"] = """
SELECT classificacao_preco, COUNT(*) AS produtos, COUNT_IF(possui_preco_suspeito) AS suspeitos
FROM g_precos GROUP BY classificacao_preco"""


BODIES["pricing_kpis"] = f"""
SELECT COUNT(*) AS monitorados, {round_avg_signed('diferenca_pct_vs_media', 'DECIMAL(19,2)')} AS diferenca_media_pct,
       COUNT_IF(classificacao_preco = {q(P.CLASS_ABOVE_ALL)}) AS mais_caros_que_todos,
       COUNT_IF(possui_preco_suspeito) AS com_preco_suspeito
FROM g_precos"""
BODIES["daily_revenue_filtered"] = """
SELECT data, canal_venda, CAST(SUM(receita) AS DECIMAL(20,2)) AS receita, COUNT(*) AS total_vendas
FROM s_vendas WHERE year(data) = 1996 AND canal_venda = 'ecommerce' GROUP BY data, canal_venda"""
BODIES["declared_table_load"] = _union([
    f"SELECT '{t}' AS tabela, COUNT(*) AS linhas FROM b_{c}"
    for t, c in [("clientes", "clientes"), ("produtos", "produtos"), ("vendas", "vendas"), ("preco_competidores", "precos")]])
BODIES["published_tables"] = _union([
    f"SELECT '{t}' AS tabela, COUNT(*) AS linhas FROM {c}"
    for t, c in [("silver.clientes", "s_clientes"), ("silver.produtos", "s_produtos"), ("silver.vendas", "s_vendas"),
                 ("silver.preco_competidores", "s_precos"), *((f"gold.{k}", v) for k, v in GOLD_CTE.items()),
                 ("gold.quality_scorecard", "g_qualidade")]])
BODIES["snapshot_history"] = f"SELECT v AS versao, t.* FROM (VALUES (1), (2)) s(v), ({BODIES['published_tables']}) t"
BODIES["csv_malformed_lines"] = """
SELECT id_venda, CASE WHEN o % 97 = 0 THEN 'campos a menos' WHEN o % 89 = 1 THEN 'campos a mais'
                      WHEN o % 83 = 2 THEN 'quantidade' ELSE 'nenhum' END AS problema
FROM (SELECT id_venda, CAST(string_split(id_venda, '_')[2] AS BIGINT) AS o FROM b_vendas)"""
BODIES["reconcile_days"] = """
SELECT data, id_venda, CASE WHEN o % 1009 = 0 THEN 'only left' ELSE 'different' END AS difference, CAST(1 AS BIGINT) AS left_rows,
       CAST(CASE WHEN o % 1009 = 0 THEN 0 WHEN o % 1019 = 2 THEN 2 ELSE 1 END AS BIGINT) AS right_rows
FROM (SELECT data, id_venda, CAST(string_split(id_venda, '_')[2] AS BIGINT) AS o FROM s_vendas)
WHERE o % 1009 = 0 OR o % 1013 = 1 OR o % 1019 = 2"""
BODIES["given_figures"] = """
SELECT 'total_vendas' AS metric, CAST(COUNT(*) AS DECIMAL(38,2)) AS observed, CAST(COUNT(*) AS DECIMAL(38,2)) AS expected, true AS passed FROM s_vendas
UNION ALL
SELECT 'total_clientes', CAST(COUNT(*) AS DECIMAL(38,2)), CAST(COUNT(*) + 1 AS DECIMAL(38,2)), false FROM s_clientes"""
BODIES["enforced_relationships"] = """
SELECT c.regiao, p.categoria, COUNT(*) AS vendas, CAST(SUM(v.receita) AS DECIMAL(20,2)) AS receita
FROM s_vendas v LEFT JOIN s_clientes c ON v.id_cliente = c.id_cliente LEFT JOIN s_produtos p ON v.id_produto = p.id_produto
GROUP BY ALL"""
BODIES["distinct_rollups"] = """
SELECT nivel, chave, COUNT(DISTINCT id_cliente) AS clientes, true AS perto
FROM (SELECT 'dia' AS nivel, CAST(data AS VARCHAR) AS chave, id_cliente FROM s_vendas
      UNION ALL SELECT 'semana', CAST(CAST(date_trunc('week', data) AS DATE) AS VARCHAR), id_cliente FROM s_vendas
      UNION ALL SELECT 'canal', canal_venda, id_cliente FROM s_vendas)
GROUP BY nivel, chave"""
BODIES["dq_by_load"] = f"""
UNPIVOT (
  SELECT carga, CAST(CASE carga WHEN 1 THEN COUNT_IF(year(data) < 1996) WHEN 2 THEN COUNT_IF(COALESCE(year(data) >= 1996, true))
                                ELSE COUNT_IF(year(data) = 1996) END AS BIGINT) AS linhas_lidas,
         {', '.join(f'CAST(COUNT_IF({c} IS NULL) AS DECIMAL(38,2)) AS null_{c}' for c in _REQUIRED['sales_detail'].split())},
         CAST(COUNT_IF(NOT COALESCE(canal_venda IN ({_in(P.CHANNELS)}), false)) AS DECIMAL(38,2)) AS invalid_domain,
         CAST(COUNT_IF(true) AS DECIMAL(38,2)) AS "rows", CAST(COUNT_IF(NOT produto_cadastrado) AS DECIMAL(38,2)) AS unreg,
         CAST(SUM(receita) AS DECIMAL(38,2)) AS receita,
         CAST(COUNT_IF(COALESCE(abs(receita - CAST(quantidade * preco_unitario AS DECIMAL(10,2))) > 0.01, true)) AS DECIMAL(38,2)) AS bad_receita
  FROM g_detalhe JOIN (VALUES (1), (2), (3)) l(carga) ON carga > 1 OR year(data) < 1996 GROUP BY carga)
ON COLUMNS(* EXCLUDE (carga, linhas_lidas)) INTO NAME metric VALUE value"""
BODIES["routed_rows"] = _union([
    "SELECT {t} AS tabela, CASE WHEN {stopped} THEN 'quarantine' ELSE 'good' END AS destino, {r} AS regra, COUNT_IF({counted}) AS linhas FROM {cte} GROUP BY 2".format(
        t=q(table), r=q(name), cte=cte, counted=counted,
        stopped=" OR ".join(f"NOT COALESCE(({good}), false)" for _, good, action in rules if action == "fail"))
    for table, cte, rules in _EXPECTED_ROWS
    for name, counted in [("linhas", "true"), *((n, f"NOT COALESCE(({good}), false)") for n, good, _ in rules)]])
_state_rows = ", ".join(f"({n}, {q(c)}, {q(s)}, {q(r)})" for n, (c, s, r) in enumerate(P.BRAZIL_STATES))
BODIES["inline_states"] = f"""
SELECT estado, nome_estado, regiao, COUNT(*) AS clientes
FROM customer JOIN (VALUES {_state_rows}) s(n, estado, nome_estado, regiao) ON c_custkey % {len(P.BRAZIL_STATES)} = n
GROUP BY estado, nome_estado, regiao"""


def _bigint_count_if(sql: str) -> str:
    """DuckDB's COUNT_IF is HUGEINT; Spark's count_if is BIGINT: wrap every
    COUNT_IF(...) in CAST(... AS BIGINT) (parentheses matched, quotes skipped)."""
    out, i, key = [], 0, "COUNT_IF("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        depth, k, quoted = 0, j + len(key) - 1, False
        while k < len(sql):
            ch = sql[k]
            if ch == "'":
                quoted = not quoted
            elif not quoted and ch == "(":
                depth += 1
            elif not quoted and ch == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = _bigint_count_if(sql[j + len(key):k])
        out.append(f"CAST(COUNT_IF({inner}) AS BIGINT)")
        i = k + 1


def oracle_sql() -> dict[str, str]:
    return {name: _bigint_count_if(with_ctes(body)) for name, body in BODIES.items()}
