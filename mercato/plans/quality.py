"""Data-quality checks over the finished tables (Q1-Q16), as DataFrames.

Each check family is fused into one aggregate per table (e.g. all not-null
counts of a table in a single pass) and unpivoted with ``stack``; nothing is
collected to the driver.  Results carry a ``passed`` flag; ``report``
summarises every family.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato import params as P
from mercato.operators import expect
from mercato.operators.checkstate import CheckState
from mercato.operators.dedup import duplicate_key_count
from mercato.operators.joins import by_shuffle
from mercato.operators.materialize import materialize
from mercato.plans import silver
from mercato.schemas import GOLD, GOLD_KEYS

# Columns that must never be NULL, per gold table (completeness + flags).
REQUIRED = {
    "sales_by_time": ["data", "hora", "canal_venda", "total_vendas", "itens_vendidos", "receita",
                      "dia_semana"],
    "sales_by_product": ["id_produto", "nome_produto", "categoria", "marca", "total_vendas",
                         "itens_vendidos", "receita"],
    "customer_segments": ["id_cliente", "nome_cliente", "estado", "nome_estado", "regiao",
                          "total_compras", "receita", "segmento_cliente", "ranking_receita"],
    "sales_detail": ["id_venda", "data_venda", "id_produto", "id_cliente", "canal_venda",
                     "quantidade", "preco_unitario", "receita", "produto_cadastrado",
                     "venda_antes_do_cadastro"],
    "price_position": ["id_produto", "nome_produto", "categoria", "marca", "nosso_preco",
                       "preco_medio_concorrentes", "preco_minimo_concorrentes",
                       "preco_maximo_concorrentes", "total_concorrentes", "classificacao_preco"],
}

# Columns that must be > 0 where not NULL.
POSITIVE = {
    "sales_by_time": ["receita", "total_vendas", "itens_vendidos"],
    "sales_by_product": ["receita", "total_vendas", "itens_vendidos"],
    "price_position": ["nosso_preco", "preco_minimo_concorrentes", "preco_maximo_concorrentes"],
}


def _gold(lh, name: str) -> DataFrame:
    return getattr(lh, name)


def _stack(agg: DataFrame, items: list[list], names: list[str]) -> DataFrame:
    flat = [x for row in items for x in row]
    return agg.select(F.stack(F.lit(len(items)), *flat).alias(*names))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- profiles ----------------------------------------------------------------------
#
# Every global-aggregate check reads its numbers from the profile of its table.
# A single family computes just the numbers it needs, from the columns they
# need; a report first writes the whole profile, one aggregate per table, and
# its families read that.  Grain, rank and cardinality checks group by key and
# scan their tables themselves.

SILVER_RULES = {"customers": ("silver.clientes", silver.CUSTOMER_RULES),
                "catalog": ("silver.produtos", silver.PRODUCT_RULES),
                "sales": ("silver.vendas", silver.SALES_RULES),
                "prices": ("silver.preco_competidores", silver.COMPETITOR_RULES)}
DOMAINS = {"customer_segments": ("segmento_cliente", P.SEGMENTS),
           "sales_detail": ("canal_venda", P.CHANNELS),
           "price_position": ("classificacao_preco", P.PRICE_CLASSES),
           "catalog": ("faixa_preco", [P.BAND_TOP, P.BAND_MID, P.BAND_LOW])}


def _metrics(lh) -> dict[str, dict]:
    p = lh.params
    m: dict[str, dict] = {t: {} for t in ["customers", "catalog", "sales", "prices", *REQUIRED]}
    for t, (_, rules) in SILVER_RULES.items():
        m[t].update({f"v_{r.name}": expect.violated(r) for r in rules})
    for t, cols in REQUIRED.items():
        m[t].update({f"null_{c}": F.count_if(F.col(c).isNull()) for c in cols})
    for t, cols in POSITIVE.items():
        m[t].update({f"nonpos_{c}": F.count_if(F.col(c) <= 0) for c in cols})
    for t, (c, vals) in DOMAINS.items():
        m[t]["invalid_domain"] = F.count_if(~F.coalesce(F.col(c).isin(*vals), F.lit(False)))
    unreg, money = ~F.col("produto_cadastrado"), "decimal(38,2)"
    rows = F.count(F.lit(1))
    m["sales"].update(rows=rows, unreg=F.count_if(unreg), early=F.count_if("venda_antes_do_cadastro"),
                      receita=F.sum("receita").cast(money))
    m["prices"].update(suspicious=F.count_if("preco_suspeito"))
    m["customers"].update(rows=rows)
    m["sales_by_time"].update(rows=rows, receita=F.sum("receita").cast(money),
                              vendas=F.sum("total_vendas").cast(money))
    m["sales_by_product"].update(receita=F.sum("receita").cast(money))
    r, s = F.col("receita"), F.col("segmento_cliente")
    vip_from, top_from = F.lit(p.vip_from), F.lit(p.top_from)
    calc = F.round(F.try_divide(F.col("receita"), F.col("total_compras")), 2)
    m["customer_segments"].update(
        rows=rows, vip=F.count_if(s == P.SEG_VIP), vip_receita=F.sum(F.when(s == P.SEG_VIP, r)).cast(money),
        bad_vip=F.count_if((s == P.SEG_VIP) & (r < vip_from)),
        bad_top=F.count_if((s == P.SEG_TOP) & ((r < top_from) | (r >= vip_from))),
        bad_regular=F.count_if((s == P.SEG_REGULAR) & (r >= top_from)),
        bad_ticket=F.count_if(F.coalesce(F.abs(F.col("ticket_medio") - calc) > Decimal("0.02"),
                                         F.col("ticket_medio").isNull() != calc.isNull())))
    rev = (F.col("quantidade") * F.col("preco_unitario")).cast("decimal(10,2)")
    m["sales_detail"].update(
        rows=rows, unreg=F.count_if(unreg), receita=F.sum("receita").cast(money),
        bad_receita=F.count_if(F.coalesce(F.abs(F.col("receita") - rev) > Decimal("0.01"), F.lit(True))))
    pct = F.round((F.col("nosso_preco") - F.col("preco_medio_concorrentes"))
                  / F.col("preco_medio_concorrentes") * 100, 2)
    m["price_position"].update(
        rows=rows, dearer=F.count_if(F.col("classificacao_preco") == P.CLASS_ABOVE_ALL),
        bad_pct=F.count_if(F.coalesce(F.abs(F.col("diferenca_pct_vs_media") - pct) > Decimal("0.1"),
                                      F.lit(True))))
    return m


def profiles(lh) -> DataFrame:
    """All metrics of all tables in long form (tabela, metric, value): one
    aggregate per table, written once (a few hundred values)."""
    if "_profiles" not in lh.__dict__:
        lh.__dict__["_profiles"] = materialize(_union(_whole_profiles(lh, list(_metrics(lh)))), "quality-profiles")
    return lh.__dict__["_profiles"]


def check_state(lh, table: str, folder: str, root: str, schema=None) -> CheckState:
    """The mergeable metrics of a table that grows by files in ``folder``, kept under ``root``."""
    return CheckState(lh.spark, root, folder, schema or getattr(lh, table).schema, _metrics(lh)[table])


def profiles_from(lh, states: dict[str, CheckState]) -> DataFrame:
    """Profiles from states, which are brought up to date here: of their tables
    only files that no earlier run has seen are scanned.  The other tables are
    aggregated whole.  All families of ``lh`` read the result."""
    parts = []
    for t, state in states.items():
        state.refresh()
        parts.append(state.merged().select(F.lit(t).alias("tabela"), "metric", "value"))
    rest = [t for t in _metrics(lh) if t not in states]
    lh.__dict__["_profiles"] = materialize(_union([*parts, *_whole_profiles(lh, rest)]), "quality-profiles")
    return lh.__dict__["_profiles"]


def _whole_profiles(lh, tables: list[str]) -> list[DataFrame]:
    specs = _metrics(lh)
    parts = []
    for t in tables:
        agg = getattr(lh, t).agg(*[e.cast("decimal(38,2)").alias(n) for n, e in specs[t].items()])
        parts.append(_stack(agg, [[F.lit(t), F.lit(n), F.col(n)] for n in specs[t]], ["tabela", "metric", "value"]))
    return parts


def profile(lh, table: str, names: list[str]) -> DataFrame:
    """One row with the metrics ``names`` of ``table`` (decimal(38,2)): from
    the written profiles if there are any, else from the table's own columns."""
    if "_profiles" in lh.__dict__:
        long = lh.__dict__["_profiles"].where(F.col("tabela") == table)
        return long.agg(*[F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n in names])
    spec = _metrics(lh)[table]
    return getattr(lh, table).agg(*[spec[n].cast("decimal(38,2)").alias(n) for n in names])


def _long(lh, items: list[tuple]) -> DataFrame:
    """(key, side, table, metric) -> rows (key, side, value) from profiles."""
    by_table: dict[str, list] = {}
    for k, side, t, mc in items:
        by_table.setdefault(t, []).append((k, side, mc))
    parts = [_stack(profile(lh, t, sorted({mc for _, _, mc in own})),
                    [[F.lit(k), F.lit(side), F.col(mc).cast("decimal(38,2)")] for k, side, mc in own],
                    ["k", "side", "v"]) for t, own in by_table.items()]
    return _union(parts)


def _pair(lh, items: list[tuple], key: str, left: str, right: str) -> DataFrame:
    """Two values per key side by side, from a union (no join of one-row frames)."""
    return _long(lh, items).groupBy("k").agg(
        F.max(F.when(F.col("side") == "l", F.col("v"))).alias(left),
        F.max(F.when(F.col("side") == "r", F.col("v"))).alias(right)).withColumnRenamed("k", key)


def expectations(lh) -> DataFrame:
    """X1-X3 as a table: violations per silver rule (one pass per table)."""
    parts = [_stack(profile(lh, t, [f"v_{r.name}" for r in rules]), [[F.lit(table), F.lit(r.name), F.lit(r.action),
                                      F.col(f"v_{r.name}").cast("bigint")] for r in rules],
                    ["tabela", "regra", "acao", "violacoes"])
             for t, (table, rules) in SILVER_RULES.items()]
    return _union(parts).withColumn("passed", (F.col("acao") == expect.WARN) | (F.col("violacoes") == 0))


def not_null(lh) -> DataFrame:
    """Q3/Q14: NULL count per required column, one aggregate per table."""
    parts = [_stack(profile(lh, t, [f"null_{c}" for c in cols]), [[F.lit(t), F.lit(c), F.col(f"null_{c}").cast("bigint")] for c in cols],
                    ["table_name", "column_name", "nulls"]) for t, cols in REQUIRED.items()]
    return _union(parts).withColumn("passed", F.col("nulls") == 0)


def positive(lh) -> DataFrame:
    """Q4: rows with a value <= 0 per column (NULL ignored)."""
    parts = [_stack(profile(lh, t, [f"nonpos_{c}" for c in cols]), [[F.lit(t), F.lit(c), F.col(f"nonpos_{c}").cast("bigint")] for c in cols],
                    ["table_name", "column_name", "not_positive"]) for t, cols in POSITIVE.items()]
    return _union(parts).withColumn("passed", F.col("not_positive") == 0)


def unique_grain(lh) -> DataFrame:
    """Q6: duplicated keys per gold table (partial-aggregated group counts)."""
    parts = [duplicate_key_count(_gold(lh, t), keys)
             .select(F.lit(t).alias("table_name"), F.lit(",".join(keys)).alias("grain"),
                     "duplicated_keys") for t, keys in GOLD_KEYS.items()]
    return _union(parts).withColumn("passed", F.col("duplicated_keys") == 0)


def schema_check(lh) -> DataFrame:
    """Q5: every contract column present with its declared type, from the
    published tables' schemas alone (no scan)."""
    rows = []
    for table, contract in GOLD.items():
        actual = {f.name: f.dataType.simpleString() for f in _gold(lh, table).schema.fields}
        rows += [(table, f.name, f.dataType.simpleString(), actual.get(f.name)) for f in contract.fields]
    out = lh.spark.createDataFrame(rows, "table_name string, column_name string, expected_type string, actual_type string")
    return out.withColumn("passed", F.coalesce(F.col("expected_type") == F.col("actual_type"), F.lit(False)))


def domain(lh) -> DataFrame:
    """Q12: values outside their domain."""
    parts = [profile(lh, t, ["invalid_domain"]).select(F.lit(c).alias("check_name"), F.col("invalid_domain").cast("bigint")
                                   .alias("invalid")) for t, (c, _) in DOMAINS.items()]
    return _union(parts).withColumn("passed", F.col("invalid") == 0)


def row_preservation(lh) -> DataFrame:
    """Q8: the wide table keeps every silver sale, unregistered ones too."""
    out = _pair(lh, [("vendas", "l", "sales_detail", "rows"), ("vendas", "r", "sales", "rows"),
                     ("nao_cadastradas", "l", "sales_detail", "unreg"),
                     ("nao_cadastradas", "r", "sales", "unreg")], "check_name", "gold_rows", "silver_rows")
    return out.select("check_name", F.col("gold_rows").cast("bigint").alias("gold_rows"),
                      F.col("silver_rows").cast("bigint").alias("silver_rows")).withColumn(
        "passed", F.coalesce(F.col("gold_rows") == F.col("silver_rows"), F.lit(False)))


def reconcile(lh) -> DataFrame:
    """Q9: revenue and sale counts agree across the three sales tables."""
    out = _pair(lh, [("receita tempo x detalhe", "l", "sales_by_time", "receita"),
                     ("receita tempo x detalhe", "r", "sales_detail", "receita"),
                     ("receita produtos x detalhe", "l", "sales_by_product", "receita"),
                     ("receita produtos x detalhe", "r", "sales_detail", "receita"),
                     ("vendas tempo x detalhe", "l", "sales_by_time", "vendas"),
                     ("vendas tempo x detalhe", "r", "sales_detail", "rows")],
                "check_name", "observed", "expected")
    return out.withColumn("passed", F.col("observed").eqNullSafe(F.col("expected")))


def recompute(lh) -> DataFrame:
    """Q10: stored derived values equal a fresh computation."""
    parts = [profile(lh, t, [mc]).select(F.lit(n).alias("check_name"), F.col(mc).cast("bigint").alias("inconsistent"))
             for n, t, mc in [("ticket_medio", "customer_segments", "bad_ticket"),
                              ("diferenca_pct_vs_media", "price_position", "bad_pct"),
                              ("receita", "sales_detail", "bad_receita")]]
    return _union(parts).withColumn("passed", F.col("inconsistent") == 0)


def segment_bounds(lh) -> DataFrame:
    """Q11: each segment's revenue lies inside its bounds."""
    return _stack(profile(lh, "customer_segments", ["bad_vip", "bad_top", "bad_regular"]),
                  [[F.lit(P.SEG_VIP), F.col("bad_vip").cast("bigint")],
                   [F.lit(P.SEG_TOP), F.col("bad_top").cast("bigint")],
                   [F.lit(P.SEG_REGULAR), F.col("bad_regular").cast("bigint")]],
                  ["check_name", "invalid"]).withColumn("passed", F.col("invalid") == 0)


def rank_dense(lh) -> DataFrame:
    """Q13: ranks run 1..n without gaps or repeats."""
    def one(df, table, col):
        return df.agg(F.lit(table).alias("table_name"), F.lit(col).alias("column_name"),
                      F.max(col).cast("bigint").alias("max_rank"),
                      F.count_distinct(col).alias("distinct_ranks"),
                      F.count(F.lit(1)).alias("rows"))
    out = _union([one(lh.sales_by_product, "sales_by_product", "ranking_receita"),
                  one(lh.customer_segments, "customer_segments", "ranking_receita")])
    return out.withColumn("passed", (F.col("max_rank") == F.col("rows"))
                          & (F.col("distinct_ranks") == F.col("rows")))


def rules_present(lh) -> DataFrame:
    """Q15: all seven rules are in the scorecard and three of them agree with
    a recount from the silver flags."""
    sc = lh.quality_scorecard
    recount = _union([
        profile(lh, t, [mc]).select(F.lit(rule[0]).alias("regra"), F.col(mc).cast("bigint").alias("recount"))
        for rule, t, mc in [(P.RULE_UNREGISTERED, "sales", "unreg"), (P.RULE_EARLY_SALE, "sales", "early"),
                            (P.RULE_SUSPICIOUS, "prices", "suspicious")]])
    expected = lh.spark.createDataFrame([(r[0],) for r in P.SCORECARD_RULES], "regra string")
    got = sc.groupBy("regra").agg(F.count(F.lit(1)).alias("present"),
                                  F.sum("linhas_afetadas").alias("scorecard_count"))
    out = (expected.join(got, "regra", "left").join(recount, "regra", "left")
           .withColumn("present", F.coalesce("present", F.lit(0)).cast("bigint")))
    return out.withColumn("passed", (F.col("present") == 1) & F.coalesce(
        F.col("recount") == F.col("scorecard_count"), F.col("recount").isNull()))


def join_cardinality(lh) -> DataFrame:
    """Declared relationships hold (right side unique per key) and how
    many keys each side lacks."""
    det, seg = lh.sales_detail, lh.customer_segments
    prod, pp = lh.sales_by_product, lh.price_position

    def rel(name, left, right, key):
        lk = left.groupBy(key).agg(F.count(F.lit(1)).alias("l"))
        rk = right.groupBy(key).agg(F.count(F.lit(1)).alias("r"))
        j = lk.join(rk, key, "full")
        return j.agg(F.lit(name).alias("relation"),
                     F.coalesce(F.max("r"), F.lit(0)).alias("max_right_per_key"),
                     F.count_if(F.col("r").isNull()).alias("left_only_keys"),
                     F.count_if(F.col("l").isNull()).alias("right_only_keys"))
    out = _union([rel("vendas_detalhadas->clientes_segmentacao", det, seg, "id_cliente"),
                  rel("vendas_produtos->precos_competitividade", prod, pp, "id_produto")])
    return out.withColumn("passed", F.col("max_right_per_key") <= 1)


def referential_integrity(lh) -> DataFrame:
    """Q7: every sale's customer is a registered one, and every sale that is
    marked as registered has its product in the catalog (in the wide table)."""
    det = lh.sales_detail

    def orphans(name, sales, registry, key):
        # the written registry has one row a key; nothing stands between its
        # shuffle and the join, so that a hot key's sales can be split
        lost = sales.select(key).join(by_shuffle(registry.select(key)), key, "left_anti")
        return lost.agg(F.lit(name).alias("check_name"), F.count(F.lit(1)).alias("orphans"))
    out = _union([orphans("venda -> cliente", det, lh.customers_written, "id_cliente"),
                  orphans("venda cadastrada -> produto", det.where("produto_cadastrado"), lh.catalog_written, "id_produto")])
    return out.withColumn("passed", F.col("orphans") == 0)


def close(observed, expected, rel_tol) -> "F.Column":
    """Q2: |observed - expected| <= rel_tol * |expected| (absolute when the
    expected value is 0), in decimal arithmetic; rel_tol = 0 is Q1 equality.
    Two NULLs agree (e.g. the revenue of an empty segment on both sides)."""
    tol = F.lit(Decimal(str(rel_tol)))
    return (F.when(observed.isNull() | expected.isNull(), observed.isNull() & expected.isNull())
            .when(expected == 0, F.abs(observed) <= tol)
            .otherwise(F.abs(observed - expected) <= tol * F.abs(expected)))


HEADLINE = [("receita_total", "sales_by_time", "receita"), ("total_vendas", "sales_by_time", "vendas"),
            ("total_clientes", "customer_segments", "rows"), ("clientes_vip", "customer_segments", "vip"),
            ("receita_vip", "customer_segments", "vip_receita"), ("produtos_monitorados", "price_position", "rows"),
            ("produtos_mais_caros_todos", "price_position", "dearer"), ("linhas_vendas_temporais", "sales_by_time", "rows")]


def expected_values(lh, expected: dict, rel_tol=0) -> DataFrame:
    """Q1/Q2: headline figures of gold equal given values: metric -> value,
    exactly or within ``rel_tol``.  A value for an unknown metric fails."""
    gold = _long(lh, [(k, "l", t, mc) for k, t, mc in HEADLINE if k in expected]) if set(expected) & {h[0] for h in HEADLINE} else None
    given = lh.spark.createDataFrame([(k, Decimal(str(v))) for k, v in expected.items()], "metric string, expected decimal(38,2)")
    observed = gold.select(F.col("k").alias("metric"), F.col("v").alias("observed")) if gold is not None else \
        lh.spark.createDataFrame([], "metric string, observed decimal(38,2)")
    out = given.join(observed, "metric", "left").select("metric", "observed", "expected")
    return out.withColumn("passed", F.coalesce(close(F.col("observed"), F.col("expected"), rel_tol), F.lit(False)))


def _one_value(df: DataFrame, name: str, expr) -> DataFrame:
    return df.agg(expr.cast("decimal(38,2)").alias("value")).select(F.lit(name).alias("source"), "value")


def baseline(lh, rel_tol=0) -> DataFrame:
    """Q1/Q2: headline figures read from gold equal an independent count
    from silver (exact by default; money compared as decimals, not floats)."""
    p = lh.params
    gold = _long(lh, [*((k, "l", t, mc) for k, t, mc in HEADLINE),
                      ("receita_total", "r", "sales", "receita"), ("total_vendas", "r", "sales", "rows"),
                      ("total_clientes", "r", "customers", "rows")])
    s = lh.sales
    per_cust = s.groupBy("id_cliente").agg(F.sum("receita").alias("r"))
    known = lh.customers.select("id_cliente").join(by_shuffle(per_cust), "id_cliente", "left")
    cust_vip = F.coalesce(F.col("r"), F.lit(0)) >= F.lit(p.vip_from)
    monitored = lh.prices.groupBy("id_produto").agg(F.max("preco_concorrente").alias("mx")) \
        .join(by_shuffle(lh.catalog.select("id_produto", "preco_atual")), "id_produto", "inner")
    cells = s.select("data", "hora", "canal_venda").distinct()
    recounted = _union([
        _one_value(known, "clientes_vip", F.count_if(cust_vip)),
        _one_value(known, "receita_vip", F.sum(F.when(cust_vip, F.col("r")))),
        _one_value(monitored, "produtos_monitorados", F.count(F.lit(1))),
        _one_value(monitored, "produtos_mais_caros_todos", F.count_if(F.col("preco_atual") > F.col("mx"))),
        _one_value(cells, "linhas_vendas_temporais", F.count(F.lit(1))),
    ]).select(F.col("source").alias("k"), F.lit("r").alias("side"), F.col("value").alias("v"))
    out = gold.unionByName(recounted).groupBy("k").agg(
        F.max(F.when(F.col("side") == "l", F.col("v"))).alias("observed"),
        F.max(F.when(F.col("side") == "r", F.col("v"))).alias("expected")).withColumnRenamed("k", "metric")
    return out.withColumn("passed", close(F.col("observed"), F.col("expected"), rel_tol))


FAMILIES = {
    "dq_expectations": expectations, "dq_not_null": not_null, "dq_positive": positive,
    "dq_unique_grain": unique_grain, "dq_domain": domain, "dq_row_preservation": row_preservation,
    "dq_reconcile": reconcile, "dq_recompute": recompute, "dq_segment_bounds": segment_bounds,
    "dq_rank_dense": rank_dense, "dq_rules_present": rules_present,
    "dq_join_cardinality": join_cardinality, "dq_baseline": baseline, "dq_schema": schema_check,
    "dq_referential_integrity": referential_integrity,
}

# Families that scan and group tables themselves.
GROUPING = {"dq_unique_grain", "dq_rank_dense", "dq_join_cardinality", "dq_baseline", "dq_referential_integrity"}


def checks(lh) -> DataFrame:
    """Every check of every family: group, passed, and a message with the
    check's own figures.  Families that group tables are written one by one:
    in one plan, the driver plans all of it anew after each of its stages."""
    profiles(lh)
    parts = []
    for name, fn in FAMILIES.items():
        df = fn(lh)
        figures = F.concat_ws(", ", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("NULL")))
                                      for c in df.columns if c != "passed"])
        rows = df.select(F.lit(name).alias("grupo"), "passed",
                         F.concat(F.when(F.col("passed"), "OK: ").otherwise("FAILED: "), figures).alias("mensagem"))
        parts.append(materialize(rows, name) if name in GROUPING else rows)
    return _union(parts)


def report(lh) -> DataFrame:
    """Q16: per family and for all of them (TOTAL), the number of checks and
    of passed checks."""
    family = F.when(F.grouping("grupo") == 1, "TOTAL").otherwise(F.col("grupo"))
    return checks(lh).rollup("grupo").agg(
        family.alias("nome"), F.count(F.lit(1)).alias("checks"), F.count_if("passed").alias("passed_checks"),
        F.bool_and("passed").alias("all_passed")) \
        .select(F.col("nome").alias("grupo"), "checks", "passed_checks", "all_passed")
