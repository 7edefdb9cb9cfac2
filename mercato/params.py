"""Business thresholds and fixed values.

Every threshold is a parameter of the plans; the defaults are the values the
published tables were built with.  ``TESTDATA_PARAMS`` are the thresholds used
when the library runs over the driver's TPC-H-ish test tables (see
``mercato.sources.testdata``), whose prices and revenues live on another scale.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

# ---------------------------------------------------------------------------
# FIXED VALUES - must equal the published tables for identical results.
# ---------------------------------------------------------------------------

# Courtesy titles stripped from customer names (title, dot, whitespace).
TITLE_PATTERN = r"^(Sr|Sra|Srta|Dr|Dra)\.\s+"
# The scorecard counts names with a title, dot and one space.
SCORECARD_TITLE_PATTERN = r"^(Sr|Sra|Srta|Dr|Dra)[.] "

# Weekday labels by dayofweek number (1 = Sunday ... 7 = Saturday).
WEEKDAYS_PT = ["Domingo", "Segunda", "Terça", "Quarta", "Quinta", "Sexta", "Sábado"]

# Brazilian states: code, name, region.
BRAZIL_STATES = [
    ("AC", "Acre", "Norte"),
    ("AM", "Amazonas", "Norte"),
    ("AP", "Amapá", "Norte"),
    ("PA", "Pará", "Norte"),
    ("RO", "Rondônia", "Norte"),
    ("RR", "Roraima", "Norte"),
    ("TO", "Tocantins", "Norte"),
    ("AL", "Alagoas", "Nordeste"),
    ("BA", "Bahia", "Nordeste"),
    ("CE", "Ceará", "Nordeste"),
    ("MA", "Maranhão", "Nordeste"),
    ("PB", "Paraíba", "Nordeste"),
    ("PE", "Pernambuco", "Nordeste"),
    ("PI", "Piauí", "Nordeste"),
    ("RN", "Rio Grande do Norte", "Nordeste"),
    ("SE", "Sergipe", "Nordeste"),
    ("DF", "Distrito Federal", "Centro-Oeste"),
    ("GO", "Goiás", "Centro-Oeste"),
    ("MT", "Mato Grosso", "Centro-Oeste"),
    ("MS", "Mato Grosso do Sul", "Centro-Oeste"),
    ("ES", "Espírito Santo", "Sudeste"),
    ("MG", "Minas Gerais", "Sudeste"),
    ("RJ", "Rio de Janeiro", "Sudeste"),
    ("SP", "São Paulo", "Sudeste"),
    ("PR", "Paraná", "Sul"),
    ("RS", "Rio Grande do Sul", "Sul"),
    ("SC", "Santa Catarina", "Sul"),
]

# Sales channels.
CHANNELS = ["ecommerce", "loja_fisica"]

# Price bands, customer segments, price classes.
BAND_TOP, BAND_MID, BAND_LOW = "PREMIUM", "MEDIO", "BASICO"
SEG_VIP, SEG_TOP, SEG_REGULAR = "VIP", "TOP_TIER", "REGULAR"
SEGMENTS = [SEG_VIP, SEG_TOP, SEG_REGULAR]
CLASS_ABOVE_ALL = "MAIS_CARO_QUE_TODOS"
CLASS_BELOW_ALL = "MAIS_BARATO_QUE_TODOS"
CLASS_ABOVE_MEAN = "ACIMA_DA_MEDIA"
CLASS_BELOW_MEAN = "ABAIXO_DA_MEDIA"
CLASS_AT_MEAN = "NA_MEDIA"
PRICE_CLASSES = [CLASS_ABOVE_ALL, CLASS_ABOVE_MEAN, CLASS_AT_MEAN, CLASS_BELOW_MEAN, CLASS_BELOW_ALL]

# Labels for sales of products missing from the catalog.
UNREGISTERED_NAME = "Produto não cadastrado"
UNREGISTERED_LABEL = "Não cadastrado"

# Quality scorecard: rule text, source table, severity (in table order).
RULE_UNREGISTERED = ("Venda de produto não cadastrado", "silver.vendas", "ALERTA")
RULE_EARLY_SALE = ("Venda anterior à criação do produto", "silver.vendas", "ALERTA")
RULE_SUSPICIOUS = ("Preço de concorrente abaixo de 60% do nosso", "silver.preco_competidores", "ALERTA")
RULE_BRAND = ("Marca do produto diferente da marca citada no nome", "silver.produtos", "ALERTA")
RULE_SAME_NAME = ("Produto com nome igual ao de outro produto", "silver.produtos", "INFORMATIVO")
RULE_THIN = ("Produto monitorado em menos de 4 concorrentes", "silver.preco_competidores", "INFORMATIVO")
RULE_TITLE = ("Nome de cliente com pronome de tratamento", "silver.clientes", "CORRIGIDO")
SCORECARD_RULES = [RULE_UNREGISTERED, RULE_EARLY_SALE, RULE_SUSPICIOUS, RULE_BRAND,
                   RULE_SAME_NAME, RULE_THIN, RULE_TITLE]

# Expectations: rule name, predicate of a good row, action; by silver table.
SILVER_EXPECTATIONS = {
    "clientes": [
        ("id_cliente_preenchido", "id_cliente IS NOT NULL", "fail"),
        ("cliente_com_regiao", "regiao IS NOT NULL", "fail"),
    ],
    "produtos": [
        ("id_produto_preenchido", "id_produto IS NOT NULL", "fail"),
        ("preco_positivo", "preco_atual > 0", "fail"),
    ],
    "vendas": [
        ("campos_obrigatorios",
         "id_venda IS NOT NULL AND data_venda IS NOT NULL AND id_cliente IS NOT NULL "
         "AND id_produto IS NOT NULL AND quantidade IS NOT NULL AND preco_unitario IS NOT NULL", "fail"),
        ("quantidade_positiva", "quantidade > 0", "fail"),
        ("preco_positivo", "preco_unitario > 0", "fail"),
        ("canal_conhecido", "canal_venda IN ('ecommerce', 'loja_fisica')", "fail"),
        ("produto_cadastrado", "produto_cadastrado", "warn"),
        ("venda_depois_do_cadastro", "venda_depois_do_cadastro", "warn"),
        ("venda_nao_antecede_cadastro", "NOT venda_antes_do_cadastro", "warn"),
    ],
    "preco_competidores": [
        ("id_produto_preenchido", "id_produto IS NOT NULL", "fail"),
        ("preco_positivo", "preco_concorrente > 0", "fail"),
        ("preco_plausivel", "NOT preco_suspeito", "warn"),
    ],
}

# Labels of the "above market" business question.
STATUS_TO_CONFIRM, STATUS_CONFIRMED = "a confirmar", "confirmado"

# ---------------------------------------------------------------------------
# Parameters
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Params:
    """Thresholds of the business rules (defaults = published values)."""

    band_top: Decimal = Decimal("1000")       # price > band_top -> PREMIUM
    band_mid: Decimal = Decimal("500")        # price > band_mid -> MEDIO
    vip_from: Decimal = Decimal("22000")      # revenue >= vip_from -> VIP
    top_from: Decimal = Decimal("17000")      # revenue >= top_from -> TOP_TIER
    suspicious_pct: int = 60                  # competitor < pct% of ours -> suspicious
    expected_competitors: int = 4             # fewer -> thin competition
    top_n: int = 10                           # default ranking length
    states: list = field(default_factory=lambda: list(BRAZIL_STATES))


DEFAULT_PARAMS = Params()

# Thresholds for the driver's test tables: part prices are 900-999.90 and
# per-customer revenue is in the millions (see mercato.sources.testdata).
TESTDATA_PARAMS = Params(
    band_top=Decimal("990"),
    band_mid=Decimal("950"),
    vip_from=Decimal("2100000"),
    top_from=Decimal("1580000"),
    expected_competitors=7,
)
