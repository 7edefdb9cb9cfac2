"""Small hand-written inputs in the four bronze shapes (FIXTURES.md §3)."""

from datetime import datetime as dt

from mercato.schemas import BRONZE


def customers(spark, rows):
    return spark.createDataFrame(rows, BRONZE["clientes"])


def products(spark, rows):
    return spark.createDataFrame(rows, BRONZE["produtos"])


def sales(spark, rows):
    return spark.createDataFrame(rows, BRONZE["vendas"])


def prices(spark, rows):
    return spark.createDataFrame(rows, BRONZE["preco_competidores"])


T0 = dt(2025, 12, 20, 10, 0, 0)

CUSTOMERS = [
    ("cus_1", "Sr. joão silva", " sp ", "Brasil", dt(2024, 1, 1)),
    ("cus_1", "Sr. joão da silva", "SP", "Brasil", dt(2024, 2, 1)),      # later copy survives
    ("cus_2", "Dra.  ana-maria o'neil", "rj", "Brasil", dt(2024, 1, 1)),  # two spaces, hyphen, apostrophe
    ("cus_3", "Sr maria", "MG", "Brasil", dt(2024, 1, 1)),               # title without dot: kept
    ("cus_4", "sra. paula", "BA", "Brasil", dt(2024, 1, 1)),             # lower-case title: kept
    ("cus_5", "  Srta. carla  ", "PR", "Brasil", dt(2024, 1, 1)),        # padded
    ("cus_6", "Pedro", "XX", "Brasil", dt(2024, 1, 1)),                  # unknown state
]

PRODUCTS = [
    ("prd_1", " Fone Acme Bolt ", "Audio", "Acme", 500.00, dt(2025, 1, 1)),
    ("prd_2", "Cabo", "Audio", "Bolt", 500.01, dt(2025, 1, 1)),
    ("prd_3", "Tv", "Video", "Zeta", 1000.00, dt(2025, 12, 20, 10, 0, 0)),
    ("prd_4", "Tv grande", "Video", "Zeta", 1000.01, None),              # NULL creation time
    ("prd_5", "Caixa 100% som", "Audio", "100%", 5.15, dt(2025, 1, 1)),
    ("prd_6", "Sem marca", "Casa", None, 80.00, dt(2025, 1, 1)),
    ("prd_6", "Sem marca velho", "Casa", None, 70.00, dt(2024, 1, 1)),   # older copy dropped
]

SALES = [
    ("sal_1", T0, "cus_1", "prd_1", "ecommerce", 2, 500.00),
    ("sal_1", dt(2025, 12, 19), "cus_1", "prd_1", "ecommerce", 1, 500.00),   # older duplicate
    ("sal_2", T0, "cus_2", "prd_3", "loja_fisica", 1, 1000.00),              # exactly at creation
    ("sal_3", dt(2025, 12, 20, 9, 59, 59), "cus_2", "prd_3", "ecommerce", 1, 1000.00),  # 1 s before
    ("sal_4", T0, "cus_3", "prd_4", "ecommerce", 1, 1000.01),                # registered, NULL creation
    ("sal_5", T0, "cus_3", "prd_999", "ecommerce", 3, 10.00),                # unregistered
    ("sal_6", dt(2025, 12, 21, 23, 0), "cus_4", "prd_2", "loja_fisica", 10, 500.01),
]

PRICES = [
    ("prd_5", "A", 3.09, "2026-01-11 10:00:00"),      # exactly 60 %: not suspicious
    ("prd_5", "B", 3.08, "2026-01-11 10:00:00"),      # one cent below: suspicious
    ("prd_1", "A", 400.00, "2026-01-11 10:00:00"),    # we are dearer than all
    ("prd_2", "A", 600.00, "2026-01-11 10:00:00"),    # we are cheaper than all
    ("prd_3", "A", 1000.00, "2026-01-11 10:00:00"),   # equal
    ("prd_4", "A", 1000.00, "2026-01-10 10:00:00"),
    ("prd_4", "A", 1000.02, "2026-01-11 10:00:00"),   # latest collection survives
    ("prd_4", "B", 1000.01, "2026-01-11 10:00:00"),   # mean 1000.015 -> 1000.02
    ("prd_777", "A", 10.00, "2026-01-11 10:00:00"),   # unknown product
]
