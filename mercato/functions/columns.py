"""Column expressions shared by the plans (all JVM-side built-ins)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from mercato import params as P

MONEY = "decimal(10,2)"
MONEY_SUM = "decimal(20,2)"
MONEY_AVG = "decimal(11,2)"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dec(value) -> Column:
    """An exact decimal literal (never a binary float)."""
    return F.lit(Decimal(str(value)))


def money(c) -> Column:
    """Cast to money, decimal(10,2) (half-up; overflow raises under ANSI)."""
    return col(c).cast(MONEY)


def line_revenue(qty, unit_price) -> Column:
    """quantity x unit price, narrowed to money."""
    return (col(qty) * col(unit_price)).cast(MONEY)


def clean_person_name(c) -> Column:
    """Strip a leading courtesy title, then capitalise each word.

    ``initcap`` splits on whitespace only, so hyphen / apostrophe parts keep
    their lower case.
    """
    return F.initcap(F.regexp_replace(col(c), P.TITLE_PATTERN, ""))


def state_code(c) -> Column:
    return F.upper(F.trim(col(c)))


def weekday_name(day_number) -> Column:
    """Weekday label from dayofweek (1 = Sunday); unknown number -> NULL."""
    pairs = []
    for i, name in enumerate(P.WEEKDAYS_PT, start=1):
        pairs += [F.lit(i), F.lit(name)]
    return F.create_map(*pairs)[col(day_number)]


def price_band(price, p: P.Params = P.DEFAULT_PARAMS) -> Column:
    """PREMIUM above band_top, MEDIO above band_mid, else BASICO (NULL too)."""
    c = col(price)
    return (F.when(c > dec(p.band_top), P.BAND_TOP)
            .when(c > dec(p.band_mid), P.BAND_MID)
            .otherwise(P.BAND_LOW))


def segment(revenue, p: P.Params = P.DEFAULT_PARAMS) -> Column:
    c = col(revenue)
    return (F.when(c >= dec(p.vip_from), P.SEG_VIP)
            .when(c >= dec(p.top_from), P.SEG_TOP)
            .otherwise(P.SEG_REGULAR))


def price_class(own, mean, low, high) -> Column:
    """Position of our price against the market; the order of tests matters."""
    o = col(own)
    return (F.when(o > col(high), P.CLASS_ABOVE_ALL)
            .when(o < col(low), P.CLASS_BELOW_ALL)
            .when(o > col(mean), P.CLASS_ABOVE_MEAN)
            .when(o < col(mean), P.CLASS_BELOW_MEAN)
            .otherwise(P.CLASS_AT_MEAN))


def pct_diff(own, ref) -> Column:
    """(own - ref) / ref * 100 rounded to 2 places, decimal arithmetic."""
    return F.round((col(own) - col(ref)) / col(ref) * 100, 2)


def is_suspicious(competitor, own, pct: int = 60) -> Column:
    """competitor < pct% of own, exact decimal compare, NULL -> false."""
    return F.coalesce(col(competitor) * 100 < col(own) * pct, F.lit(False))


def null_false(c) -> Column:
    return F.coalesce(col(c), F.lit(False))


def round_avg(c) -> Column:
    return F.round(F.avg(col(c)), 2)


def calendar(ts) -> dict:
    """Calendar columns of a sale timestamp (zone-free for TIMESTAMP_NTZ)."""
    t = col(ts)
    return {
        "data": F.to_date(t),
        "hora": F.hour(t),
        "dia_semana_num": F.dayofweek(t),
        "dia_semana": weekday_name(F.dayofweek(t)),
    }
