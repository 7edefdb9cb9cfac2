"""Row-level expectations (X1-X3): fail-set and warn-set rules.

A rule is a SQL predicate that a good row satisfies.  A row whose predicate
is FALSE *or NULL* violates it.  Every rule is evaluated once a row, into a
bitmask (bit i: rule i is violated); counters and the row's destination come
from the mask, so one write of the table feeds all three: the good rows, the
rows set aside, and the counters, observed on that write.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

FAIL, WARN = "fail", "warn"
#: The rules that a row violates, as bits; and where it goes.
MASK, ROUTE = "regras_violadas", "destino"
GOOD, QUARANTINE = "good", "quarantine"


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str
    action: str = FAIL


class ExpectationFailed(Exception):
    pass


def holds(rule: Rule) -> Column:
    return F.coalesce(F.expr(rule.predicate), F.lit(False))


def violated(rule: Rule) -> Column:
    return F.count_if(~holds(rule))


def mask(rules: Sequence[Rule]) -> Column:
    """Bit i is set where rule i is violated."""
    if len(rules) > 63:
        raise ValueError("a mask holds at most 63 rules")
    bits = [F.when(holds(r), F.lit(0)).otherwise(F.lit(1 << i)).cast("long") for i, r in enumerate(rules)]
    out = F.lit(0).cast("long")
    for b in bits:
        out = out.bitwiseOR(b)
    return out


def breaks(rules: Sequence[Rule], some: Sequence[Rule]) -> Column:
    """Whether the stored mask of ``rules`` has the bit of any of ``some``."""
    names = {r.name for r in some}
    wanted = sum(1 << i for i, r in enumerate(rules) if r.name in names)
    return F.col(MASK).bitwiseAND(F.lit(wanted).cast("long")) != 0


def broken_rules(rules: Sequence[Rule]) -> Column:
    """Names of the rules in the stored mask, in the order of their declaration."""
    return F.array_compact(F.array(*[F.when(breaks(rules, [r]), F.lit(r.name)) for r in rules]))


def routed(df: DataFrame, rules: Sequence[Rule], name: str, set_aside: bool = False) -> tuple[DataFrame, Observation]:
    """``df`` with its mask and destination, and the counters that its next action fills.

    With ``set_aside`` rows that violate a fail-set rule go to quarantine;
    rows that violate warn-set rules only are good.  Write the result
    partitioned by ``ROUTE``: good and quarantined rows are then two sets of
    files of one job over one scan.
    """
    masked = df.withColumn(MASK, mask(rules))
    aside = breaks(rules, [r for r in rules if r.action == FAIL]) if set_aside else F.lit(False)
    out = masked.withColumn(ROUTE, F.when(aside, QUARANTINE).otherwise(GOOD))
    obs = Observation(name)
    counters = [F.count_if(breaks(rules, [r])).alias(r.name) for r in rules]
    return out.observe(obs, F.count(F.lit(1)).alias("_rows"), F.count_if(F.col(ROUTE) == QUARANTINE).alias("_quarantined"), *counters), obs


def check_observed(obs: Observation, rules: Sequence[Rule], set_aside: bool = False) -> dict:
    """All counters; raises when a fail-set rule was violated by a row that wasn't set aside."""
    metrics = obs.get
    failed = [r.name for r in rules if r.action == FAIL and metrics.get(r.name, 0) > 0]
    if failed and not set_aside:
        raise ExpectationFailed(f"fail-set expectations violated: {failed} ({metrics})")
    return metrics
