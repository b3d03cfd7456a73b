"""Risk rules as data: reasons and score come from one definition."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    reason: str
    column: str
    threshold: float
    weight: int

    def fires(self) -> Column:
        return F.col(self.column) >= F.lit(self.threshold)


# Reason, feature, threshold (inclusive) and weight; weights add up to 100.
DEFAULT_RULES = (
    Rule("high_card_velocity_5m", "tx_by_card_5m", 5, 24),
    Rule("many_merchants_10m", "distinct_merchants_10m", 4, 18),
    Rule("many_countries_1h", "distinct_countries_1h", 3, 18),
    Rule("device_shared_by_cards", "distinct_cards_per_device", 4, 16),
    Rule("high_declined_ratio_1h", "declined_ratio_1h", 0.45, 12),
    Rule("high_amount", "amount", 1200, 12),
)


def reasons(rules: tuple[Rule, ...] = DEFAULT_RULES) -> Column:
    """Names of the rules that fire, in rule order."""
    none = F.array().cast("array<string>")
    return F.concat(*[F.when(r.fires(), F.array(F.lit(r.reason))).otherwise(none) for r in rules])


def risk_score(rules: tuple[Rule, ...] = DEFAULT_RULES) -> Column:
    """Sum of the weights of the rules that fire; a null feature scores 0."""
    total = F.lit(0)
    for r in rules:
        total = total + F.when(r.fires(), F.lit(r.weight)).otherwise(F.lit(0))
    return total
