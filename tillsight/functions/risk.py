"""Rule-based fraud risk, in whole per cent."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RiskRules:
    """Thresholds and weights. The defaults are fixed values of the data feed."""

    base: int = 5
    price_above: float = 500
    price_weight: int = 10
    risky_payments: tuple[str, ...] = ("CreditCard", "PayPal")
    payment_weight: int = 5
    age_below: int = 25
    age_weight: int = 5
    income_above: int = 150000
    income_weight: int = -5
    risky_categories: tuple[str, ...] = ("Electronics", "Automotive")
    category_weight: int = 5


def rule_risk(rules: RiskRules = RiskRules()) -> Column:
    """Sum of the weights of the rules that hold; a NULL input satisfies no rule."""

    def weight(condition: Column, points: int) -> Column:
        return F.when(condition, points).otherwise(0)

    return (
        F.lit(rules.base)
        + weight(F.col("price") > rules.price_above, rules.price_weight)
        + weight(F.col("payment_method").isin(*rules.risky_payments), rules.payment_weight)
        + weight(F.col("user_age") < rules.age_below, rules.age_weight)
        + weight(F.col("user_income") > rules.income_above, rules.income_weight)
        + weight(F.col("category").isin(*rules.risky_categories), rules.category_weight)
    )
