"""The additive churn rules: a score, and the list of rules that fired."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CAP = 0.85


def rules() -> list[tuple[str, Column, float]]:
    """(reason, condition, weight). The weights and limits are fixed values of the score."""
    contract, tenure, charge = F.col("contract_type"), F.col("tenure_months"), F.col("monthly_charges")
    return [
        ("month-to-month contract", contract == "Month-to-month", 0.25),
        ("one year contract", contract == "One year", 0.05),
        ("tenure under 6 months", tenure < 6, 0.15),
        ("tenure under 12 months", (tenure >= 6) & (tenure < 12), 0.08),
        ("charges above 80", charge > 80, 0.10),
        ("charges above 60", (charge > 60) & (charge <= 80), 0.05),
        ("no security and no support", (F.col("online_security") == "No") & (F.col("tech_support") == "No"), 0.08),
        ("pays by electronic check", F.col("payment_method") == "Electronic check", 0.06),
        ("fiber optic line", F.col("internet_service") == "Fiber optic", 0.05),
    ]


def churn_score() -> Column:
    total = F.lit(0.0)
    for _, condition, weight in rules():
        total = total + F.when(condition, F.lit(weight)).otherwise(F.lit(0.0))
    return F.least(F.lit(CAP), total)


def explain_risk() -> Column:
    """The reasons that apply, in rule order; an empty text when none does."""
    return F.concat_ws("; ", *[F.when(condition, F.lit(reason)) for reason, condition, _ in rules()])
