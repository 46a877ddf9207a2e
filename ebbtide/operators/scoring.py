"""The rule that stands in for a trained model, and window stamps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.columns import clamp
from ebbtide.functions.hashing import uniform


def standin_score(customers: DataFrame, tag: str = "score") -> DataFrame:
    """Add churn_probability and prediction from contract, tenure and a keyed draw."""
    # Fixed values of the scoring rule.
    base, monthly_contract, short_tenure, noise, low, high = 0.15, 0.35, 0.20, 0.30, 0.01, 0.99
    score = (
        F.lit(base)
        + F.when(F.col("contract_type") == "Month-to-month", F.lit(monthly_contract)).otherwise(F.lit(0.0))
        + F.when(F.col("tenure_months") < 12, F.lit(short_tenure)).otherwise(F.lit(0.0))
        + (uniform("customer_id", tag) - F.lit(0.5)) * F.lit(noise)
    )
    return customers.withColumn("churn_probability", clamp(score, low, high)).withColumn(
        "prediction", F.when(F.col("churn_probability") >= 0.5, 1.0).otherwise(0.0))


def stamp_window(scored: DataFrame, timestamp: str, model_id: str) -> DataFrame:
    return scored.withColumns({
        "inference_timestamp": F.lit(timestamp).cast("timestamp_ntz"), "model_id": F.lit(model_id)})
