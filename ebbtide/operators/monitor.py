"""Baseline, inference log and monitor refresh."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.columns import yes_to_double
from ebbtide.functions.hashing import uniform
from ebbtide.operators.drift import drift
from ebbtide.operators.features import avg_price_increase, split_columns_by_type
from ebbtide.operators.profile import TABLE, column_profile, custom_metrics, window_start
from ebbtide.operators.quality import quality
from ebbtide.operators.scoring import stamp_window, standin_score

Scorer = Callable[[DataFrame], DataFrame]

HIGH_RISK = "100.0D * sum(case when {{prediction_col}} = 1 then 1 else 0 end) / count(*)"
LOG_COLUMNS = ("prediction", "churn_probability", "inference_timestamp", "model_id", "churn_label")


def labelled_split(labels: DataFrame, features: DataFrame, split: str) -> DataFrame:
    """Customers of one split with features, the on-demand feature and the label as a double."""
    rows = labels.filter(F.col("split") == split).select(
        "customer_id", yes_to_double(F.col("churn")).alias("churn_label"))
    return rows.join(features, "customer_id").withColumn("avg_price_increase", avg_price_increase())


def _ordered(df: DataFrame) -> DataFrame:
    body = [c for c in df.columns if c not in LOG_COLUMNS and c != "customer_id"]
    return df.select("customer_id", *body, *LOG_COLUMNS)


def build_baseline(
    labels: DataFrame, features: DataFrame, scorer: Scorer = standin_score, model_id: str = "churn_model"
) -> DataFrame:
    """The scored train split: the reference distribution of the monitor."""
    return _ordered(stamp_window(scorer(labelled_split(labels, features, "train")), "2025-06-01", model_id))


# Fixed values of the simulated drift: charges in percent, months added, share moved to a monthly contract.
MONTHLY_PERCENT, TOTAL_PERCENT, MONTHS, MONTHLY_SHARE = 115, 120, 6, 0.70


def simulate_drift(rows: DataFrame, tag: str = "drift") -> DataFrame:
    """Charges up 15% and 20%, tenure up 6 months, 70% forced to a monthly contract.

    Money is raised in whole cents, rounding half up.
    """
    def raised(name: str, percent: int):
        whole = F.round(F.col(name) * 100).cast("bigint")
        return F.floor((whole * percent + 50) / 100).cast("double") / 100

    return rows.withColumns({
        "monthly_charges": raised("monthly_charges", MONTHLY_PERCENT),
        "total_charges": raised("total_charges", TOTAL_PERCENT),
        "tenure_months": F.col("tenure_months") + MONTHS,
        "contract_type": F.when(uniform("customer_id", tag) < MONTHLY_SHARE, "Month-to-month").otherwise(
            F.col("contract_type")),
    }).withColumn("avg_price_increase", F.col("monthly_charges") / F.greatest("tenure_months", F.lit(1)))


def build_inference_log(
    labels: DataFrame, features: DataFrame, scorer: Scorer = standin_score, model_id: str = "churn_model"
) -> DataFrame:
    """The test split scored in two windows, the second with drifted features."""
    rows = labelled_split(labels, features, "test")
    first = stamp_window(scorer(rows), "2025-07-01", model_id)
    second = stamp_window(scorer(simulate_drift(rows)), "2025-08-01", model_id)
    return _ordered(first).unionByName(_ordered(second))


def window_manifest(log: DataFrame) -> DataFrame:
    return log.groupBy("inference_timestamp").agg(
        F.count("*").alias("rows"), (F.avg("prediction") * 100).alias("pct_predicted_churn"),
        F.count("churn_label").alias("labeled_rows"))


@dataclass(frozen=True)
class MonitorConfig:
    timestamp: str = "inference_timestamp"
    granularity: str = "month"
    model_id: str = "model_id"
    prediction: str = "prediction"
    probability: str | None = "churn_probability"
    label: str | None = "churn_label"
    keys: tuple[str, ...] = ("customer_id",)
    slices: tuple[str, ...] = ()
    custom: Mapping[str, str] = field(default_factory=lambda: {"high_risk_percentage": HIGH_RISK})


def profiled_columns(log: DataFrame, config: MonitorConfig) -> tuple[list[str], list[str]]:
    skip = (*config.keys, config.timestamp, config.model_id, "window", "slice_value")
    return split_columns_by_type(log, skip)


def profile(log: DataFrame, config: MonitorConfig = MonitorConfig(), log_type: str = "INPUT") -> DataFrame:
    """Statistics of every column, quality on the prediction row, custom metrics on the table row."""
    numeric, categorical = profiled_columns(log, config)
    windowed = log.withColumn(
        "window", window_start(config.timestamp, config.granularity) if log_type == "INPUT"
        else F.lit(None).cast("timestamp_ntz"))
    out = None
    for slice_key in (None, *config.slices):
        rows = windowed.withColumn(
            "slice_value", F.lit(None).cast("string") if slice_key is None else F.col(slice_key).cast("string"))
        part = _profile_slice(rows, config, numeric, categorical).withColumn(
            "slice_key", F.lit(slice_key).cast("string"))
        out = part if out is None else out.unionByName(part)
    return out.withColumns({"log_type": F.lit(log_type), "granularity": F.lit(f"1 {config.granularity}")})


def _profile_slice(
    rows: DataFrame, config: MonitorConfig, numeric: list[str], categorical: list[str]
) -> DataFrame:
    by = ["_group"]
    names = ["window", config.model_id, "slice_value"]
    # Null-safe grouping: window and slice are null in some rows, so the group is one text key.
    keyed = rows.withColumn("_group", F.to_json(F.struct(*names)))
    groups = keyed.groupBy("_group").agg(*[F.max(n).alias(n) for n in names], F.count("*").alias("_rows"))
    columns = column_profile(keyed, by, numeric, categorical)
    table = groups.select("_group", F.lit(TABLE).alias("column_name"), F.col("_rows").alias("count"))
    values = {"prediction_col": config.prediction, "label_col": config.label or "", "timestamp_col": config.timestamp,
              "model_id_col": config.model_id}
    extra = custom_metrics(keyed, by, config.custom, values) if config.custom else None
    if extra is not None:
        table = table.join(extra, "_group", "left")
    if config.label:
        q = quality(keyed, config.label, config.prediction, config.probability, by).withColumn(
            "column_name", F.lit(config.prediction))
        columns = columns.join(q, [*by, "column_name"], "left")
    return columns.unionByName(table, allowMissingColumns=True).join(
        groups.drop("_rows"), "_group").drop("_group").withColumnRenamed(config.model_id, "model_id")


def monitor_refresh(
    log: DataFrame, baseline: DataFrame, config: MonitorConfig = MonitorConfig()
) -> tuple[DataFrame, DataFrame]:
    """(profile metrics, drift metrics) of a log against its baseline."""
    numeric, categorical = profiled_columns(log, config)
    # Predicted and true classes are classes, however they are stored.
    classes = [c for c in (config.prediction, config.label) if c in numeric]
    metrics = profile(log, config).unionByName(profile(baseline, config, "BASELINE"))
    moved = drift(log, baseline, config.timestamp, [c for c in numeric if c not in classes],
                  [*categorical, *classes], config.granularity, config.slices, config.model_id)
    return metrics, moved
