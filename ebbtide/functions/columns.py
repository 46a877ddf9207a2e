"""Row-wise column expressions shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPTIONAL_SERVICES = (
    "streaming_tv", "streaming_movies", "online_security",
    "online_backup", "device_protection", "tech_support",
)


def join_by(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join on equal keys of the same names in which null equals null, so that a null group keeps its rows."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in keys])


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """a / b, and 0.0 when b is null, zero or negative."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def count_yes(columns=OPTIONAL_SERVICES) -> Column:
    """How many of the columns say Yes; a null counts as No."""
    return reduce(
        lambda a, b: a + b,
        [F.when(F.col(c) == "Yes", 1).otherwise(0) for c in columns],
    ).cast("int")


def tenure_bucket(tenure: Column) -> Column:
    return (
        F.when(tenure <= 12, "0-12 months")
        .when(tenure <= 24, "13-24 months")
        .when(tenure <= 48, "25-48 months")
        .otherwise("49+ months")
    )


def yes_to_double(flag: Column) -> Column:
    return F.when(flag == "Yes", 1.0).otherwise(0.0)


def clamp(value: Column, low: float, high: float) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), value))


def pad_id(prefix: str, number: Column, width: int) -> Column:
    """PREFIX-000n; numbers wider than the width keep all their digits."""
    text = number.cast("string")
    return F.concat(F.lit(prefix + "-"), F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0")))


def fill_template(template: Column, values: dict[str, Column]) -> Column:
    """Replace each {name} in the template by its column."""
    for name, value in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), value.cast("string"))
    return template


def cents(amount: Column) -> Column:
    """Money as whole cents: exact sums and no rounding ties."""
    return F.floor(amount * 100 + 0.5).cast("bigint")
