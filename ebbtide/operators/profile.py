"""Per-column statistics of a log, by time window, in long form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.columns import join_by
from ebbtide.operators.ordered import exact_quantiles
from ebbtide.sources.sinks import materialize_once

QUANTILES = {"p25": 0.25, "median": 0.5, "p75": 0.75}
TABLE = ":table"


def window_start(timestamp: str | Column, granularity: str = "month") -> Column:
    """Start of the calendar window; calendar months have no fixed length, so no ``window()``."""
    column = F.col(timestamp) if isinstance(timestamp, str) else timestamp
    return F.date_trunc(granularity, column).cast("timestamp_ntz")


def value_counts(
    df: DataFrame, by: Sequence[str], numeric: Sequence[str], categorical: Sequence[str] = ()
) -> DataFrame:
    """(by, column_name, number, text, n): how often each value of each column occurs.

    One scan and one shuffle serve all columns; a numeric column fills ``number``, any
    other fills ``text``. Repeated values, however hot, are counted on the map side.
    """
    no_number, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("number"), no_text.alias("text"))
               for c in numeric]
    entries += [F.struct(F.lit(c).alias("column_name"), no_number.alias("number"), F.col(c).cast("string").alias("text"))
                for c in categorical]
    long = df.select(*by, F.explode(F.array(*entries)).alias("_e")).select(*by, "_e.*")
    present = F.col("number").isNotNull() | F.col("text").isNotNull()
    return long.filter(present).groupBy(*by, "column_name", "number", "text").agg(F.count("*").alias("n"))


def _wide_statistics(df: DataFrame, by: Sequence[str], numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """All single-pass statistics of all columns in one aggregate, then turned to long form.

    Turning the few result rows, not the input rows, keeps the scan at one row per row.
    """
    def stats(c: str, is_number: bool) -> list[Column]:
        value = F.col(c)
        number = value.cast("double")
        missing = F.sum(F.when(value.isNull(), 1).otherwise(0))
        none = F.lit(None).cast("double")
        return [
            F.count(value).alias(f"{c}__count"),
            (F.lit(100.0) * missing / F.count("*")).alias(f"{c}__percent_nulls"),
            ((F.lit(100.0) * F.sum(F.when(number == 0, 1).otherwise(0)) / F.count("*"))
             if is_number else F.max(none)).alias(f"{c}__percent_zeros"),
            (F.avg(number) if is_number else F.max(none)).alias(f"{c}__avg"),
            (F.stddev_samp(number) if is_number else F.max(none)).alias(f"{c}__stddev"),
            (F.min(number) if is_number else F.max(none)).alias(f"{c}__min"),
            (F.max(number) if is_number else F.max(none)).alias(f"{c}__max"),
        ]

    names = ["count", "percent_nulls", "percent_zeros", "avg", "stddev", "min", "max"]
    columns = [(c, True) for c in numeric] + [(c, False) for c in categorical]
    wide = df.groupBy(*by).agg(*[s for c, is_number in columns for s in stats(c, is_number)])
    packed = F.array(*[
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{c}__{n}").alias(n) for n in names]) for c, _ in columns])
    return wide.select(*by, F.explode(packed).alias("_s")).select(*by, "_s.*")


def column_profile(
    df: DataFrame, by: Sequence[str], numeric: Sequence[str], categorical: Sequence[str] = (),
) -> DataFrame:
    """by, column_name, count, percent_nulls, percent_zeros, avg, stddev, min, max,
    distinct_count and exact quartiles, one row per group and column.

    The value counts behind the quartiles are stored, as they are read several times.
    """
    by = list(by)
    keys = [*by, "column_name"]
    single = _wide_statistics(df, by, numeric, categorical)
    counts = materialize_once(value_counts(df, by, numeric, categorical), "value-counts")
    distinct = counts.groupBy(*keys).agg(F.count("*").alias("distinct_count"))
    out = join_by(single, distinct, keys, "left").withColumn("distinct_count", F.coalesce("distinct_count", F.lit(0)))
    if not numeric:
        return out.withColumns({q: F.lit(None).cast("double") for q in QUANTILES})
    numbers = counts.filter(F.col("number").isNotNull())
    return join_by(out, exact_quantiles(numbers, keys, "number", "n", QUANTILES), keys, "left")


def fill_placeholders(template: str, values: Mapping[str, str]) -> str:
    """Put column names into a metric given as text: {{prediction_col}} and the like."""
    for name, column in values.items():
        template = template.replace("{{" + name + "}}", f"`{column}`")
    if "{{" in template:
        raise ValueError(f"unfilled placeholder in {template}")
    return template


def custom_metrics(
    df: DataFrame, by: Sequence[str], templates: Mapping[str, str], values: Mapping[str, str]
) -> DataFrame:
    """User aggregates, one double per group and metric."""
    return df.groupBy(*by).agg(*[
        F.expr(fill_placeholders(text, values)).cast("double").alias(name) for name, text in templates.items()])
