"""Exploratory measures: counts, shares, averages and ratios by group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def share_of_total(df: DataFrame, *keys: str, digits: int = 1) -> DataFrame:
    """Group counts and their percentage of all rows.

    The total is a scalar subquery over the grouped counts, so no single task has to
    take in every group when the key has many values.
    """
    grouped = count_by(df, *keys, name="n")
    total = grouped.agg(F.sum("n").alias("total")).scalar()
    return grouped.withColumn("pct", F.round(F.col("n") * F.lit(100.0) / total, digits))


def share_by_window(counts: DataFrame, n: str = "n", digits: int = 6) -> DataFrame:
    """The same with SUM(..) OVER (), for a grouped frame over a closed set of values."""
    everything = Window.partitionBy()
    return counts.withColumn("pct", F.round(F.col(n) * F.lit(100.0) / F.sum(n).over(everything), digits))


def rate(condition: Column) -> Column:
    """Mean of a condition as a double; a decimal literal would cut the digits."""
    return F.avg(F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0)))


def tickets_per_customer(customers: DataFrame, tickets: DataFrame, by: str) -> DataFrame:
    """Tickets, customers and tickets per customer in each group.

    Tickets are counted per customer before the join, so that the join never multiplies
    customers by tickets and a customer with very many tickets costs one row.
    """
    per_customer = count_by(tickets, "customer_id", name="_n")
    return (
        customers.select("customer_id", by).join(per_customer, "customer_id", "left")
        .groupBy(by)
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("tickets"),
            F.countDistinct("customer_id").alias("customers"),
        )
        .withColumn("tickets_per_customer", F.col("tickets").cast("double") / F.col("customers"))
    )


def first_k_per_class(df: DataFrame, class_column: str, key: str, k: dict) -> DataFrame:
    """The k first rows of each class by key; each map task keeps only k rows per class."""
    order = Window.partitionBy(class_column).orderBy(key)
    wanted = F.create_map(*[F.lit(x) for pair in k.items() for x in pair])
    return (
        df.filter(F.col(class_column).isin(*k))
        .withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= max(k.values()))
        .filter(F.col("_rank") <= wanted[F.col(class_column)])
        .drop("_rank")
    )


def latest_per(df: DataFrame, key: str, at: str, tie: str) -> DataFrame:
    """The newest row of each key, by ``max_by`` rather than a window, so that a hot key is
    reduced on the map side. Ties in time go to the larger ``tie``."""
    rest = [c for c in df.columns if c != key]
    newest = F.max_by(F.struct(*rest), F.struct(at, tie)).alias("_row")
    return df.groupBy(key).agg(newest).select(key, "_row.*")
