"""Profiles kept by mergeable sketches, so that a refresh reads only what is new.

A partial profile is one row for each group and column: exact counts, moments and bounds, a quantile sketch (KLL), a
distinct-count sketch (HLL) and a frequent-items sketch. Partial profiles of disjoint rows merge into that of all of
them, in any order, so new files are profiled alone, their rows are appended to a stored state, and the profile is a
merge over that small state. Counts, nulls, zeros, mean, deviation, least and most are exact. Errors of the others:

* quantiles: the rank of the value given is off by at most ``RANK_ERROR`` of all rows, with 99 % confidence;
* distinct values: relative standard error ``DISTINCT_ERROR``;
* frequent values: a count is too high by at most the sketch's own bound, and every value above it is listed.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Size of the quantile sketch, and the rank error the published formula of KLL gives for it (2.296 / k ** 0.9021).
KLL_K, RANK_ERROR = 800, 0.0056
#: Logarithm of the registers of the distinct-count sketch, and its error (1.04 / sqrt(registers)).
HLL_LG, DISTINCT_ERROR = 14, 0.0082
#: Values that a frequent-items sketch follows.
FOLLOWED = 1024
QUANTILES = {"p25": 0.25, "median": 0.5, "p75": 0.75}


def _partials(column: str, number: bool) -> Column:
    """All partial statistics of one column as a struct of aggregates."""
    value = F.col(f"`{column}`")
    as_number = value.cast("double") if number else F.lit(None).cast("double")
    as_text = value.cast("string")
    kept = F.when(as_number.isNotNull() & ~F.isnan(as_number), as_number)
    none = F.lit(None).cast("binary")
    return F.struct(
        F.lit(column).alias("column_name"), F.lit(number).alias("is_number"), F.count("*").alias("rows"), F.count(value).alias("count"),
        F.sum(F.when(as_number == 0, 1).otherwise(0)).alias("zeros"), F.count(kept).alias("n"), F.avg(kept).alias("mean"),
        (F.var_pop(kept) * F.count(kept)).alias("m2"), F.min(kept).alias("least"), F.max(kept).alias("most"),
        (F.kll_sketch_agg_double(kept, KLL_K) if number else none).alias("quantiles"),
        F.hll_sketch_agg(as_text, HLL_LG).alias("distinct"),
        F.expr(f"approx_top_k_accumulate(cast(`{column.replace('`', '``')}` as string), {FOLLOWED})").alias("frequent"))


def partial_profile(df: DataFrame, by: Sequence[str], numeric: Sequence[str], categorical: Sequence[str] = ()) -> DataFrame:
    """by and the partial statistics of every column, from one scan and one aggregate; sketches merge on the map side."""
    columns = [(c, True) for c in numeric] + [(c, False) for c in categorical]
    wide = df.groupBy(*by).agg(*[_partials(c, number).alias(f"_p{i}") for i, (c, number) in enumerate(columns)])
    return wide.select(*by, F.explode(F.array(*[f"_p{i}" for i in range(len(columns))])).alias("_p")).select(*by, "_p.*")


def merged(state: DataFrame, by: Sequence[str]) -> DataFrame:
    """Partial statistics of disjoint rows as those of all of them.

    Moments are merged pair by pair in the order of their means, which loses nothing where means are large. What is
    collected for a group is one triple for each partial profile, as many as refreshes since the state was compacted.
    """
    part = F.struct("mean", "n", "m2")
    joined = state.groupBy(*by, "column_name", "is_number").agg(
        F.sum("rows").alias("rows"), F.sum("count").alias("count"), F.sum("zeros").alias("zeros"),
        F.sort_array(F.collect_list(F.when(F.col("n") > 0, part))).alias("_parts"), F.min("least").alias("least"), F.max("most").alias("most"),
        F.kll_merge_agg_double("quantiles", KLL_K).alias("quantiles"), F.hll_union_agg("distinct").alias("distinct"),
        F.expr("approx_top_k_combine(frequent, %d)" % FOLLOWED).alias("frequent"))
    start = F.struct(F.lit(0.0).alias("mean"), F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("m2"))

    def both(a: Column, b: Column) -> Column:
        n, gap = a["n"] + b["n"], b["mean"] - a["mean"]
        return F.struct((a["mean"] + gap * b["n"] / n).alias("mean"), n.alias("n"),
                        (a["m2"] + b["m2"] + gap * gap * a["n"] * b["n"] / n).alias("m2"))

    moments = joined.withColumn("_m", F.aggregate("_parts", start, both))
    return moments.select(*by, "column_name", "is_number", "rows", "count", "zeros", F.col("_m.n").alias("n"),
                          F.when(F.col("_m.n") > 0, F.col("_m.mean")).alias("mean"), F.when(F.col("_m.n") > 0, F.col("_m.m2")).alias("m2"),
                          "least", "most", "quantiles", "distinct", "frequent")


def read_profile(state: DataFrame, by: Sequence[str], frequent: int = 3, quantiles: Mapping[str, float] = QUANTILES) -> DataFrame:
    """by, column_name, count, percent_nulls, percent_zeros, avg, stddev, min, max, distinct_count, quantiles, frequent values."""
    m = merged(state, by)
    number = F.col("is_number") & (F.col("n") > 0)
    share = lambda c: F.lit(100.0) * c / F.col("rows")
    return m.select(
        *by, "column_name", "count", share(F.col("rows") - F.col("count")).alias("percent_nulls"),
        F.when(F.col("is_number"), share(F.col("zeros"))).alias("percent_zeros"), F.col("mean").alias("avg"),
        F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("stddev"), F.col("least").alias("min"), F.col("most").alias("max"),
        F.hll_sketch_estimate("distinct").alias("distinct_count"),
        *[F.when(number, F.kll_sketch_get_quantile_double("quantiles", F.lit(p))).alias(q) for q, p in quantiles.items()],
        F.expr(f"approx_top_k_estimate(frequent, {frequent})").alias("frequent"))


def refresh(stream: DataFrame, path: str, checkpoint: str, by: Sequence[str], numeric: Sequence[str], categorical: Sequence[str] = ()) -> None:
    """Add the partial profile of everything new in a stream of files to the state at ``path``, then stop.

    The checkpoint knows which files were read, so a refresh opens none of them twice; a batch that is run again
    replaces its own part of the state.
    """
    def add(batch: DataFrame, batch_id: int) -> None:
        partial_profile(batch, by, numeric, categorical).write.mode("overwrite").parquet(os.path.join(path, f"batch={batch_id}"))

    query = stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def state_of(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch")
