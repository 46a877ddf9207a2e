"""How far each window of a log has moved from its baseline: six measures per column.

Log and baseline are scanned once, into stored counts of their values. The baseline is then read as a distribution:
a prefix sum of its counts, once, in slices. No window carries a copy of it. The values of all windows are put into
the baseline's order by a sort-merge of positions, and what happens between two neighbouring values of a window, where
only the baseline rises, has a closed form: the largest gap lies at one of the ends, and the area on either side of the
place where the baseline crosses the window's share is a difference of two integrals of the baseline. Categories that a
window lacks count as a whole: by what is left of the baseline's totals.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import erfc, exp, lgamma, log, pi, sqrt

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ebbtide.functions.columns import join_by
from ebbtide.operators.ordered import carry_at, ordered_prefix, quantiles_of
from ebbtide.operators.profile import value_counts, window_start
from ebbtide.sources.sinks import materialize_once

FLOOR = 1e-4  # smallest share used in logarithms and expected counts
DECILES = {f"d{i}": i / 10 for i in range(1, 10)}
SLICE = ["slice_key", "slice_value"]  # both null: all rows
SIDE = [*SLICE, "column_name"]  # a distribution of the baseline
KEYS = ["window", "model_id", *SIDE]  # one of the log


@dataclass
class Compared:
    """Stored value counts of both sides, and the baseline's numbers as a distribution."""

    windows: DataFrame  # window, model_id
    base: DataFrame  # SIDE, number, text, n
    log: DataFrame  # KEYS, number, text, n
    prefix: DataFrame  # SIDE, value, n, s, cum_n, cum_s, total_n, total_s: s is the sum of the values


def sliced(rows: DataFrame, slices: Sequence[str]) -> DataFrame:
    """Each row once for the whole table and once for each slice column, before anything is counted."""
    none = F.lit(None).cast("string")
    if not slices:
        return rows.withColumns({"slice_key": none, "slice_value": none})
    marks = [F.struct(none.alias("slice_key"), none.alias("slice_value"))]
    marks += [F.struct(F.lit(c).alias("slice_key"), F.col(c).cast("string").alias("slice_value")) for c in slices]
    return rows.select("*", F.explode(F.array(*marks)).alias("_slice")).select("*", "_slice.*").drop("_slice")


def compare(
    log: DataFrame, baseline: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), slices: Sequence[str] = (),
    model_id: str | None = None,
) -> Compared:
    """``log`` has a window column. One scan of each side; the baseline's numbers are put in order once."""
    if not numeric and not categorical:
        raise ValueError("no columns to compare")
    model = F.col(model_id) if model_id else F.lit(None)
    rows = sliced(log.withColumn("model_id", model.cast("string")), slices)
    counted = materialize_once(value_counts(rows, ["window", "model_id", *SLICE], numeric, categorical), "drift-log")
    base = materialize_once(value_counts(sliced(baseline, slices), SLICE, numeric, categorical), "drift-baseline")
    numbers = base.filter(F.col("number").isNotNull()).select(
        *SIDE, F.col("number").alias("value"), "n", (F.col("number") * F.col("n")).alias("s"))
    prefix = materialize_once(ordered_prefix(numbers, SIDE, "value", ["n", "s"], rows=base.count()), "drift-prefix")
    windows = log.select("window", model.cast("string").alias("model_id")).distinct()
    return Compared(windows, base, counted, prefix)


def numbers_of(counts: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return counts.filter(F.col("number").isNotNull()).select(*keys, F.col("number").alias("value"), "n")


def decile_edges(compared: Compared) -> DataFrame:
    """(SIDE, edges): the nine inner deciles of the baseline, rounded so that two engines agree."""
    q = quantiles_of(compared.prefix, SIDE, "value", "n", DECILES)
    return q.select(*SIDE, F.array(*[F.round(d, 6) for d in DECILES]).alias("edges"))


def bins(counts: DataFrame, edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, kind, bin, n: decile bins of numbers, the values of texts."""
    placed = join_by(numbers_of(counts, keys), edges, SIDE, "left").select(
        *keys, F.lit("numeric").alias("kind"), F.size(F.filter("edges", lambda e: F.col("value") > e)).cast("string").alias("bin"), "n")
    numbers = placed.groupBy(*keys, "kind", "bin").agg(F.sum("n").alias("n"))
    texts = counts.filter(F.col("text").isNotNull()).select(*keys, F.lit("categorical").alias("kind"), F.col("text").alias("bin"), "n")
    return numbers.unionByName(texts)


def both_bins(compared: Compared) -> tuple[DataFrame, DataFrame]:
    """(bins of the baseline with nb, bins of the log with nw)."""
    edges = decile_edges(compared)
    return (bins(compared.base, edges, SIDE).withColumnRenamed("n", "nb"),
            bins(compared.log, edges, KEYS).withColumnRenamed("n", "nw"))


def joined_bins(compared: Compared) -> DataFrame:
    """KEYS, kind, bin, nb, nw of every bin that either side has: the table of both, for reading."""
    base, log = both_bins(compared)
    zero = F.lit(0).cast("bigint")
    # The result itself has a row for each window and bin of the baseline.
    listed = compared.windows.agg(F.collect_set(F.struct(F.col("window"), F.col("model_id"))).alias("w")).scalar()
    spread = base.select(F.explode(listed).alias("_w"), "*").select("_w.*", *SIDE, "kind", "bin", "nb", zero.alias("nw"))
    both = spread.unionByName(log.withColumn("nb", zero))
    return both.groupBy(*KEYS, "kind", "bin").agg(F.sum("nb").alias("nb"), F.sum("nw").alias("nw"))


def ks_pvalue(statistic: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sample p-value; 1 where the series does not converge."""
    lam = F.sqrt(n * m / (n + m)) * statistic
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)), F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(F.lit(-2.0) * k * k * lam * lam))
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


def chi2_tail(x: float, df: int) -> float:
    """Upper tail of the chi-squared distribution, by its finite sum for whole df."""
    if df <= 0 or x <= 0:
        return 1.0
    half = x / 2
    if df % 2 == 0:
        logs = [k * log(half) - lgamma(k + 1) - half for k in range(df // 2)]
        return min(1.0, sum(exp(v) for v in logs))
    logs = [i * log(x) - (i + 1) * log(2) - lgamma(i + 1.5) + 0.5 * log(pi) for i in range((df - 1) // 2)]
    head = 0.5 * log(2 * x / pi) - half
    return min(1.0, erfc(sqrt(half)) + sum(exp(head + v) for v in logs))


@F.pandas_udf(DoubleType())
def chi2_pvalue(statistic: pd.Series, df: pd.Series) -> pd.Series:
    """Called on one row per window and column: Spark SQL has no erfc."""
    return pd.Series([None if pd.isna(x) or pd.isna(d) else chi2_tail(float(x), int(d))
                      for x, d in zip(statistic, df)], dtype="float64")


def numeric_distances(compared: Compared) -> DataFrame:
    """KS statistic with p-value, and Wasserstein distance, from both CDFs.

    Between two neighbouring values of a window its CDF is a constant c, while the baseline's rises. Its largest
    distance from c is at one of the ends. The area between them is that below c up to the place where the baseline
    reaches c, which is a rank of the baseline, and that above c from there on.
    """
    rows = compared.prefix.count() + compared.log.count()
    marks = compared.prefix.select(*SIDE, "value", "n", "cum_n", "cum_s")
    seen = carry_at(marks, numbers_of(compared.log), SIDE, "value", "b", rows)
    # Baseline values up to v, their sum, and those below v.
    cn, cs = F.coalesce("b.cum_n", F.lit(0)), F.coalesce("b.cum_s", F.lit(0.0))
    below = F.when(F.col("b.value") == F.col("value"), cn - F.col("b.n")).otherwise(cn)
    seen = materialize_once(seen.select(*KEYS, "value", "n", cn.alias("cn"), cs.alias("cs"), below.alias("below")), "drift-seen")
    cdf = ordered_prefix(seen, KEYS, "value", ["n"], carry=("cn", "cs", "below"), ahead=("cn", "cs"), rows=rows)
    totals = compared.prefix.groupBy(*SIDE).agg(
        F.max("total_n").alias("base_n"), F.max("total_s").alias("base_s"), F.max("value").alias("base_max"))
    cdf = join_by(cdf, totals, SIDE, "left")
    # The rank at which the baseline reaches the window's share, and the value there.
    reach = F.ceil(F.col("cum_n").cast("decimal(19,0)") * F.col("base_n").cast("decimal(19,0)") / F.col("total_n").cast("decimal(19,0)"))
    cdf = materialize_once(cdf.withColumn("rank", (reach - 1).cast("bigint")), "drift-cdf")
    ranks = compared.prefix.select(*SIDE, (F.col("cum_n") - F.col("n")).alias("rank"), F.col("value").alias("at"), "cum_n", "cum_s")
    cdf = carry_at(ranks, cdf.filter(F.col("rank").isNotNull()), SIDE, "rank", "x", rows).unionByName(
        cdf.filter(F.col("rank").isNull()), allowMissingColumns=True)
    n, v, next_v, share = F.col("base_n"), F.col("value"), F.col("next_value"), F.col("cum_n") / F.col("total_n")

    here, there = (v, F.col("cn"), F.col("cs")), (next_v, F.col("next_cn"), F.col("next_cs"))
    place = F.col("x.at")

    def at_cross(at_v: Column, at_next: Column, inside: Column) -> Column:
        return F.when(place <= v, at_v).when(place >= next_v, at_next).otherwise(inside)

    cross = tuple(at_cross(h, t, x) for h, t, x in zip(here, there, (place, F.col("x.cum_n"), F.col("x.cum_s"))))

    def risen(a: tuple, b: tuple) -> Column:
        """The integral of the baseline's CDF from one place to another, from the values up to each and their sums."""
        return (b[0] - a[0]) * (a[1] / n) + (b[0] * (b[1] - a[1]) - (b[2] - a[2])) / n

    between = share * (cross[0] - v) - risen(here, cross) + risen(cross, there) - share * (next_v - cross[0])
    end = (F.col("base_max"), n, F.col("base_s"))
    behind = F.when(end[0] > v, (end[0] - v) - risen(here, end)).otherwise(F.lit(0.0))
    before = F.when(F.col("cum_n") == F.col("n"), (v * here[1] - here[2]) / n).otherwise(F.lit(0.0))
    area = F.when(next_v.isNotNull(), between).otherwise(behind) + before
    gap = F.greatest(F.abs(F.col("cn") / n - share), F.abs(F.col("below") / n - (F.col("cum_n") - F.col("n")) / F.col("total_n")))
    known = n.isNotNull()
    out = cdf.groupBy(*KEYS).agg(
        F.max(F.when(known, gap)).alias("ks"), F.sum(F.when(known, F.greatest(area, F.lit(0.0)))).alias("wasserstein_distance"),
        F.max("base_n").cast("double").alias("_n"), F.max("total_n").cast("double").alias("_m"))
    test = F.struct(F.col("ks").alias("statistic"), ks_pvalue(F.col("ks"), F.col("_n"), F.col("_m")).alias("pvalue"))
    return out.select(*KEYS, F.when(F.col("ks").isNotNull(), test).alias("ks_test"), "wasserstein_distance")


def _kl(a: Column, mid: Column) -> Column:
    return F.when(a > 0, a * F.log(a / mid)).otherwise(F.when(a.isNotNull(), F.lit(0.0)))


def _absent_psi(q: Column) -> Column:
    """What a bin of the baseline adds where the window has nothing in it."""
    qf = F.greatest(q, F.lit(FLOOR))
    return (F.lit(FLOOR) - qf) * F.log(F.lit(FLOOR) / qf)


def largest_absent(base: DataFrame, met: DataFrame) -> DataFrame:
    """KEYS, kind, absent: rows in the largest bin of the baseline that a window lacks.

    Bins of equal size are counted together, so a window is compared with a list of sizes: it lacks the largest size
    of which it has fewer bins than there are, or the first, from the largest down, of which it has none.
    """
    sizes = base.groupBy(*SIDE, "kind", "nb").agg(F.count("*").alias("there"))
    sizes = sizes.withColumn("place", F.row_number().over(Window.partitionBy(*SIDE, "kind").orderBy(F.desc("nb"))))
    have = met.filter(F.col("nb").isNotNull()).groupBy(*KEYS, "kind", "nb").agg(F.count("*").alias("here"))
    have = join_by(have, sizes, [*SIDE, "kind", "nb"])
    order = Window.partitionBy(*KEYS, "kind").orderBy("place")
    have = have.withColumn("run", F.row_number().over(order))
    # Places 1, 2, ... without a gap are those whose number is their order.
    out = have.groupBy(*KEYS, "kind").agg(
        F.max(F.when(F.col("here") < F.col("there"), F.col("nb"))).alias("partly"),
        (F.coalesce(F.max(F.when(F.col("run") == F.col("place"), F.col("place"))), F.lit(0)) + 1).alias("place"))
    none = sizes.select(*SIDE, "kind", "place", F.col("nb").alias("wholly"))
    return join_by(out, none, [*SIDE, "kind", "place"], "left").select(*KEYS, "kind", F.greatest("partly", "wholly").alias("absent"))


def distribution_distances(compared: Compared) -> DataFrame:
    """PSI, Jensen-Shannon, total variation and chi-squared from binned shares.

    Each sum runs over the bins a window has; the others are what is left of the baseline's totals.
    """
    base, seen = (materialize_once(x, "drift-bins") for x in both_bins(compared))
    of_base = base.groupBy(*SIDE, "kind").agg(F.sum("nb").alias("total_b"), F.count("*").alias("bins_b"))
    share = join_by(base, of_base, [*SIDE, "kind"]).withColumn("q", F.col("nb") / F.col("total_b"))
    of_base = share.groupBy(*SIDE, "kind").agg(
        F.max("total_b").alias("total_b"), F.max("bins_b").alias("bins_b"), F.sum(_absent_psi(F.col("q"))).alias("psi_b"))
    of_log = seen.groupBy(*KEYS, "kind").agg(F.sum("nw").alias("total_w"))
    met = join_by(seen, base, [*SIDE, "kind", "bin"], "left")
    lacks = largest_absent(base, met)
    rows = join_by(join_by(met, of_log, [*KEYS, "kind"]), of_base, [*SIDE, "kind"], "left")
    nb = F.when(F.col("total_b").isNotNull(), F.coalesce("nb", F.lit(0)))
    p, q = F.col("nw") / F.col("total_w"), nb / F.col("total_b")
    pf, qf = F.greatest(p, F.lit(FLOOR)), F.greatest(q, F.lit(FLOOR))
    mid = (p + q) / 2
    expected = F.when(q > 0, q).otherwise(F.lit(FLOOR)) * F.col("total_w")
    part = rows.groupBy(*KEYS, "kind").agg(
        F.sum((pf - qf) * F.log(pf / qf)).alias("psi"), F.sum(F.when(F.col("nb").isNotNull(), _absent_psi(q))).alias("psi_met"),
        F.sum(_kl(p, mid) * 0.5 + _kl(q, mid) * 0.5).alias("js"), F.sum(F.abs(p - q)).alias("tv"), F.max(F.abs(p - q)).alias("most"),
        F.sum((F.col("nw") - expected) * (F.col("nw") - expected) / expected).alias("chi"), F.sum("nb").alias("met_b"),
        F.count("nb").alias("met_bins"), F.count("*").alias("bins_w"), F.max("total_w").alias("total_w"))
    # Every window meets every column of the baseline, also one it has no values of.
    listed = compared.windows.agg(F.collect_set(F.struct(F.col("window"), F.col("model_id"))).alias("w")).scalar()
    pairs = of_base.select(F.explode(listed).alias("_w"), *SIDE, "kind").select("_w.*", *SIDE, "kind")
    pairs = pairs.unionByName(part.select(*KEYS, "kind")).distinct()
    whole = join_by(join_by(join_by(pairs, part, [*KEYS, "kind"], "left"), of_base, [*SIDE, "kind"], "left"), lacks, [*KEYS, "kind"], "left")
    met_b, met_bins = F.coalesce("met_b", F.lit(0)), F.coalesce("met_bins", F.lit(0))
    left_bins, left = F.coalesce("bins_b", F.lit(0)) - met_bins, (F.col("total_b") - met_b) / F.col("total_b")
    both = F.col("total_b").isNotNull() & F.col("total_w").isNotNull()
    psi = F.coalesce("psi", F.lit(0.0)) + F.when(left_bins > 0, F.coalesce("psi_b", F.lit(0.0)) - F.coalesce("psi_met", F.lit(0.0))).otherwise(F.lit(0.0))
    out = whole.select(
        *KEYS, "kind", psi.alias("population_stability_index"),
        F.when(both, F.sqrt(F.greatest(F.lit(0.0), F.col("js") + left * (0.5 * log(2))))).alias("js_distance"),
        F.when(both, (F.col("tv") + left) / 2).alias("tv_distance"),
        F.when(both, F.greatest(F.col("most"), F.when(left_bins > 0, F.col("absent") / F.col("total_b")))).alias("max_bin_diff"),
        F.when(both & (F.col("kind") == "categorical"), F.col("chi") + left * F.col("total_w")).alias("chi2"),
        (F.coalesce("bins_b", F.lit(0)) + F.coalesce("bins_w", F.lit(0)) - met_bins - 1).alias("degrees"))
    test = F.struct(F.col("chi2").alias("statistic"), chi2_pvalue("chi2", "degrees").alias("pvalue"))
    return out.withColumn("chi_squared_test", F.when(F.col("chi2").isNotNull(), test)).drop("kind", "chi2")


def drift(
    log: DataFrame,
    baseline: DataFrame,
    timestamp: str,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    granularity: str = "month",
    slices: Sequence[str] = (),
    model_id: str | None = None,
) -> DataFrame:
    """All measures, one row per window, model, slice and column.

    ``slices`` are columns of both sides; each of their values is compared with the same value of the baseline, and a
    value that the baseline lacks has no measures. Without ``model_id`` all rows are those of one model.
    """
    compared = compare(log.withColumn("window", window_start(timestamp, granularity)), baseline, numeric, categorical, slices, model_id)
    out = join_by(distribution_distances(compared), numeric_distances(compared), KEYS, "left")
    return out.select(
        "window", "column_name", "ks_test", "chi_squared_test", "wasserstein_distance", "population_stability_index",
        "js_distance", "tv_distance", "max_bin_diff", "degrees", *SLICE, "model_id", F.lit(f"1 {granularity}").alias("granularity"))


def _psi() -> Column:
    return F.coalesce("population_stability_index", F.lit(0.0))


def _pvalue() -> Column:
    return F.coalesce("ks_test.pvalue", "chi_squared_test.pvalue")


# Fixed thresholds of the status rules.
MAJOR, MODERATE, SIGNIFICANT = 0.2, 0.1, 0.05


def drift_status(measures: DataFrame) -> DataFrame:
    status = (
        F.when(_psi() > MAJOR, "MAJOR DRIFT").when(_psi() > MODERATE, "MODERATE DRIFT")
        .when(F.coalesce(_pvalue(), F.lit(1.0)) < SIGNIFICANT, "SIGNIFICANT").otherwise("STABLE")
    )
    return measures.withColumns({"psi": _psi(), "test_pvalue": _pvalue(), "drift_status": status})


def drift_alerts(measures: DataFrame, psi: float = MODERATE, p: float = SIGNIFICANT) -> DataFrame:
    """Only the rows over a threshold, with a severity text."""
    pvalue = F.coalesce(_pvalue(), F.lit(1.0))
    text = (
        F.when(_psi() > MAJOR, "severe: the distribution has moved far")
        .when(_psi() > psi, "watch: the distribution is moving")
        .when(pvalue < p, "note: a test tells the samples apart").otherwise("none")
    )
    return measures.filter((_psi() > psi) | (pvalue < p)).withColumns(
        {"psi": _psi(), "test_pvalue": _pvalue(), "status": text})


def drift_rank(measures: DataFrame) -> DataFrame:
    return drift_status(measures).orderBy(F.desc("psi"), "column_name", "window")
