"""Running totals over a value order, without one task per group.

Cumulative distributions, exact quantiles, ROC areas and weighted draws all need a
prefix sum over sorted values. A plain ``sum() over (partition by g order by v)``
sorts a whole group in one task, and here the groups are a handful of (window,
column) pairs that hold everything. Instead every value falls into a slice of its
group, cut at some of the group's own values. The number of slices follows from the
number of rows, so that a slice holds some 100,000 at most; where one level of slices
is not enough, slices are cut into slices. Their totals are summed level by level over
a few hundred rows each, and the running sum inside a slice is a window partitioned by
slice. The slice of a value is a fixed function of the group's values, so a recomputed
task puts every row where it was before, and the result is exact. Edges and totals are
small and are stored, so that a plan holds the rows it orders once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.columns import join_by
from ebbtide.sources.sinks import materialize_once

#: Rows that one slice may hold, about.
SLICE_ROWS = 100_000
#: Slices that one level cuts.
CELLS = 256
_ALL = "_all"


def slice_levels(rows: int, cells: int | None = None) -> list[int]:
    """How many slices each level cuts for so many rows in a group; slices of sampled edges differ in size by a small factor."""
    if cells is not None:
        return [cells] if cells > 1 else []
    levels = []
    while rows > SLICE_ROWS:
        levels.append(min(CELLS, -(-4 * rows // SLICE_ROWS)))
        rows = -(-rows // max(2, levels[-1] // 4)) if levels[-1] == CELLS else 0
    return levels


def slice_edges(df: DataFrame, by: list[str], value: str, cells: int) -> DataFrame:
    """by, _edges: up to ``cells - 1`` of each group's values, those of the smallest hash, in order.

    They are a sample of the distinct values, so slices between them hold like numbers of rows however
    crowded or far apart the values are. The choice depends on the values alone.
    """
    order = Window.partitionBy(*by).orderBy(F.xxhash64(F.col(value).cast("double")), value)
    picked = df.select(*by, value).withColumn("_r", F.row_number().over(order)).filter(F.col("_r") < cells)
    return picked.groupBy(*by).agg(F.sort_array(F.collect_list(value)).alias("_edges"))


def _stored_edges(df: DataFrame, by: list[str], value: str, cells: int) -> DataFrame:
    """The edges, written: a plan that holds them again for each level and step doubles with each of them."""
    return materialize_once(slice_edges(df, by, value, cells), "slice-edges")


def _sliced(df: DataFrame, edges: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    v = F.col(value)
    return join_by(df, edges, by, "left").withColumn(
        name, F.when(F.col("_edges").isNull(), 0).otherwise(F.size(F.filter("_edges", lambda e: e < v)))).drop("_edges")


def _offsets(totals: DataFrame, by: list[str], cells: list[str], sums: list[str]) -> DataFrame:
    """by, cells, ``_before_<s>``, ``total_<s>`` and ``_ahead``, the first row behind, of every slice of the last level."""
    added = [F.sum(f"_cell_{s}").alias(f"_cell_{s}") for s in sums]
    if not cells:
        return totals.groupBy(*by).agg(*added, F.lit(None).cast(totals.schema["_first"].dataType).alias("_ahead")).select(
            *by, "_ahead", *[F.lit(0).alias(f"_before_{s}") for s in sums], *[F.col(f"_cell_{s}").alias(f"total_{s}") for s in sums])
    upper = [*by, *cells[:-1]]
    parents = _offsets(totals.groupBy(*upper).agg(*added, F.min("_first").alias("_first")), by, cells[:-1], sums)
    across = Window.partitionBy(*upper).orderBy(cells[-1])
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    inner = totals.select(
        *upper, cells[-1], F.lead("_first").over(across).alias("_near"),
        *[F.coalesce(F.sum(f"_cell_{s}").over(before), F.lit(0)).alias(f"_in_{s}") for s in sums])
    return join_by(inner, parents, upper).select(
        *upper, cells[-1], F.coalesce("_near", "_ahead").alias("_ahead"),
        *[(F.col(f"_before_{s}") + F.col(f"_in_{s}")).alias(f"_before_{s}") for s in sums], *[f"total_{s}" for s in sums])


def ordered_prefix(
    df: DataFrame, by: list[str], value: str, sums: list[str], cells: int | None = None, carry: tuple[str, ...] = (),
    ahead: tuple[str, ...] = (), rows: int | None = None,
) -> DataFrame:
    """Add running and total sums to a frame with one row per (by, value).

    Result columns: by, value, sums, ``carry``, ``cum_<s>`` (up to and including the value), ``total_<s>``,
    ``next_value`` and ``next_<a>`` for each of ``ahead`` out of ``carry`` (null at the end). Rows with a null
    value are left out; a null in ``by`` is a group of its own. ``rows`` is a bound of a group's rows; where it
    is not given, the rows are counted. ``cells`` sets the slices of a single level instead.
    """
    constant = not by
    if constant:
        by = [_ALL]
        df = df.withColumn(_ALL, F.lit(0))
    v = F.col(value)
    df = df.select(*by, value, *sums, *carry).filter(v.isNotNull() & ~F.isnan(v.cast("double")))
    levels = slice_levels(df.count() if rows is None and cells is None else rows or 0, cells)
    next_row = F.struct(F.col(value).alias("value"), *ahead)
    names = [f"_cell{i}" for i in range(len(levels))]
    for i, n in enumerate(levels):
        keys = [*by, *names[:i]]
        df = _sliced(df, _stored_edges(df, keys, value, n), keys, value, names[i])
    keys = [*by, *names]
    inside = Window.partitionBy(*keys).orderBy(value)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if not levels:
        whole = Window.partitionBy(*by)
        summed = df.select(
            *by, value, *sums, *carry, *[F.sum(s).over(upto).alias(f"cum_{s}") for s in sums],
            *[F.sum(s).over(whole).alias(f"total_{s}") for s in sums], F.lead(next_row).over(inside).alias("_n"))
    else:
        totals = materialize_once(
            df.groupBy(*keys).agg(*[F.sum(s).alias(f"_cell_{s}") for s in sums], F.min(next_row).alias("_first")), "slice-totals")
        summed = join_by(df, _offsets(totals, by, names, sums), keys).select(
            *by, value, *sums, *carry, *[(F.col(f"_before_{s}") + F.sum(s).over(upto)).alias(f"cum_{s}") for s in sums],
            *[F.col(f"total_{s}") for s in sums], F.coalesce(F.lead(next_row).over(inside), F.col("_ahead")).alias("_n"))
    out = summed.select(
        *by, value, *sums, *carry, *[f"cum_{s}" for s in sums], *[f"total_{s}" for s in sums],
        F.col("_n.value").alias("next_value"), *[F.col(f"_n.{a}").alias(f"next_{a}") for a in ahead])
    return out.drop(_ALL) if constant else out


def quantiles_of(prefix: DataFrame, by: list[str], value: str, n: str, probabilities: dict[str, float]) -> DataFrame:
    """Interpolated quantiles from a prefix sum of ``n`` copies of each value."""
    rank = {name: F.lit(p) * (F.col(f"total_{n}") - 1) for name, p in probabilities.items()}
    aggs = []
    for name, r in rank.items():
        aggs.append(F.min(F.when(F.col(f"cum_{n}") > F.floor(r), F.col(value))).alias(f"_lo_{name}"))
        aggs.append(F.min(F.when(F.col(f"cum_{n}") > F.ceil(r), F.col(value))).alias(f"_hi_{name}"))
        aggs.append(F.max(r - F.floor(r)).alias(f"_f_{name}"))
    return prefix.groupBy(*by).agg(*aggs).select(
        *by,
        *[(F.col(f"_lo_{q}") + (F.coalesce(F.col(f"_hi_{q}"), F.col(f"_lo_{q}")) - F.col(f"_lo_{q}"))
           * F.col(f"_f_{q}")).alias(q) for q in probabilities],
    )


def exact_quantiles(
    counts: DataFrame, by: list[str], value: str, n: str, probabilities: dict[str, float], cells: int | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Interpolated quantiles of a frame holding ``n`` copies of each value.

    The built-in exact percentile keeps every distinct value of a group in one
    task's memory; here only the few bracketing values are kept.
    """
    return quantiles_of(ordered_prefix(counts, by, value, [n], cells, rows=rows), by, value, n, probabilities)


def _carries(last: DataFrame, by: list[str], cells: list[str]) -> DataFrame:
    """by, cells, _carry: the last mark in front of every slice of the last level."""
    if not cells:
        return last.groupBy(*by).agg(F.lit(None).cast(last.schema["_last"].dataType).alias("_carry"))
    upper = [*by, *cells[:-1]]
    parents = _carries(last.groupBy(*upper).agg(F.max("_last").alias("_last")), by, cells[:-1])
    before = Window.partitionBy(*upper).orderBy(cells[-1]).rowsBetween(Window.unboundedPreceding, -1)
    inner = last.select(*upper, cells[-1], F.last("_last", ignorenulls=True).over(before).alias("_near"))
    return join_by(inner, parents, upper).select(*upper, cells[-1], F.coalesce("_near", "_carry").alias("_carry"))


def carry_at(
    marks: DataFrame, probes: DataFrame, by: list[str], value: str, at: str, rows: int | None = None, cells: int | None = None
) -> DataFrame:
    """Add ``at``, a struct of the last mark of the same group whose value is no greater, to every probe; null before the first.

    ``marks`` has one row per (by, value). Marks and probes are cut together at some of their values and each slice
    is sorted once, so there are no pairs, and probes between two marks can fall into many slices. ``rows`` is a bound
    of a group's marks and probes; where it is not given, they are counted.
    """
    kept = [c for c in marks.columns if c not in by]
    others = [c for c in probes.columns if c not in (*by, value)]
    row = F.struct(*others) if others else F.struct(F.lit(0).alias("_"))
    mark = F.struct(F.col(value).alias("_v"), *kept)
    left = marks.select(*by, F.col(value).alias("_v"), F.lit(0).alias("_kind"), mark.alias("_mark"))
    right = probes.select(*by, F.col(value).alias("_v"), F.lit(1).alias("_kind"), row.alias("_row"))
    both = left.unionByName(right, allowMissingColumns=True)
    levels = slice_levels(both.count() if rows is None and cells is None else rows or 0, cells)
    names = [f"_cell{i}" for i in range(len(levels))]
    for i, n in enumerate(levels):
        keys = [*by, *names[:i]]
        both = _sliced(both, _stored_edges(both, keys, "_v", n), keys, "_v", names[i])
    keys = [*by, *names]
    inside = Window.partitionBy(*keys).orderBy("_v", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = F.last("_mark", ignorenulls=True).over(inside)
    if levels:
        last = materialize_once(both.groupBy(*keys).agg(F.max("_mark").alias("_last")), "slice-marks")
        both = join_by(both, _carries(last, by, names), keys)
        near = F.coalesce(near, F.col("_carry"))
    found = both.withColumn("_at", near).filter(F.col("_kind") == 1)
    return found.select(*by, F.col("_v").alias(value), *[F.col(f"_row.{c}").alias(c) for c in others],
                        F.when(F.col("_at").isNotNull(), F.struct(*[F.col(f"_at.{c}").alias(c) for c in kept])).alias(at))
