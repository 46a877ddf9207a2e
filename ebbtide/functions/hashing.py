"""Uniform draws that depend only on a key and a tag.

``rand(seed)`` depends on how rows are partitioned, so a re-run or a lost executor
would change it. A hash of (key, tag) gives every row the same draw everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform(key: Column | str, tag: str) -> Column:
    """A number in [0, 1) fixed by the key and the tag."""
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(key.cast("string"), F.lit(f"|{tag}")))
    # 13 hex digits are 52 bits, all of which a double holds.
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def uniform_int(key: Column | str, tag: str, low: int, high: int) -> Column:
    """An integer in [low, high)."""
    return (F.floor(uniform(key, tag) * F.lit(float(high - low))) + F.lit(low)).cast("bigint")


def categorical(u: Column, values: list, probabilities: list[float]) -> Column:
    """Pick a value by walking the cumulative probabilities with the uniform ``u``."""
    if len(values) != len(probabilities) or abs(sum(probabilities) - 1.0) > 1e-9:
        raise ValueError("need one probability per value, summing to 1")
    edge, out = 0.0, None
    for value, p in zip(values[:-1], probabilities[:-1]):
        edge = round(edge + p, 12)
        out = F.when(u < edge, F.lit(value)) if out is None else out.when(u < edge, F.lit(value))
    return F.lit(values[-1]) if out is None else out.otherwise(F.lit(values[-1]))


def exponential(u: Column, mean: float, shift: float = 0.0, digits: int = 1) -> Column:
    """Inverse-transform exponential draw, shifted and rounded."""
    return F.round(-F.lit(mean) * F.log(F.lit(1.0) - u) + F.lit(shift), digits)
