"""Span trees of conversations: parents from the order of turns, totals of subtrees by pointer doubling.

A trace is a tree: an answer belongs to the question before it, a question to the answer it follows. The parent of a turn
is the nearest turn before it whose role may stand above its own. Parents are found by a merge in slices, so a
conversation may have any number of turns. Depths and totals of subtrees then take as many rounds as the logarithm of
the longest chain: in round k every span knows the ancestor 2 ** k above it, the spans beneath it up to that distance
are added to that ancestor, and distances double. Each round is a join and a grouping over all conversations at once,
stored before the next; no conversation is collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.operators.ordered import carry_at
from ebbtide.sources.sinks import materialize_once

#: Which roles may stand above a role; none: the turn is a root.
ABOVE: Mapping[str, Sequence[str]] = {"user": ("assistant", "system"), "assistant": ("user",), "system": ()}
KEY = ["conv_id"]


def with_parents(turns: DataFrame, above: Mapping[str, Sequence[str]] = ABOVE) -> DataFrame:
    """conv_id, turn, role, parent: the nearest earlier turn of a role that may stand above; null for a root.

    Turns are numbered within their conversation. A turn without a number has no place and is left out, a repeated
    number stands once, with the first of its roles by name. A role that ``above`` does not name is a root.
    """
    one = turns.filter(F.col("turn").isNotNull()).groupBy("conv_id", F.col("turn").cast("long").alias("turn")).agg(F.min("role").alias("role"))
    one = materialize_once(one, "turns")
    most = one.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    parts = [one.filter(~F.coalesce(F.col("role").isin(*[r for r, up in above.items() if up]), F.lit(False))).withColumn("parent", F.lit(None).cast("long"))]
    for role, up in above.items():
        if up:
            marks = one.filter(F.col("role").isin(*up)).select("conv_id", "turn", F.col("turn").alias("parent"))
            probes = one.filter(F.col("role") == role).withColumn("own", F.col("turn")).withColumn("turn", F.col("turn") - 1)
            found = carry_at(marks, probes, KEY, "turn", "m", rows=2 * most)
            parts.append(found.select("conv_id", F.col("own").alias("turn"), "role", F.col("m.parent").alias("parent")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def span_tree(turns: DataFrame, kinds: Sequence[str] = ("user", "assistant", "system"), above: Mapping[str, Sequence[str]] = ABOVE) -> DataFrame:
    """conv_id, turn, role, parent, depth (0 for a root), children and children by kind, spans and spans by kind of the subtree.

    A subtree has its own span in it. An empty table gives an empty result.
    """
    nodes = materialize_once(with_parents(turns, above), "span-parents")
    ones = {f"n_{k}": F.when(F.col("role") == k, 1).otherwise(0).cast("long") for k in kinds}
    counts = ["n", *ones]
    state = nodes.select("conv_id", "turn", F.col("parent").alias("up"), F.when(F.col("parent").isNull(), 0).otherwise(1).cast("long").alias("depth"),
                         F.lit(1).cast("long").alias("n"), *[c.alias(name) for name, c in ones.items()])
    state = materialize_once(state, "span-round")
    # Every round halves the way to the root that is left; it ends when no span has any.
    while not state.filter(F.col("up").isNotNull()).isEmpty():
        climbing = state.filter(F.col("up").isNotNull())
        lifted = climbing.groupBy("conv_id", F.col("up").alias("turn")).agg(*[F.sum(c).alias(f"_{c}") for c in counts])
        higher = state.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("_up"), F.col("depth").alias("_depth"))
        state = materialize_once(
            state.join(higher, ["conv_id", "up"], "left").join(lifted, ["conv_id", "turn"], "left").select(
                "conv_id", "turn", F.col("_up").alias("up"), (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"),
                *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in counts]), "span-round")
    children = nodes.filter(F.col("parent").isNotNull()).groupBy("conv_id", F.col("parent").alias("turn")).agg(
        F.count("*").alias("children"), *[F.count(F.when(F.col("role") == k, 1)).alias(f"{k}_children") for k in kinds])
    out = nodes.join(state.drop("up"), ["conv_id", "turn"]).join(children, ["conv_id", "turn"], "left")
    zero = F.lit(0)
    return out.select("conv_id", "turn", "role", "parent", "depth", F.coalesce("children", zero).alias("children"),
                      *[F.coalesce(f"{k}_children", zero).alias(f"{k}_children") for k in kinds], F.col("n").alias("spans"),
                      *[F.col(f"n_{k}").alias(f"{k}_spans") for k in kinds])
