"""A change feed from two plain snapshots, by a tree of digests over key ranges.

Nobody marks what has changed: there are two copies of a table, and a stored summary of the older one. The summary cuts
the keys into leaves by their hash and holds, for each leaf, the number of its rows and an order-free digest of them;
sixteen leaves make a node of the level above, and so on up to one root. Comparing two summaries goes down from the root
and opens only nodes that differ, and only the rows of the leaves that are left at the end are read, from snapshots that
are stored by leaf. So the bytes read fall with the share of leaves that changed, and an unchanged table costs one row.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.session import shared_dir

#: Children of a node.
FAN = 16
#: Rows that a leaf holds, about.
LEAF_ROWS = 20_000


@dataclass
class Snapshot:
    """A copy of a table stored by leaf, and its tree: level, node, rows, digest. Level 0 is the root."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    depth: int

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.path, "rows"))

    def tree(self) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.path, "tree"))


def _leaf(keys: tuple[str, ...], depth: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(FAN ** depth)).cast("int")


def _digest(columns: list[str]) -> Column:
    """Of one row: two hashes of 64 bits over all columns, in the order of their names; null has a mark of its own."""
    marked = [c for name in sorted(columns) for c in (F.col(name).isNull(), F.col(name))]
    return F.struct(F.xxhash64(*marked).alias("a"), F.xxhash64(F.lit("again"), *marked).alias("b"))


def depth_for(rows: int, leaf_rows: int = LEAF_ROWS) -> int:
    depth = 0
    while FAN ** depth * leaf_rows < rows:
        depth += 1
    return depth


def take_snapshot(table: DataFrame, keys: tuple[str, ...], path: str | None = None, depth: int | None = None) -> Snapshot:
    """Store a copy by leaf with its tree. ``depth`` is that of the snapshot it will be compared with; else it follows from the rows.

    Columns of any type that can be hashed are compared by value. A null key is a key. Rows that repeat a key
    belong to one leaf and are compared as a bag.
    """
    spark = table.sparkSession
    path = path or shared_dir(spark, "snapshot")
    depth = depth_for(table.count()) if depth is None else depth
    leaf = _leaf(keys, depth)
    columns = table.columns
    placed = table.withColumn("_leaf", leaf)
    placed.repartition(F.col("_leaf")).write.partitionBy("_leaf").parquet(os.path.join(path, "rows"))
    stored = spark.read.parquet(os.path.join(path, "rows"))
    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    level = stored.select("_leaf", _digest(columns).alias("d")).groupBy(F.col("_leaf").alias("node")).agg(
        F.count("*").alias("rows"), total("d.a").alias("a"), total("d.b").alias("b"))
    levels = None
    for k in range(depth, -1, -1):
        part = level.withColumn("level", F.lit(k))
        levels = part if levels is None else levels.unionByName(part)
        # Sums of whole numbers: the digest of a node does not depend on the order of anything below it.
        level = level.groupBy(F.floor(F.col("node") / FAN).cast("int").alias("node")).agg(
            F.sum("rows").alias("rows"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    digest = F.concat_ws("/", F.col("rows").cast("string"), F.col("a").cast("string"), F.col("b").cast("string"))
    levels.select("level", "node", "rows", digest.alias("digest")).write.partitionBy("level").parquet(os.path.join(path, "tree"))
    return Snapshot(spark, path, keys, depth)


def changed_leaves(old: Snapshot, new: Snapshot) -> DataFrame:
    """_leaf: those whose digests differ, found by opening differing nodes only, level by level."""
    if old.depth != new.depth:
        raise ValueError("snapshots of different depth; take the new one with the depth of the old")
    suspects = None
    for level in range(old.depth + 1):
        a, b = (s.tree().filter(F.col("level") == level).select("node", F.col("digest").alias(n)) for s, n in ((old, "a"), (new, "b")))
        if suspects is not None:
            children = suspects.select(F.explode(F.sequence(F.col("node") * FAN, F.col("node") * FAN + FAN - 1)).alias("node"))
            a, b = a.join(children, "node", "left_semi"), b.join(children, "node", "left_semi")
        suspects = a.join(b, "node", "full").filter(~F.col("a").eqNullSafe(F.col("b"))).select("node")
    return suspects.select(F.col("node").alias("_leaf"))


def changes(old: Snapshot, new: Snapshot) -> DataFrame:
    """_change (insert, update, delete) and the columns of the new row, or of the old one for a delete.

    Only leaves that differ are read: the list of them prunes the stored partitions. Where a key has several rows, those
    that only one side has are paired in the order of their digests; what is left over is inserted or deleted.
    """
    leaves = changed_leaves(old, new)
    columns = [c for c in new.rows().columns if c != "_leaf"]
    keys = list(old.keys)
    row = F.struct(*columns).alias("row")

    def side(s: Snapshot, name: str) -> DataFrame:
        rows = s.rows().join(leaves, "_leaf", "left_semi")
        one = rows.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], _digest(columns).alias("d"), row)
        by = [f"_k{i}" for i in range(len(keys))]
        return one.groupBy(*by, "d").agg(F.first("row").alias(f"{name}_row"), F.count("*").alias(name))

    by = [f"_k{i}" for i in range(len(keys))]
    same = [F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in (*by, "d")]
    condition = same[0]
    for c in same[1:]:
        condition = condition & c
    o, n = side(old, "old").alias("o"), side(new, "new").alias("n")
    both = o.join(n, condition, "full").select(
        *[F.when(F.col("n.new").isNotNull(), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in by],
        F.coalesce("n.d", "o.d").alias("d"), "old_row", "new_row", (F.coalesce("n.new", F.lit(0)) - F.coalesce("o.old", F.lit(0))).alias("more"))
    odd = both.filter("more <> 0")
    # A key's own differences; a key has as many as it has different rows.
    gone = F.sort_array(F.collect_list(F.when(F.col("more") < 0, F.struct("d", F.col("old_row").alias("row"), (-F.col("more")).alias("times")))))
    come = F.sort_array(F.collect_list(F.when(F.col("more") > 0, F.struct("d", F.col("new_row").alias("row"), F.col("more").alias("times")))))
    times = lambda a: F.flatten(F.transform(a, lambda x: F.array_repeat(x["row"], x["times"].cast("int"))))
    listed = odd.groupBy(*by).agg(times(gone).alias("gone"), times(come).alias("come"))
    kind = F.when(F.col("p.come").isNull(), "delete").when(F.col("p.gone").isNull(), "insert").otherwise("update")
    return listed.select(F.explode(F.arrays_zip("gone", "come")).alias("p")).select(
        kind.alias("_change"), F.coalesce("p.come", "p.gone").alias("row")).select("_change", "row.*")
