"""What each input column adds to a boosted model's score, row by row.

A row goes from the root of a tree to a leaf. At each split the expected value of the node changes, and the change is
put down to the column that the split asks. The sum over the path is the leaf's value less the root's, so over all trees
the attributions and the base value add up to the row's margin exactly. One-hot parts are summed into their column.

The trees are read from the saved model, not node by node from the JVM. They are as large as the model, whose size the
depth and the rounds bound; tasks walk all rows of a batch through a tree at once.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.session import shared_dir


class Forest:
    """Trees as arrays: for each node its split, children, value and, for a split on categories, those that go left."""

    def __init__(self, trees: list[dict], weights: list[float]):
        self.trees, self.weights = trees, weights
        self.base = float(sum(w * t["value"][0] for w, t in zip(weights, trees)))

    @classmethod
    def of(cls, model: PipelineModel, spark) -> Forest:
        path = shared_dir(spark, "model")
        model.stages[-1].write().save(path)
        rows = spark.read.parquet(os.path.join(path, "data")).select("treeID", "nodeData.*").orderBy("treeID", "id").collect()
        trees: dict[int, dict] = {}
        for r in rows:
            t = trees.setdefault(r["treeID"], {"feature": [], "left": [], "right": [], "value": [], "threshold": [], "sets": {}})
            split = r["split"]
            if r["leftChild"] >= 0 and split["numCategories"] >= 0:
                t["sets"][r["id"]] = set(split["leftCategoriesOrThreshold"])
            inner = r["leftChild"] >= 0
            t["feature"].append(split["featureIndex"] if inner else -1)
            t["left"].append(r["leftChild"])
            t["right"].append(r["rightChild"])
            t["value"].append(r["prediction"])
            t["threshold"].append(split["leftCategoriesOrThreshold"][0] if inner and split["numCategories"] < 0 else np.nan)
        arrays = [{**{k: np.array(v) for k, v in t.items() if k != "sets"}, "sets": t["sets"]} for _, t in sorted(trees.items())]
        return cls(arrays, [float(w) for w in model.stages[-1].treeWeights])

    def attributions(self, x: np.ndarray) -> np.ndarray:
        """One row for each row of ``x`` and one column for each feature."""
        out = np.zeros(x.shape)
        for weight, t in zip(self.weights, self.trees):
            node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
            while len(rows):
                rows = rows[t["feature"][node[rows]] >= 0]
                at = node[rows]
                feature = t["feature"][at]
                value = x[rows, feature]
                left = value <= t["threshold"][at]
                for i in np.flatnonzero(np.isnan(t["threshold"][at])).tolist():
                    left[i] = value[i] in t["sets"][int(at[i])]
                to = np.where(left, t["left"][at], t["right"][at])
                np.add.at(out, (rows, feature), weight * (t["value"][to] - t["value"][at]))
                node[rows] = to
        return out


def feature_columns(model: PipelineModel, rows: DataFrame) -> list[str]:
    """The input column of each entry of the feature vector."""
    attributes = model.transform(rows).schema["features"].metadata["ml_attr"]["attrs"]
    numbers = next(s for s in model.stages if s.hasParam("outputCol") and s.getOutputCol() == "_numbers").getInputCols()
    named = {}
    for group in attributes.values():
        for a in group:
            raw = a.get("name", f"f{a['idx']}")
            named[a["idx"]] = numbers[int(raw.rsplit("_", 1)[1])] if raw.startswith("_scaled_") else raw.split("__hot_")[0]
    return [named.get(i, f"f{i}") for i in range(model.stages[-1].numFeatures)]


def row_attributions(model: PipelineModel, rows: DataFrame, key: str = "customer_id") -> DataFrame:
    """key, column_name, attribution, base, margin: one row for each row and input column.

    For every row, the base and its attributions add up to the margin, which is that of the model itself.
    """
    forest, names = Forest.of(model, rows.sparkSession), feature_columns(model, rows)
    columns = list(dict.fromkeys(names))
    place = np.array([columns.index(n) for n in names])
    scored = model.transform(rows).select(
        F.col(key).alias("key"), vector_to_array("features").alias("x"), vector_to_array("rawPrediction")[1].alias("margin"))
    kind = rows.schema[key].dataType.simpleString()

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            found = forest.attributions(np.stack(batch["x"].to_numpy()))
            summed = np.zeros((len(batch), len(columns)))
            np.add.at(summed.T, place, found.T)
            n = len(columns)
            yield pd.DataFrame({"key": np.repeat(batch["key"].to_numpy(), n), "column_name": columns * len(batch), "attribution": summed.ravel(),
                                "base": forest.base, "margin": np.repeat(batch["margin"].to_numpy(), n)})

    out = scored.mapInPandas(walk, f"key {kind}, column_name string, attribution double, base double, margin double")
    return out.withColumnRenamed("key", key)
