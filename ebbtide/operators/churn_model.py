"""Train, tune, keep and apply a churn classifier with Spark ML."""

from __future__ import annotations

import math
import os
import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import (
    IDF, HashingTF, OneHotEncoder, RegexTokenizer, StandardScaler, StringIndexer, VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.functions.hashing import uniform
from ebbtide.operators.features import split_columns_by_type
from ebbtide.operators.quality import quality, roc_auc
from ebbtide.sources.sinks import materialize_once, store_of

SKIP = ("customer_id", "churn", "split", "label", "churn_label")


def prepare(rows: DataFrame, label: str = "churn") -> DataFrame:
    """Label 1/0 by a fixed mapping, and no nulls: 0 for numbers, 'unknown' for texts."""
    out = rows.withColumn("label", F.when(F.col(label) == "Yes", 1.0).otherwise(0.0)) if label in rows.columns else rows
    numeric, texts = split_columns_by_type(out, SKIP)
    return out.fillna(0, subset=numeric).fillna("unknown", subset=texts)


def preprocess_stages(rows: DataFrame) -> list:
    """Numbers scaled, categories one-hot with room for values not seen in training."""
    numeric, texts = split_columns_by_type(rows, SKIP)
    index = [f"{c}__index" for c in texts]
    hot = [f"{c}__hot" for c in texts]
    return [
        StringIndexer(inputCols=texts, outputCols=index, handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=index, outputCols=hot, dropLast=False),
        VectorAssembler(inputCols=numeric, outputCol="_numbers"),
        StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True),
        VectorAssembler(inputCols=["_scaled", *hot], outputCol="features"),
    ]


# Search ranges (kind, low, high) of the nine tuned parameters.
SPACE = {
    "maxIter": ("int", 50, 300), "maxDepth": ("int", 3, 10), "stepSize": ("log", 0.01, 0.3),
    "maxBins": ("int", 16, 128), "minInstancesPerNode": ("int", 5, 50), "subsamplingRate": ("float", 0.5, 1.0),
    "featureSubsetStrategy": ("share", 0.5, 1.0), "minInfoGain": ("log", 1e-8, 0.1),
    "minWeightFractionPerNode": ("float", 0.0, 0.05),
}


def draw_params(trial: int, seed: int, space: Mapping[str, tuple]) -> dict:
    rng = random.Random(f"{seed}-{trial}")
    drawn = {}
    for name, (kind, low, high) in space.items():
        if kind == "int":
            drawn[name] = rng.randint(low, high)
        elif kind == "log":
            drawn[name] = math.exp(rng.uniform(math.log(low), math.log(high)))
        else:
            value = rng.uniform(low, high)
            drawn[name] = f"{value:.3f}" if kind == "share" else value
    return drawn


#: Bytes of stored training rows that one partition holds; a small table is one task, without overhead for each tree level.
PARTITION_BYTES = 32 << 20
#: Rounds after which lineage is cut and a trial's first budget.
CUT_EVERY, FIRST_ROUNDS = 10, 8


def _classifier(params: Mapping, seed: int, **more) -> GBTClassifier:
    return GBTClassifier(featuresCol="features", labelCol="label", seed=seed, **{**params, **more})


def score(model, rows: DataFrame) -> DataFrame:
    """Add prediction and churn_probability, both double; the model's own columns are dropped."""
    keep = [c for c in rows.columns if c not in ("prediction", "churn_probability")]
    return model.transform(rows).withColumn(
        "churn_probability", vector_to_array("probability")[1]).select(*keep, "prediction", "churn_probability")


@dataclass
class Tuning:
    trials: DataFrame
    best: dict
    preprocessing: PipelineModel
    model: PipelineModel  # preprocessing and the classifier of the best trial
    measures: list = field(default_factory=list)


def training_vectors(train: DataFrame, val: DataFrame, preprocessing: PipelineModel, label: str = "training-vectors") -> DataFrame:
    """label, features, held (the row is of the validation split), stored in partitions of a bounded size."""
    rows = preprocessing.transform(train).select("label", "features", F.lit(False).alias("held")).unionByName(
        preprocessing.transform(val).select("label", "features", F.lit(True).alias("held")))
    entries = rows.agg(F.sum(F.size(vector_to_array("features")))).first()[0] or 0
    return materialize_once(rows.coalesce(max(1, -(-8 * entries // PARTITION_BYTES))), label)


def boost(vectors: DataFrame, params: Mapping, seed: int, rounds: int | None = None):
    """A boosted model of at most ``rounds`` rounds that stops when the held rows no longer gain.

    The node of each row is kept from one tree level to the next, and lineage is cut every few rounds.
    """
    rounds = min(rounds or params["maxIter"], params["maxIter"])
    return _classifier(params, seed, maxIter=rounds, validationIndicatorCol="held", validationTol=1e-5, cacheNodeIds=True,
                       checkpointInterval=CUT_EVERY).fit(vectors)


def _measured(models: Mapping[int, object], held: DataFrame) -> dict[int, tuple[float, float]]:
    """F1 and log loss of each trial's model on the held rows, in one query."""
    scored = None
    for trial, model in models.items():
        part = score(model, held).select(F.lit(trial).alias("trial"), "label", "prediction", "churn_probability")
        scored = part if scored is None else scored.unionByName(part)
    q = quality(scored, "label", "prediction", None, ["trial"]).select("trial", "f1_positive")
    p = F.greatest(F.lit(1e-15), F.least(F.lit(1 - 1e-15), F.when(F.col("label") == 1, F.col("churn_probability")).otherwise(
        1 - F.col("churn_probability"))))
    loss = scored.groupBy("trial").agg(F.avg(-F.log(p)).alias("loss"))
    return {r["trial"]: (float(r["f1_positive"]), float(r["loss"])) for r in q.join(loss, "trial").collect()}


def tune(
    train: DataFrame, val: DataFrame, n_trials: int = 20, seed: int = 42, space: Mapping[str, tuple] = SPACE,
    parallelism: int = 8, first_rounds: int = FIRST_ROUNDS,
) -> Tuning:
    """Seeded random search for the best F1 on the validation split, with a budget of boosting rounds.

    All trials are drawn from the full space. They run in heats: each trial of a heat boosts for as many rounds as the
    heat allows, the better half goes on, and the rounds double until they reach what the trials themselves ask for.
    Boosting also stops when the validation rows no longer gain, so a trial uses what it needs. Every trial is logged
    with the rounds it used, its heat and its scores there; the best is the best of the last heat. The preprocessing is
    fitted on the train split and applied once; the vectors are stored, and the trials of a heat, which are independent
    Spark jobs, share them.
    """
    spark = train.sparkSession
    preprocessing = Pipeline(stages=preprocess_stages(train)).fit(train)
    vectors = training_vectors(train, val, preprocessing)
    held = vectors.filter("held").select("label", "features")
    params = {t: draw_params(t, seed, space) for t in range(n_trials)}
    alive, rounds, heat = list(params), first_rounds, 0
    log: dict[int, tuple] = {}
    while True:
        last = len(alive) <= 2 or rounds >= max(params[t]["maxIter"] for t in alive)
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            models = dict(zip(alive, pool.map(lambda t: boost(vectors, params[t], seed, None if last else rounds), alive)))
        found = _measured(models, held)
        for t in alive:
            log[t] = (heat, models[t].getNumTrees, *found[t])
        alive.sort(key=lambda t: (-found[t][0], found[t][1], t))
        if last:
            break
        alive, rounds, heat = alive[:-(-len(alive) // 2)], rounds * 2, heat + 1
    best = alive[0]
    done = [(t, params[t], *log[t]) for t in params]
    areas = {best: quality(score(models[best], held), "label", "prediction", "churn_probability").select("roc_auc").first()[0]}
    table = spark.createDataFrame(
        [(t, {k: str(v) for k, v in p.items()}, h, r, f1, loss, areas.get(t), t == best) for t, p, h, r, f1, loss in done],
        "trial int, params map<string,string>, heat int, rounds int, f1_score double, log_loss double, roc_auc double, is_best boolean")
    whole = PipelineModel(stages=[*preprocessing.stages, models[best]])
    return Tuning(table, params[best], preprocessing, whole, done)


def fit_final(train: DataFrame, params: Mapping, seed: int = 42, val: DataFrame | None = None) -> PipelineModel:
    """Preprocessing and classifier as one pipeline, fitted on the train split; with ``val``, boosting stops by it."""
    if val is None:
        return Pipeline(stages=[*preprocess_stages(train), _classifier(params, seed)]).fit(train)
    preprocessing = Pipeline(stages=preprocess_stages(train)).fit(train)
    return PipelineModel(stages=[*preprocessing.stages, boost(training_vectors(train, val, preprocessing), params, seed)])


class ModelStore:
    """Versioned models in a folder, with an append-only manifest of versions and aliases."""

    SCHEMA = "seq bigint, name string, version int, alias string, f1_score double, roc_auc double"

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self._manifest = os.path.join(root, "manifest")

    def manifest(self) -> DataFrame:
        store, place = store_of(self.spark, self._manifest)
        if not store.exists(place):  # nothing registered yet; any other trouble is raised
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).json(self._manifest)

    def _next(self, name: str) -> tuple[int, int]:
        row = self.manifest().agg(
            F.max("seq"), F.max(F.when(F.col("name") == name, F.col("version")))).first()
        return (row[0] or 0) + 1, (row[1] or 0) + 1

    def _append(self, row: tuple) -> None:
        self.spark.createDataFrame([row], self.SCHEMA).coalesce(1).write.mode("append").json(self._manifest)

    def register(self, name: str, model: PipelineModel, f1: float | None = None, auc: float | None = None) -> int:
        seq, version = self._next(name)
        model.write().save(os.path.join(self.root, name, f"v{version}"))  # an existing version is an error
        self._append((seq, name, version, None, f1, auc))
        return version

    def set_alias(self, name: str, alias: str, version: int) -> None:
        self._append((self._next(name)[0], name, version, alias, None, None))

    def load(self, name: str, alias: str) -> PipelineModel:
        row = self.manifest().filter((F.col("name") == name) & (F.col("alias") == alias)).agg(
            F.max_by("version", "seq")).first()
        if row[0] is None:
            raise KeyError(f"{name} has no alias {alias}")
        return PipelineModel.load(os.path.join(self.root, name, f"v{row[0]}"))


def importances(model: PipelineModel, scored_schema_source: DataFrame) -> list[tuple[str, float]]:
    """(input column, importance): one-hot parts are summed into their column."""
    assembled = model.transform(scored_schema_source).schema["features"].metadata["ml_attr"]["attrs"]
    numbers = model.stages[2].getInputCols()
    names = {}
    for group in assembled.values():
        for a in group:
            raw = a.get("name", f"f{a['idx']}")
            if raw.startswith("_scaled_"):
                raw = numbers[int(raw.rsplit("_", 1)[1])]
            names[a["idx"]] = raw.split("__hot_")[0]
    weights = model.stages[-1].featureImportances.toArray()
    out: dict[str, float] = {}
    for i, w in enumerate(weights):
        column = names.get(i, f"f{i}")
        out[column] = out.get(column, 0.0) + float(w)
    return sorted(out.items(), key=lambda x: (-x[1], x[0]))


def permutation_importance(
    model, rows: DataFrame, columns: Sequence[str], label: str = "label", key: str = "customer_id",
    rows_per_bucket: int = 1000, seed: int = 42,
) -> DataFrame:
    """column_name, roc_auc, auc_drop when the column's values change places.

    Rows fall into hash buckets of bounded size, and inside a bucket every row takes the
    value of the next row in a hash order of its own per column; no global order is
    needed. All columns are scored in one pass and one area query.
    """
    buckets = rows.agg(F.greatest(F.ceil(F.count("*") / F.lit(float(rows_per_bucket))).cast("int"), F.lit(1))
                       .alias("n")).scalar()
    placed = rows.withColumn("_b", F.pmod(F.xxhash64(key), buckets))
    moved = {}
    for c in columns:
        w = Window.partitionBy("_b").orderBy(uniform(key, f"{c}-{seed}"), key)
        moved[f"_p_{c}"] = F.coalesce(
            F.lead(c).over(w), F.first(c).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    shuffled = placed.withColumns(moved).withColumn("_c", F.explode(F.array(F.lit("(none)"), *map(F.lit, columns))))
    replaced = shuffled.withColumns({
        c: F.when(F.col("_c") == c, F.col(f"_p_{c}")).otherwise(F.col(c)) for c in columns})
    scored = score(model, replaced.drop("_b", *moved))
    areas = roc_auc(scored, label, "churn_probability", ["_c"])
    whole = areas.filter("_c = '(none)'").select("roc_auc").scalar()
    return areas.filter("_c <> '(none)'").select(
        F.col("_c").alias("column_name"), "roc_auc", (whole - F.col("roc_auc")).alias("auc_drop"))


def standardize(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / population deviation; a constant column becomes 0."""
    stats = rows.agg(F.struct(*[
        F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns]).alias("st")).scalar()
    return rows.withColumns({
        c: F.when(stats[c]["s"] > 0, (F.col(c) - stats[c]["m"]) / stats[c]["s"]).otherwise(F.lit(0.0)) for c in columns})


def serving_payload(rows: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """key, payload: the feature vector of each row as one JSON record."""
    return rows.select(key, F.to_json(F.struct(*columns)).alias("payload"))


def fit_text_classifier(labelled: DataFrame, text: str, label: str, features: int = 1 << 14) -> PipelineModel:
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="_words", pattern=r"[^\p{L}]+", toLowercase=True),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features),
        IDF(inputCol="_tf", outputCol="_tfidf", minDocFreq=2),
        LogisticRegression(featuresCol="_tfidf", labelCol=label, maxIter=20, regParam=0.01),
    ]).fit(labelled)
