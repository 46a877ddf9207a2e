"""Model queries: preprocessing, tuning, fitting, scoring and importance."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.operators import attributions as at
from ebbtide.operators import churn_model as cm
from ebbtide.operators.features import avg_price_increase, build_features, feature_lookup
from ebbtide.operators.quality import quality
from ebbtide.plans.registry import query
from ebbtide.session import shared_dir
from ebbtide.sources.sinks import materialize_once

# A short search for tests; the named queries run the 20 trials of the full space.
SMALL_SPACE = {**cm.SPACE, "maxIter": ("int", 3, 6), "maxDepth": ("int", 2, 4)}
_SHARED: dict[tuple, object] = {}


def _rows(t):
    """Labelled rows of all splits, stored once: every fit reads them several times."""
    def make():
        labels = t.churn_labels.select("customer_id", "churn", "split")
        joined = feature_lookup(labels, build_features(t.customers, t.tickets),
                                computed={"avg_price_increase": avg_price_increase()})
        return materialize_once(cm.prepare(joined), "training")

    return t.once("training", make)


def _split(t, name):
    return _rows(t).filter(F.col("split") == name)


def _shared(t, name, make):
    """Made once in a session for the same training rows, whichever query asks first."""
    rows = _rows(t)
    held = t.once("training-print", lambda: tuple(rows.agg(
        F.count("*"), F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)"))).first()))
    key = (t.spark.sparkContext.applicationId, name, *held)
    if key not in _SHARED:
        _SHARED[key] = make()
    return _SHARED[key]


def _tuned(t):
    return _shared(t, "tuning", lambda: cm.tune(_split(t, "train"), _split(t, "val"), space=cm.SPACE))


def _model(t):
    """The final model: the best trial's, fitted on the train split with all the rounds it asked for or could use."""
    return _tuned(t).model


@query("ml_preprocess")
def ml_preprocess(t):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    train = _split(t, "train")
    fitted = Pipeline(stages=cm.preprocess_stages(train)).fit(train)
    return fitted.transform(_split(t, "val")).select(
        "customer_id", F.size(vector_to_array("features")).alias("width"), "label")


_STD = ("tenure_months", "monthly_charges", "total_charges")


@query("ml_standardize", "select customer_id, " + ", ".join(
    f"round(({c} - avg({c}) over ())/stddev_pop({c}) over (), 6) as {c}" for c in _STD) + " from customers")
def ml_standardize(t):
    out = cm.standardize(t.customers.select("customer_id", *_STD), _STD)
    return out.select("customer_id", *[F.round(c, 6).alias(c) for c in _STD])


@query("ml_tune")
def ml_tune(t):
    return _tuned(t).trials.select(
        "trial", F.to_json("params").alias("params"), "heat", "rounds", "f1_score", "log_loss", "roc_auc", "is_best")


@query("ml_fit_final")
def ml_fit_final(t):
    scored = cm.score(_model(t), _split(t, "val"))
    q = quality(scored, "label", "prediction", "churn_probability")
    return q.select("labeled_rows", "accuracy_score", "precision_positive", "recall_positive", "f1_positive",
                    "log_loss", "roc_auc")


@query("ml_persist_load")
def ml_persist_load(t):
    """The best model as Challenger, a plain one as Champion until the Challenger beats it on the val split."""
    store = cm.ModelStore(t.spark, shared_dir(t.spark, "models"))
    plain = cm.fit_final(_split(t, "train"), cm.draw_params(0, 42, cm.SPACE), val=_split(t, "val"))

    def measured(model):
        q = quality(cm.score(model, _split(t, "val")), "label", "prediction", "churn_probability").first()
        return float(q["f1_positive"] or 0.0), q["roc_auc"]

    old, new = measured(plain), measured(_model(t))
    first = store.register("churn_model", plain, *old)
    store.set_alias("churn_model", "Champion", first)
    second = store.register("churn_model", _model(t), *new)
    store.set_alias("churn_model", "Challenger", second)
    version = second if new[0] >= old[0] else first
    store.set_alias("churn_model", "Champion", version)
    reloaded = store.load("churn_model", "Champion")
    return cm.score(reloaded, _split(t, "test")).select("customer_id", "prediction", "churn_probability").withColumn(
        "version", F.lit(version))


@query("ml_batch_score")
def ml_batch_score(t):
    return cm.score(_model(t), _split(t, "test")).select("customer_id", "prediction", "churn_probability")


@query("ml_importance")
def ml_importance(t):
    """Split importance of each input column beside its permutation importance."""
    rows, model = _split(t, "val"), _model(t)
    weights = dict(cm.importances(model, rows))
    columns = [c for c in rows.columns if c in weights]
    moved = cm.permutation_importance(model, rows, columns)
    known = F.create_map(*[F.lit(x) for c in columns for x in (c, weights.get(c, 0.0))])
    return moved.withColumn("split_importance", known[F.col("column_name")])


@query("ml_attributions")
def ml_attributions(t):
    """What each input column adds to the score of each test row; base and attributions add up to the margin."""
    return at.row_attributions(_model(t), _split(t, "test"))


@query("ml_serving_payload", """select customer_id, '{"tenure_months":' || tenure_months || ',"contract_type":"' ||
 contract_type || '","senior_citizen":' || senior_citizen || ',"total_tickets":' || total_tickets || '}' as payload
 from features""")
def ml_serving_payload(t):
    rows = build_features(t.customers, t.tickets)
    return cm.serving_payload(rows, "customer_id", ("tenure_months", "contract_type", "senior_citizen", "total_tickets"))
