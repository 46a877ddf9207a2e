"""Binary classification quality from scored and labelled rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.columns import join_by
from ebbtide.operators.ordered import ordered_prefix

CLIP = 1e-15


def confusion_matrix(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """by, label, prediction, n: all four cells, also the empty ones."""
    cells = [(a, b) for a in (0.0, 1.0) for b in (0.0, 1.0)]
    wide = df.groupBy(*by).agg(*[
        F.count(F.when((F.col(label) == a) & (F.col(prediction) == b), 1)).alias(f"c{int(a)}{int(b)}")
        for a, b in cells])
    packed = F.array(*[F.struct(F.lit(a).alias("label"), F.lit(b).alias("prediction"),
                                F.col(f"c{int(a)}{int(b)}").alias("n")) for a, b in cells])
    return wide.select(*by, F.explode(packed).alias("_c")).select(*by, "_c.*")


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a.cast("double") / b).otherwise(F.lit(0.0))


def quality(
    df: DataFrame, label: str, prediction: str, probability: str | None = None, by: Sequence[str] = (),
) -> DataFrame:
    """Accuracy, precision, recall, F1 (positive class, macro, weighted), log loss and ROC area.

    Rows without a label do not count. Ratios with an empty denominator are 0.
    """
    by = list(by)
    rows = df.filter(F.col(label).isNotNull())
    y, hat = F.col(label) == 1, F.col(prediction) == 1
    aggs = [
        F.count(F.when(y & hat, 1)).alias("tp"), F.count(F.when(~y & hat, 1)).alias("fp"),
        F.count(F.when(y & ~hat, 1)).alias("fn"), F.count(F.when(~y & ~hat, 1)).alias("tn"),
    ]
    if probability:
        p = F.greatest(F.lit(CLIP), F.least(F.lit(1 - CLIP), F.col(probability)))
        aggs.append(F.avg(-F.log(F.when(y, p).otherwise(1 - p))).alias("log_loss"))
    c = rows.groupBy(*by).agg(*aggs)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    n, pos, neg = tp + fp + fn + tn, tp + fn, tn + fp
    p1, r1 = _ratio(tp, tp + fp), _ratio(tp, pos)
    p0, r0 = _ratio(tn, tn + fn), _ratio(tn, neg)
    f1, f0 = _ratio(2 * tp, 2 * tp + fp + fn), _ratio(2 * tn, 2 * tn + fn + fp)

    def averages(one: Column, zero: Column) -> Column:
        return F.struct(
            ((one + zero) / 2).alias("macro"), _ratio(tp + tn, n).alias("micro"),
            _ratio(one * pos + zero * neg, n).alias("weighted"))

    out = c.select(
        *by, n.alias("labeled_rows"), _ratio(tp + tn, n).alias("accuracy_score"),
        p1.alias("precision_positive"), r1.alias("recall_positive"), f1.alias("f1_positive"),
        averages(p1, p0).alias("precision"), averages(r1, r0).alias("recall"), averages(f1, f0).alias("f1_score"),
        *(["log_loss"] if probability else []),
    )
    if probability:
        auc = roc_auc(rows, label, probability, by)
        if by:
            out = join_by(out, auc, by, "left")
        else:
            out = out.withColumn("roc_auc", auc.select("roc_auc").scalar())
    return out


def _score_counts(df: DataFrame, label: str, score: str, by: list[str]) -> DataFrame:
    counts = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull()).groupBy(
        *by, F.col(score).cast("double").alias("score")).agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("pos"), F.count(F.when(F.col(label) != 1, 1)).alias("neg"))
    return ordered_prefix(counts, by, "score", ["pos", "neg"])


def roc_auc(
    df: DataFrame, label: str, score: str, by: Sequence[str] = ()
) -> DataFrame:
    """Chance that a positive outscores a negative, ties counting half; null with one class only."""
    by = list(by)
    wins = F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") * F.lit(0.5)))
    pairs = F.max("total_pos").cast("double") * F.max("total_neg")
    return _score_counts(df, label, score, by).groupBy(*by).agg(F.when(pairs > 0, wins / pairs).alias("roc_auc"))


def roc_curve(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """threshold, fpr, tpr: one point per distinct score, predicting 1 at or above it."""
    by = list(by)
    at_or_above = {s: F.col(f"total_{s}") - F.col(f"cum_{s}") + F.col(s) for s in ("pos", "neg")}
    return _score_counts(df, label, score, by).select(
        *by, F.col("score").alias("threshold"),
        _ratio(at_or_above["neg"], F.col("total_neg")).alias("fpr"),
        _ratio(at_or_above["pos"], F.col("total_pos")).alias("tpr"))


def unwrap_averages(df: DataFrame, names: Sequence[str] = ("precision", "recall", "f1_score")) -> DataFrame:
    """Quality fields may be plain numbers or structs of averages; take the weighted one of a struct."""
    out = df
    for name in names:
        kind = df.schema[name].dataType
        if kind.typeName() == "struct":
            fields = kind.fieldNames()
            picked = "weighted" if "weighted" in fields else fields[0]
            out = out.withColumn(name, F.col(f"{name}.{picked}"))
    return out
