"""Quality classifier with hierarchical empirical Bayes.

A document's own evidence is two logistic models, for low quality and for toxicity, over surface
features and the log-odds of words learned from labels. Its site gives the prior: the rates of a host and
of a path below it are grouped sums of the evidence, shrunk level by level, a path toward its host and a
host toward the whole. How strongly is estimated from how much rates differ between groups. The
posterior adds the evidence and how the prior of the document's path differs from that of the whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.runtime import buffers, carried, column, ensure, quoted, slices, stored

#: Most labelled documents a model is fitted on, most words it knows, documents a known word has at least.
FIT_ROWS, LEXICON, LEAST_DOCUMENTS = 20_000, 5_000, 3
FEATURES = ("symbols", "capitals", "digits", "repeats", "sameness", "length", "weight", "known")
WORD = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
TARGETS = ("poor", "toxic")
#: Evidence is worth at most this much, in logits.
MOST = 12.0

find_words = re.compile(WORD).findall


@dataclass(frozen=True)
class Model:
    """Word weights for toxicity, and coefficients of both logistic models over (1, *features)."""

    lexicon: dict[str, float]
    coefficients: dict[str, tuple[float, ...]]


def _marks() -> np.ndarray:
    table = np.zeros((3, 256), np.uint8)
    for row, chars in enumerate(("!|*#&%$@^~<>{}[]\\=+_", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789")):
        table[row, [ord(c) for c in chars]] = 1
    return table


def features(texts: pa.Array, lexicon: dict[str, float]) -> np.ndarray:
    """One row of FEATURES for each text; null counts as empty."""
    data, offsets = buffers(texts)
    size = np.maximum(np.diff(offsets), 1)
    out = np.zeros((len(texts), len(FEATURES)))
    for k, marks in enumerate(_marks()):
        total = np.concatenate([[0], np.cumsum(marks[data], dtype=np.int64)])
        out[:, k] = (total[offsets[1:]] - total[offsets[:-1]]) / size
    out[:, 5] = np.log1p(np.diff(offsets)) / 10
    get = lexicon.get
    for i, text in enumerate(texts.to_pylist()):
        words = find_words(text.lower()) if text else ()
        if words:
            out[i, 3] = sum(map(str.__eq__, words, words[1:])) / len(words)
            distinct = set(words)
            out[i, 4] = (1 - len(distinct) / len(words)) if len(words) > 20 else 0
            known = [w for w in map(get, distinct) if w is not None]
            out[i, 6:] = sum(known) / 10, len(known) / 5
    return out


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> tuple[float, ...]:
    """Ridge logistic regression by Newton's method over (1, standardised x), given for plain x."""
    mean, spread = x.mean(axis=0), x.std(axis=0)
    spread[spread == 0] = 1
    a = np.column_stack([np.ones(len(x)), (x - mean) / spread])
    w = np.zeros(a.shape[1])
    penalty = np.diag([1e-9] + [ridge * len(x)] * x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a.T * (p * (1 - p) + 1e-9)) @ a + penalty, a.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    slopes = w[1:] / spread
    return (float(w[0] - slopes @ mean), *map(float, slopes))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, text: str = "text") -> Model:
    """Fit on at most ``fit_rows`` labelled documents, the first by a hash of their id.

    Labels of one id are put together: toxic if one says so, of quality if all do; null labels and ids
    are left out. One half of the sample gives the words, the other half the coefficients. What is
    collected is bounded by ``fit_rows`` rows of numbers and LEXICON words. Without labels of both kinds
    a model knows only the rate.
    """
    spark = ensure(docs.sparkSession)
    known = labels.where("doc_id is not null and quality is not null and toxic is not null").groupBy("doc_id").agg(
        (1 - F.min("quality")).alias("poor"), F.max("toxic").alias("toxic"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    # At most fit_rows short rows, so the bound of this broadcast is known.
    rows = docs.select("doc_id", F.col(f"`{text}`").alias("text")).join(F.broadcast(stored(sample, "fit-labels")), "doc_id")
    rows = rows.withColumn("half", F.pmod(F.xxhash64(F.col("doc_id"), F.lit("half")), F.lit(2)))

    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)))
    split = rows.where("half = 0")
    sizes = split.agg(F.coalesce(F.sum("toxic"), F.lit(0)).alias("t"), F.count("*").alias("n")).first()
    toxic, clean = sizes["t"], sizes["n"] - sizes["t"]
    counts = split.select("toxic", F.explode(words).alias("word")).groupBy("word").agg(F.sum("toxic").alias("t"), F.count("*").alias("n"))
    odds = F.log((F.col("t") + 0.5) / F.lit(toxic + 1.0)) - F.log((F.col("n") - F.col("t") + 0.5) / F.lit(clean + 1.0))
    strong = counts.where(F.col("t") >= LEAST_DOCUMENTS).withColumn("odds", odds).where("odds > 2").orderBy(
        F.desc(F.col("odds") * F.col("t")), "word").limit(LEXICON)
    lexicon = {r["word"]: float(r["odds"]) for r in strong.collect()} if toxic and clean else {}

    shared = spark.sparkContext.broadcast(lexicon)
    names = [*TARGETS, *FEATURES]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            x = features(column(piece, "text"), shared.value)
            y = [column(piece, t).cast(pa.float64()) for t in TARGETS]
            yield pa.RecordBatch.from_arrays([*y, *(pa.array(c) for c in x.T)], names)

    got = rows.where("half = 1").select("text", *TARGETS).mapInArrow(measure, ", ".join(f"{n} double" for n in names)).toPandas()
    got = got.sort_values(names)  # the order of tasks must not move the last digits
    x, coefficients = got[list(FEATURES)].to_numpy(), {}
    for target in TARGETS:
        y = got[target].to_numpy()
        rate = (y.sum() + 0.5) / (len(y) + 1)
        both = 0 < y.sum() < len(y)
        coefficients[target] = logistic(x, y) if both else (float(np.log(rate / (1 - rate))), *[0.0] * len(FEATURES))
    return Model(lexicon, coefficients)


def evidence(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with _poor and _toxic, the logits of the document's own evidence."""
    spark = ensure(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    names = docs.columns

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        weights = np.array([known.coefficients[t] for t in TARGETS]).T
        for piece in slices(batches, text):
            x = features(column(piece, text), known.lexicon)
            logits = np.clip(weights[0] + x @ weights[1:], -MOST, MOST)
            yield pa.RecordBatch.from_arrays([*piece.columns, *(pa.array(c) for c in logits.T)], [*names, "_poor", "_toxic"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), "_poor double", "_toxic double"])
    return docs.mapInArrow(score, schema)


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def site_priors(scored: DataFrame, host: Column, path: Column) -> DataFrame:
    """(_host, _path, _prior_poor, _prior_toxic): for each path, how the logit of its shrunken rate differs from the whole's.

    Documents are summed before any shuffle by path, paths by host, and hosts over all.
    """
    p = {t: _sigmoid(F.col(f"_{t}")) for t in TARGETS}
    paths = stored(scored.groupBy(host.alias("_host"), path.alias("_path")).agg(
        F.count("*").alias("n"), *(F.sum(p[t]).alias(t) for t in TARGETS)), "site-sums")
    hosts = paths.groupBy("_host").agg(F.sum("n").alias("host_n"), *(F.sum(t).alias(f"host_{t}") for t in TARGETS))

    def strength(groups: DataFrame, n: str, prefix: str) -> dict[str, tuple[float, float]]:
        """(mean rate, how many documents the mean is worth) by moments: one row is collected."""
        total = F.sum(n)
        whole = groups.agg(total.alias("n"), F.count("*").alias("g"), F.sum(F.col(n).cast("double") * F.col(n)).alias("nn"), *(
            F.sum(f"{prefix}{t}").alias(t) for t in TARGETS), *(
            F.sum(F.col(f"{prefix}{t}") * F.col(f"{prefix}{t}") / F.col(n)).alias(f"{t}_square") for t in TARGETS)).first()
        out = {}
        for t in TARGETS:
            count = float(whole["n"] or 0)
            mean = min(max(((whole[t] or 0.0) + 0.5) / (count + 1), 1e-6), 1 - 1e-6)
            between = (whole[f"{t}_square"] or 0.0) - count * mean * mean
            room = count - (whole["nn"] or 0.0) / count if count else 0.0
            variance = (between - (whole["g"] - 1) * mean * (1 - mean)) / room if room > 0 else 0.0
            worth = mean * (1 - mean) / variance - 1 if variance > 0 else 1e6
            out[t] = mean, min(max(worth, 10.0), 1e6)
        return out

    over_hosts, over_paths = strength(hosts, "host_n", "host_"), strength(paths, "n", "")
    priors = paths.join(hosts, paths["_host"].eqNullSafe(hosts["_host"])).drop(hosts["_host"])
    for t in TARGETS:
        mean, worth = over_hosts[t]
        at_host = (F.col(f"host_{t}") + mean * worth) / (F.col("host_n") + worth)
        worth = over_paths[t][1]
        at_path = (F.col(t) + at_host * worth) / (F.col("n") + worth)
        priors = priors.withColumn(f"_prior_{t}", _logit(at_path) - float(np.log(mean / (1 - mean))))
    return stored(priors.select("_host", "_path", *(f"_prior_{t}" for t in TARGETS)), "site-priors")


def classify(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", threshold: float = 0.5,
             fit_rows: int = FIT_ROWS, text: str = "text") -> DataFrame:
    """``docs`` with p_poor, p_toxic and keep, which is set where both stay below the threshold.

    The host and path of a document are two of its columns; null is a host and a path of its own. A null
    text is judged as the empty one. Each row is judged by itself, repeated rows alike. Columns of
    ``docs`` with the names of the new ones are replaced, all others come out unchanged. An empty table gives
    no rows; without labels the rates alone decide. A very long text is measured as a whole. A document on the
    threshold is not kept.
    """
    new = ("p_poor", "p_toxic", "keep")
    docs = docs.drop(*new)
    model = fit(docs, labels, fit_rows, text)
    user, back = carried(docs, [c for c in docs.columns if c != text])
    back.insert(docs.columns.index(text), F.col("text").alias(text))
    site = (F.col(quoted(host)).alias("_h"), F.col(quoted(path)).alias("_p"))
    the_text = F.col(quoted(text)).alias("text")
    priors = site_priors(evidence(docs.select(*site, the_text), model), F.col("_h"), F.col("_p"))
    scored = evidence(docs.select(user, *site, the_text), model)
    joined = scored.join(priors, scored["_h"].eqNullSafe(priors["_host"]) & scored["_p"].eqNullSafe(priors["_path"]), "left")
    p = {t: _sigmoid(F.col(f"_{t}") + F.coalesce(f"_prior_{t}", F.lit(0.0))) for t in TARGETS}
    judged = joined.select("user", "text", *(p[t].alias(f"p_{t}") for t in TARGETS))
    keep = (F.col("p_poor") < threshold) & (F.col("p_toxic") < threshold)
    return judged.select(*back, "p_poor", "p_toxic", keep.alias("keep"))
