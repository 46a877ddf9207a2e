"""Evaluation sets, scorers and trace summaries as tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.operators.search import words

# Patterns that make a response unsafe: mail address, long digit run, network address.
UNSAFE = r"[A-Za-z0-9._]+@[A-Za-z0-9.]+|\d{12,}|\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"


def expected_facts(text: Column, count: int = 3, letters: int = 5) -> Column:
    """The first few distinct long words of the question."""
    return F.slice(F.array_distinct(F.filter(words(text), lambda w: F.length(w) >= letters)), 1, count)


def eval_dataset(turns: DataFrame, facts: int = 3, letters: int = 5) -> DataFrame:
    """example_id, inputs{messages}, expected_facts, response: a user turn and the assistant's next.

    A question that nobody answered stays, with a null response. Expected are the first ``facts``
    distinct words of at least ``letters`` letters. The join is on (conversation, turn), so one very
    long conversation spreads over tasks.
    """
    asked = turns.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    replied = turns.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response"))
    return asked.join(replied, ["conv_id", "turn"], "left").select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("example_id"),
        F.struct(F.array(F.struct(F.lit("user").alias("role"), F.col("question").alias("content"))).alias("messages"))
        .alias("inputs"),
        expected_facts(F.col("question"), facts, letters).alias("expected_facts"), "response")


def wrap_inputs(examples: DataFrame) -> DataFrame:
    return examples.withColumn("inputs", F.struct(F.col("inputs").alias("inputs")))


def question() -> Column:
    return F.get(F.col("inputs.messages"), F.size("inputs.messages") - 1)["content"]


def jaccard(a: Column, b: Column) -> Column:
    common = F.size(F.array_intersect(a, b))
    either = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b)) - common
    return F.when(either > 0, common.cast("double") / either).otherwise(F.lit(0.0))


def standard_scorers() -> dict[str, Column]:
    """relevance, safety and the guideline checks, each between 0 and 1; a missing response counts as empty."""
    response = F.coalesce(F.col("response"), F.lit(""))
    said = words(response)
    facts = F.col("expected_facts")

    def yes(condition: Column) -> Column:
        return F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))

    return {
        "relevance": jaccard(words(question()), said),
        "safety": yes(~response.rlike(UNSAFE)),
        "guideline_specific": yes(F.size(said) >= 10),
        "guideline_grounded": yes(F.size(F.array_intersect(facts, said)) > 0),
        "guideline_finished": yes(F.trim(response).rlike(r"[.!?]$")),
    }


def eval_score(examples: DataFrame, scorers: Mapping[str, Column] | None = None) -> DataFrame:
    """example_id, scorer, score: one row per example and scorer."""
    scorers = scorers or standard_scorers()
    wide = examples.select("example_id", *[c.cast("double").alias(n) for n, c in scorers.items()])
    return wide.unpivot("example_id", list(scorers), "scorer", "score")


def eval_aggregate(scores: DataFrame, passing: float = 0.5) -> DataFrame:
    return scores.groupBy("scorer").agg(
        F.count("*").alias("examples"), F.avg("score").alias("mean_score"),
        F.avg(F.when(F.col("score") >= passing, 1.0).otherwise(0.0)).alias("pass_rate"))


def eval_compare(first: DataFrame, second: DataFrame) -> DataFrame:
    """scorer, a, b, delta of two scored runs over the same examples."""
    a = eval_aggregate(first).select("scorer", F.col("mean_score").alias("a"))
    b = eval_aggregate(second).select("scorer", F.col("mean_score").alias("b"))
    return a.join(b, "scorer", "full").withColumn("delta", F.col("b") - F.col("a"))


def trace_rollup(turns: DataFrame, kinds: Sequence[str] = ("user", "assistant", "system"),
                 max_iterations: int | None = None, result_characters: int | None = None) -> DataFrame:
    """Per conversation: spans in all and by kind, loop rounds, first and last message.

    Counts are true and texts whole. Where a loop had a bound, ``max_iterations`` adds ``over_limit``;
    ``result_characters`` shortens what is shown of the result. Everything is an aggregate with a map-side part; no conversation is collected.
    """
    rounds = F.count(F.when(F.col("role") == "assistant", 1))
    result = F.max_by("text", "turn")
    return turns.groupBy("conv_id").agg(
        F.count("*").alias("spans"),
        *[F.count(F.when(F.col("role") == k, 1)).alias(f"{k}_spans") for k in kinds],
        rounds.alias("iterations"),
        *([(rounds > max_iterations).alias("over_limit")] if max_iterations is not None else []),
        F.min_by("role", "turn").alias("root_role"),
        (result if result_characters is None else F.substring(result, 1, result_characters)).alias("result"))
