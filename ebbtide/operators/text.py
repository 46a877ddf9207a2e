"""Batch text operators: prompts, labels, sentiment, summaries and field extraction.

The scorers are rules given as parameters, so that results can be checked. A caller with
a model of its own passes a frame through ``with_scorer``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.operators.search import words

SENTENCE_END = r"[.!?\n]+"


def build_prompt(instruction: str, parts: Mapping[str, Column]) -> Column:
    """The instruction, then one 'Name: value' line per part; a null value reads 'unknown'."""
    lines = [F.concat(F.lit(f"\n{name}: "), F.coalesce(value.cast("string"), F.lit("unknown")))
             for name, value in parts.items()]
    return F.concat(F.lit(instruction), *lines)


def with_scorer(
    df: DataFrame, scorer: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str
) -> DataFrame:
    """Hand the rows in Arrow batches to a caller's own model client."""
    return df.mapInPandas(scorer, schema)


def keyword_hits(df: DataFrame, text: str, lists: Mapping[str, Sequence[str]], key: str | None = None) -> DataFrame:
    """How often words of each list stand in the text, by row, or summed by ``key``.

    A text is split into words once. Sums of one key have a map-side part, so a key may have any number of rows.
    """
    split = df.withColumn("_words", words(F.coalesce(F.col(text), F.lit(""))))

    def count(listed: Sequence[str]) -> Column:
        return F.size(F.filter("_words", lambda w: w.isin(*listed)))

    hits = split.withColumns({name: count(k) for name, k in lists.items()}).drop("_words")
    return hits.groupBy(key).agg(*[F.sum(name).alias(name) for name in lists]) if key else hits


def classify(
    df: DataFrame, text: str, labels: Mapping[str, Sequence[str]], default: str, out: str = "label", key: str | None = None
) -> DataFrame:
    """Exactly one label per row, or per ``key``: most keyword hits, ties to the label named first, no hit to the default."""
    scores = [f"_score_{i}" for i in range(len(labels))]
    scored = keyword_hits(df, text, dict(zip(scores, labels.values())), key)
    best = F.greatest(*scores) if len(scores) > 1 else F.col(scores[0])
    choice = F.when(best == 0, F.lit(default))
    for s, label in zip(scores, labels):
        choice = choice.when(F.col(s) == best, F.lit(label))
    return scored.withColumn(out, choice).drop(*scores)


def sentiment(
    df: DataFrame, text: str, positive: Sequence[str], negative: Sequence[str], out: str = "sentiment", key: str | None = None
) -> DataFrame:
    """positive, negative, neutral (no hits) or mixed (the weaker side has at least half the hits), per row or per ``key``."""
    scored = keyword_hits(df, text, {"_pos": positive, "_neg": negative}, key)
    pos, neg = F.col("_pos"), F.col("_neg")
    verdict = (
        F.when((pos == 0) & (neg == 0), "neutral")
        .when(F.least(pos, neg) * 2 >= F.greatest(pos, neg), "mixed")
        .when(pos > neg, "positive").otherwise("negative")
    )
    return scored.withColumn(out, verdict).drop("_pos", "_neg")


def summarize(df: DataFrame, key: str, text: str, out: str = "summary", order: str | None = None) -> DataFrame:
    """One row per key: the sentence whose words are the most frequent among all of the key's; ties to the earliest.

    A key may have several rows; ``order`` then says which is earlier, and rows without it come last. A
    key without words has a null summary. Word counts by key have a map-side part.
    """
    place = F.coalesce(F.col(order).cast("bigint"), F.lit((1 << 63) - 1)) if order else F.lit(0).cast("bigint")
    sentences = df.select(key, place.alias("_o"), F.xxhash64(text).alias("_h"), F.posexplode(
        F.transform(F.split(F.col(text), SENTENCE_END), lambda s: F.trim(s))).alias("_s", "_sentence"))
    at = [key, "_o", "_h", "_s"]
    counted = sentences.select(*at, F.explode(words(F.col("_sentence"))).alias("_w")).groupBy(*at, "_w").agg(F.count("*").alias("_c"))
    weighted = counted.join(counted.groupBy(key, "_w").agg(F.sum("_c").alias("_tf")), [key, "_w"])
    scored = weighted.groupBy(*at).agg((F.sum(F.col("_c") * F.col("_tf")).cast("double") / F.sum("_c")).alias("_score"))
    best = scored.groupBy(key).agg(F.min(F.struct((-F.col("_score")).alias("_score"), "_o", "_h", "_s")).alias("_b")).select(key, "_b._o", "_b._h", "_b._s")
    said = sentences.join(best, at).groupBy(key).agg(F.min("_sentence").alias(out))
    return df.select(key).distinct().join(said, key, "left")


def transcript_lines(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """key, turn, line: each turn as a 'Role: text' line."""
    line = F.concat(F.initcap(role), F.lit(": "), F.coalesce(F.col(text), F.lit("")))
    return turns.select(key, order, line.alias("line"))


def assemble_transcripts(
    turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text",
    turns_per_part: int = 1000,
) -> DataFrame:
    """key, part, n_turns, transcript_text: 'Role: text' lines in turn order.

    A conversation of ordinary length is part 0. A longer one continues in further
    parts, so no task and no value has to hold an unbounded number of turns. Turns
    without a number have no order; they are spread over negative parts.
    """
    unordered = -1 - F.pmod(F.xxhash64(text), F.lit(64))
    part = F.coalesce(F.floor(F.col(order) / turns_per_part), unordered).cast("bigint")
    line = F.concat(F.initcap(role), F.lit(": "), F.coalesce(F.col(text), F.lit("")))
    lines = turns.select(key, part.alias("part"), F.struct(F.col(order), line.alias("line")).alias("_l"))
    return lines.groupBy(key, "part").agg(
        F.count("*").alias("n_turns"),
        F.array_join(F.transform(F.sort_array(F.collect_list("_l")), lambda x: x["line"]), "\n").alias("transcript_text"))


def _first_match(text: Column, pattern: str) -> Column:
    hit = F.regexp_extract(text, pattern, 0)
    return F.when(hit != "", hit)


def extract_fields(text: Column, fields: Mapping[str, str]) -> Column:
    """A struct with the first match of each field's pattern, null without one."""
    return F.struct(*[_first_match(text, pattern).alias(name) for name, pattern in fields.items()])


def extract_fields_v2(text: Column, names_json: str, patterns: Mapping[str, str]) -> Column:
    """``{response: {field: value}, error_message}`` for a JSON list of field names.

    A field nobody has a pattern for is null and named in the error message; so is an
    empty text.
    """
    import json

    names = json.loads(names_json)
    if not isinstance(names, list) or not all(isinstance(n, str) for n in names):
        raise ValueError("the field list must be a JSON array of strings")
    unknown = [n for n in names if n not in patterns]
    response = F.struct(*[
        (_first_match(text, patterns[n]) if n in patterns else F.lit(None).cast("string")).alias(n) for n in names])
    problem = F.when(F.coalesce(F.length(text), F.lit(0)) == 0, F.lit("empty document"))
    if unknown:
        problem = problem.otherwise(F.lit("no rule for " + ", ".join(unknown)))
    return F.struct(response.alias("response"), problem.alias("error_message"))


def _equals(value: Column) -> Callable[[Column], Column]:
    return lambda m: m == value


def _citation(name: str, value: Column) -> Callable[[Column, Column], Column]:
    return lambda line, i: F.struct(
        i.alias("id"), F.lit(name).alias("field"), F.instr(line, value).alias("start"),
        (F.instr(line, value) + F.length(value) - 1).alias("end"))


def extract_audited(df: DataFrame, text: str, fields: Mapping[str, str], out: str = "audited") -> DataFrame:
    """Add ``{response: {field: {value, confidence_score, citation_ids}}, metadata: {citations}}``.

    The confidence is the share of a field's matches that agree with its first match. A
    citation is a line of the text that contains the value: (id, field, start, end), with
    the line number as id. Matches and lines are columns of an earlier projection, so a
    text is searched once per field and not once per line.
    """
    found = {name: f"_m_{name}" for name in fields}
    staged = df.withColumns({
        "_lines": F.split(F.col(text), "\n"),
        **{found[name]: F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)) for name, pattern in fields.items()},
    })
    answers, cited = [], []
    for name in fields:
        matches = F.col(found[name])
        value = F.get(matches, F.lit(0))
        places = F.when(F.size(matches) > 0, F.filter(
            F.transform("_lines", _citation(name, value)), lambda c: c["start"] > 0))
        staged = staged.withColumn(f"_c_{name}", F.coalesce(places, F.slice(F.transform(
            "_lines", _citation(name, F.lit(""))), 1, 0)))
        cited.append(F.col(f"_c_{name}"))
        answers.append(F.struct(
            value.alias("value"),
            F.when(value.isNotNull(), F.size(F.filter(matches, _equals(value))).cast("double") / F.size(matches))
            .alias("confidence_score"),
            F.transform(f"_c_{name}", lambda c: c["id"]).alias("citation_ids")).alias(name))
    audited = F.struct(F.struct(*answers).alias("response"), F.struct(F.concat(*cited).alias("citations")).alias("metadata"))
    return staged.withColumn(out, audited).select(*df.columns, out)


def audited_fields(df: DataFrame, key: str, audited: str, fields: Sequence[str]) -> DataFrame:
    """key, field, value, confidence_score, citation_ids: one row per field."""
    packed = F.array(*[F.struct(
        F.lit(f).alias("field"), F.col(f"{audited}.response.{f}.value").alias("value"),
        F.col(f"{audited}.response.{f}.confidence_score").alias("confidence_score"),
        F.col(f"{audited}.response.{f}.citation_ids").alias("citation_ids")) for f in fields])
    return df.select(key, F.explode(packed).alias("_f")).select(key, "_f.*")


def resolve_citations(df: DataFrame, key: str, audited: str, fields: Sequence[str]) -> DataFrame:
    """key, field, citation_id, start, end: every cited id with its record."""
    wanted = audited_fields(df, key, audited, fields).select(key, "field", F.explode("citation_ids").alias("citation_id"))
    records = df.select(key, F.explode(f"{audited}.metadata.citations").alias("_c")).select(
        key, "_c.field", F.col("_c.id").alias("citation_id"), "_c.start", "_c.end")
    return wanted.join(records, [key, "field", "citation_id"])


# Fixed limits of the routing rule.
HIGH, MEDIUM = 0.85, 0.60


def route_by_confidence(df: DataFrame, confidence: str = "confidence_score", hi: float = HIGH, lo: float = MEDIUM) -> DataFrame:
    c = F.col(confidence)
    band = F.when(c.isNull(), "unknown").when(c >= hi, "high").when(c >= lo, "medium").otherwise("low")
    return df.withColumn("route", band).withColumn(
        "action", F.when(F.col("route") == "high", "auto_approve").otherwise("review"))
