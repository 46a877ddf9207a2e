"""Evaluation tables and trace summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.operators import evaluate as ev
from ebbtide.operators import spans as sp
from ebbtide.plans.oracle import VIEWS
from ebbtide.plans.registry import query


def _words(x: str) -> str:
    return f"list_filter(string_split_regex(lower({x}), '[^\\p{{L}}]+'), lambda w: w <> '')"


VIEWS["examples"] = f"""select a.conv_id || '-' || a.turn as example_id, a.text as question, b.text as response,
 list_filter({_words('a.text')}, lambda w: len(w) >= 5) as long_words
 from conversations a left join conversations b on a.conv_id=b.conv_id and b.turn=a.turn+1 and b.role='assistant'
 where a.role='user'"""
# First three distinct long words, in order of appearance.
VIEWS["example_facts"] = """select *, list_filter(long_words, lambda w, i: list_position(long_words, w) = i)[1:3] as facts
 from examples"""


def _scored_sql(source):
    response = "coalesce(response, '')"
    q, r = _words("question"), _words(response)
    common = f"len(list_distinct(list_intersect({q}, {r})))"
    union = f"(len(list_distinct({q})) + len(list_distinct({r})) - {common})"
    # Written apart from the operator's own pattern.
    unsafe = "[\\w.]+@[\\w.]+|[0-9]{12}|([0-9]{1,3}[.]){3}[0-9]"
    checks = {
        "relevance": f"case when {union} > 0 then {common}::double/{union} else 0e0 end",
        "safety": f"case when regexp_matches({response}, '{unsafe}') then 0e0 else 1e0 end",
        "guideline_specific": f"case when len({r}) >= 10 then 1e0 else 0e0 end",
        "guideline_grounded": f"case when len(list_intersect(facts, {r})) > 0 then 1e0 else 0e0 end",
        "guideline_finished": "case when regexp_matches(trim(coalesce(response, '')), '[.!?]$') then 1e0 else 0e0 end",
    }
    return " union all ".join(f"select example_id, '{n}' as scorer, {c} as score from {source}" for n, c in checks.items())


VIEWS["scores"] = _scored_sql("example_facts")
VIEWS["example_facts_v2"] = """select * replace (concat_ws(chr(10), 'Situation: ' || question, response) as response)
 from example_facts"""
VIEWS["scores_v2"] = _scored_sql("example_facts_v2")


def _examples(t):
    return ev.eval_dataset(t.raw("conversations"))


def _improved(t):
    """The second run: the reply opens by restating the situation."""
    return _examples(t).withColumn(
        "response", F.concat_ws("\n", F.concat(F.lit("Situation: "), ev.question()), "response"))


@query("eval_dataset", """select example_id, question, array_to_string(facts, ',') as expected_facts, response
 from example_facts""")
def eval_dataset(t):
    return _examples(t).select(
        "example_id", ev.question().alias("question"), F.concat_ws(",", "expected_facts").alias("expected_facts"), "response")


@query("eval_wrap", """select example_id, question as content, 'user' as role from examples""")
def eval_wrap(t):
    wrapped = ev.wrap_inputs(_examples(t))
    return wrapped.select("example_id", F.explode("inputs.inputs.messages").alias("m")).select(
        "example_id", "m.content", "m.role")


@query("eval_score", "select example_id, scorer, round(score, 6) as score from scores")
def eval_score(t):
    return ev.eval_score(_examples(t)).withColumn("score", F.round("score", 6))


@query("eval_aggregate", """select scorer, count(*) as examples, round(avg(score), 6) as mean_score,
 round(avg(case when score >= 0.5 then 1e0 else 0e0 end), 6) as pass_rate from scores group by scorer""")
def eval_aggregate(t):
    out = ev.eval_aggregate(ev.eval_score(_examples(t)))
    return out.select("scorer", "examples", *[F.round(c, 6).alias(c) for c in ("mean_score", "pass_rate")])


@query("eval_compare", """select a.scorer, round(a.m, 6) as a, round(b.m, 6) as b, round(b.m - a.m, 6) as delta
 from (select scorer, avg(score) as m from scores group by 1) a
 join (select scorer, avg(score) as m from scores_v2 group by 1) b on a.scorer = b.scorer""")
def eval_compare(t):
    out = ev.eval_compare(ev.eval_score(_examples(t)), ev.eval_score(_improved(t)))
    return out.select("scorer", *[F.round(c, 6).alias(c) for c in ("a", "b", "delta")])


@query("trace_rollup", """select conv_id, count(*) as spans, count(*) filter (where role='user') as user_spans,
 count(*) filter (where role='assistant') as assistant_spans, count(*) filter (where role='system') as system_spans,
 count(*) filter (where role='assistant') as iterations, arg_min(role, turn) as root_role,
 arg_max(text, turn) as result from conversations group by conv_id""")
def trace_rollup(t):
    return ev.trace_rollup(t.raw("conversations"))


@query("span_tree", """with recursive p as (select conv_id, turn, role, case role
  when 'user' then (select max(b.turn) from conversations b where b.conv_id=a.conv_id and b.turn < a.turn and b.role in ('assistant','system'))
  when 'assistant' then (select max(b.turn) from conversations b where b.conv_id=a.conv_id and b.turn < a.turn and b.role='user') end as parent
  from conversations a),
 up as (select conv_id, turn, turn as above, parent as next, 0 as d from p
  union all select u.conv_id, u.turn, p.turn, p.parent, d + 1 from up u join p on p.conv_id=u.conv_id and p.turn=u.next),
 depth as (select conv_id, turn, max(d) as depth from up group by all),
 below as (select u.conv_id, u.above as turn, count(*) as spans, count(*) filter (where p.role='assistant') as assistant_spans
  from up u join p on p.conv_id=u.conv_id and p.turn=u.turn group by all),
 kids as (select conv_id, parent as turn, count(*) as children, count(*) filter (where role='assistant') as assistant_children from p
  where parent is not null group by all)
 select p.conv_id, p.turn, p.role, p.parent, depth.depth::bigint as depth, coalesce(children, 0) as children,
  coalesce(assistant_children, 0) as assistant_children, spans, assistant_spans
 from p join depth using (conv_id, turn) join below using (conv_id, turn) left join kids using (conv_id, turn)""")
def span_tree(t):
    return sp.span_tree(t.raw("conversations")).select(
        "conv_id", "turn", "role", "parent", "depth", "children", "assistant_children", "spans", "assistant_spans")
