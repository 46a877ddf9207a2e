"""Text, documents, retrieval and evaluation on edge rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from ebbtide.operators import documents as dc
from ebbtide.operators import evaluate as ev
from ebbtide.operators import retrieve as rt
from ebbtide.operators import search as se
from ebbtide.operators import text as tx


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "id bigint, text string")


def test_classify_ties_defaults_and_nulls(spark):
    df = texts(spark, "apple pear", "pear pear apple", "none", None, "")
    got = tx.classify(df, "text", {"A": ["apple"], "P": ["pear"]}, "other")
    assert [r.label for r in got.orderBy("id").collect()] == ["A", "P", "other", "other", "other"]


def test_sentiment(spark):
    df = texts(spark, "good good good", "bad", "good bad", "nothing", None)
    got = tx.sentiment(df, "text", ["good"], ["bad"]).orderBy("id").collect()
    assert [r.sentiment for r in got] == ["positive", "negative", "mixed", "neutral", "neutral"]


def test_summary(spark):
    df = texts(spark, "Alone here. the cat the cat. Other words.", "one. two.", None, "!!!")
    got = dict(rows(tx.summarize(df, "id", "text")))
    assert got[0] == "the cat the cat" and got[1] == "one"  # ties go to the earliest
    assert got[2] is None and got[3] is None


def test_extract(spark):
    df = texts(spark, "a 12 b 34", "none", "", None)
    got = [r[0] for r in df.orderBy("id").select(tx.extract_fields(F.col("text"), {"n": "[0-9]+"})["n"]).collect()]
    assert got == ["12", None, None, None]
    v2 = df.orderBy("id").select(tx.extract_fields_v2(F.col("text"), '["n"]', {"n": "[0-9]+"}).alias("x")).collect()
    assert [(r.x.response.n, r.x.error_message) for r in v2] == [
        ("12", None), (None, None), (None, "empty document"), (None, "empty document")]
    with pytest.raises(ValueError):
        tx.extract_fields_v2(F.col("text"), '{"a": 1}', {})


def test_audited_and_citations(spark):
    df = texts(spark, "x 12\ny 34\nz 12", "none", None)
    audited = tx.extract_audited(df, "text", {"n": "[0-9]+"}, "x")
    got = {r.id: r for r in tx.audited_fields(audited, "id", "x", ["n"]).collect()}
    assert (got[0].value, got[0].citation_ids) == ("12", [0, 2])
    assert got[0].confidence_score == pytest.approx(2 / 3)
    assert got[1].value is None and got[1].confidence_score is None and got[1].citation_ids == []
    cited = tx.resolve_citations(audited, "id", "x", ["n"])
    assert {(r.id, r.field, r.citation_id, r.start, r.end) for r in cited.collect()} == {
        (0, "n", 0, 3, 4), (0, "n", 2, 3, 4)}


def test_routes(spark):
    df = spark.createDataFrame([(0.85,), (0.60,), (0.5999,), (None,)], "confidence_score double")
    got = [(r.route, r.action) for r in tx.route_by_confidence(df).collect()]
    assert got == [("high", "auto_approve"), ("medium", "review"), ("low", "review"), ("unknown", "review")]


def test_transcripts(spark):
    turns = spark.createDataFrame([(1, 2, "agent", "b"), (1, 0, "customer", "a"), (2, 5, "agent", None),
                                   (3, None, "agent", "lost"), (4, 0, "agent", "p"), (4, 1500, "agent", "q")],
                                  "conv_id int, turn int, role string, text string")
    got = {(r.conv_id, r.part): r.transcript_text for r in tx.assemble_transcripts(turns).collect()}
    assert got[(1, 0)] == "Customer: a\nAgent: b" and got[(2, 0)] == "Agent: "
    assert got[(4, 0)] == "Agent: p" and got[(4, 1)] == "Agent: q"  # long calls continue in parts
    assert [t for (c, p), t in got.items() if c == 3 and p < 0] == ["Agent: lost"]


HTML = """<html><head><title>T &amp; t</title><style>p{}</style><script>var a = "</p><p>hidden</p>";</script></head>
<body><nav><ul><li><a href=x>one</a></li></ul></nav><h1>Head</h1><p>first <b>bold <p>second<table><tr><td>1</td></tr></table>
<!-- <p>comment</p> --><footer>&copy; us</footer>tail</body>"""


def test_parse_document(spark):
    df = texts(spark, HTML, "", None, "plain words", "<p>open")
    got = {r.id: r.parsed for r in dc.parse_documents(df, "id", "text").collect()}
    found = [(e.type, e.content) for e in got[0].document.elements]
    assert found == [("title", "T & t"), ("page_header", "one"), ("section_header", "Head"), ("text", "first bold"),
                     ("text", "second"), ("table", "1"), ("page_footer", "© us"), ("text", "tail")]
    assert [e.id for e in got[0].document.elements] == list(range(8)) and got[0].error_status is None
    assert got[1].error_status == "empty document" and got[2].error_status == "empty document"
    assert [(e.type, e.content) for e in got[3].document.elements] == [("text", "plain words")]
    assert [e.content for e in got[4].document.elements] == ["open"]


@pytest.mark.parametrize("local", [4096, 1])
def test_topk_equals_brute_force(spark, local):
    rng = np.random.default_rng(5)
    items = rng.normal(size=(60, 8)).round(3)
    items[7] = items[3]  # a tie
    items[9] = 0
    queries = np.vstack([items[3], rng.normal(size=(4, 8))])
    i = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(items)], "item_id bigint, vector array<double>")
    q = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(queries)], "query_id bigint, vector array<double>")
    got = rt.vector_topk(q, i.repartition(5), 4, block=local).orderBy("query_id", "rank").collect()
    for k, v in enumerate(queries):
        norms = np.linalg.norm(items, axis=1)
        scores = np.where(norms > 0, items @ v / np.where(norms > 0, norms, 1) / np.linalg.norm(v), 0).round(9)
        want = sorted(range(60), key=lambda j: (-scores[j], j))[:4]
        assert [r.item_id for r in got if r.query_id == k] == want
    assert rt.vector_topk(q, i, 100, block=local).count() == 5 * 60  # k larger than the table


def test_search(spark):
    articles = texts(spark, "red fox", "blue fox", "blue whale whale").withColumnRenamed("id", "article_id")
    asked = spark.createDataFrame([(0, "whale"), (1, "fox red"), (2, "absent")], "query_id bigint, text string")
    got = {(r.query_id, r["rank"]): r.article_id for r in se.text_search(asked, articles, 2).collect()}
    assert got == {(0, 1): 2, (1, 1): 0, (1, 2): 1}


def test_eval(spark):
    turns = spark.createDataFrame([(1, 0, "user", "Where is my invoice?"), (1, 1, "assistant", "Your invoice is here."),
                                   (1, 2, "user", "thanks"), (2, 0, "user", "mail"), (2, 1, "assistant", "a.b@c.de")],
                                  "conv_id int, turn int, role string, text string")
    ex = ev.eval_dataset(turns)
    assert sorted(r.example_id for r in ex.collect()) == ["1-0", "1-2", "2-0"]  # a question without an answer stays
    got = {(r.example_id, r.scorer): r.score for r in ev.eval_score(ex).collect()}
    assert got[("1-0", "relevance")] == pytest.approx(2 / 6) and got[("1-0", "guideline_grounded")] == 1
    assert got[("2-0", "safety")] == 0 and got[("1-0", "safety")] == 1
    same = ev.eval_compare(ev.eval_score(ex), ev.eval_score(ex))
    assert all(r.delta == 0 for r in same.collect())
    roll = {r.conv_id: r for r in ev.trace_rollup(turns).collect()}
    assert roll[1].spans == 3 and roll[1].iterations == 1 and roll[1].result == "thanks" and roll[1].root_role == "user"


def test_long_conversations_stay_whole(spark):
    turns = spark.range(1500).select(F.lit(7).alias("conv_id"), F.col("id").alias("turn"), F.lit("agent").alias("role"), F.when(
        F.col("id") < 700, "apple is good.").otherwise("pear pear is bad.").alias("text"))
    lines = tx.transcript_lines(turns)
    assert rows(tx.classify(lines, "line", {"A": ["apple"], "P": ["pear"]}, "other", key="conv_id")) == [(7, "P")]
    assert rows(tx.sentiment(lines, "line", ["good"], ["bad"], key="conv_id")) == [(7, "mixed")]
    assert rows(tx.summarize(lines, "conv_id", "line", order="turn")) == [(7, "Agent: pear pear is bad")]


def test_traces_report_true_counts(spark):
    turns = spark.range(30).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("assistant").alias("role"),
                                   F.lit("x" * 3000).alias("text"))
    got = ev.trace_rollup(turns, max_iterations=8, result_characters=10).first()
    assert got.iterations == 30 and got.over_limit and len(got.result) == 10
    assert len(ev.trace_rollup(turns).first().result) == 3000
