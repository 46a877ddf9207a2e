"""Lookup functions, retrieval and the retention worksheet."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from ebbtide.functions import sql_functions
from ebbtide.operators import lookup as lk
from ebbtide.operators import retrieve as rt
from ebbtide.operators import search as se
from ebbtide.operators.scoring import standin_score
from ebbtide.plans.oracle import VIEWS, u
from ebbtide.plans.registry import query

VIEWS["scored"] = f"""select *, case when churn_probability >= 0.5e0 then 1e0 else 0e0 end as prediction from (
 select *, least(0.99e0, greatest(0.01e0, 0.15e0
  + case when contract_type='Month-to-month' then 0.35e0 else 0e0 end
  + case when tenure_months < 12 then 0.20e0 else 0e0 end + ({u('customer_id', 'score')} - 0.5e0) * 0.30e0))
  as churn_probability from customers)"""
VIEWS["policies"] = "select * from (values " + ", ".join(
    "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in row) + ")" for row in lk.POLICIES
) + ") p(policy_id, policy_name, category, policy_text)"
VIEWS["urgent_tickets"] = """select * from (select *, row_number() over (partition by customer_id
 order by created_date desc, ticket_id desc) as rn from service_tickets
 where priority in ('high','critical') and status in ('open','escalated')) where rn = 1"""


def _views(t):
    t.views()
    t.spark.createDataFrame(lk.POLICIES, "policy_id string, policy_name string, category string, policy_text string"
                            ).createOrReplaceTempView("policies")
    standin_score(t.customers).select("customer_id", "churn_probability").createOrReplaceTempView("churn_predictions")
    sql_functions.register(t.spark)


@query("tool_latest_ticket", """select ticket_id, customer_id, created_date, category, priority, status, description
 from service_tickets where priority in ('high','critical') and status in ('open','escalated')
 order by created_date desc, ticket_id desc limit 1""")
def tool_latest_ticket(t):
    _views(t)
    return t.spark.sql("select * from tool_latest_ticket()")


@query("tool_customer_profile", """select customer_id, name, tenure_months, contract_type, monthly_charges,
 total_charges, internet_service, phone_service, payment_method, senior_citizen, partner, dependents
 from customers where customer_id in (select customer_id from service_tickets)""")
def tool_customer_profile(t):
    _views(t)
    return t.spark.sql(
        "select p.* from (select distinct customer_id as id from service_tickets) s, "
        "lateral tool_customer_profile(s.id) p")


_HISTORY = """select customer_id, category, count(*) as ticket_count, max(created_date) as latest_ticket,
 arg_min(description, ticket_id) as example_description from service_tickets
 where customer_id in (select customer_id from customers) group by all"""


@query("tool_ticket_history", _HISTORY)
def tool_ticket_history(t):
    _views(t)
    return t.spark.sql("select c.customer_id, h.* from customers c, lateral tool_ticket_history(c.customer_id) h")


@query("ticket_history", _HISTORY)
def ticket_history(t):
    return lk.ticket_history(t.tickets, t.customers)


@query("lateral_lookup", """select c.customer_id, c.contract_type, h.category, h.n from customers c
 join (select customer_id, category, count(*) as n from service_tickets group by all) h
 on h.customer_id=c.customer_id where c.churn='Yes'""")
def lateral_lookup(t):
    _views(t)
    return t.spark.sql(
        "select c.customer_id, c.contract_type, h.category, h.ticket_count as n from customers c, "
        "lateral tool_ticket_history(c.customer_id) h where c.churn = 'Yes'")


@query("tool_retention_policy", """select t.customer_id, p.policy_name, count(*) as n from service_tickets t
 join policies p on t.category = p.category where p.category in ('retention','cancellation') group by all""")
def tool_retention_policy(t):
    _views(t)
    return t.spark.sql(
        "select t.customer_id, p.policy_name, count(*) as n from service_tickets t "
        "join tool_retention_policy() p on t.category = p.category group by all")


_RISK = "select customer_id, round(churn_probability, 6) as churn_risk from scored"


@query("tool_churn_risk", _RISK)
def tool_churn_risk(t):
    _views(t)
    return t.spark.sql("select customer_id, round(tool_churn_risk(customer_id), 6) as churn_risk from customers")


@query("udf_sql_scalar", _RISK + " where contract_type = 'Month-to-month'")
def udf_sql_scalar(t):
    _views(t)
    return t.spark.sql("select customer_id, round(tool_churn_risk(customer_id), 6) as churn_risk from customers "
                       "where contract_type = 'Month-to-month'")


@query("scalar_subquery_lookup", """select t.ticket_id, round(s.churn_probability,6) as churn_risk
 from service_tickets t left join scored s on t.customer_id = s.customer_id""")
def scalar_subquery_lookup(t):
    risk = lk.churn_risk(standin_score(t.customers))
    return t.tickets.select("ticket_id", "customer_id").join(risk, "customer_id", "left").select(
        "ticket_id", F.round("churn_risk", 6).alias("churn_risk"))


@query("udf_python_scalar", """select customer_id, round(case when tenure_months > 0
 then monthly_charges/tenure_months else 0 end, 6) as avg_price_increase from customers""")
def udf_python_scalar(t):
    _views(t)
    return t.spark.sql("select customer_id, round(avg_price_increase(monthly_charges, tenure_months), 6) "
                       "as avg_price_increase from customers")


@query("udtf_sql_table", """select c.customer_id, c.name, count(distinct t.category) as categories,
 count(*) as tickets, max(t.created_date) as latest_ticket from customers c join service_tickets t
 on t.customer_id = c.customer_id group by all""")
def udtf_sql_table(t):
    _views(t)
    return t.spark.sql(
        "select p.customer_id, p.name, count(*) as categories, sum(h.ticket_count) as tickets, "
        "max(h.latest_ticket) as latest_ticket from (select distinct customer_id as id from service_tickets) s, "
        "lateral tool_customer_profile(s.id) p, lateral tool_ticket_history(s.id) h group by all")


@query("udf_pandas_scalar", "select customer_id, num_optional_services from features")
def udf_pandas_scalar(t):
    """The vectorised twin of the column expression, kept for the equality check."""
    from ebbtide.functions.columns import OPTIONAL_SERVICES

    @F.pandas_udf(IntegerType())
    def count_yes(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series, e: pd.Series, f: pd.Series) -> pd.Series:
        return pd.concat([a, b, c, d, e, f], axis=1).eq("Yes").sum(axis=1).astype("int32")

    return t.customers.select("customer_id", count_yes(*OPTIONAL_SERVICES).alias("num_optional_services"))


# ---- retrieval ------------------------------------------------------------------------

VIEWS["label_centroids"] = """select label::bigint as query_id, list(m order by i) as c from (
 select label, i, avg(v) as m from (select label, unnest(embedding)::double as v, unnest(range(1,65)) as i
 from embeddings) group by all) group by label"""


def _label_centroids(t):
    """One query vector per label: the mean of its articles' vectors."""
    long = t.raw("embeddings").select("label", F.posexplode("embedding").alias("i", "v"))
    means = long.groupBy("label", "i").agg(F.avg(F.col("v").cast("double")).alias("m"))
    # One mean per dimension: the list is as long as a vector.
    return means.groupBy(F.col("label").cast("bigint").alias("query_id")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("vector"))


@query("vector_topk", """with ranked_items as (select query_id, vec_id as item_id, round(list_cosine_similarity(c,
 embedding::double[64]::double[]), 9) as score from label_centroids, embeddings)
 select query_id, rank, item_id, round(score, 6) as score, lang as category from (
 select *, (row_number() over (partition by query_id order by score desc, item_id))::int as rank from ranked_items) r
 join documents d on d.doc_id = r.item_id where rank <= 3""")
def vector_topk(t):
    items = t.raw("embeddings").select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vector"))
    found = rt.vector_topk(_label_centroids(t), items, 3)
    articles = t.raw("documents").select(F.col("doc_id").alias("item_id"), F.col("lang").alias("category"))
    return found.join(articles, "item_id").select(
        "query_id", "rank", "item_id", F.round("score", 6).alias("score"), "category")


@query("vector_topk_approximate", """select count(*) as queries, sum(least(20, n - 1))::bigint as wanted, true as recall_reached
 from embeddings, (select count(*) as n from embeddings) where vec_id % 20 = 0""")
def vector_topk_approximate(t):
    """The approximate search against the exact one: of all true neighbours, at least nine in ten are found."""
    items = t.raw("embeddings").select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vector"))
    asked = items.filter("item_id % 20 = 0").withColumnRenamed("item_id", "query_id")
    # A vector's own row is its best hit and is not counted.
    exact, near = (f(asked, items, 21).filter("query_id <> item_id") for f in (rt.vector_topk, rt.approximate_topk))
    exact = exact.withColumn("n", F.row_number().over(Window.partitionBy("query_id").orderBy("rank"))).filter("n <= 20")
    hit = exact.select("query_id", "item_id").join(near.select("query_id", "item_id", F.lit(1).alias("hit")), ["query_id", "item_id"], "left")
    return hit.agg(F.count_distinct("query_id").alias("queries"), F.count("*").alias("wanted"),
                   (F.sum(F.coalesce("hit", F.lit(0))) >= 0.9 * F.count("*")).alias("recall_reached"))


def _terms(source, key):
    return f"""select {key}, term, count(*) as tf from (select {key},
 unnest(string_split_regex(lower(text), '[^\\p{{L}}]+')) as term from {source}) where term <> '' group by all"""


VIEWS["doc_terms"] = _terms("documents", "doc_id")
VIEWS["ask_terms"] = _terms("benchmark", "item_id")
VIEWS["idf"] = """select term, ln(((select count(*) from documents)::double + 1)/(count(*) + 1)) + 1 as idf
 from doc_terms group by term"""
VIEWS["doc_weights"] = "select doc_id, term, tf*idf as w from doc_terms join idf using (term)"
VIEWS["ask_weights"] = "select item_id, term, tf*idf as qw from ask_terms join idf using (term)"


@query("tool_search_kb", """with dots as (select item_id, doc_id, sum(w*qw) as dot from doc_weights
  join ask_weights using (term) group by all),
 dn as (select doc_id, sqrt(sum(w*w)) as n from doc_weights group by doc_id),
 qn as (select item_id, sqrt(sum(qw*qw)) as n from ask_weights group by item_id),
 s as (select item_id, doc_id, round(dot/(dn.n*qn.n), 9) as score from dots join dn using (doc_id)
  join qn using (item_id))
 select item_id as query_id, rank, doc_id as article_id, round(score, 6) as score, lang, source from (select *,
 (row_number() over (partition by item_id order by score desc, doc_id))::int as rank from s) r
 join documents d using (doc_id) where rank <= 3""")
def tool_search_kb(t):
    asked = t.raw("benchmark").select(F.col("item_id").alias("query_id"), "text")
    articles = t.raw("documents").withColumnRenamed("doc_id", "article_id")
    return se.text_search(asked, articles, 3, carry=("lang", "source")).withColumn("score", F.round("score", 6))


# ---- retention worksheet --------------------------------------------------------------

def _articles(t):
    """Articles for each urgent ticket's customer: nearest by embedding to the customer's own vector."""
    vectors = t.raw("embeddings")
    asked = lk.latest_ticket(t.tickets, "customer_id").select("customer_id").join(
        vectors.select(F.col("vec_id").alias("customer_id"), F.col("embedding").alias("vector")), "customer_id")
    items = vectors.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vector"))
    found = rt.vector_topk(asked.withColumnRenamed("customer_id", "query_id"), items, 3)
    return found.select(F.col("query_id").alias("customer_id"), "rank", F.col("item_id").alias("article_id"))


def _context(t, with_articles=True):
    return lk.retention_context(t.tickets, t.customers, standin_score(t.customers), lk.policies(t.spark),
                                _articles(t) if with_articles else None)


_CONTEXT = """select u.customer_id, u.ticket_id, u.category, c.contract_type, round(s.churn_probability,6) as churn_risk,
 h.categories, h.tickets, (select count(*) from policies p where p.category=u.category)::int as n_policies
 from urgent_tickets u left join customers c on c.customer_id=u.customer_id
 left join scored s on s.customer_id=u.customer_id
 left join (select customer_id, count(distinct category)::int as categories, count(*) as tickets
 from service_tickets group by 1) h on h.customer_id=u.customer_id"""


@query("retention_context", f"""with near as (select a.vec_id as customer_id, b.vec_id as article_id,
  row_number() over (partition by a.vec_id order by round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 9) desc,
  b.vec_id) as rank from embeddings a, embeddings b where a.vec_id in (select customer_id from urgent_tickets))
 select x.*, n.articles from ({_CONTEXT}) x left join (select customer_id,
 string_agg(article_id::varchar, ',' order by rank) as articles from near where rank <= 3 group by 1) n
 on n.customer_id = x.customer_id""")
def retention_context(t):
    return _context(t).select(
        "customer_id", "ticket.ticket_id", "ticket.category", "profile.contract_type",
        F.round("churn_risk", 6).alias("churn_risk"), F.size("history").alias("categories"),
        F.aggregate("history", F.lit(0).cast("bigint"), lambda a, h: a + h["ticket_count"]).alias("tickets"),
        F.coalesce(F.size("policies"), F.lit(0)).alias("n_policies"),
        F.concat_ws(",", F.col("articles").cast("array<string>")).alias("articles"))


@query("retention_action", """select u.customer_id, u.ticket_id, case when s.churn_probability > 0.7 then 'aggressive_offer'
 when u.category='billing' then 'plan_review' when u.category='technical' then 'article_and_credit'
 when u.category='cancellation' then 'retention_offer' else 'follow_up' end as action
 from urgent_tickets u left join scored s on s.customer_id=u.customer_id""")
def retention_action(t):
    return lk.retention_action(_context(t, False)).select("customer_id", "ticket.ticket_id", "action")
