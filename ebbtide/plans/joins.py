"""Join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.functions.columns import yes_to_double
from ebbtide.operators import joins as jn
from ebbtide.operators.features import build_features
from ebbtide.operators.metricview import tickets_with_customers
from ebbtide.operators.scoring import standin_score
from ebbtide.plans.oracle import u
from ebbtide.plans.registry import query


@query("join_inner_split", """select f.customer_id, f.tenure_months, f.total_tickets from churn_labels l
 join features f on l.customer_id=f.customer_id where l.split='test'""")
def join_inner_split(t):
    test = t.churn_labels.filter("split = 'test'").select("customer_id")
    return test.join(build_features(t.customers, t.tickets), "customer_id").select(
        "customer_id", "tenure_months", "total_tickets")


@query("join_inner_view", """select category, churn, contract_type, count(*) as n from service_tickets t
 join customers c on t.customer_id=c.customer_id group by all""")
def join_inner_view(t):
    return tickets_with_customers(t.customers, t.tickets).groupBy("category", "churn", "contract_type").agg(
        F.count("*").alias("n"))


@query("join_left_labels", """select s.customer_id, round(s.churn_probability,6) as churn_probability,
 case when l.churn is null then null when l.churn='Yes' then 1e0 else 0e0 end as churn_label
 from scored s left join (select * from churn_labels where split <> 'test') l on s.customer_id=l.customer_id""")
def join_left_labels(t):
    late = t.churn_labels.filter("split <> 'test'").select("customer_id", yes_to_double(F.col("churn")).alias("churn_label"))
    scored = standin_score(t.customers).select("customer_id", F.round("churn_probability", 6).alias("churn_probability"))
    return scored.join(late, "customer_id", "left")


@query("semi_membership", """select ticket_id, category,
 customer_id in (select customer_id from customers where churn='Yes') as is_churner from service_tickets""")
def semi_membership(t):
    churners = t.customers.filter("churn = 'Yes'")
    return jn.membership_flag(t.tickets.select("ticket_id", "customer_id", "category"), churners,
                              "customer_id", "is_churner").drop("customer_id")


@query("lookup_map", """select ticket_id, split_part(name, '#', 1) as first_word, tenure_months, monthly_charges
 from service_tickets t left join customers c on t.customer_id=c.customer_id""")
def lookup_map(t):
    attributes = t.customers.select(
        "customer_id", F.split_part(F.col("name"), F.lit("#"), F.lit(1)).alias("first_word"),
        "tenure_months", "monthly_charges")
    return t.tickets.select("ticket_id", "customer_id").join(attributes, "customer_id", "left").drop("customer_id")


@query("weighted_key_join", f"""with weights as (select customer_id, case when churn='Yes' then 3 else 1 end as w
  from customers),
 spans as (select customer_id, w, sum(w) over (order by customer_id) as hi, sum(w) over () as total from weights),
 draws as (select event_id, floor({u('event_id', 'draw')} * (select max(total) from spans))::bigint as pos from events)
 select event_id, customer_id from draws, spans where pos >= hi - w and pos < hi""")
def weighted_key_join(t):
    weight = F.when(F.col("churn") == "Yes", 3).otherwise(1)
    return jn.weighted_draw(t.raw("events").select("event_id"), "event_id", t.customers, "customer_id", weight, "draw")


@query("version_compare", f"""with a as (select customer_id, churn_probability from scored),
 b as (select customer_id, least(0.99e0, greatest(0.01e0, 0.15e0
  + case when contract_type='Month-to-month' then 0.35e0 else 0e0 end
  + case when tenure_months < 12 then 0.20e0 else 0e0 end + ({u('customer_id', 'score2')} - 0.5e0) * 0.30e0)) as p
  from customers)
 select a.customer_id, round(a.churn_probability,6) as a, round(p,6) as b, round(p - a.churn_probability,6) as delta
 from a join b on a.customer_id=b.customer_id""")
def version_compare(t):
    both = jn.compare_versions(standin_score(t.customers), standin_score(t.customers, "score2"),
                               ["customer_id"], "churn_probability")
    return both.select("customer_id", *[F.round(c, 6).alias(c) for c in ("a", "b", "delta")])
