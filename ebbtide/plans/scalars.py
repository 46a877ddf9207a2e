"""Filters, buckets and scalar functions over the stored tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.functions import columns as cl
from ebbtide.functions.hashing import uniform
from ebbtide.plans.oracle import u
from ebbtide.plans.registry import query


@query("filter_eq_in_and", """select ticket_id, category, priority from service_tickets
 where status='escalated' and priority in ('high','critical')""")
def filter_eq_in_and(t):
    return t.tickets.filter((F.col("status") == "escalated") & F.col("priority").isin("high", "critical")).select(
        "ticket_id", "category", "priority")


@query("filter_like", "select page_id, url from pages where url like 'https://%' and url like '%.org/%'")
def filter_like(t):
    return t.raw("pages").filter(F.col("url").like("https://%") & F.col("url").like("%.org/%")).select("page_id", "url")


@query("filter_between", "select p_partkey, p_name, p_retailprice from part where p_retailprice between 930 and 1010")
def filter_between(t):
    return t.raw("part").filter(F.col("p_retailprice").between(930, 1010)).select("p_partkey", "p_name", "p_retailprice")


@query("case_bucket", """select customer_id, case when tenure_months <= 12 then '0-12 months'
 when tenure_months <= 24 then '13-24 months' when tenure_months <= 48 then '25-48 months' else '49+ months' end
 as tenure_bucket from customers""")
def case_bucket(t):
    return t.customers.select("customer_id", cl.tenure_bucket(F.col("tenure_months")).alias("tenure_bucket"))


@query("flag_to_label", """select customer_id, case when senior_citizen=1 then 'Yes' else 'No' end as senior,
 case when churn='Yes' then 1e0 else 0e0 end as churn_label from customers""")
def flag_to_label(t):
    return t.customers.select(
        "customer_id", F.when(F.col("senior_citizen") == 1, "Yes").otherwise("No").alias("senior"),
        cl.yes_to_double(F.col("churn")).alias("churn_label"))


@query("unpack_struct", """select event_id, cast(json_extract_string(props,'$.k') as int) as k,
 event_type as kind from events""")
def unpack_struct(t):
    inner = t.raw("events").select("event_id", F.struct(
        F.from_json("props", "k int")["k"].alias("k"), F.col("event_type").alias("kind")).alias("extracted"))
    return inner.select("event_id", "extracted.*")


@query("fn_round", "select l_orderkey, l_linenumber, round(l_extendedprice*(1-l_discount), 4) as net from lineitem")
def fn_round(t):
    return t.raw("lineitem").select("l_orderkey", "l_linenumber", F.round(
        F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("net"))


@query("fn_substring", "select conv_id, turn, substring(text, 1, 80) as preview from conversations")
def fn_substring(t):
    return t.raw("conversations").select("conv_id", "turn", F.substring("text", 1, 80).alias("preview"))


@query("fn_concat", """select customer_id, 'Tenure: ' || tenure_months || ' months, contract: ' || contract_type as line,
 concat('#', customer_id, '/', senior_citizen) as tag from customers""")
def fn_concat(t):
    return t.customers.select(
        "customer_id",
        F.concat(F.lit("Tenure: "), F.col("tenure_months"), F.lit(" months, contract: "), F.col("contract_type")).alias("line"),
        F.concat(F.lit("#"), F.col("customer_id"), F.lit("/"), F.col("senior_citizen")).alias("tag"))


@query("fn_regexp_extract", "select page_id, regexp_extract(url, '://([^/]+)/', 1) as host from pages")
def fn_regexp_extract(t):
    return t.raw("pages").select("page_id", F.regexp_extract("url", "://([^/]+)/", 1).alias("host"))


@query("fn_split_first", """select p_partkey, split_part(p_name, ' ', 1) as first_word,
 split_part(p_brand, '#', 2) as brand_number from part""")
def fn_split_first(t):
    return t.raw("part").select(
        "p_partkey", F.get(F.split("p_name", " "), F.lit(0)).alias("first_word"),
        F.split_part("p_brand", F.lit("#"), F.lit(2)).alias("brand_number"))


@query("fn_pad_id", """select c_custkey, 'CUST-' || lpad(c_custkey::varchar, greatest(5, len(c_custkey::varchar))::int, '0') as customer_code,
 'ACCT-' || lpad(c_custkey::varchar, 7, '0') as account_code from customer""")
def fn_pad_id(t):
    key = F.col("c_custkey")
    return t.raw("customer").select(
        "c_custkey", cl.pad_id("CUST", key, 5).alias("customer_code"), cl.pad_id("ACCT", key, 7).alias("account_code"))


@query("fn_template_fill", """select customer_id, 'After ' || tenure_months || ' months on a ' || contract_type ||
 ' contract I pay by ' || lower(payment_method) || '.' as line from customers""")
def fn_template_fill(t):
    template = F.lit("After {tenure} months on a {contract} contract I pay by {payment}.")
    return t.customers.select("customer_id", cl.fill_template(template, {
        "tenure": F.col("tenure_months"), "contract": F.col("contract_type"),
        "payment": F.lower("payment_method")}).alias("line"))


@query("fn_date_trunc", """select ticket_id, date_trunc('month', created_date)::timestamp as month_start,
 date_trunc('day', created_date)::timestamp as day_start from service_tickets""")
def fn_date_trunc(t):
    return t.tickets.select(
        "ticket_id", F.date_trunc("month", "created_date").cast("timestamp_ntz").alias("month_start"),
        F.date_trunc("day", "created_date").cast("timestamp_ntz").alias("day_start"))


@query("fn_date_shift", """select event_id, timestamp '2025-01-01 00:00:00' + to_days((event_id % 365)::int)
 + to_hours(8 + event_id % 12) as shifted from events""")
def fn_date_shift(t):
    return t.raw("events").select("event_id", F.expr(
        "timestamp_ntz'2025-01-01 00:00:00' + make_dt_interval(cast(event_id % 365 as int), "
        "cast(8 + event_id % 12 as int), 0, 0)").alias("shifted"))


@query("fn_current_ts")
def fn_current_ts(t):
    from ebbtide.operators.features import build_features, stamp_update

    return stamp_update(build_features(t.customers, t.tickets)).select("customer_id", "update_timestamp")


@query("fn_clamp", """select s_suppkey, least(5000e0, greatest(0e0, s_acctbal)) as clamped from supplier""")
def fn_clamp(t):
    return t.raw("supplier").select("s_suppkey", cl.clamp(F.col("s_acctbal"), 0.0, 5000.0).alias("clamped"))


@query("fn_cast", """select ticket_id, ticket_id::varchar as id_text, cast(resolution_time_hours as int) as hours,
 cast(created_date as date) as created_day from service_tickets where resolution_time_hours is not null
 and resolution_time_hours = floor(resolution_time_hours)""")
def fn_cast(t):
    whole = t.tickets.filter(F.col("resolution_time_hours") == F.floor("resolution_time_hours"))
    return whole.selectExpr("ticket_id", "ticket_id::string as id_text", "cast(resolution_time_hours as int) as hours",
                            "created_date::date as created_day")


@query("fn_rand", f"select event_id, {u('event_id', 'noise')} as noise from events")
def fn_rand(t):
    return t.raw("events").select("event_id", uniform("event_id", "noise").alias("noise"))


@query("array_literal", """select category, count(*) as n from service_tickets
 where list_contains(['billing','technical'], category) group by category""")
def array_literal(t):
    wanted = F.array(F.lit("billing"), F.lit("technical"))
    return t.tickets.filter(F.array_contains(wanted, F.col("category"))).groupBy("category").agg(F.count("*").alias("n"))


@query("map_literal", """select ticket_id, case priority when 'low' then 1 when 'medium' then 2 when 'high' then 3
 else 4 end as level from service_tickets""")
def map_literal(t):
    levels = F.create_map(*[F.lit(x) for pair in {"low": 1, "medium": 2, "high": 3, "critical": 4}.items() for x in pair])
    return t.tickets.select("ticket_id", levels[F.col("priority")].alias("level"))
