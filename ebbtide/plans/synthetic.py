"""Generated tables keyed by the rows of the stored ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.functions.hashing import categorical, exponential, uniform
from ebbtide.operators import lookup as lk
from ebbtide.operators import synth as sy
from ebbtide.operators.risk import churn_score
from ebbtide.plans.oracle import VIEWS, u
from ebbtide.plans.registry import query
from ebbtide.plans.texts import SCORE_SQL
from ebbtide.sources.sinks import materialize_once, write_overwrite
from ebbtide.session import shared_dir


def _u(tag):
    return u("n", f"{tag}-42")


def _int(tag, low, high):
    return f"(floor({_u(tag)} * {high - low}e0)::bigint + {low})"


def _yes(tag, p):
    return f"case when {_u(tag)} < {p} then 'Yes' else 'No' end"


def _case(x, values, probabilities):
    edge, parts = 0.0, []
    for v, p in zip(values[:-1], probabilities[:-1]):
        edge = round(edge + p, 12)
        parts.append(f"when {x} < {edge} then '{v}'")
    return f"case {' '.join(parts)} else '{values[-1]}' end"


_NET = ["Fiber optic", "DSL", "No"]
VIEWS["made_base"] = f"""select c_custkey as n, case when {_u('senior')} < 0.16 then 1 else 0 end::bigint as senior_citizen,
 {_case(_u('contract'), ['Month-to-month', 'One year', 'Two year'], [0.5, 0.25, 0.25])} as contract_type,
 {_case(_u('internet'), _NET, [0.44, 0.34, 0.22])} as internet_service, {_yes('phone', 0.9)} as phone_service
 from (select *, c_custkey as n from customer)"""
_SVC = {"streaming_tv": 0.5, "streaming_movies": 0.5, "online_security": 0.35, "online_backup": 0.4,
        "device_protection": 0.4, "tech_support": 0.35}
_SERVICES = ", ".join(
    f"case when internet_service='No' then 'No internet service' else {_yes(s, p)} end as {s}" for s, p in _SVC.items())
VIEWS["made_services"] = f"""select *, case when senior_citizen=1 then {_int('age', 65, 85)} else {_int('age', 18, 65)} end as age,
 case contract_type when 'Month-to-month' then {_int('tenure', 1, 12)} when 'One year' then {_int('tenure', 6, 48)}
 else {_int('tenure', 12, 72)} end as tenure_months, {_SERVICES} from made_base"""
_PRICES = " + ".join(f"case when {s}='Yes' then {_int(s + '_price', 500, 1200)} else 0 end" for s in _SVC)
VIEWS["made_customers"] = f"""select * exclude (m), m::double/100 as monthly_charges,
 greatest(m, m*tenure_months + {_int('total', -5000, 5000)})::double/100 as total_charges,
 {_case(_u('payment'), ['Electronic check', 'Mailed check', 'Bank transfer', 'Credit card'], [0.25] * 4)} as payment_method
 from (select *, 2000 + case internet_service when 'Fiber optic' then 4400 when 'DSL' then 2500 else 0 end
 + case when phone_service='Yes' then 1000 else 0 end + {_int('charge', -500, 1000)} + {_PRICES} as m from made_services)"""


def _names(tag, values):
    return f"([{', '.join(repr(v) for v in values)}])[{_int(tag, 0, len(values))} + 1]"


@query("synth_customers", f"""select 'CUST-' || lpad((n+1)::varchar, greatest(5, len((n+1)::varchar))::int, '0') as customer_id,
 {_names('first', sy.FIRST_NAMES)} || ' ' || {_names('last', sy.LAST_NAMES)} as name,
 {_case(_u('gender'), ['Male', 'Female'], [0.5, 0.5])} as gender, senior_citizen, age, {_yes('partner', 0.5)} as partner,
 {_yes('dependents', 0.3)} as dependents, tenure_months, contract_type, monthly_charges, total_charges, payment_method,
 internet_service, phone_service, {', '.join(_SVC)}, {_yes('paperless', 0.6)} as paperless_billing,
 case when {_u('churn')} < {SCORE_SQL} then 'Yes' else 'No' end as churn from made_customers""")
def synth_customers(t):
    return sy.synth_customers(t.raw("customer").select(F.col("c_custkey").alias("n")))


@query("synth_churn_score", f"select customer_id, round({SCORE_SQL}, 6) as churn_score from customers")
def synth_churn_score(t):
    return t.customers.select("customer_id", F.round(churn_score(), 6).alias("churn_score"))


_CATS = ["billing", "technical", "cancellation", "upgrade", "general"]
_PRI = ["low", "medium", "high", "critical"]
VIEWS["made_draws"] = f"""select d.n, s.customer_id, s.churn from (select event_id as n,
 floor({u('event_id', 'ticket-42')} * (select sum(case when churn='Yes' then 3 else 1 end) from customers))::bigint as pos
 from events) d join (select customer_id, churn, w, sum(w) over (order by customer_id) as hi from (select customer_id,
 churn, case when churn='Yes' then 3 else 1 end as w from customers)) s on d.pos >= s.hi - s.w and d.pos < s.hi"""
VIEWS["made_tickets"] = f"""select *, case when category='cancellation' then
 {_case(_u('priority'), _PRI, [0.05, 0.2, 0.45, 0.3])} else {_case(_u('priority'), _PRI, [0.3, 0.4, 0.2, 0.1])} end as priority,
 {_case(_u('status'), ['open', 'resolved', 'escalated'], [0.15, 0.65, 0.2])} as status from (select *,
 case when churn='Yes' then {_case(_u('category'), _CATS, [0.3, 0.2, 0.25, 0.05, 0.2])}
 else {_case(_u('category'), _CATS, [0.2, 0.3, 0.05, 0.2, 0.25])} end as category from made_draws)"""
_TEXTS = " ".join("when '{}' then ([{}])[{} + 1]".format(
    c, ", ".join("'" + x.replace("'", "''") + "'" for x in xs), _int("text", 0, 2)) for c, xs in sy.TICKET_TEXTS.items())


@query("synth_tickets", f"""select 'TKT-' || lpad((n+1)::varchar, greatest(6, len((n+1)::varchar))::int, '0') as ticket_id,
 customer_id, timestamp '2025-01-01 00:00:00' + to_days({_int('day', 0, 365)}::int) + to_hours({_int('hour', 8, 20)})
 as created_date, category, priority, status,
 case when status='resolved' then round(-24e0*ln(1e0-{_u('hours')}) + 0.5e0, 1) end as resolution_time_hours,
 case category {_TEXTS} end as description from made_tickets""")
def synth_tickets(t):
    return sy.synth_tickets(t.customers, t.raw("events").select(F.col("event_id").alias("n")))


@query("synth_transcripts")
def synth_transcripts(t):
    return sy.synth_transcripts(t.customers, t.raw("conversations").select("conv_id").distinct().withColumnRenamed(
        "conv_id", "n"))


_CAPS = "array_to_string(list_transform(string_split({}, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"


def _quoted(text):
    return "'" + text.replace("'", "''") + "'"


def _values(rows):
    return ", ".join("(" + ", ".join(_quoted(x) if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


VIEWS["made_plans"] = f"""select 'PLAN-' || lpad(p_partkey::varchar, greatest(3, len(p_partkey::varchar))::int, '0') as plan_id,
 array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ') as plan_name,
 p_retailprice as monthly_cost, case when p_size > 40 then -1 else p_size*10 end::bigint as data_limit_gb,
 case when p_size % 2 = 0 then -1 else 500 end::bigint as minutes_included,
 (['Month-to-month','One year','Two year'])[floor({u('p_partkey', 'term')} * 3e0)::bigint + 1] as contract_term
 from part"""
VIEWS["made_policies"] = f"""select 'POL-' || k as policy_id, policy_name, category,
 date '2023-01-01' + (floor({u('k', 'effective-42')} * 730e0)::int) as effective_date,
 replace(text, '{{place}}', {_CAPS.format('n_name')}) as policy_text
 from (select *, code || '-' || n_nationkey as k from nation, (values {_values(sy.POLICY_TEXTS)}) p(code, policy_name, category, text))"""
VIEWS["made_articles"] = f"""select 'ART-' || k as article_id, replace(replace(replace(title, '{{name}}', n), '{{price}}', c), '{{size}}', s) as title, category,
 date '2024-01-01' + (floor({u('k', 'updated-42')} * 365e0)::int) as last_updated,
 replace(replace(replace(text, '{{name}}', n), '{{price}}', c), '{{size}}', s) as content
 from (select *, p_partkey || '-' || kind as k, {_CAPS.format('p_name')} as n, format('{{:,.2f}}', p_retailprice) as c, p_size::varchar as s
 from part, (values {_values((i, *a) for i, a in enumerate(sy.ARTICLE_TEXTS))}) a(kind, category, title, text)
 where (kind - floor({u('p_partkey', 'article-42')} * {len(sy.ARTICLE_TEXTS)}e0)::bigint + {len(sy.ARTICLE_TEXTS)}) % {len(sy.ARTICLE_TEXTS)} < 2)"""


@query("synth_reference_tables", """select 'plans' as table_name, plan_id as id, plan_name as title, contract_term as category,
  monthly_cost as amount, null::date as dated, concat_ws(' ', data_limit_gb, minutes_included) as content from made_plans
 union all select 'policies', policy_id, policy_name, category, null, effective_date, policy_text from made_policies
 union all select 'articles', article_id, title, category, null, last_updated, content from made_articles""")
def synth_reference_tables(t):
    """The three tables that the others refer to, one below the other: plans, policies of every place, articles on every product."""
    none = F.lit(None)
    plans = sy.synth_plans(t.raw("part")).select(
        F.lit("plans").alias("table_name"), F.col("plan_id").alias("id"), F.col("plan_name").alias("title"), F.col("contract_term").alias("category"),
        F.col("monthly_cost").alias("amount"), none.cast("date").alias("dated"), F.concat_ws(" ", "data_limit_gb", "minutes_included").alias("content"))
    policies = sy.synth_policies(t.raw("nation")).select(
        F.lit("policies").alias("table_name"), F.col("policy_id").alias("id"), F.col("policy_name").alias("title"), "category",
        none.cast("double").alias("amount"), F.col("effective_date").alias("dated"), F.col("policy_text").alias("content"))
    articles = sy.synth_articles(t.raw("part")).select(
        F.lit("articles").alias("table_name"), F.col("article_id").alias("id"), "title", "category", none.cast("double").alias("amount"),
        F.col("last_updated").alias("dated"), "content")
    return plans.unionByName(policies).unionByName(articles)


@query("synth_plans", "select * from made_plans")
def synth_plans(t):
    return sy.synth_plans(t.raw("part"))


@query("synth_labels_split", f"""select customer_id, churn, timestamp '2025-06-01 00:00:00' as label_date,
 {_case(u('customer_id', 'split-42'), ['train', 'val', 'test'], [0.7, 0.15, 0.15])} as split from customers""")
def synth_labels_split(t):
    return sy.synth_labels(t.customers)


@query("synth_categorical", f"""select event_id, {_case(u('event_id', 'kind'), _CATS, [0.3, 0.2, 0.25, 0.05, 0.2])} as kind
 from events""")
def synth_categorical(t):
    return t.raw("events").select(
        "event_id", categorical(uniform("event_id", "kind"), sy.CATEGORIES, sy.CATEGORY_P["Yes"]).alias("kind"))


@query("synth_exponential", f"""select event_id, round(-24e0*ln(1e0-{u('event_id', 'wait')}) + 0.5e0, 1) as hours from events""")
def synth_exponential(t):
    return t.raw("events").select("event_id", exponential(uniform("event_id", "wait"), 24.0, 0.5).alias("hours"))


_M = "cast(round(monthly_charges*100) as bigint)"


@query("synth_bill_lines", f"""with a as (select customer_id, {_M} as service,
 floor({u('customer_id', 'equipment-42')}*1000e0)::bigint + 800 as equipment, ({_M}*22+500)//1000 as fee,
 ({_M}*78+500)//1000 as tax, case when {u('customer_id', 'over-42')} < 0.4 then
 floor({u('customer_id', 'overage-42')}*2200e0)::bigint else 0 end as overage from customers)
 """ + " union all ".join(
    f"select customer_id, {i + 1} as line_no, '{c}' as item, {e}::bigint as cents from a" for i, (c, e) in enumerate(
        [("service", "service"), ("equipment", "equipment"), ("fee", "fee"), ("tax", "tax"), ("overage", "overage"),
         ("total", "(service+equipment+fee+tax+overage)")])))
def synth_bill_lines(t):
    return sy.bill_lines(t.customers)


@query("ingest_frame", """select p.policy_id, p.category, count(t.ticket_id) as tickets, count(distinct t.customer_id) as customers,
 count(distinct case when c.churn='Yes' then t.customer_id end) as churners from policies p
 left join service_tickets t on t.category = p.category left join customers c on c.customer_id = t.customer_id group by all""")
def ingest_frame(t):
    """Customers, tickets and the small policy table stored as tables, read back and joined."""
    stored = write_overwrite(lk.policies(t.spark), shared_dir(t.spark, "policies"))
    customers = write_overwrite(t.customers.select("customer_id", "churn"), shared_dir(t.spark, "customers"))
    tickets = materialize_once(t.tickets.select("ticket_id", "customer_id", "category"), "tickets")
    # One row for each customer and category before the join.
    asked = tickets.groupBy("category", "customer_id").agg(F.count("*").alias("n")).join(customers, "customer_id", "left")
    per_category = asked.groupBy("category").agg(
        F.sum("n").alias("tickets"), F.count("customer_id").alias("customers"), F.count(F.when(F.col("churn") == "Yes", 1)).alias("churners"))
    return stored.join(per_category, "category", "left").select(
        "policy_id", "category", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("tickets", "customers", "churners")])
