"""Feature table queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.operators import features as ft
from ebbtide.operators import pointintime as pit
from ebbtide.plans.oracle import VIEWS
from ebbtide.plans.registry import query
from ebbtide.session import shared_dir

VIEWS["ticket_aggregates"] = """
select customer_id, count(*) as total_tickets,
 count(*) filter (where category='billing') as billing_tickets,
 count(*) filter (where category='technical') as technical_tickets,
 count(*) filter (where category='cancellation') as cancellation_tickets,
 count(*) filter (where priority in ('high','critical')) as high_priority_tickets,
 avg(resolution_time_hours) as avg_resolution_hours, max(created_date) as last_ticket_date
from service_tickets group by customer_id"""

VIEWS["features"] = """
select c.customer_id, tenure_months, contract_type, monthly_charges, total_charges, payment_method,
 internet_service, phone_service, paperless_billing, partner, dependents, senior_citizen,
 (streaming_tv='Yes')::int + (streaming_movies='Yes')::int + (online_security='Yes')::int
  + (online_backup='Yes')::int + (device_protection='Yes')::int + (tech_support='Yes')::int as num_optional_services,
 coalesce(total_tickets,0) as total_tickets, coalesce(billing_tickets,0) as billing_tickets,
 coalesce(technical_tickets,0) as technical_tickets, coalesce(cancellation_tickets,0) as cancellation_tickets,
 coalesce(high_priority_tickets,0) as high_priority_tickets,
 coalesce(avg_resolution_hours,0) as avg_resolution_hours
from customers c left join ticket_aggregates a on c.customer_id = a.customer_id"""

_ROUND = "* replace (round(avg_resolution_hours, 6) as avg_resolution_hours)"


def _round_hours(df):
    return df.withColumn("avg_resolution_hours", F.round("avg_resolution_hours", 6))


@query("conditional_counts", f"select {_ROUND} from ticket_aggregates")
def conditional_counts(t):
    return _round_hours(ft.ticket_features(t.tickets))


@query("join_left_features", f"select {_ROUND} from features")
def join_left_features(t):
    return _round_hours(ft.build_features(t.customers, t.tickets))


@query("fill_defaults", """select c.customer_id, coalesce(total_tickets,0) as total_tickets,
 round(coalesce(avg_resolution_hours,0),6) as avg_resolution_hours
 from customers c left join ticket_aggregates a on c.customer_id=a.customer_id""")
def fill_defaults(t):
    joined = t.customers.join(ft.ticket_features(t.tickets), "customer_id", "left")
    filled = ft.fill_ticket_defaults(joined)
    return _round_hours(filled.select("customer_id", "total_tickets", "avg_resolution_hours"))


@query("add_columns", """select customer_id, monthly_charges, 'v1' as model_id,
 timestamp '2025-06-01 00:00:00' as inference_timestamp,
 case when tenure_months > 0 then round(monthly_charges/tenure_months,6) else 0 end as avg_price_increase
 from customers""")
def add_columns(t):
    return t.customers.select("customer_id", "monthly_charges", "tenure_months").withColumns({
        "model_id": F.lit("v1"),
        "inference_timestamp": F.lit("2025-06-01 00:00:00").cast("timestamp_ntz"),
        "avg_price_increase": F.round(ft.avg_price_increase(), 6),
    }).drop("tenure_months")


@query("project_columns", """select customer_id, tenure_months, contract_type, monthly_charges, total_charges
 from customers""")
def project_columns(t):
    return t.customers.select("customer_id", "tenure_months", "contract_type", "monthly_charges", "total_charges")


@query("drop_columns", """select customer_id, split from churn_labels""")
def drop_columns(t):
    return t.churn_labels.drop("label_date", "churn")


@query("select_by_dtype", """select customer_id, total_charges, monthly_charges, tenure_months, senior_citizen
 from customers""")
def select_by_dtype(t):
    numeric, _ = ft.split_columns_by_type(t.customers)
    return t.customers.select(*numeric)


@query("select_by_exclusion", "select * exclude (customer_id, name, churn) from customers")
def select_by_exclusion(t):
    keys = ("customer_id", "name", "churn")
    return t.customers.select(*[c for c in t.customers.columns if c not in keys])


@query("fn_count_yes", "select customer_id, num_optional_services from features")
def fn_count_yes(t):
    from ebbtide.functions.columns import count_yes

    return t.customers.select("customer_id", count_yes().alias("num_optional_services"))


@query("fn_safe_divide", """select customer_id, case when tenure_months > 0
 then round(monthly_charges/tenure_months,6) else 0 end as avg_price_increase from customers""")
def fn_safe_divide(t):
    return t.customers.select("customer_id", F.round(ft.avg_price_increase(), 6).alias("avg_price_increase"))


_TRAINING = """select l.customer_id, l.churn, l.split, f.* exclude (customer_id)
 replace (round(avg_resolution_hours,6) as avg_resolution_hours),
 case when tenure_months > 0 then round(monthly_charges/tenure_months,6) else 0 end as avg_price_increase
 from churn_labels l left join features f on l.customer_id = f.customer_id"""


def _training(t, splits):
    out = ft.training_set(t.churn_labels, ft.build_features(t.customers, t.tickets), splits=splits)
    return _round_hours(out).withColumn("avg_price_increase", F.round("avg_price_increase", 6))


@query("feature_lookup", _TRAINING)
def feature_lookup(t):
    return _training(t, ("train", "val", "test"))


@query("ml_training_set", _TRAINING + " where l.split in ('train','val')")
def ml_training_set(t):
    return _training(t, ("train", "val"))


@query("split_alignment", """select l.split, count(*) as n, sum(tenure_months)::bigint as tenure_sum,
 sum(total_tickets)::bigint as tickets from churn_labels l join features f on l.customer_id=f.customer_id
 where l.split in ('train','val') group by l.split""")
def split_alignment(t):
    rows = ft.training_set(t.churn_labels, ft.build_features(t.customers, t.tickets))
    return rows.groupBy("split").agg(
        F.count("*").alias("n"), F.sum("tenure_months").alias("tenure_sum"), F.sum("total_tickets").alias("tickets"))


@query("ml_split_by_column", """select split, churn, count(*) as n from churn_labels
 where split in ('train','val') group by all""")
def ml_split_by_column(t):
    rows = t.churn_labels.select("customer_id", "churn", "split")
    parts = [rows.filter(F.col("split") == s) for s in ("train", "val")]
    return parts[0].unionByName(parts[1]).groupBy("split", "churn").agg(F.count("*").alias("n"))


@query("ml_label_encode", """select customer_id, case when churn='Yes' then 1 else 0 end as label from churn_labels""")
def ml_label_encode(t):
    return t.churn_labels.select("customer_id", F.when(F.col("churn") == "Yes", 1).otherwise(0).alias("label"))


@query("keyed_feature_write", f"select {_ROUND} from features")
def keyed_feature_write(t):
    table = ft.build_features(t.customers, t.tickets)
    return _round_hours(ft.keyed_write(table, shared_dir(t.spark, "features"), ["customer_id"]))


# Two labels for each customer, with dates of their own in the month of the tickets.
VIEWS["dated_labels"] = """select customer_id, churn, timestamp '2024-01-02 00:00:00' + to_days((customer_id % 13 + 14 * k)::int)
 + to_hours((customer_id % 24)::int) as label_date from churn_labels, (values (0), (1)) w(k)"""


def _dated_labels(t):
    second = F.explode(F.array(F.lit(0), F.lit(1))).alias("k")
    rows = t.churn_labels.select("customer_id", "churn", second)
    days = (F.col("customer_id") % 13 + F.col("k") * 14).cast("int")
    date = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(days, (F.col("customer_id") % 24).cast("int"))
    return rows.select("customer_id", "churn", date.cast("timestamp_ntz").alias("label_date"))


@query("training_set_as_of", """select l.customer_id, l.churn, l.label_date, count(t.ticket_id) as total_tickets,
 count(*) filter (where t.category='billing') as billing_tickets, count(*) filter (where t.category='technical') as technical_tickets,
 count(*) filter (where t.category='cancellation') as cancellation_tickets,
 count(*) filter (where t.priority in ('high','critical')) as high_priority_tickets,
 round(coalesce(avg(t.resolution_time_hours), 0), 6) as avg_resolution_hours, max(t.created_date) as last_ticket_date,
 any_value(f.num_optional_services) as num_optional_services, any_value(f.contract_type) as contract_type
 from dated_labels l join features f on f.customer_id = l.customer_id
 left join service_tickets t on t.customer_id = l.customer_id and t.created_date < l.label_date
 group by l.customer_id, l.churn, l.label_date""")
def training_set_as_of(t):
    rows = pit.training_set_at(_dated_labels(t), t.customers, t.tickets)
    return _round_hours(rows).select(
        "customer_id", "churn", "label_date", *ft.TICKET_COUNTS, "avg_resolution_hours", "last_ticket_date", "num_optional_services",
        "contract_type")
