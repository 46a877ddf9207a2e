"""Exploratory queries: counts, shares, averages, sorts and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.functions.columns import tenure_bucket
from ebbtide.operators import explore as ex
from ebbtide.plans.registry import query


@query("count_rows", """select 'customers' as table_name, count(*) as n from customers
 union all select 'service_tickets', count(*) from service_tickets""")
def count_rows(t):
    def count(name, df):
        return df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")

    return count("customers", t.customers).unionByName(count("service_tickets", t.tickets))


@query("count_by_key", "select category, count(*) as n from service_tickets group by category order by n desc, category")
def count_by_key(t):
    return ex.count_by(t.tickets, "category").orderBy(F.desc("n"), "category")


@query("count_by_two_keys", "select contract_type, churn, count(*) as n from customers group by all order by 1, 2")
def count_by_two_keys(t):
    return ex.count_by(t.customers, "contract_type", "churn").orderBy("contract_type", "churn")


@query("share_of_total", """select churn, count(*) as n, round(count(*)*100.0::double/sum(count(*)) over (), 1) as pct
 from customers group by churn""")
def share_of_total(t):
    return ex.share_of_total(t.customers, "churn")


@query("window_total", """select payment_method, count(*) as n,
 round(count(*)*100.0::double/sum(count(*)) over (), 6) as pct from customers group by payment_method""")
def window_total(t):
    return ex.share_by_window(ex.count_by(t.customers, "payment_method"))


@query("avg_rounded", """select churn, round(avg(tenure_months),4) as avg_tenure,
 round(avg(monthly_charges),4) as avg_monthly, round(avg(total_charges),4) as avg_total from customers group by churn""")
def avg_rounded(t):
    return t.customers.groupBy("churn").agg(
        F.round(F.avg("tenure_months"), 4).alias("avg_tenure"),
        F.round(F.avg("monthly_charges"), 4).alias("avg_monthly"),
        F.round(F.avg("total_charges"), 4).alias("avg_total"),
    )


@query("distinct_ratio", """select category, count(*) as tickets, count(distinct customer_id) as customers,
 round(count(*)::double/count(distinct customer_id), 6) as per_customer from service_tickets group by category""")
def distinct_ratio(t):
    return t.tickets.groupBy("category").agg(
        F.count("*").alias("tickets"), F.countDistinct("customer_id").alias("customers")
    ).withColumn("per_customer", F.round(F.col("tickets").cast("double") / F.col("customers"), 6))


@query("join_left_ratio", """select churn, count(ticket_id) as tickets, count(distinct c.customer_id) as customers,
 round(count(ticket_id)::double/count(distinct c.customer_id), 6) as tickets_per_customer
 from customers c left join service_tickets s on c.customer_id = s.customer_id group by churn""")
def join_left_ratio(t):
    return ex.tickets_per_customer(t.customers, t.tickets, "churn").withColumn(
        "tickets_per_customer", F.round("tickets_per_customer", 6))


@query("avg_ignore_null", """select category, count(*) as n, count(resolution_time_hours) as resolved,
 round(avg(resolution_time_hours), 6) as avg_hours from service_tickets group by category""")
def avg_ignore_null(t):
    return t.tickets.groupBy("category").agg(
        F.count("*").alias("n"), F.count("resolution_time_hours").alias("resolved"),
        F.round(F.avg("resolution_time_hours"), 6).alias("avg_hours"))


@query("max_ts", "select customer_id, max(created_date) as last_ticket_date from service_tickets group by customer_id")
def max_ts(t):
    return t.tickets.groupBy("customer_id").agg(F.max("created_date").alias("last_ticket_date"))


@query("count_filter", """select contract_type, count(*) as total, count(*) filter (where churn='Yes') as churned
 from customers group by contract_type""")
def count_filter(t):
    return t.customers.groupBy("contract_type").agg(
        F.count("*").alias("total"), F.expr("count(*) filter (where churn = 'Yes')").alias("churned"))


@query("rate_measure", """select contract_type, round(avg(case when churn='Yes' then 1e0 else 0e0 end),6) as churn_rate
 from customers group by contract_type""")
def rate_measure(t):
    return t.customers.groupBy("contract_type").agg(F.round(ex.rate(F.col("churn") == "Yes"), 6).alias("churn_rate"))


@query("group_by_all", """select category, priority, count(*) as n, round(avg(resolution_time_hours),6) as avg_hours
 from service_tickets group by all""")
def group_by_all(t):
    return t.spark.sql(
        "select category, priority, count(*) as n, round(avg(resolution_time_hours), 6) as avg_hours "
        "from {tickets} group by all", tickets=t.tickets)


@query("group_by_ordinal", "select status, count(*) as n from service_tickets group by 1 order by 2 desc, 1")
def group_by_ordinal(t):
    return t.spark.sql(
        "select status, count(*) as n from {tickets} group by 1 order by 2 desc, 1", tickets=t.tickets)


@query("max_scalar", """select customer_id, max(resolution_time_hours) as longest_hours from service_tickets
 group by customer_id""")
def max_scalar(t):
    return t.tickets.groupBy("customer_id").agg(F.max("resolution_time_hours").alias("longest_hours"))


@query("distinct_values", """select count(*) as n_pairs, count(distinct contract_type) as n_contracts from
 (select distinct contract_type, payment_method from customers)""")
def distinct_values(t):
    pairs = t.customers.select("contract_type", "payment_method").distinct()
    return pairs.agg(F.count("*").alias("n_pairs"), F.countDistinct("contract_type").alias("n_contracts"))


@query("dedupe_by_group", """select contract_type, internet_service, churn from customers
 group by contract_type, internet_service, churn""")
def dedupe_by_group(t):
    return t.customers.select("contract_type", "internet_service", "churn").dropDuplicates()


@query("split_distribution", "select split, churn, count(*) as n from churn_labels group by all")
def split_distribution(t):
    return ex.count_by(t.churn_labels, "split", "churn")


@query("latest_per_group", """select customer_id, ticket_id, created_date, category from
 (select *, row_number() over (partition by customer_id order by created_date desc, ticket_id desc) as rn
  from service_tickets) where rn = 1""")
def latest_per_group(t):
    wanted = t.tickets.select("customer_id", "ticket_id", "created_date", "category")
    return ex.latest_per(wanted, "customer_id", "created_date", "ticket_id")


@query("tumbling_month", """select date_trunc('month', o_orderdate)::timestamp as window_start, count(*) as n,
 sum(cast(round(o_totalprice*100) as bigint))::bigint as cents from orders group by 1""")
def tumbling_month(t):
    return (
        t.raw("orders").groupBy(F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("window_start"))
        .agg(F.count("*").alias("n"), F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"))
    )


@query("order_multi", """select contract_type, payment_method, count(*) as n from customers group by all
 order by contract_type, payment_method""")
def order_multi(t):
    return ex.count_by(t.customers, "contract_type", "payment_method").orderBy("contract_type", "payment_method")


@query("order_by_measure_desc", """select payment_method, round(avg(case when churn='Yes' then 1e0 else 0e0 end),6)
 as churn_rate from customers group by 1 order by churn_rate desc, payment_method""")
def order_by_measure_desc(t):
    rates = t.customers.groupBy("payment_method").agg(
        F.round(ex.rate(F.col("churn") == "Yes"), 6).alias("churn_rate"))
    return rates.orderBy(F.desc("churn_rate"), "payment_method")


@query("top1_latest", """select ticket_id, customer_id, created_date, category from service_tickets
 where priority in ('high','critical') and status in ('open','escalated')
 order by created_date desc, ticket_id desc limit 1""")
def top1_latest(t):
    urgent = t.tickets.filter(
        F.col("priority").isin("high", "critical") & F.col("status").isin("open", "escalated"))
    return (urgent.orderBy(F.desc("created_date"), F.desc("ticket_id")).limit(1)
            .select("ticket_id", "customer_id", "created_date", "category"))


@query("limit_preview", "select customer_id, name, contract_type from customers order by customer_id limit 10")
def limit_preview(t):
    return t.customers.select("customer_id", "name", "contract_type").orderBy("customer_id").limit(10)


_BUCKET = """case when tenure_months <= 12 then '0-12 months' when tenure_months <= 24 then '13-24 months'
 when tenure_months <= 48 then '25-48 months' else '49+ months' end"""


@query("top_segment", f"""select {_BUCKET} as tenure_bucket,
 round(avg(case when churn='Yes' then 1e0 else 0e0 end),6) as churn_rate from customers group by 1
 order by 2 desc, 1 limit 1""")
def top_segment(t):
    return (
        t.customers.groupBy(tenure_bucket(F.col("tenure_months")).alias("tenure_bucket"))
        .agg(F.round(ex.rate(F.col("churn") == "Yes"), 6).alias("churn_rate"))
        .orderBy(F.desc("churn_rate"), "tenure_bucket").limit(1)
    )


@query("first_k_per_class", """select customer_id, churn from (select customer_id, churn,
 row_number() over (partition by churn order by customer_id) as rn from customers)
 where (churn='Yes' and rn<=3) or (churn='No' and rn<=2)""")
def first_k_per_class(t):
    return ex.first_k_per_class(t.customers.select("customer_id", "churn"), "churn", "customer_id", {"Yes": 3, "No": 2})


@query("union_all_classes", """select customer_id, churn from (select customer_id, churn,
 row_number() over (partition by churn order by customer_id) as rn from customers)
 where (churn='Yes' and rn<=3) or (churn='No' and rn<=2)""")
def union_all_classes(t):
    rows = t.customers.select("customer_id", "churn")
    churners = rows.filter("churn = 'Yes'").orderBy("customer_id").limit(3)
    keepers = rows.filter("churn = 'No'").orderBy("customer_id").limit(2)
    return churners.unionByName(keepers)


@query("cdf_frames", """with v as (select status, resolution_time_hours as v, count(*) as n from service_tickets
 where resolution_time_hours is not null group by all)
 select status, v, n, (sum(n) over (partition by status order by v rows unbounded preceding))::bigint as cum_n,
 (sum(n) over (partition by status))::bigint as total_n,
 lead(v) over (partition by status order by v) as next_value from v""")
def cdf_frames(t):
    from ebbtide.operators.ordered import ordered_prefix

    counts = (t.tickets.filter(F.col("resolution_time_hours").isNotNull())
              .groupBy("status", F.col("resolution_time_hours").alias("v")).agg(F.count("*").alias("n")))
    return ordered_prefix(counts, ["status"], "v", ["n"])
