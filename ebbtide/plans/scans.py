"""Scans, sources, sinks and catalog queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.operators.features import build_features
from ebbtide.plans.registry import query
from ebbtide.schemas import TABLE_NAMES
from ebbtide.session import shared_dir
from ebbtide.sources import sinks, tables


@query("scan_table", "select c_custkey, c_name, c_mktsegment, c_acctbal from customer")
def scan_table(t):
    return t.raw("customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")


@query("scan_by_identifier", """select category, count(*) as n from service_tickets
 where priority in ('high','critical') group by category""")
def scan_by_identifier(t):
    t.tickets.createOrReplaceTempView("service_tickets")
    found = tables.scan_by_identifier(t.spark, "service_tickets")
    return found.filter(F.col("priority").isin("high", "critical")).groupBy("category").agg(F.count("*").alias("n"))


@query("scan_binary_files")
def scan_binary_files(t):
    files = tables.scan_binary_files(t.spark, t.root, "*.parquet", content=True)
    return tables.file_digests(files).select(
        F.regexp_extract("path", "([^/]+)$", 1).alias("file_name"), "length", "content_length", "content_md5")


@query("file_metadata", """select page_id, url, octet_length(encode(html))::bigint as length,
 regexp_extract(url, '/([^/]+)$', 1) as file_name from pages""")
def file_metadata(t):
    return t.raw("pages").select(
        "page_id", "url", F.octet_length("html").cast("bigint").alias("length"),
        F.regexp_extract("url", "/([^/]+)$", 1).alias("file_name"))


@query("write_overwrite", "select contract_type, count(*) as n from customers group by contract_type")
def write_overwrite(t):
    path = shared_dir(t.spark, "overwrite")
    sinks.write_overwrite(t.customers.select("customer_id", "churn"), path)
    again = sinks.write_overwrite(t.customers.select("customer_id", "contract_type"), path)
    return again.groupBy("contract_type").agg(F.count("*").alias("n"))


@query("ctas", "select customer_id, contract_type, churn from customers where churn = 'Yes'")
def ctas(t):
    churners = t.customers.filter("churn = 'Yes'").select("customer_id", "contract_type", "churn")
    return sinks.create_table_as(churners, "ebbtide_churners")


@query("materialize_once", """select churn, count(*) as n, sum(total_tickets)::bigint as tickets
 from features f join churn_labels l on f.customer_id = l.customer_id group by churn""")
def materialize_once(t):
    stored = sinks.materialize_once(build_features(t.customers, t.tickets), "features")
    return (stored.join(t.churn_labels.select("customer_id", "churn"), "customer_id").groupBy("churn")
            .agg(F.count("*").alias("n"), F.sum("total_tickets").alias("tickets")))


@query("fallback_source", """select contract_type, round(avg(churn_probability), 6) as avg_probability
 from scored group by contract_type""")
def fallback_source(t):
    from ebbtide.operators.scoring import standin_score

    scored = sinks.table_or_else(t.spark, "ebbtide_no_such_table", lambda: standin_score(t.customers))
    return scored.groupBy("contract_type").agg(F.round(F.avg("churn_probability"), 6).alias("avg_probability"))


@query("literal_view", """select model_id, stage, count(*) as customers from customers,
 (select 'churn_model' as model_id, 'Champion' as stage) v group by all""")
def literal_view(t):
    t.spark.range(1).select(
        F.lit("churn_model").alias("model_id"), F.lit("Champion").alias("stage")
    ).createOrReplaceTempView("current_model")
    t.customers.createOrReplaceTempView("customers")
    return t.spark.sql(
        "select (select max(model_id) from current_model) as model_id, "
        "(select max(stage) from current_model) as stage, count(*) as customers from customers")


@query("join_view", """select t.ticket_id, t.category, t.priority, t.status, t.created_date, c.churn, c.contract_type
 from service_tickets t join customers c on t.customer_id = c.customer_id""")
def join_view(t):
    from ebbtide.operators.metricview import tickets_with_customers

    tickets_with_customers(t.customers, t.tickets).createOrReplaceTempView("tickets_with_customers")
    return t.spark.sql(
        "select ticket_id, category, priority, status, created_date, churn, contract_type from tickets_with_customers")


_COUNTS = " union all ".join(f"select '{n}' as asset, count(*) as rows, 'ready' as status from {n}" for n in TABLE_NAMES)


@query("asset_readiness", _COUNTS + " union all select 'no_such_table', null, 'unreadable'")
def asset_readiness(t):
    assets = {n: (lambda n=n: t.raw(n)) for n in TABLE_NAMES}
    assets["no_such_table"] = lambda: t.spark.read.parquet(f"{t.root}/no_such_table.parquet")
    return sinks.readiness(assets)


@query("list_tables", " union all ".join(
    f"select '{n}' as table_name, count(*) as n_rows from {n}" for n in TABLE_NAMES))
def list_tables(t):
    for name in TABLE_NAMES:
        t.raw(name).createOrReplaceTempView(name)
    listed = [v.name for v in t.spark.catalog.listTables() if v.isTemporary and v.name in TABLE_NAMES]
    parts = [t.spark.table(n).agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
             for n in sorted(listed)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


_SHAPE = {"ticket_id": "bigint", "customer_id": "bigint", "created_date": "timestamp_ntz", "category": "string",
          "priority": "string", "status": "string", "resolution_time_hours": "double", "description": "string"}


@query("schema_of", " union all ".join(
    f"select '{c}' as column_name, '{ty}' as data_type, count({c}) as n_not_null from service_tickets"
    for c, ty in _SHAPE.items()))
def schema_of(t):
    """Column names and types as rows, with how often each is filled: one scan, then unpivoted."""
    fields = t.tickets.schema.fields
    filled = t.tickets.agg(*[F.count(f.name).alias(f.name) for f in fields])
    types = F.create_map(*[F.lit(x) for f in fields for x in (f.name, f.dataType.simpleString())])
    long = filled.unpivot([], [f.name for f in fields], "column_name", "n_not_null")
    return long.select("column_name", types[F.col("column_name")].alias("data_type"), "n_not_null")
