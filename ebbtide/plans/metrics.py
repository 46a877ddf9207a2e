"""Queries against the two metric views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.operators.metricview import customer_metrics, ticket_metrics
from ebbtide.plans.oracle import VIEWS
from ebbtide.plans.registry import query

_BUCKET = """case when tenure_months <= 12 then '0-12 months' when tenure_months <= 24 then '13-24 months'
 when tenure_months <= 48 then '25-48 months' else '49+ months' end"""

VIEWS["joined_tickets"] = """select t.*, c.churn, c.contract_type from service_tickets t
 join customers c on t.customer_id = c.customer_id"""

# DuckDB text of each measure.
_SQL = {
    "total_customers": "count(*)",
    "churned_customers": "count(*) filter (where churn='Yes')",
    "churn_rate": "round(avg(case when churn='Yes' then 1e0 else 0e0 end),6)",
    "arpu": "round(avg(monthly_charges),4)",
    "avg_tenure": "round(avg(tenure_months),4)",
    "avg_total_charges": "round(avg(total_charges),4)",
    "ticket_volume": "count(*)",
    "resolved_tickets": "count(*) filter (where status='resolved')",
    "resolution_rate": "round(avg(case when status='resolved' then 1e0 else 0e0 end),6)",
    "avg_resolution_hours": "round(avg(resolution_time_hours),6)",
    "escalation_rate": "round(avg(case when status='escalated' then 1e0 else 0e0 end),6)",
}
_DIMS = {
    "churn_status": "churn", "tenure_bucket": _BUCKET, "ticket_category": "category", "ticket_priority": "priority",
    "ticket_status": "status", "ticket_month": "date_trunc('month', created_date)::timestamp",
    "senior_citizen": "case when senior_citizen = 1 then 'Yes' else 'No' end",
}
_DIGITS = {"churn_rate": 6, "arpu": 4, "avg_tenure": 4, "avg_total_charges": 4, "resolution_rate": 6,
           "avg_resolution_hours": 6, "escalation_rate": 6}
_CUSTOMER = ("total_customers", "churned_customers", "churn_rate", "arpu", "avg_tenure", "avg_total_charges")
_TICKET = ("ticket_volume", "resolved_tickets", "resolution_rate", "avg_resolution_hours", "escalation_rate")


def _sql(source, dims, measures, tail=""):
    parts = [f"{_DIMS.get(d, d)} as {d}" for d in dims] + [f"{_SQL[m]} as {m}" for m in measures]
    where, _, rest = tail.partition("|")
    grouping = f"group by {', '.join(str(i + 1) for i in range(len(dims)))}" if dims else ""
    return f"select {', '.join(parts)} from {source} {where} {grouping} {rest}"


def _register(name, kind, dims, measures, tail="", where=None, order_by=(), limit=None):
    """One named query over a metric view with its checking SQL."""
    source = "customers" if kind == "customer" else "joined_tickets"

    @query(name, _sql(source, dims, measures, tail))
    def run(t):
        view = customer_metrics(t.customers) if kind == "customer" else ticket_metrics(t.customers, t.tickets)
        return view.query(dims, measures, None if where is None else where(view), order_by, limit, _DIGITS)

    return run


_register("metric_customer", "customer",
          ("contract_type", "internet_service", "payment_method", "churn_status", "tenure_bucket", "senior_citizen"),
          _CUSTOMER)
_register("metric_ticket", "ticket",
          ("ticket_category", "ticket_priority", "ticket_status", "churn_status", "contract_type", "ticket_month"),
          _TICKET)
_register("metric_query", "customer", ("internet_service",), ("total_customers", "churn_rate"),
          "where contract_type = 'Month-to-month' |order by churn_rate desc, 1",
          lambda v: v.dim("contract_type") == "Month-to-month", ("-churn_rate", "internet_service"))
_register("kpi_churn_by_contract", "customer", ("contract_type",),
          ("total_customers", "churn_rate", "arpu", "avg_tenure"), order_by=("-churn_rate", "contract_type"))
_register("kpi_tenure_by_status", "customer", ("tenure_bucket", "churn_status"), ("total_customers", "arpu"),
          order_by=("tenure_bucket", "churn_status"))
_register("kpi_ticket_by_category_status", "ticket", ("ticket_category", "churn_status"),
          ("ticket_volume", "resolution_rate", "escalation_rate"), order_by=("-ticket_volume", "ticket_category"))
_register("kpi_arpu_churned_vs_retained", "customer", ("churn_status",), ("arpu",))
_register("kpi_ticket_month_churners", "ticket", ("ticket_month",), ("ticket_volume",), "where churn='Yes'",
          lambda v: v.dim("churn_status") == "Yes", ("ticket_month",))
_register("kpi_resolution_by_category_priority", "ticket", ("ticket_category", "ticket_priority"),
          ("resolution_rate", "ticket_volume"), order_by=("ticket_category", "ticket_priority"))
_register("kpi_top_tenure_bucket", "customer", ("tenure_bucket",), ("churn_rate",),
          "|order by churn_rate desc, 1 limit 1", order_by=("-churn_rate", "tenure_bucket"), limit=1)
_register("kpi_arpu_by_internet", "customer", ("internet_service",), ("arpu",), order_by=("-arpu",))
_register("kpi_overall_churn", "customer", (), ("churn_rate", "total_customers"))
_register("kpi_churn_contract_internet", "customer", ("contract_type", "internet_service"),
          ("churn_rate", "total_customers"))
_register("kpi_cancellation_month_trend", "ticket", ("ticket_month",), ("ticket_volume",),
          "where category='cancellation'", lambda v: v.dim("ticket_category") == "cancellation", ("ticket_month",))
_register("kpi_top_arpu_segment", "customer", ("contract_type", "internet_service"), ("arpu",),
          "|order by arpu desc, 1, 2 limit 1", order_by=("-arpu", "contract_type", "internet_service"), limit=1)
_register("kpi_drilldown", "customer", ("contract_type", "internet_service", "senior_citizen"),
          ("total_customers", "churn_rate"))


@query("metric_view_define", """select 'customer_metrics' as view_name, 6 as n_dimensions, 6 as n_measures,
 count(*) as source_rows from customers union all select 'ticket_metrics', 6, 5, count(*) from joined_tickets""")
def metric_view_define(t):
    """What each view defines, with the rows its measures are computed from."""
    out = None
    for view, total in ((customer_metrics(t.customers), "total_customers"),
                        (ticket_metrics(t.customers, t.tickets), "ticket_volume")):
        row = view.query((), (total,)).select(
            F.lit(view.name).alias("view_name"), F.lit(len(view.dimensions)).alias("n_dimensions"),
            F.lit(len(view.measures)).alias("n_measures"), F.col(total).alias("source_rows"))
        out = row if out is None else out.unionByName(row)
    return out
