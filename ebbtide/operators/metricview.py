"""Governed measures: named dimensions and measures over one source, grouped at query time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class UnknownMetric(KeyError):
    """A dimension or measure the view does not define."""


@dataclass(frozen=True)
class Metric:
    """A dimension's row expression or a measure's aggregate expression."""

    expr: str
    comment: str = ""


@dataclass(frozen=True)
class MetricView:
    """Measures are always computed from the source rows, never from earlier averages."""

    name: str
    source: DataFrame
    dimensions: Mapping[str, Metric]
    measures: Mapping[str, Metric]
    comment: str = ""
    _checked: bool = field(default=False, compare=False)

    def __post_init__(self):
        clash = set(self.dimensions) & set(self.measures)
        if clash:
            raise ValueError(f"{self.name}: both a dimension and a measure: {sorted(clash)}")
        # Analysis only, no job: an unknown column, a dimension with an aggregate or a
        # measure that nests aggregates is rejected here.
        self.source.select(*[F.expr(m.expr).alias(n) for n, m in self.dimensions.items()]).schema
        self.source.groupBy().agg(*[F.expr(m.expr).alias(n) for n, m in self.measures.items()]).schema

    def dim(self, name: str) -> Column:
        """A dimension as a column, for filters."""
        if name not in self.dimensions:
            raise UnknownMetric(f"{self.name} has no dimension {name}")
        return F.expr(self.dimensions[name].expr)

    def measure(self, name: str) -> Column:
        if name not in self.measures:
            raise UnknownMetric(f"{self.name} has no measure {name}")
        return F.expr(self.measures[name].expr)

    def query(
        self,
        dims: Sequence[str] = (),
        measures: Sequence[str] = (),
        where: Column | str | None = None,
        order_by: Sequence[str] = (),
        limit: int | None = None,
        digits: Mapping[str, int] | None = None,
    ) -> DataFrame:
        """Group by the chosen dimensions and compute the chosen measures.

        ``where`` filters source rows (use ``dim`` to filter on a dimension);
        ``order_by`` takes output names, with a leading minus for descending.
        """
        digits = digits or {}
        columns = []
        for name in measures:
            value = self.measure(name)
            columns.append((F.round(value, digits[name]) if name in digits else value).alias(name))
        rows = self.source if where is None else self.source.filter(where)
        out = rows.groupBy(*[self.dim(d).alias(d) for d in dims]).agg(*columns)
        if order_by:
            out = out.orderBy(*[F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in order_by])
        return out if limit is None else out.limit(limit)

    def describe(self) -> list[tuple[str, str, str, str]]:
        """(kind, name, expression, comment) of everything the view defines."""
        return [("dimension", n, m.expr, m.comment) for n, m in self.dimensions.items()] + [
            ("measure", n, m.expr, m.comment) for n, m in self.measures.items()]


def tickets_with_customers(customers: DataFrame, tickets: DataFrame) -> DataFrame:
    """Tickets with the attributes of their customer, at ticket grain.

    Only the columns the ticket measures use cross the shuffle; a customer holding a
    large share of the tickets is split by the adaptive skew join.
    """
    attributes = customers.select("customer_id", "churn", "contract_type", "internet_service", "monthly_charges")
    return tickets.join(attributes, "customer_id")


def customer_metrics(customers: DataFrame) -> MetricView:
    return MetricView(
        "customer_metrics", customers,
        {
            "contract_type": Metric("contract_type", "length of the contract"),
            "internet_service": Metric("internet_service", "kind of internet line"),
            "payment_method": Metric("payment_method", "how the customer pays"),
            "churn_status": Metric("churn", "Yes if the customer left"),
            "tenure_bucket": Metric(
                "case when tenure_months <= 12 then '0-12 months' when tenure_months <= 24 then '13-24 months' "
                "when tenure_months <= 48 then '25-48 months' else '49+ months' end", "tenure in four ranges"),
            "senior_citizen": Metric("case when senior_citizen = 1 then 'Yes' else 'No' end", "senior flag"),
        },
        {
            "total_customers": Metric("count(*)", "customers"),
            "churned_customers": Metric("count(*) filter (where churn = 'Yes')", "customers who left"),
            "churn_rate": Metric("avg(case when churn = 'Yes' then 1.0D else 0.0D end)", "share who left"),
            "arpu": Metric("avg(monthly_charges)", "mean monthly charge"),
            "avg_tenure": Metric("avg(tenure_months)", "mean months of tenure"),
            "avg_total_charges": Metric("avg(total_charges)", "mean lifetime charge"),
        },
        "churn measures per customer",
    )


def ticket_metrics(customers: DataFrame, tickets: DataFrame) -> MetricView:
    return MetricView(
        "ticket_metrics", tickets_with_customers(customers, tickets),
        {
            "ticket_category": Metric("category", "what the ticket is about"),
            "ticket_priority": Metric("priority", "low to critical"),
            "ticket_status": Metric("status", "open, resolved or escalated"),
            "churn_status": Metric("churn", "Yes if the customer left"),
            "contract_type": Metric("contract_type", "length of the contract"),
            "ticket_month": Metric("cast(date_trunc('MONTH', created_date) as timestamp_ntz)", "month of creation"),
        },
        {
            "ticket_volume": Metric("count(*)", "tickets"),
            "resolved_tickets": Metric("count(*) filter (where status = 'resolved')", "tickets resolved"),
            "resolution_rate": Metric("avg(case when status = 'resolved' then 1.0D else 0.0D end)", "share resolved"),
            "avg_resolution_hours": Metric("avg(resolution_time_hours)", "mean hours to resolve"),
            "escalation_rate": Metric("avg(case when status = 'escalated' then 1.0D else 0.0D end)", "share escalated"),
        },
        "ticket measures with customer attributes",
    )
