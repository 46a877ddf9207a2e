"""Views the checking SQL may name, written for DuckDB."""

from __future__ import annotations

import re


def u(key: str, tag: str) -> str:
    """The keyed uniform in DuckDB's dialect."""
    return f"(('0x'||substr(md5(concat(cast({key} as varchar),'|{tag}')),1,13))::BIGINT/4503599627370496.0::DOUBLE)"


def _service(tag: str, p: float) -> str:
    return (
        f"case when c_nationkey % 3 = 2 then 'No internet service' "
        f"when {u('c_custkey', tag)} < {p} then 'Yes' else 'No' end"
    )


VIEWS: dict[str, str] = {}

VIEWS["customers"] = f"""
select c_custkey as customer_id, c_name as name,
 case when {u('c_custkey', 'senior')} < 0.16 then 1 else 0 end as senior_citizen,
 case when c_mktsegment in ('AUTOMOBILE','BUILDING') then 'Month-to-month'
      when c_mktsegment in ('FURNITURE','HOUSEHOLD') then 'One year' else 'Two year' end as contract_type,
 case c_nationkey % 3 when 0 then 'Fiber optic' when 1 then 'DSL' else 'No' end as internet_service,
 case c_custkey % 4 when 0 then 'Electronic check' when 1 then 'Mailed check'
      when 2 then 'Bank transfer' else 'Credit card' end as payment_method,
 case when {u('c_custkey', 'phone')} < 0.9 then 'Yes' else 'No' end as phone_service,
 case when {u('c_custkey', 'paper')} < 0.6 then 'Yes' else 'No' end as paperless_billing,
 case when {u('c_custkey', 'partner')} < 0.5 then 'Yes' else 'No' end as partner,
 case when {u('c_custkey', 'dep')} < 0.3 then 'Yes' else 'No' end as dependents,
 {_service('stv', 0.5)} as streaming_tv, {_service('smo', 0.5)} as streaming_movies,
 {_service('sec', 0.35)} as online_security, {_service('bak', 0.4)} as online_backup,
 {_service('dev', 0.4)} as device_protection, {_service('tec', 0.35)} as tech_support,
 cast((c_custkey*7+c_nationkey) % 73 as bigint) as tenure_months,
 cast(2000+floor(abs(c_acctbal)) as double)/100 as monthly_charges,
 cast((2000+floor(abs(c_acctbal))) * ((c_custkey*7+c_nationkey) % 73) as double)/100 as total_charges,
 case when last_order < timestamp '2000-08-01 00:00:00' then 'Yes' else 'No' end as churn
from customer left join (select o_custkey, max(o_orderdate) as last_order from orders group by o_custkey) o
  on c_custkey = o_custkey"""

VIEWS["service_tickets"] = """
select event_id as ticket_id, user_id as customer_id, ts as created_date,
 case event_type when 'purchase' then 'billing' when 'error' then 'technical' when 'click' then 'cancellation'
      when 'signup' then 'upgrade' else 'general' end as category,
 case when k<30 then 'low' when k<70 then 'medium' when k<90 then 'high' else 'critical' end as priority,
 case when k%20<3 then 'open' when k%20<16 then 'resolved' else 'escalated' end as status,
 case when k%20>=3 and k%20<16 then round(value,1) end as resolution_time_hours,
 concat(event_type,' ',props) as description
from (select *, cast(json_extract_string(props,'$.k') as int) as k from events) e"""

VIEWS["churn_labels"] = f"""
select customer_id, churn, timestamp '2025-06-01 00:00:00' as label_date,
 case when u<0.70 then 'train' when u<0.85 then 'val' else 'test' end as split
from (select customer_id, churn, {u('customer_id', 'split')} as u from customers) x"""


def _named(text: str) -> list[str]:
    return [name for name in VIEWS if re.search(rf"\b{name}\b", text)]


def with_views(sql: str) -> str:
    """Prefix the SQL with the views it names, each after the views it needs."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for other in _named(VIEWS[name]):
            if other != name:
                visit(other)
        ordered.append(name)

    for name in _named(sql):
        visit(name)
    body = sql.strip()
    if not ordered:
        return body
    head = ",\n".join(f"{name} as ({VIEWS[name].strip()})" for name in ordered)
    return f"with {head},\n{body[5:]}" if body[:5].lower() == "with " else f"with {head}\n{body}"
