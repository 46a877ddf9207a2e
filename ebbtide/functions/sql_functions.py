"""Parameterised lookups as SQL functions, for callers that write SQL.

Each is a temporary function over the registered retention views. Table functions hold
only filters and aggregates, which Spark turns into a join when they are applied per
row with LATERAL; a body with ORDER BY .. LIMIT is used without arguments only.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Fixed signatures; the bodies are the plain SQL for them.
FUNCTIONS = {
    "tool_latest_ticket": """() RETURNS TABLE(ticket_id BIGINT, customer_id BIGINT, created_date TIMESTAMP_NTZ,
        category STRING, priority STRING, status STRING, description STRING)
      RETURN SELECT ticket_id, customer_id, created_date, category, priority, status, description
      FROM service_tickets WHERE priority IN ('high', 'critical') AND status IN ('open', 'escalated')
      ORDER BY created_date DESC, ticket_id DESC LIMIT 1""",
    "tool_customer_profile": """(id BIGINT) RETURNS TABLE(customer_id BIGINT, name STRING, tenure_months BIGINT,
        contract_type STRING, monthly_charges DOUBLE, total_charges DOUBLE, internet_service STRING,
        phone_service STRING, payment_method STRING, senior_citizen INT, partner STRING, dependents STRING)
      RETURN SELECT c.customer_id, c.name, c.tenure_months, c.contract_type, c.monthly_charges, c.total_charges,
        c.internet_service, c.phone_service, c.payment_method, c.senior_citizen, c.partner, c.dependents
      FROM customers c WHERE c.customer_id = id""",
    "tool_ticket_history": """(id BIGINT) RETURNS TABLE(category STRING, ticket_count BIGINT,
        latest_ticket TIMESTAMP_NTZ, example_description STRING)
      RETURN SELECT s.category, count(*), max(s.created_date), min_by(s.description, s.ticket_id)
      FROM service_tickets s WHERE s.customer_id = id GROUP BY s.category""",
    "tool_retention_policy": """() RETURNS TABLE(policy_name STRING, category STRING, policy_text STRING)
      RETURN SELECT policy_name, category, policy_text FROM policies
      WHERE category IN ('retention', 'cancellation')""",
    "tool_churn_risk": """(id BIGINT) RETURNS DOUBLE
      RETURN SELECT max(p.churn_probability) FROM churn_predictions p WHERE p.customer_id = id""",
    "avg_price_increase": """(charge DOUBLE, months BIGINT) RETURNS DOUBLE
      RETURN CASE WHEN months > 0 THEN charge / months ELSE 0.0D END""",
}


def register(spark: SparkSession, *names: str) -> None:
    for name in names or FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{FUNCTIONS[name]}")
