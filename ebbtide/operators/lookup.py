"""Per-customer lookups in batch form, and the retention worksheet built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators.explore import latest_per

PROFILE = ("name", "tenure_months", "contract_type", "monthly_charges", "total_charges", "internet_service",
           "phone_service", "payment_method", "senior_citizen", "partner", "dependents")

# Eight policies of our own wording: (id, name, category, text).
POLICIES = [
    ("POL-001", "Leaving without a term", "cancellation", "Monthly contracts end at the next billing date, free of charge."),
    ("POL-002", "Leaving during a term", "cancellation", "A yearly contract ends early against a fee for each open month."),
    ("POL-003", "Loyalty discount", "retention", "Long-standing customers may get a discount for up to a year."),
    ("POL-004", "Goodwill credit", "retention", "A one-time credit may follow a confirmed service fault."),
    ("POL-005", "Bill review", "billing", "A disputed charge is reviewed before it is collected."),
    ("POL-006", "Payment plan", "billing", "An open balance may be paid in monthly parts."),
    ("POL-007", "Faster line", "upgrade", "A faster line starts a new term at the current price list."),
    ("POL-008", "Contact data", "general", "Changes of address and contact data are confirmed in writing."),
]


def policies(spark: SparkSession) -> DataFrame:
    """The policy table: eight fixed rows."""
    return spark.createDataFrame(POLICIES, "policy_id string, policy_name string, category string, policy_text string")


def retention_policy(table: DataFrame) -> DataFrame:
    return table.filter(F.col("category").isin("retention", "cancellation")).select(
        "policy_name", "category", "policy_text")


def customer_profile(customers: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Profile columns of all customers, or of those whose ids are given."""
    rows = customers.select("customer_id", *PROFILE)
    return rows if ids is None else rows.join(ids.select("customer_id").distinct(), "customer_id", "left_semi")


def ticket_history(tickets: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Per customer and category: tickets, newest date and the text of the first ticket."""
    rows = tickets if ids is None else tickets.join(
        ids.select("customer_id").distinct(), "customer_id", "left_semi")
    return rows.groupBy("customer_id", "category").agg(
        F.count("*").alias("ticket_count"), F.max("created_date").alias("latest_ticket"),
        F.min_by("description", "ticket_id").alias("example_description"))


def churn_risk(predictions: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Highest probability over all scored windows; unscored ids give null."""
    best = predictions.groupBy("customer_id").agg(F.max("churn_probability").alias("churn_risk"))
    return best if ids is None else ids.select("customer_id").distinct().join(best, "customer_id", "left")


def urgent(tickets: DataFrame) -> DataFrame:
    return tickets.filter(F.col("priority").isin("high", "critical") & F.col("status").isin("open", "escalated"))


def latest_ticket(tickets: DataFrame, by: str | None = None) -> DataFrame:
    """Newest urgent ticket overall, or of each ``by`` key."""
    rows = urgent(tickets).select(
        "ticket_id", "customer_id", "created_date", "category", "priority", "status", "description")
    if by is None:
        return rows.orderBy(F.desc("created_date"), F.desc("ticket_id")).limit(1)
    return latest_per(rows, by, "created_date", "ticket_id")


def retention_context(
    tickets: DataFrame, customers: DataFrame, predictions: DataFrame, policy_table: DataFrame,
    articles: DataFrame | None = None,
) -> DataFrame:
    """One row per customer with an urgent ticket: ticket, profile, risk, history, articles, policies.

    The nested lists are bounded before they are collected: the history has one entry
    per ticket category, the policies are the fixed table and ``articles``
    (customer_id, rank, article_id) is a top-k result. Everything is reduced to customer
    grain before it is joined.
    """
    ticket = latest_ticket(tickets, "customer_id").select(
        "customer_id", F.struct("ticket_id", "created_date", "category", "priority", "status", "description")
        .alias("ticket"))
    profile = customers.select("customer_id", F.struct(*PROFILE).alias("profile"))
    risk = churn_risk(predictions)
    history = ticket_history(tickets).groupBy("customer_id").agg(F.sort_array(F.collect_list(
        F.struct("category", "ticket_count", "latest_ticket", "example_description"))).alias("history"))
    by_category = policy_table.groupBy("category").agg(
        F.sort_array(F.collect_list("policy_id")).alias("policies"))
    out = (
        ticket.join(profile, "customer_id", "left").join(risk, "customer_id", "left")
        .join(history, "customer_id", "left")
        # Eight policies in at most as many categories.
        .join(F.broadcast(by_category.withColumnRenamed("category", "_c")), F.col("ticket.category") == F.col("_c"), "left")
        .drop("_c")
    )
    if articles is not None:
        lists = articles.groupBy("customer_id").agg(
            F.transform(F.sort_array(F.collect_list(F.struct("rank", "article_id"))), lambda a: a["article_id"])
            .alias("articles"))
        out = out.join(lists, "customer_id", "left")
    return out


def retention_action(context: DataFrame) -> DataFrame:
    """The rule of what to offer: high risk first, then by what the ticket is about."""
    high_risk = 0.7
    action = (
        F.when(F.col("churn_risk") > high_risk, "aggressive_offer")
        .when(F.col("ticket.category") == "billing", "plan_review")
        .when(F.col("ticket.category") == "technical", "article_and_credit")
        .when(F.col("ticket.category") == "cancellation", "retention_offer")
        .otherwise("follow_up")
    )
    return context.withColumn("action", action)
