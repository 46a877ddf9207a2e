"""Features as they were at each label's own time.

A label may not see what came after it. Tickets become running totals in order of time, for each customer; every label
then takes the totals of the last moment before its date. Both steps sort slices of bounded size (``operators/ordered``),
so there are no pairs of labels and tickets, a customer may have any number of either, and labels of one customer may
have different dates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.operators.features import FEATURES, TICKET_COUNTS, avg_price_increase
from ebbtide.functions.columns import count_yes
from ebbtide.operators.ordered import carry_at, ordered_prefix
from ebbtide.sources.sinks import materialize_once

KEY = "customer_id"


def ticket_features_at(labels: DataFrame, tickets: DataFrame, at: str = "label_date") -> DataFrame:
    """``labels`` with the ticket features of tickets created before ``at``: zeros and a null last date without any.

    Several labels of a customer, equal ones too, each get their row. A label without a time sees no ticket; a ticket
    without a time is seen by no label.
    """
    def tally(condition) -> F.Column:
        return F.sum(F.when(condition, 1).otherwise(0)).cast("long")

    moment = F.unix_micros(F.col("created_date").cast("timestamp"))
    daily = tickets.filter(F.col("created_date").isNotNull()).groupBy(KEY, moment.alias("moment")).agg(
        F.count("*").alias("total_tickets"), tally(F.col("category") == "billing").alias("billing_tickets"),
        tally(F.col("category") == "technical").alias("technical_tickets"), tally(F.col("category") == "cancellation").alias("cancellation_tickets"),
        tally(F.col("priority").isin("high", "critical")).alias("high_priority_tickets"),
        F.coalesce(F.sum("resolution_time_hours"), F.lit(0.0)).alias("hours"), F.count("resolution_time_hours").alias("timed"))
    daily = materialize_once(daily, "ticket-moments")
    most = daily.groupBy(KEY).count().agg(F.max("count")).first()[0] or 0
    sums = [*TICKET_COUNTS, "hours", "timed"]
    totals = ordered_prefix(daily, [KEY], "moment", sums, rows=most)
    marks = totals.select(KEY, "moment", *[F.col(f"cum_{s}").alias(s) for s in sums], F.col("moment").alias("last"))
    # A ticket at the label's own moment is not before it.
    probes = labels.withColumn("moment", F.unix_micros(F.col(at).cast("timestamp")) - 1)
    dated = materialize_once(probes, "label-moments")
    per_customer = dated.groupBy(KEY).count().agg(F.max("count")).first()[0] or 0
    seen = carry_at(marks, dated.filter(F.col("moment").isNotNull()), [KEY], "moment", "t", rows=most + per_customer)
    unseen = dated.filter(F.col("moment").isNull())
    found = seen.unionByName(unseen, allowMissingColumns=True)
    return found.select(
        *labels.columns, *[F.coalesce(f"t.{c}", F.lit(0)).alias(c) for c in TICKET_COUNTS],
        F.when(F.col("t.timed") > 0, F.col("t.hours") / F.col("t.timed")).otherwise(F.lit(0.0)).alias("avg_resolution_hours"),
        F.timestamp_micros("t.last").cast("timestamp_ntz").alias("last_ticket_date"))


def training_set_at(labels: DataFrame, customers: DataFrame, tickets: DataFrame, at: str = "label_date") -> DataFrame:
    """Labels with all features, none of which knows a ticket from after the label."""
    dated = ticket_features_at(labels, tickets, at)
    fixed = [c for c in FEATURES if c not in (*TICKET_COUNTS, "avg_resolution_hours", "num_optional_services")]
    joined = dated.join(customers.select(KEY, *fixed, count_yes().alias("num_optional_services")), KEY, "left")
    return joined.withColumn("avg_price_increase", avg_price_increase())
