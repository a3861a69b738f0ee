"""Month-3 churn: activity between day 60 and day 90 (inclusive) after the
first purchase, by country.

Transactions are first reduced to distinct (customer, date) pairs (partial
aggregate, shuffled on both columns), bounded per customer by the calendar
span, so the per-customer ``min() over (partition by customer)`` never sees a
customer's raw lines.  This is the same set of customers as the
reference's equi-join with a date-range residual.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.money import pct, round_half_up


def customer_window_activity(transactions: DataFrame, start_day: int = 60, end_day: int = 90) -> DataFrame:
    """One row per customer: first purchase and whether any purchase falls in
    [first + start_day, first + end_day]."""
    days = transactions.select("customer_id", "transaction_date").distinct()
    first = F.min("transaction_date").over(Window.partitionBy("customer_id"))
    d = days.withColumn("first_purchase", first)
    hit = F.col("transaction_date").between(F.date_add("first_purchase", start_day),
                                            F.date_add("first_purchase", end_day))
    return d.groupBy("customer_id").agg(
        F.min("first_purchase").alias("first_purchase"),
        F.max(hit.cast("int")).alias("active"),
    )


def month3_active(transactions: DataFrame, start_day: int = 60, end_day: int = 90) -> DataFrame:
    """Distinct customers active in the day window."""
    return (customer_window_activity(transactions, start_day, end_day)
            .where(F.col("active") == 1).select("customer_id"))


def month3_churn(customers: DataFrame, transactions: DataFrame, min_cohort: int = 50,
                 start_day: int = 60, end_day: int = 90) -> DataFrame:
    """Per country: buyers, buyers active in the window, retention and churn
    percent; countries below ``min_cohort`` buyers dropped; worst first."""
    act = customer_window_activity(transactions, start_day, end_day)
    joined = act.join(customers.select("customer_id", "country"), "customer_id")
    g = joined.groupBy("country").agg(
        F.count(F.lit(1)).alias("cohort_size"),
        F.sum("active").cast("long").alias("active_month3"),
    ).where(F.col("cohort_size") >= min_cohort)
    ratio = F.col("active_month3").cast("double") * F.lit(100.0) / F.nullif(F.col("cohort_size"), F.lit(0)).cast("double")
    return g.select(
        "country", "cohort_size", "active_month3",
        pct("active_month3", "cohort_size").alias("month3_retention_pct"),
        round_half_up(F.lit(100.0) - ratio, 2).alias("month3_churn_pct"),
    ).orderBy(F.col("month3_churn_pct").desc(), F.col("country"))
