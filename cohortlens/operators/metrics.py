"""Customer-grain metrics: the materialised metrics view, the pandas-style
RFM base, lifetime value and distinct active months.

All of them aggregate the transaction table by ``customer_id`` first and
join customer attributes afterwards (aggregate-before-join): the join then
sees one row per customer instead of one per line.  Every aggregate is
partial/final (map-side combine), so a customer holding a third of all
lines costs one partial row per map task in the shuffle, not a third of
the data in one task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.dates import days_between, month_start
from cohortlens.functions.money import line_revenue
from cohortlens.operators.bits import month_bits


def _as_of_col(as_of):
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, (dt.date, str)):
        return F.lit(as_of).cast("date")
    return as_of


def with_revenue(transactions: DataFrame) -> DataFrame:
    """Add the exact line revenue column ``revenue`` (DECIMAL(18,6))."""
    return transactions.withColumn("revenue", line_revenue())


def transaction_aggregates(transactions: DataFrame, as_of=None) -> DataFrame:
    """Per customer: frequency (distinct transactions), last/first purchase,
    recency, monetary value, distinct active months.

    Two levels: lines first collapse to distinct (customer, transaction,
    month) rows with their revenue and date range (a plain hash aggregate,
    shuffled on all three keys, so a hot customer is spread out); the count of
    distinct transactions and the set of months, which the calendar bounds,
    then run on those far fewer rows, without expanding them.  Both counts
    stay exact even if one transaction id spans several dates.
    """
    per_txn = transactions.groupBy(
        "customer_id", "transaction_id", month_start("transaction_date").alias("_month")
    ).agg(
        F.sum(line_revenue()).alias("_rev"),
        F.max("transaction_date").alias("_last"),
        F.min("transaction_date").alias("_first"),
    )
    agg = per_txn.groupBy("customer_id").agg(
        F.count_distinct("transaction_id").alias("frequency"),
        F.max("_last").alias("last_purchase_date"),
        F.sum("_rev").alias("monetary_value"),
        F.min("_first").alias("first_purchase_date"),
        F.size(F.collect_set("_month")).alias("active_months"),
    )
    return agg.withColumn("recency_days", days_between(_as_of_col(as_of), "last_purchase_date"))


def customer_metrics(customers: DataFrame, transactions: DataFrame, as_of=None) -> DataFrame:
    """The per-customer metrics view: customers INNER JOIN their transaction
    aggregates (customers with no purchase drop out)."""
    attrs = customers.select("customer_id", "country", "signup_date", "acquisition_channel")
    m = transaction_aggregates(transactions, as_of)
    return attrs.join(m, "customer_id", "inner").select(
        "customer_id", "country", "signup_date", "acquisition_channel", "frequency",
        "last_purchase_date", "recency_days", "monetary_value", "first_purchase_date", "active_months",
    )


def rfm_base(transactions: DataFrame, snapshot, with_first_purchase: bool = False) -> DataFrame:
    """pandas-style RFM base from transactions alone: last purchase, ROW count
    (not distinct) as frequency, revenue sum, recency against ``snapshot``
    (and, on request, the first purchase from the same aggregate)."""
    extra = [F.min("transaction_date").alias("first_purchase")] if with_first_purchase else []
    agg = transactions.groupBy("customer_id").agg(
        F.max("transaction_date").alias("last_purchase"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum(line_revenue()).alias("monetary_value"),
        *extra,
    )
    return agg.withColumn("recency_days", days_between(_as_of_col(snapshot), "last_purchase"))


def customer_ltv(transactions: DataFrame) -> DataFrame:
    """Lifetime value = SUM(line revenue) per customer."""
    return transactions.groupBy("customer_id").agg(F.sum(line_revenue()).alias("ltv"))


def customer_active_months(transactions: DataFrame) -> DataFrame:
    """COUNT(DISTINCT month) per customer, from months as bits: the shuffle of
    the lines carries a word for five years, not a row a month."""
    words = month_bits(transactions, "customer_id")
    return words.groupBy("customer_id").agg(F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)).alias("active_months"))
