"""Monthly cohort retention.

Skew: every cohort step first reduces transactions to distinct
(customer, month) pairs with a partial (map-side) aggregate shuffled on both
columns, so a customer with a third of all lines contributes at most one row
per calendar month afterwards.  Only then is the cohort month (the
customer's first month) attached with ``min() over (partition by
customer)``; that window sees at most one row per customer-month.  This
replaces the reference's cohort x activity join: one small shuffle, same
rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.dates import month_label, month_number, month_start, parse_month
from cohortlens.functions.money import pct, round_half_up
from cohortlens.session import stable

HORIZON = 12


def cohorts(transactions: DataFrame) -> DataFrame:
    """Per customer: first purchase -> cohort month, quarter, year."""
    first = transactions.groupBy("customer_id").agg(F.min("transaction_date").alias("first_purchase"))
    return first.select(
        "customer_id",
        month_start("first_purchase").alias("cohort_month"),
        F.quarter("first_purchase").alias("cohort_quarter"),
        F.year("first_purchase").alias("cohort_year"),
    )


def customer_activity(transactions: DataFrame) -> DataFrame:
    """Distinct (customer, activity month) pairs."""
    return (transactions.select("customer_id", month_start("transaction_date").alias("activity_month"))
            .distinct())


def cohort_activity(transactions: DataFrame) -> DataFrame:
    """Customer-month rows with cohort month/quarter/year and month number."""
    act = customer_activity(transactions)
    by_customer = Window.partitionBy("customer_id")
    cm = F.min("activity_month").over(by_customer)
    return act.select(
        "customer_id",
        cm.alias("cohort_month"),
        F.quarter(cm).alias("cohort_quarter"),
        F.year(cm).alias("cohort_year"),
        "activity_month",
        month_number("activity_month", cm).alias("month_number"),
    )


def cohort_sizes(transactions: DataFrame) -> DataFrame:
    """Customers per cohort (active in month 0)."""
    return (cohort_activity(transactions).where(F.col("month_number") == 0)
            .groupBy("cohort_month").agg(F.count(F.lit(1)).alias("cohort_size")))


def retention_counts(transactions: DataFrame) -> DataFrame:
    """Retained (distinct) customers per cohort and month number."""
    return (cohort_activity(transactions)
            .groupBy("cohort_month", "month_number")
            .agg(F.count(F.lit(1)).alias("retained_customers")))


def cohort_retention(transactions: DataFrame) -> DataFrame:
    """Retention and churn percent per cohort-month.  The cohort size is the
    month-0 count of the same cohort, taken with a window over the
    (cohorts x months) aggregate instead of a second join."""
    rc = retention_counts(transactions)
    size = F.max(F.when(F.col("month_number") == 0, F.col("retained_customers"))).over(
        Window.partitionBy("cohort_month"))
    rc = rc.withColumn("cohort_size", size).where(F.col("cohort_size").isNotNull())
    churn = (F.lit(1.0) - F.col("retained_customers").cast("double") / F.col("cohort_size").cast("double")) \
        * F.lit(100.0)
    return rc.select(
        "cohort_month", "cohort_size", "month_number", "retained_customers",
        pct("retained_customers", "cohort_size").alias("retention_rate_pct"),
        round_half_up(churn, 2).alias("churn_rate_pct"),
    ).orderBy("cohort_month", "month_number")


def cohort_matrix(transactions: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Wide retention matrix: one row per cohort (``yyyy-MM``), columns
    ``"0"`` .. ``"horizon"`` with retention percent (ratio rounded to 4 dp,
    times 100), NULL where the month is not observed.  Pivot values are
    listed, so no extra job discovers them."""
    counts = (cohort_activity(transactions).where(F.col("month_number") <= horizon)
              .groupBy("cohort_month").pivot("month_number", list(range(horizon + 1)))
              .agg(F.count(F.lit(1))))
    base = F.col("0").cast("double")
    cols = [F.col(str(k)) for k in range(horizon + 1)]
    return counts.select(
        month_label("cohort_month").alias("cohort_month"),
        *[round_half_up(round_half_up(c.cast("double") / base, 4) * F.lit(100.0), 2).alias(str(k))
          for k, c in enumerate(cols)],
    )


def cohort_long(matrix: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Matrix back to long rows with churn = 100 - retention, cohort date,
    year and quarter; unobserved cells dropped."""
    months = [str(k) for k in range(horizon + 1) if str(k) in matrix.columns]
    long = matrix.unpivot(["cohort_month"], months, "month_number", "retention_rate_pct") \
        .dropna(subset=["retention_rate_pct"])
    dt = parse_month("cohort_month")
    return long.select(
        "cohort_month",
        F.col("month_number").cast("int").alias("month_number"),
        "retention_rate_pct",
        round_half_up(F.lit(100.0) - F.col("retention_rate_pct"), 2).alias("churn_rate_pct"),
        dt.alias("cohort_month_dt"),
        F.year(dt).alias("cohort_year"),
        F.quarter(dt).alias("cohort_quarter"),
    )


def avg_retention(matrix: DataFrame, k: int = 3) -> DataFrame:
    """Unweighted mean over cohorts of month-k retention (cohorts without
    month k skipped), and the matching churn."""
    c = F.col(str(k))
    avg = F.sum(c.cast("decimal(18,6)")).cast("double") / F.count(c)  # exact, whatever the order of rows
    return matrix.agg(
        round_half_up(avg, 2).alias(f"avg_month{k}_retention_pct"),
        round_half_up(F.lit(100.0) - avg, 2).alias(f"avg_month{k}_churn_pct"),
        F.count(c).alias("cohorts"),
    )


def transactions_with_cohort(transactions: DataFrame) -> DataFrame:
    """Line-grain transactions with cohort month, activity month and month
    number.  The per-customer cohort table is written and joined back, not
    computed with a window at line grain: both sides of the join are then
    plain shuffles, and AQE splits a customer holding a large share of the
    lines."""
    c = stable(cohorts(transactions).select("customer_id", "cohort_month"), "cohort-of")
    return transactions.join(c, "customer_id").select(
        "transaction_id", "customer_id", "transaction_date", "cohort_month",
        month_start("transaction_date").alias("activity_month"),
        month_number("transaction_date", "cohort_month").alias("month_number"),
    )


def cohort_preview(matrix: DataFrame, rows: int = 6, months: int = 7) -> DataFrame:
    """First ``rows`` cohorts x first ``months`` month columns."""
    return matrix.orderBy("cohort_month").limit(rows).select(
        "cohort_month", *[str(k) for k in range(months)])
