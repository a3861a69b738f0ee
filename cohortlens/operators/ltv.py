"""Acquisition-quarter lifetime value.

One aggregate per customer yields both the acquisition date (first
purchase) and the LTV, so the reference's cohorts x LTV join disappears.
The per-quarter median is exact and distributed (``grouped_median``), not a
``median()`` that would hold a whole quarter's customers in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.dates import month_start
from cohortlens.functions.money import line_revenue, round_half_up
from cohortlens.functions.stats import mean
from cohortlens.operators.ranking import grouped_median
from cohortlens.session import stable


def customer_acquisition_ltv(transactions: DataFrame) -> DataFrame:
    """customer_id, first purchase, cohort month, acquisition quarter/year, ltv."""
    agg = transactions.groupBy("customer_id").agg(
        F.min("transaction_date").alias("first_purchase"),
        F.sum(line_revenue()).alias("ltv"),
    )
    return agg.select(
        "customer_id", "first_purchase",
        month_start("first_purchase").alias("cohort_month"),
        F.quarter("first_purchase").alias("acq_quarter"),
        F.year("first_purchase").alias("acq_year"),
        "ltv",
    )


def quarter_ltv(transactions: DataFrame) -> DataFrame:
    """Per (quarter, year): cohort size, mean / median / total LTV and the LTV
    index (mean over the unweighted mean of quarter means)."""
    per_customer = stable(customer_acquisition_ltv(transactions), "acq_ltv")
    keys = ["acq_quarter", "acq_year"]
    g = per_customer.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("cohort_size"),
        mean("ltv").alias("_avg"),
        F.sum("ltv").alias("_sum"),
    )
    med = grouped_median(per_customer, keys, "ltv", "_median")
    g = g.join(med, keys, "left")
    index = F.col("_avg") / F.avg("_avg").over(Window.partitionBy())
    return g.select(
        F.col("acq_quarter").cast("int").alias("acq_quarter"),
        F.col("acq_year").cast("int").alias("acq_year"),
        "cohort_size",
        round_half_up("_avg", 2).alias("avg_ltv"),
        round_half_up("_median", 2).alias("median_ltv"),
        round_half_up("_sum", 2).alias("total_revenue"),
        round_half_up(index, 2).alias("ltv_index"),
    ).orderBy("acq_year", "acq_quarter")


def ltv_by_quarter(transactions: DataFrame) -> DataFrame:
    """Mean LTV by acquisition quarter over all years (2 dp)."""
    per_customer = customer_acquisition_ltv(transactions)
    return (per_customer.groupBy(F.col("acq_quarter").cast("int").alias("acq_quarter"))
            .agg(round_half_up(mean("ltv"), 2).alias("avg_ltv"))
            .orderBy("acq_quarter"))


def q4_q1_ratio(transactions: DataFrame) -> DataFrame:
    """Q4 / Q1 mean-LTV ratio from the rounded quarter means (one row); NULL
    unless both quarters exist."""
    q = ltv_by_quarter(transactions)
    q1 = F.max(F.when(F.col("acq_quarter") == 1, F.col("avg_ltv")))
    q4 = F.max(F.when(F.col("acq_quarter") == 4, F.col("avg_ltv")))
    return q.agg(
        q1.alias("q1_avg_ltv"), q4.alias("q4_avg_ltv"),
        round_half_up(q4 / F.nullif(q1, F.lit(0.0)), 2).alias("q4_q1_ratio"),
    )
