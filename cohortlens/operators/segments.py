"""Segment-level analyses over a segmented customer table: summary with
shares, the pandas-style rounded summary, at-risk recovery and headline.

Share-of-total windows (``sum(...) over ()``) run on the aggregated rows
only (at most ten segments), never at customer grain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.money import pct, round_half_up
from cohortlens.functions.stats import mean

def _all():
    """Whole-frame window, only ever used on aggregated rows."""
    return Window.partitionBy()


def share_of_total(df: DataFrame, col: str, out: str, digits: int = 2) -> DataFrame:
    """``col * 100 / SUM(col) OVER ()`` on an already aggregated frame."""
    return df.withColumn(out, pct(F.col(col), F.sum(col).over(_all()), digits))


def segment_summary(seg: DataFrame) -> DataFrame:
    """Per segment: customers, % customers, revenue, % revenue (of the
    unrounded sums), average LTV (2 dp), recency and frequency (1 dp)."""
    g = seg.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.sum("monetary_value").alias("_rev"),
        mean("monetary_value").alias("_ltv"),
        mean("recency_days").alias("_rec"),
        mean("frequency").alias("_freq"),
    )
    g = share_of_total(g, "customer_count", "pct_of_customers")
    g = share_of_total(g, "_rev", "pct_of_revenue")
    return g.select(
        "segment", "customer_count", "pct_of_customers",
        round_half_up("_rev", 2).alias("total_revenue"), "pct_of_revenue",
        round_half_up("_ltv", 2).alias("avg_ltv"),
        round_half_up("_rec", 1).alias("avg_recency_days"),
        round_half_up("_freq", 1).alias("avg_frequency"),
    ).orderBy(F.col("total_revenue").desc(), F.col("segment"))


def segment_summary_rounded(seg: DataFrame) -> DataFrame:
    """pandas flavour: every mean to 2 dp, shares computed from the rounded
    segment totals."""
    g = seg.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"),
        round_half_up(F.sum("monetary_value"), 2).alias("total_revenue"),
        round_half_up(mean("monetary_value"), 2).alias("avg_ltv"),
        round_half_up(mean("recency_days"), 2).alias("avg_recency"),
        round_half_up(mean("frequency"), 2).alias("avg_frequency"),
    )
    g = share_of_total(g, "customers", "pct_customers")
    g = share_of_total(g, "total_revenue", "pct_revenue")
    return g.orderBy(F.col("total_revenue").desc(), F.col("segment"))


def at_risk(seg: DataFrame, label: str = "At-Risk") -> DataFrame:
    return seg.where(F.col("segment") == F.lit(label))


def recoverable(monetary="monetary_value", frequency="frequency", months: int = 3):
    """Average spend per purchase x ``months``; NULL when frequency is 0."""
    m = F.col(monetary) if isinstance(monetary, str) else monetary
    f = F.col(frequency) if isinstance(frequency, str) else frequency
    return m.cast("double") / F.nullif(f, F.lit(0)).cast("double") * F.lit(float(months))


def at_risk_recovery(seg: DataFrame, months: int = 3) -> DataFrame:
    """One row per at-risk customer with the estimated recoverable revenue,
    highest first."""
    return at_risk(seg).select(
        "customer_id", "country",
        round_half_up("monetary_value", 2).alias("historical_spend"),
        F.col("recency_days").cast("int").alias("recency_days"),
        F.col("frequency").cast("long").alias("frequency"),
        round_half_up(recoverable(months=months), 2).alias("estimated_recoverable_revenue"),
    ).orderBy(F.col("estimated_recoverable_revenue").desc_nulls_last(), F.col("customer_id"))


def at_risk_headline(seg: DataFrame) -> DataFrame:
    """At-risk customer count and total historical spend (one row)."""
    return at_risk(seg).agg(
        F.count(F.lit(1)).alias("at_risk_customers"),
        round_half_up(F.coalesce(F.sum("monetary_value"), F.lit(0)), 2).alias("historical_spend"),
    )
