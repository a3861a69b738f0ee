"""The pandas-flavour RFM table and the flat BI extracts (customers,
monthly revenue, geography)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.dates import month_label, month_start
from cohortlens.functions.lookups import COUNTRY_NAMES, REGION_DEFAULT, REGION_OF, lookup
from cohortlens.functions.money import line_revenue, pct, round_half_up
from cohortlens.functions.segments import segment_expr, segment_rank
from cohortlens.functions.stats import mean
from cohortlens.operators.metrics import rfm_base
from cohortlens.operators.scoring import quantile_scores, with_scores
from cohortlens.session import stable


def rfm_pandas_base(customers: DataFrame, transactions: DataFrame, snapshot) -> DataFrame:
    """Base metrics and first purchase from ONE aggregate over the
    transactions, with customer attributes: what the scores are made from."""
    base = rfm_base(transactions, snapshot, with_first_purchase=True).select(
        "customer_id", "last_purchase", "frequency", "monetary_value", "recency_days",
        month_start("first_purchase").alias("cohort_month"),
        F.quarter("first_purchase").alias("cohort_quarter"))
    return base.join(customers.select("customer_id", "country", "acquisition_channel"), "customer_id")


def rfm_pandas(customers: DataFrame, transactions: DataFrame, snapshot) -> DataFrame:
    """RFM scored by equal-frequency value buckets, with customer attributes
    and acquisition cohort: the table the BI extracts read.  The base is frozen
    before the scoring passes."""
    return rfm_pandas_scored(stable(rfm_pandas_base(customers, transactions, snapshot), "rfm_pandas"))


def rfm_pandas_scored(base: DataFrame) -> DataFrame:
    """``rfm_pandas`` from its written base."""
    scored = with_scores(quantile_scores(base, freeze=False)).withColumn("segment", segment_expr())
    return scored.select(
        "customer_id", "last_purchase",
        F.col("frequency").cast("long").alias("frequency"),
        "monetary_value",
        F.col("recency_days").cast("int").alias("recency_days"),
        "r_score", "f_score", "m_score", "rfm_total", "segment", "country", "acquisition_channel",
        month_label("cohort_month").alias("cohort_month"),
        F.col("cohort_month").alias("cohort_month_ts"),
        F.col("cohort_quarter").cast("int").alias("acq_quarter"),
    )


def rfm_pandas_output(rfm: DataFrame) -> DataFrame:
    """Scores file view: monetary value rounded to 2 dp as DOUBLE."""
    return rfm.withColumn("monetary_value", round_half_up("monetary_value", 2))


def rfm_customers_extract(rfm: DataFrame) -> DataFrame:
    """One row per customer: 12 RFM fields + segment rank + 0/1 flags."""
    return rfm.select(
        "customer_id", "country", "acquisition_channel", "recency_days", "frequency",
        round_half_up("monetary_value", 2).alias("monetary_value"),
        "r_score", "f_score", "m_score", "rfm_total", "segment", "acq_quarter",
        segment_rank("segment").alias("segment_rank"),
        (F.col("segment") == "Champion").cast("int").alias("is_champion"),
        (F.col("segment") == "At-Risk").cast("int").alias("is_at_risk"),
    )


def monthly_revenue(transactions: DataFrame) -> DataFrame:
    """Revenue by month x category: line count, distinct customers, revenue
    and mean line revenue (2 dp).  Rows without a category are dropped."""
    t = transactions.where(F.col("category").isNotNull()).withColumn("_rev", line_revenue())
    g = t.groupBy(month_start("transaction_date").alias("_start"), "category").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.count_distinct("customer_id").alias("customers"),
        F.sum("_rev").alias("_sum"),
        mean("_rev").alias("_avg"),
    )
    return g.select(
        month_label("_start").alias("month"), F.year("_start").alias("year"), F.quarter("_start").alias("quarter"),
        "category", "transactions", "customers",
        round_half_up("_sum", 2).alias("revenue"),
        round_half_up("_avg", 2).alias("avg_order"),
    ).orderBy("month", "category")


def geo_labels(df: DataFrame, regions: DataFrame | dict | None = None, names: dict | None = None) -> DataFrame:
    """Add ``country_name`` (default: the code) and ``region`` (default
    "Other").  ``regions`` may be a (country, region) DataFrame, e.g. built
    from the nation / region dimension tables; the ISO table is the default."""
    out = lookup(df, "country", names or COUNTRY_NAMES, "country_name", default_to_key=True)
    return lookup(out, "country", REGION_OF if regions is None else regions, "region", default=REGION_DEFAULT)


def geo_summary(rfm: DataFrame, regions: DataFrame | dict | None = None) -> DataFrame:
    """Per country: customers, revenue, mean LTV / recency / frequency,
    champions, labels and shares (of the rounded totals)."""
    g = rfm.where(F.col("country").isNotNull()).groupBy("country").agg(
        F.count(F.lit(1)).alias("customers"),
        round_half_up(F.sum("monetary_value"), 2).alias("total_revenue"),
        round_half_up(mean("monetary_value"), 2).alias("avg_ltv"),
        round_half_up(mean("recency_days"), 2).alias("avg_recency"),
        round_half_up(mean("frequency"), 2).alias("avg_frequency"),
        F.sum((F.col("segment") == "Champion").cast("long")).alias("champion_count"),
    )
    g = geo_labels(g, regions)
    all_rows = Window.partitionBy()
    g = g.withColumn("pct_revenue", pct(F.col("total_revenue"), F.sum("total_revenue").over(all_rows)))
    g = g.withColumn("pct_customers", pct(F.col("customers"), F.sum("customers").over(all_rows)))
    return g.select(
        "country", "customers", "total_revenue", "avg_ltv", "avg_recency", "avg_frequency",
        "champion_count", "country_name", "region", "pct_revenue", "pct_customers",
    ).orderBy(F.col("total_revenue").desc(), F.col("country"))
