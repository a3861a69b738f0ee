"""BI-sheet aggregates: what each worksheet of the dashboards plots,
computed as DataFrames over the customer extract, the long cohort table and
the geography summary.  Every "overall average" / "share of total" window
runs on already aggregated rows (segments, tiers, months, countries)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.money import pct, round_half_up
from cohortlens.functions.stats import mean
from cohortlens.operators.segments import at_risk, recoverable

def _all():
    """Whole-frame window, only ever used on aggregated rows."""
    return Window.partitionBy()


def segment_bars(rfm: DataFrame) -> DataFrame:
    """Revenue and distinct customers per segment, plus the overall average
    of the segment revenues (the reference line)."""
    g = rfm.groupBy("segment").agg(
        F.sum("monetary_value").alias("_rev"),
        F.count_distinct("customer_id").alias("customers"),
    )
    return g.select(
        "segment", round_half_up("_rev", 2).alias("total_revenue"), "customers",
        round_half_up(F.avg(F.col("_rev").cast("double")).over(_all()), 2).alias("avg_segment_revenue"),
    ).orderBy(F.col("total_revenue").desc(), F.col("segment"))


def rfm_scatter(rfm: DataFrame) -> DataFrame:
    """Per segment: mean recency, mean frequency, revenue, customers, mean LTV."""
    return rfm.groupBy("segment").agg(
        round_half_up(mean("recency_days"), 2).alias("avg_recency_days"),
        round_half_up(mean("frequency"), 2).alias("avg_frequency"),
        round_half_up(F.sum("monetary_value"), 2).alias("total_revenue"),
        F.count(F.lit(1)).alias("customers"),
        round_half_up(mean("monetary_value"), 2).alias("avg_ltv"),
    ).orderBy("segment")


def champion_kpi(rfm: DataFrame, label: str = "Champion") -> DataFrame:
    """Champion revenue and its share of all revenue (one row)."""
    champ = F.sum(F.when(F.col("segment") == label, F.col("monetary_value")))
    tot = F.sum("monetary_value")
    return rfm.agg(
        round_half_up(F.coalesce(champ, F.lit(0)), 2).alias("champion_revenue"),
        round_half_up(tot, 2).alias("total_revenue"),
        pct(F.coalesce(champ, F.lit(0)), tot).alias("champion_revenue_pct"),
        F.sum((F.col("segment") == label).cast("long")).alias("champion_customers"),
    )


def ltv_tier(col="monetary_value", high: float = 2000, mid: float = 500):
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c > F.lit(high), "High").when(c > F.lit(mid), "Mid").otherwise("Low")


def ltv_tiers(rfm: DataFrame, high: float = 2000, mid: float = 500) -> DataFrame:
    """Customers and revenue per LTV tier."""
    return rfm.groupBy(ltv_tier(high=high, mid=mid).alias("ltv_tier")).agg(
        F.count(F.lit(1)).alias("customers"),
        round_half_up(F.sum("monetary_value"), 2).alias("total_revenue"),
    ).orderBy("ltv_tier")


def _mean_pct(c: str):
    """Mean of rounded percentages, summed as decimals: exact in any order."""
    return F.sum(F.col(c).cast("decimal(18,6)")).cast("double") / F.count(c)


def retention_curve(long: DataFrame, critical_month: int = 3, high: float = 25, mid: float = 15) -> DataFrame:
    """Mean retention / churn by month number, a High/Mid/Low label on the
    mean retention and the month-3 "Critical Window" flag."""
    g = long.groupBy("month_number").agg(
        _mean_pct("retention_rate_pct").alias("_ret"),
        _mean_pct("churn_rate_pct").alias("_churn"),
        F.count(F.lit(1)).alias("cohorts"),
    )
    ret = round_half_up("_ret", 2)
    return g.select(
        "month_number",
        ret.alias("avg_retention_pct"),
        round_half_up("_churn", 2).alias("avg_churn_pct"),
        "cohorts",
        F.when(ret > F.lit(float(high)), "High").when(ret > F.lit(float(mid)), "Mid").otherwise("Low")
        .alias("retention_label"),
        F.when(F.col("month_number") == critical_month, "Critical Window").otherwise("").alias("month_flag"),
    ).orderBy("month_number")


COMPARED = ("At-Risk", "Champion", "Loyal Customer")


def segment_comparison(rfm: DataFrame, names=COMPARED) -> DataFrame:
    """Points (segment, recency) with customer count and revenue, for the
    compared segments only."""
    return rfm.where(F.col("segment").isin(list(names))).groupBy("segment", "recency_days").agg(
        F.count(F.lit(1)).alias("customers"),
        round_half_up(F.sum("monetary_value"), 2).alias("total_revenue"),
    ).orderBy("segment", "recency_days")


RECOVERY_RATES = (0.05, 0.08, 0.12)


def recovery_scenarios(rfm: DataFrame, rates=RECOVERY_RATES) -> DataFrame:
    """Re-engagement rate x total at-risk historical spend.  The rates are
    exploded from the one-row aggregate (no join)."""
    spend = at_risk(rfm).agg(F.coalesce(F.sum("monetary_value"), F.lit(0)).alias("_spend"))
    rate_arr = F.array(*[F.lit(float(r)) for r in rates])
    return spend.select(F.explode(rate_arr).alias("rate"), "_spend").select(
        "rate",
        F.concat(F.format_number(F.col("rate") * 100, 0), F.lit("%")).alias("scenario"),
        round_half_up("_spend", 2).alias("at_risk_spend"),
        round_half_up(F.col("_spend").cast("double") * F.col("rate"), 2).alias("recoverable_revenue"),
    ).orderBy("rate")


def spend_bins(rfm: DataFrame, width: float = 200) -> DataFrame:
    """At-risk customers in monetary bins of ``width``: count, mean recency."""
    b = (F.floor(F.col("monetary_value") / F.lit(width)) * F.lit(width)).cast("double")
    return at_risk(rfm).groupBy(b.alias("spend_bin")).agg(
        F.count(F.lit(1)).alias("customers"),
        round_half_up(mean("recency_days"), 2).alias("avg_recency_days"),
    ).orderBy("spend_bin")


def top_countries(geo: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` countries with the most revenue (a top-k report)."""
    return geo.select("country", "country_name", "region", "total_revenue") \
        .orderBy(F.col("total_revenue").desc(), F.col("country")).limit(n)


def geo_scatter(geo: DataFrame, label_top: int = 10) -> DataFrame:
    """Revenue vs mean LTV per country; only the top ``label_top`` by revenue
    carry a label.  The ranking window runs on the per-country rows."""
    rn = F.row_number().over(Window.orderBy(F.col("total_revenue").desc(), F.col("country")))
    return geo.select(
        "country", "region", "total_revenue", "avg_ltv", "customers",
        F.when(rn <= label_top, F.col("country")).alias("label"),
    )


def region_revenue(geo: DataFrame) -> DataFrame:
    """Revenue and customers per region with the revenue share."""
    g = geo.groupBy("region").agg(
        F.sum("total_revenue").alias("_rev"),
        F.sum("customers").alias("customers"),
    )
    return g.select(
        "region", round_half_up("_rev", 2).alias("total_revenue"), "customers",
        pct(F.col("_rev"), F.sum("_rev").over(_all())).alias("pct_revenue"),
    ).orderBy(F.col("total_revenue").desc(), F.col("region"))


def at_risk_kpis(rfm: DataFrame, months: int = 3) -> DataFrame:
    """Header numbers: at-risk customers, historical spend, recoverable."""
    return at_risk(rfm).agg(
        F.count(F.lit(1)).alias("at_risk_customers"),
        round_half_up(F.coalesce(F.sum("monetary_value"), F.lit(0)), 2).alias("historical_spend"),
        round_half_up(F.coalesce(F.sum(recoverable(months=months).cast("decimal(28,10)")), F.lit(0)), 2).alias("recoverable_revenue"),
    )


def by_cohort_year(df: DataFrame, year: int) -> DataFrame:
    return df.where(F.col("cohort_year") == year)


def by_region(df: DataFrame, region: str) -> DataFrame:
    return df.where(F.col("region") == region)
