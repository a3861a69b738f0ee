"""Query registry: name -> builder ``(spark, sf_dir) -> DataFrame`` over the
driver tables, plus the oracle SQL of the same name.

Parameters that depend on the data's money scale (LTV tier thresholds and
spend-bin width) are set here for the driver tables, whose customer
lifetime spend is in the hundreds of thousands.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.functions.dates import days_between, month_label, month_number, month_start, parse_month
from cohortlens.functions.money import line_revenue, round_half_up
from cohortlens.operators import bits, churn, cohorts, extracts, ltv, metrics, ranking, scoring, segments, sheets
from cohortlens.operators.states import MetricStates
from cohortlens.session import checkpoint_dir, stable
from cohortlens.sources import audit as audit_mod
from cohortlens.sources import defaults, driver, files, sinks
from cohortlens.sources.schemas import schema_for

AS_OF = driver.AS_OF
TIER_HIGH = 1_000_000
TIER_MID = 500_000
BIN_WIDTH = 200_000
COHORT_YEAR = 1998
DELTA_FROM = dt.date(1999, 1, 1)
KEY = T.LongType()
BASE_KEYS = [("lines", "order_id", "orders", "order_id"), ("lines", "product_id", "products", "product_id"),
             ("orders", "customer_id", "customers", "customer_id")]

Builder = Callable[[SparkSession, str], DataFrame]


def _c(spark, d):
    return driver.customers(spark, d)


def _t(spark, d):
    return driver.transactions(spark, d)


def _tw(spark, d):
    """Who bought when: no product attributes needed."""
    return driver.transactions(spark, d, with_product=False)


def _bt(spark, d):
    """Priced transactions from the lines and orders stored in buckets of the order key."""
    return driver.bucketed_transactions(spark, d)


def _built_metrics(spark, d):
    return metrics.customer_metrics(_c(spark, d), _bt(spark, d), AS_OF)


def _inputs(d):
    return [f"{d.rstrip('/')}/{t}.parquet" for t in ("customer", "nation", "region", "orders", "lineitem", "part")]


def _metrics(spark, d):
    """The stored metrics view of these input files."""
    return sinks.stored(spark, "customer_metrics", _inputs(d), lambda: _built_metrics(spark, d), AS_OF)


def _base(spark, d):
    """The stored base of the value-bucket scores."""
    return sinks.stored(spark, "rfm_base", _inputs(d), lambda: extracts.rfm_pandas_base(_c(spark, d), _bt(spark, d), AS_OF), AS_OF)


def _seg(spark, d):
    """SQL flavour: NTILE scores + segment, unrounded monetary."""
    return scoring.segmented(_metrics(spark, d), "ntile", freeze=False)


def _prfm(spark, d):
    """pandas flavour: quantile scores over the row-count base."""
    return extracts.rfm_pandas_scored(_base(spark, d))


def _matrix(spark, d):
    return cohorts.cohort_matrix(_tw(spark, d))


def _geo(spark, d):
    regions = driver.geography(spark, d).select("country", "region")
    return extracts.geo_summary(_prfm(spark, d), regions)


def _scratch(spark: SparkSession, name: str) -> str:
    import uuid
    return f"{checkpoint_dir(spark).rstrip('/')}/cohortlens/{name}-{uuid.uuid4().hex}"


# ---- sources ---------------------------------------------------------------

def q_scan_customers(spark, d):
    path = _scratch(spark, "customers_csv")
    files.write_csv(_c(spark, d).select("customer_id", "country", "signup_date", "acquisition_channel"), path)
    return files.read_customers(spark, path, KEY)


def q_scan_transactions(spark, d):
    path = _scratch(spark, "transactions_csv")
    t = driver.transactions_with_country(spark, d).withColumn("revenue", line_revenue())
    files.write_csv(t.select("transaction_id", "customer_id", "transaction_date", "category", "unit_price",
                             "quantity", "discount_pct", "country", "revenue"), path)
    r = files.read_transactions(spark, path, KEY)
    return r.select("transaction_id", "customer_id", "transaction_date", "category",
                    F.col("unit_price").cast("double").alias("unit_price"), "quantity",
                    F.col("discount_pct").cast("double").alias("discount_pct"), "country",
                    F.col("revenue").cast("double").alias("revenue"))


def q_default_discount(spark, d):
    t = defaults.apply_defaults(_t(spark, d), "transactions")
    return t.select("transaction_id", "customer_id", "product_id",
                    F.col("discount_pct").cast("double").alias("discount_pct"))


def q_line_revenue(spark, d):
    return _t(spark, d).select(
        "transaction_id", "customer_id", "product_id", "quantity",
        F.col("unit_price").cast("double").alias("unit_price"),
        F.col("discount_pct").cast("double").alias("discount_pct"),
        line_revenue().cast("double").alias("revenue"))


def q_constraint_audit(spark, d):
    """Base tables, before any join that would hide a missing parent; a line
    names its order, and the order its customer."""
    return audit_mod.audit(driver.audit_tables(spark, d), foreign_keys=BASE_KEYS)


def q_audit_witnesses(spark, d):
    """The keys behind each violation of the audit."""
    return audit_mod.witnesses(driver.audit_tables(spark, d), foreign_keys=BASE_KEYS)


def q_load_report(spark, d):
    return sinks.load_report(_tw(spark, d), _c(spark, d))


def _with_nulls(spark, d):
    """Transactions with NULL discounts and categories, by a fixed rule on the keys."""
    t = _t(spark, d)
    return t.withColumns({"discount_pct": F.when(F.col("customer_id") % 7 != 0, F.col("discount_pct")),
                          "category": F.when(F.col("product_id") % 11 != 0, F.col("category"))})


def q_null_discount_default(spark, d):
    t = defaults.apply_defaults(_with_nulls(spark, d), "transactions")
    return t.select("transaction_id", "customer_id", "product_id", F.col("discount_pct").cast("double").alias("discount_pct"))


def q_null_line_revenue(spark, d):
    return _with_nulls(spark, d).groupBy("customer_id").agg(F.sum(line_revenue()).cast("double").alias("revenue"))


def q_null_monthly_revenue(spark, d):
    return extracts.monthly_revenue(_with_nulls(spark, d))


def q_bulk_load(spark, d):
    """Customers from CSV into a declared table, NOT NULL columns enforced."""
    csv, path = _scratch(spark, "load_csv"), _scratch(spark, "load_table")
    files.write_csv(_c(spark, d).select("customer_id", "country", "acquisition_channel"), csv)
    return files.load_table(spark, csv, path, schema_for("customers", KEY)).select(
        "customer_id", "email", "country", "signup_date", "acquisition_channel")


def q_load_rejects(spark, d):
    """Customers with holes by fixed rules on the keys: what keeps each of
    those rows out of the table."""
    csv, path = _scratch(spark, "load_csv"), _scratch(spark, "load_table")
    c = _c(spark, d).select("customer_id", F.when(F.col("customer_id") % 97 != 0, F.col("country")).alias("country"),
                            F.when(F.col("customer_id") % 89 == 0, "soon").otherwise("2001-08-02").alias("signup_date"))
    files.write_csv(c, csv)
    files.load_table(spark, csv, path, schema_for("customers", KEY), quarantine=True)
    return files.load_rejects(spark, path).select(F.col("row.customer_id").cast("long").alias("customer_id"), "column", "reason", "value")


def q_scores_file(spark, d):
    path = _scratch(spark, "rfm_scores")
    files.write_csv(extracts.rfm_pandas_output(_prfm(spark, d)), path)
    return files.read_rfm(spark, path, KEY)


def q_matrix_file(spark, d):
    path = _scratch(spark, "cohort_matrix")
    files.write_csv(_matrix(spark, d), path)
    return cohorts.cohort_long(files.read_cohort_matrix(spark, path))


def q_materialized_metrics(spark, d):
    return sinks.materialize(q_customer_metrics(spark, d), _scratch(spark, "metrics_view"))


def q_refreshed_metrics(spark, d):
    """Two snapshots; readers see the newer, in which one market segment is gone."""
    path, m = _scratch(spark, "metrics_snapshots"), stable(q_customer_metrics(spark, d), "metrics")
    sinks.refresh(m, path, dt.date(2001, 8, 1))
    sinks.refresh(m.where("acquisition_channel <> 'BUILDING'"), path, dt.date(2001, 8, 2))
    return sinks.latest(spark, path)


def q_merged_metrics(spark, d):
    """The metrics from states: the lines up to a date, then the rest as a delta."""
    states, t = MetricStates(spark, _scratch(spark, "metric_states")), _t(spark, d)
    states.merge(t.where(F.col("transaction_date") < DELTA_FROM), "until 1999")
    states.merge(t.where(F.col("transaction_date") >= DELTA_FROM), "since 1999")
    return _metric_columns(states.customer_metrics(_c(spark, d), AS_OF))


def q_extract_file(spark, d):
    path = _scratch(spark, "geo_extract")
    files.write_extract(_geo(spark, d), path, fmt="parquet")
    return spark.read.parquet(path)


def q_region_filter(spark, d):
    """From the extract that is stored by region."""
    extract = sinks.stored_by(spark, "geo_summary", _inputs(d), lambda: _geo(spark, d), ["region"], AS_OF)
    return sheets.by_region(extract, "EUROPE")


# ---- customer metrics --------------------------------------------------------

def _metric_columns(m):
    return m.select(
        "customer_id", "country", "signup_date", "acquisition_channel",
        F.col("frequency").cast("long").alias("frequency"), "last_purchase_date",
        F.col("recency_days").cast("int").alias("recency_days"),
        F.col("monetary_value").cast("double").alias("monetary_value"),
        "first_purchase_date", F.col("active_months").cast("int").alias("active_months"))


def q_customer_metrics(spark, d):
    return _metric_columns(_built_metrics(spark, d))


def q_active_months(spark, d):
    return metrics.customer_active_months(_tw(spark, d)).select(
        "customer_id", F.col("active_months").cast("int").alias("active_months"))


def q_rfm_base(spark, d):
    b = metrics.rfm_base(_bt(spark, d), AS_OF)
    return b.select("customer_id", "last_purchase", F.col("frequency").cast("long").alias("frequency"),
                    F.col("monetary_value").cast("double").alias("monetary_value"),
                    F.col("recency_days").cast("int").alias("recency_days"))


def q_customer_ltv(spark, d):
    return metrics.customer_ltv(_bt(spark, d)).select("customer_id", round_half_up("ltv", 2).alias("ltv"))


# ---- scoring -----------------------------------------------------------------

def _ntile_one(spark, d, col, desc, out):
    r = ranking.global_ntile(_metrics(spark, d), 5, [(col, desc)], out)
    val = F.col(col).cast("double").alias(col) if col == "monetary_value" else F.col(col)
    return r.select("customer_id", val, out)


def q_ntile_recency(spark, d):
    return _ntile_one(spark, d, "recency_days", True, "r_score")


def q_ntile_frequency(spark, d):
    return _ntile_one(spark, d, "frequency", False, "f_score")


def q_ntile_monetary(spark, d):
    return _ntile_one(spark, d, "monetary_value", False, "m_score")


def _qcut_one(spark, d, col, reverse, out):
    r = ranking.quantile_bucket(_base(spark, d), col, 5, out, reverse=reverse)
    val = F.col(col).cast("double").alias(col) if col == "monetary_value" else F.col(col)
    return r.select("customer_id", val, out)


def q_qcut_recency(spark, d):
    return _qcut_one(spark, d, "recency_days", True, "r_score")


def q_qcut_frequency(spark, d):
    return _qcut_one(spark, d, "frequency", False, "f_score")


def q_qcut_monetary(spark, d):
    return _qcut_one(spark, d, "monetary_value", False, "m_score")


def q_rfm_cells(spark, d):
    return _seg(spark, d).select("customer_id", "r_score", "f_score", "m_score", "rfm_total", "rfm_cell")


def q_rfm_segments(spark, d):
    return scoring.rfm_segments(_metrics(spark, d), freeze=False)


def q_segment_cells(spark, d):
    return (_seg(spark, d).groupBy("rfm_cell", "r_score", "f_score", "m_score", "segment")
            .agg(F.count(F.lit(1)).alias("customers")))


def q_rfm_pandas_scores(spark, d):
    return extracts.rfm_pandas_output(_prfm(spark, d))


# ---- segments ----------------------------------------------------------------

def q_segment_summary(spark, d):
    return segments.segment_summary(_seg(spark, d))


def q_segment_summary_rounded(spark, d):
    return segments.segment_summary_rounded(_prfm(spark, d))


def q_at_risk_recovery(spark, d):
    return segments.at_risk_recovery(_seg(spark, d))


def q_at_risk_headline(spark, d):
    return segments.at_risk_headline(_prfm(spark, d))


def q_at_risk_kpis(spark, d):
    return sheets.at_risk_kpis(_seg(spark, d))


# ---- cohorts -----------------------------------------------------------------

def q_cohorts(spark, d):
    return cohorts.cohorts(_tw(spark, d)).select(
        "customer_id", "cohort_month", F.col("cohort_quarter").cast("int").alias("cohort_quarter"),
        F.col("cohort_year").cast("int").alias("cohort_year"))


def q_customer_activity(spark, d):
    return cohorts.customer_activity(_tw(spark, d))


def q_cohort_activity(spark, d):
    return cohorts.cohort_activity(_tw(spark, d)).select(
        "customer_id", "cohort_month", F.col("cohort_quarter").cast("int").alias("cohort_quarter"),
        F.col("cohort_year").cast("int").alias("cohort_year"), "activity_month", "month_number")


def q_cohort_sizes(spark, d):
    return cohorts.cohort_sizes(_tw(spark, d))


def q_retention_counts(spark, d):
    return cohorts.retention_counts(_tw(spark, d))


def q_cohort_retention(spark, d):
    return cohorts.cohort_retention(_tw(spark, d))


def q_cohort_matrix(spark, d):
    return _matrix(spark, d)


def q_cohort_long(spark, d):
    return cohorts.cohort_long(_matrix(spark, d))


def q_cohort_preview(spark, d):
    return cohorts.cohort_preview(_matrix(spark, d))


def q_cohort_year_filter(spark, d):
    """From the extract that is stored by cohort year."""
    extract = sinks.stored_by(spark, "cohort_long", _inputs(d), lambda: cohorts.cohort_long(_matrix(spark, d)), ["cohort_year"], AS_OF)
    return sheets.by_cohort_year(extract, COHORT_YEAR)


def q_avg_month3_retention(spark, d):
    return cohorts.avg_retention(_matrix(spark, d), 3)


def q_txn_with_cohort(spark, d):
    return cohorts.transactions_with_cohort(_tw(spark, d))


def q_retention_curve(spark, d):
    return sheets.retention_curve(cohorts.cohort_long(_matrix(spark, d)))


# ---- LTV and churn -----------------------------------------------------------

def q_quarter_ltv(spark, d):
    return ltv.quarter_ltv(_bt(spark, d))


def q_ltv_by_quarter(spark, d):
    return ltv.ltv_by_quarter(_bt(spark, d))


def q_q4_q1_ratio(spark, d):
    return ltv.q4_q1_ratio(_bt(spark, d))


def q_month3_active(spark, d):
    return churn.month3_active(_tw(spark, d))


def q_month3_churn(spark, d):
    return churn.month3_churn(_c(spark, d), _tw(spark, d))


# ---- extracts and sheets -----------------------------------------------------

def q_rfm_customers_extract(spark, d):
    return extracts.rfm_customers_extract(_prfm(spark, d))


def q_segment_rank(spark, d):
    return (extracts.rfm_customers_extract(_prfm(spark, d))
            .groupBy("segment", "segment_rank").agg(F.count(F.lit(1)).alias("customers")))


def q_monthly_revenue(spark, d):
    return extracts.monthly_revenue(_bt(spark, d))


def q_period_customers(spark, d):
    """Buyers of each category by month, quarter, year and in all, from the stored words."""
    words = sinks.stored(spark, "category_months", _inputs(d), lambda: bits.month_bits(_bt(spark, d).where("category IS NOT NULL"), "category", "customer_id"))
    return bits.period_counts(words, "customer_id", "category", name="customers")


def q_geo_labels(spark, d):
    regions = driver.geography(spark, d).select("country", "region")
    countries = _c(spark, d).select("country").distinct()
    return extracts.geo_labels(countries, regions).select("country", "country_name", "region")


def q_geo_summary(spark, d):
    return _geo(spark, d)


def q_top_countries(spark, d):
    return sheets.top_countries(_geo(spark, d))


def q_geo_scatter(spark, d):
    return sheets.geo_scatter(_geo(spark, d))


def q_region_revenue(spark, d):
    return sheets.region_revenue(_geo(spark, d))


def q_segment_bars(spark, d):
    return sheets.segment_bars(_prfm(spark, d))


def q_rfm_scatter(spark, d):
    return sheets.rfm_scatter(_prfm(spark, d))


def q_champion_kpi(spark, d):
    return sheets.champion_kpi(_prfm(spark, d))


def q_ltv_tiers(spark, d):
    return sheets.ltv_tiers(_prfm(spark, d), high=TIER_HIGH, mid=TIER_MID)


def q_segment_comparison(spark, d):
    return sheets.segment_comparison(_prfm(spark, d))


def q_recovery_scenarios(spark, d):
    return sheets.recovery_scenarios(_prfm(spark, d))


def q_spend_bins(spark, d):
    return sheets.spend_bins(_prfm(spark, d), width=BIN_WIDTH)


def q_scalar_date_parts(spark, d):
    o = spark.read.parquet(f"{d.rstrip('/')}/orders.parquet")
    dates = o.select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    label = month_label("d")
    return dates.select(
        "d", month_start("d").alias("month_start"), F.quarter("d").alias("quarter"), F.year("d").alias("year"),
        month_number("d", F.lit(dt.date(1995, 1, 1))).alias("month_number"),
        days_between(F.lit(AS_OF), "d").alias("days_to_as_of"),
        F.date_add("d", 60).alias("plus_60_days"),
        label.alias("month_label"), parse_month(label).alias("parsed_month"))


QUERIES: dict[str, Builder] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}

# Headline queries timed by bench.py (one per analysis family).
HEADLINE = [
    "customer_metrics", "rfm_segments", "segment_summary", "at_risk_recovery", "rfm_pandas_scores",
    "cohort_retention", "cohort_matrix", "quarter_ltv", "month3_churn", "monthly_revenue", "geo_summary",
]


def queries() -> dict[str, Builder]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from cohortlens.plans.oracle import oracle_sql as sql
    return sql()
