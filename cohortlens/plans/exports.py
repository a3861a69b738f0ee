"""End-to-end export: the reference's output files, produced by Spark jobs.

``export_all`` writes, under ``out_dir``:

    customers.csv, transactions.csv       the logical inputs
    rfm_scores.csv                        pandas-flavour RFM table
    segment_summary.csv                   rounded segment summary
    cohort_matrix.csv                     wide retention matrix
    tableau_rfm_customers.csv             BI extracts, built from the files
    tableau_cohort_retention.csv          above (read back with the declared
    tableau_monthly_revenue.csv           CSV schemas, as the BI step reads
    tableau_geo_summary.csv               them)

Each output is a folder of CSV part files (one writer per partition; no
``coalesce(1)``).  Returns the row count of every output, observed during
the write (no second pass).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.functions.money import line_revenue
from cohortlens.operators import cohorts, extracts, segments
from cohortlens.sources import driver, files
from cohortlens.sources.sinks import observed_count

INPUTS = ["customers.csv", "transactions.csv", "rfm_scores.csv", "cohort_matrix.csv"]


def _write(df: DataFrame, path: str) -> int:
    observed, obs = observed_count(df, path.rsplit("/", 1)[-1])
    files.write_csv(observed, path)
    return int(obs.get["rows"])


def export_all(spark: SparkSession, sf_dir: str, out_dir: str, as_of=driver.AS_OF,
               key_type: T.DataType = T.LongType()) -> dict[str, int]:
    out = out_dir.rstrip("/")
    counts: dict[str, int] = {}
    c = driver.customers(spark, sf_dir)
    t = driver.transactions(spark, sf_dir)

    counts["customers.csv"] = _write(c.select("customer_id", "country", "signup_date", "acquisition_channel"),
                                     f"{out}/customers.csv")
    t_country = t.join(c.select("customer_id", "country"), "customer_id")
    counts["transactions.csv"] = _write(t_country.select(
        "transaction_id", "customer_id", "transaction_date", "category", "unit_price", "quantity",
        "discount_pct", "country", line_revenue().alias("revenue")), f"{out}/transactions.csv")

    rfm = extracts.rfm_pandas(c, t, as_of)
    counts["rfm_scores.csv"] = _write(extracts.rfm_pandas_output(rfm), f"{out}/rfm_scores.csv")
    counts["segment_summary.csv"] = _write(segments.segment_summary_rounded(rfm), f"{out}/segment_summary.csv")
    counts["cohort_matrix.csv"] = _write(cohorts.cohort_matrix(driver.transactions(spark, sf_dir, with_product=False)),
                                         f"{out}/cohort_matrix.csv")

    # BI step: check the hand-off files exist, read them with declared schemas.
    files.require_inputs(spark, out, INPUTS)
    rfm_in = files.read_rfm(spark, f"{out}/rfm_scores.csv", key_type)
    matrix_in = files.read_cohort_matrix(spark, f"{out}/cohort_matrix.csv")
    txn_in = files.read_transactions(spark, f"{out}/transactions.csv", key_type)
    regions = driver.geography(spark, sf_dir).select("country", "region")

    counts["tableau_rfm_customers.csv"] = _write(extracts.rfm_customers_extract(rfm_in),
                                                 f"{out}/tableau_rfm_customers.csv")
    counts["tableau_cohort_retention.csv"] = _write(cohorts.cohort_long(matrix_in),
                                                    f"{out}/tableau_cohort_retention.csv")
    counts["tableau_monthly_revenue.csv"] = _write(extracts.monthly_revenue(txn_in),
                                                   f"{out}/tableau_monthly_revenue.csv")
    counts["tableau_geo_summary.csv"] = _write(extracts.geo_summary(rfm_in, regions),
                                               f"{out}/tableau_geo_summary.csv")
    return counts


def month3_headline(matrix: DataFrame) -> DataFrame:
    """Average month-3 retention / churn over cohorts (printed summary)."""
    return cohorts.avg_retention(matrix, 3).select(
        F.col("avg_month3_retention_pct"), F.col("avg_month3_churn_pct"))
