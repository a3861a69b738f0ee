"""A customer holding a third of all lines: results equal a direct pandas
computation, and every customer-keyed aggregate combines map-side before
its shuffle (so the hot customer ships one partial row per task)."""

import datetime as dt
import random
from decimal import Decimal

import pandas as pd

from pyspark.sql import functions as F

from cohortlens.operators import churn, cohorts, metrics

AS_OF = dt.date(2022, 1, 1)


def _lines(spark, n=3000, seed=11):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        cust = 0 if i % 3 == 0 else rnd.randint(1, 200)
        day = dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 700))
        txn = f"t{i // 2}-{cust}"  # two lines per transaction id on average
        rows.append((txn, cust, day, rnd.randint(1, 5), Decimal(rnd.randint(100, 9999)) / 100,
                     Decimal(rnd.choice([0, 5, 10]))))
    schema = ("transaction_id string, customer_id long, transaction_date date, quantity int, "
              "unit_price decimal(10,2), discount_pct decimal(5,2)")
    return spark.createDataFrame(rows, schema).repartition(8), rows


def test_hot_customer_metrics(spark):
    df, rows = _lines(spark)
    pdf = pd.DataFrame(rows, columns=["txn", "cust", "date", "q", "p", "d"])
    pdf["rev"] = [q * p * (100 - d) / 100 for q, p, d in zip(pdf.q, pdf.p, pdf.d)]
    pdf["month"] = [x.replace(day=1) for x in pdf.date]
    exp = pdf.groupby("cust").agg(freq=("txn", "nunique"), rev=("rev", "sum"), last=("date", "max"),
                                  months=("month", "nunique"))
    got = {r.customer_id: r for r in metrics.transaction_aggregates(df, AS_OF).collect()}
    assert len(got) == len(exp)
    for cust, e in exp.iterrows():
        g = got[cust]
        assert (g.frequency, g.last_purchase_date, g.active_months) == (e.freq, e["last"], e.months)
        assert g.monetary_value == e.rev
    hot = got[0]
    assert hot.frequency == exp.loc[0, "freq"]

    # Cohort sizes and month-3 activity agree with direct computations.
    first = pdf.groupby("cust").date.min()
    sizes = first.map(lambda x: x.replace(day=1)).value_counts()
    got_sizes = {r.cohort_month: r.cohort_size for r in cohorts.cohort_sizes(df).collect()}
    assert got_sizes == sizes.to_dict()
    active = {c for c, d in zip(pdf.cust, pdf.date)
              if first[c] + dt.timedelta(days=60) <= d <= first[c] + dt.timedelta(days=90)}
    assert {r.customer_id for r in churn.month3_active(df).collect()} == active


def test_customer_aggregates_combine_map_side(spark):
    df, _ = _lines(spark, n=300)
    for plan_df in (metrics.transaction_aggregates(df, AS_OF), metrics.rfm_base(df, AS_OF),
                    cohorts.cohorts(df), metrics.customer_ltv(df)):
        text = plan_df._jdf.queryExecution().executedPlan().toString()
        assert "partial_" in text, text


def test_hot_customer_is_split_in_the_cohort_join(spark):
    """A third of the lines on one customer: AQE splits that partition."""
    n = 120_000
    lines = spark.range(n).select(
        F.col("id").alias("transaction_id"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 9000 + 2).alias("customer_id"),
        F.date_add(F.lit(dt.date(2021, 1, 1)), (F.col("id") % 300).cast("int")).alias("transaction_date"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = cohorts.transactions_with_cohort(lines)
        assert len(df.collect()) == n
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
