"""Fixture M (hand-computed expectations): metrics, cohorts, month-3 window,
quarter LTV."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from cohortlens.operators import churn, cohorts, ltv, metrics

AS_OF = dt.date(2022, 4, 1)
D = dt.date


def test_customer_metrics(micro):
    cust, txn = micro
    m = {r.customer_id: r for r in metrics.customer_metrics(cust, txn, AS_OF).collect()}
    assert set(m) == {1, 2, 3, 5}  # customer 4 never bought: inner join drops it
    assert (m[1].frequency, m[1].last_purchase_date, m[1].recency_days) == (3, D(2021, 4, 15), 351)
    assert m[1].monetary_value == Decimal("63.650000")
    assert (m[1].first_purchase_date, m[1].active_months) == (D(2021, 1, 31), 3)
    assert m[2].monetary_value == Decimal("113.990500") and m[2].recency_days == 17
    assert (m[3].frequency, m[3].recency_days, m[3].monetary_value, m[3].active_months) == (2, 391, Decimal("74"), 2)
    assert (m[5].frequency, m[5].recency_days, m[5].monetary_value) == (3, 355, Decimal("36"))


def test_cohort_retention(micro):
    _, txn = micro
    rows = {(r.cohort_month, r.month_number): r for r in cohorts.cohort_retention(txn).collect()}
    jan, dec = D(2021, 1, 1), D(2021, 12, 1)
    assert sorted(k for c, k in rows if c == jan) == [0, 1, 2, 3]
    assert sorted(k for c, k in rows if c == dec) == [0, 1, 3]  # month 2 missing, year boundary
    got = [(rows[(jan, k)].retained_customers, rows[(jan, k)].retention_rate_pct, rows[(jan, k)].churn_rate_pct)
           for k in range(4)]
    assert got == [(3, 100.0, 0.0), (1, 33.33, 66.67), (2, 66.67, 33.33), (2, 66.67, 33.33)]
    assert all(rows[(dec, k)].retention_rate_pct == 100.0 for k in (0, 1, 3))
    assert {r.cohort_size for (c, _), r in rows.items() if c == jan} == {3}


def test_month3_window_boundaries(micro):
    _, txn = micro
    active = {r.customer_id for r in churn.month3_active(txn).collect()}
    assert active == {1, 2, 3}  # day 74, 90, 60 in; customer 5 has days 59 and 91


def test_quarter_ltv(micro):
    _, txn = micro
    rows = [tuple(r) for r in ltv.quarter_ltv(txn).collect()]
    assert rows == [(1, 2021, 3, 57.88, 63.65, 173.65, 0.67), (4, 2021, 1, 113.99, 113.99, 113.99, 1.33)]


def test_cohort_matrix_roundtrip(micro):
    _, txn = micro
    matrix = cohorts.cohort_matrix(txn)
    long = cohorts.cohort_long(matrix)
    n_cells = cohorts.retention_counts(txn).where(F.col("month_number") <= 12).count()
    assert long.count() == n_cells  # pivot then unpivot keeps every observed cell
    for r in long.collect():
        assert abs(r.retention_rate_pct + r.churn_rate_pct - 100.0) < 1e-9
    m0 = {r.cohort_month: r["0"] for r in matrix.collect()}
    assert set(m0.values()) == {100.0}
