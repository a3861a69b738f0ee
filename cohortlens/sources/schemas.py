"""Declared table schemas (customers, products, transactions) and the
schemas of the CSV files exchanged between steps.

Keys are strings (UUID text) by default; ``schema_for(name, key_type=...)``
swaps in another key type (the driver tables use BIGINT keys).
"""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(key_type: T.DataType):
    return {
        "customers": [
            T.StructField("customer_id", key_type, False),
            T.StructField("email", T.StringType(), True),
            T.StructField("country", T.StringType(), False),
            T.StructField("signup_date", T.DateType(), True),
            T.StructField("acquisition_channel", T.StringType(), True),
            T.StructField("created_at", T.TimestampType(), True),
        ],
        "products": [
            T.StructField("product_id", key_type, False),
            T.StructField("product_name", T.StringType(), False),
            T.StructField("category", T.StringType(), True),
            T.StructField("unit_price", T.DecimalType(10, 2), False),
            T.StructField("created_at", T.TimestampType(), True),
        ],
        "transactions": [
            T.StructField("transaction_id", key_type, False),
            T.StructField("customer_id", key_type, False),
            T.StructField("product_id", key_type, True),
            T.StructField("transaction_date", T.DateType(), False),
            T.StructField("quantity", T.IntegerType(), False),
            T.StructField("unit_price", T.DecimalType(10, 2), False),
            T.StructField("discount_pct", T.DecimalType(5, 2), True),
            T.StructField("country", T.StringType(), True),
            T.StructField("category", T.StringType(), True),
            T.StructField("created_at", T.TimestampType(), True),
        ],
        # CSV files written by the pipeline (header, columns in this order).
        "customers_csv": [
            T.StructField("customer_id", key_type, False),
            T.StructField("country", T.StringType(), True),
            T.StructField("signup_date", T.DateType(), True),
            T.StructField("acquisition_channel", T.StringType(), True),
        ],
        "transactions_csv": [
            T.StructField("transaction_id", key_type, False),
            T.StructField("customer_id", key_type, False),
            T.StructField("transaction_date", T.DateType(), False),
            T.StructField("category", T.StringType(), True),
            T.StructField("unit_price", T.DecimalType(10, 2), False),
            T.StructField("quantity", T.IntegerType(), False),
            T.StructField("discount_pct", T.DecimalType(5, 2), True),
            T.StructField("country", T.StringType(), True),
            T.StructField("revenue", T.DecimalType(18, 6), True),
        ],
        "rfm_scores_csv": [
            T.StructField("customer_id", key_type, False),
            T.StructField("last_purchase", T.DateType(), True),
            T.StructField("frequency", T.LongType(), True),
            T.StructField("monetary_value", T.DoubleType(), True),
            T.StructField("recency_days", T.IntegerType(), True),
            T.StructField("r_score", T.IntegerType(), True),
            T.StructField("f_score", T.IntegerType(), True),
            T.StructField("m_score", T.IntegerType(), True),
            T.StructField("rfm_total", T.IntegerType(), True),
            T.StructField("segment", T.StringType(), True),
            T.StructField("country", T.StringType(), True),
            T.StructField("acquisition_channel", T.StringType(), True),
            T.StructField("cohort_month", T.StringType(), True),
            T.StructField("cohort_month_ts", T.DateType(), True),
            T.StructField("acq_quarter", T.IntegerType(), True),
        ],
        "cohort_matrix_csv": [T.StructField("cohort_month", T.StringType(), False)]
        + [T.StructField(str(k), T.DoubleType(), True) for k in range(13)],
    }


def schema_for(name: str, key_type: T.DataType | None = None) -> T.StructType:
    return T.StructType(_fields(key_type or T.StringType())[name])


SCHEMAS: dict[str, T.StructType] = {name: schema_for(name) for name in _fields(T.StringType())}
