import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (SparkSession.builder.master("local[4]").appName("cohortlens-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    yield s


D = dt.date


@pytest.fixture()
def micro(spark):
    """Fixture M: 5 customers (4 never buys), 11 transactions."""
    from cohortlens.sources.schemas import schema_for
    from pyspark.sql import types as T
    cust = spark.createDataFrame(
        [(1, "US", None, "organic_search"), (2, "GB", None, "social"), (3, "DE", None, "email"),
         (4, "FR", None, "direct"), (5, "US", None, "referral")],
        schema_for("customers_csv", T.LongType()))
    rows = [
        ("T01", 1, D(2021, 1, 31), "Books", 2, "10.00", "0"),
        ("T02", 1, D(2021, 2, 1), "Toys", 1, "30.00", "10"),
        ("T03", 1, D(2021, 4, 15), "Books", 3, "5.55", None),
        ("T04", 2, D(2021, 12, 15), "Books", 1, "100.00", "20"),
        ("T05", 2, D(2022, 1, 3), "Beauty", 1, "19.99", "5"),
        ("T06", 2, D(2022, 3, 15), "Beauty", 2, "7.50", "0"),
        ("T07", 3, D(2021, 1, 5), "Sports", 1, "40.00", "0"),
        ("T08", 3, D(2021, 3, 6), "Sports", 1, "40.00", "15"),
        ("T09", 5, D(2021, 1, 10), "Toys", 1, "12.00", "0"),
        ("T10", 5, D(2021, 3, 10), "Toys", 1, "12.00", "0"),
        ("T11", 5, D(2021, 4, 11), "Toys", 1, "12.00", "0"),
    ]
    schema = T.StructType([
        T.StructField("transaction_id", T.StringType()), T.StructField("customer_id", T.LongType()),
        T.StructField("transaction_date", T.DateType()), T.StructField("category", T.StringType()),
        T.StructField("quantity", T.IntegerType()), T.StructField("unit_price", T.DecimalType(10, 2)),
        T.StructField("discount_pct", T.DecimalType(5, 2)),
    ])
    data = [(a, b, c, d, e, Decimal(f), None if g is None else Decimal(g)) for a, b, c, d, e, f, g in rows]
    txn = spark.createDataFrame(data, schema)
    return cust, txn
