"""Adapter from the driver's TPC-H-like tables to the logical model.

    customers     c_custkey -> customer_id, nation name -> country,
                  region name -> region, c_mktsegment -> acquisition_channel
    transactions  one row per line item: l_orderkey -> transaction_id,
                  o_custkey -> customer_id, o_orderdate -> transaction_date,
                  l_quantity -> quantity, p_retailprice -> unit_price,
                  l_discount * 100 -> discount_pct, p_type -> category

Only the needed columns are read (Parquet column pruning).  Joins carry no
broadcast hints: the planner broadcasts a side only when its size statistics
are under ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks at run
time) and uses a shuffle join otherwise.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.sources.buckets import bucket_count, stored_buckets

# Snapshot date for recency: the day after the last order date in the data.
AS_OF = dt.date(2001, 8, 2)

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def driver_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {n: _read(spark, sf_dir, n) for n in DRIVER_TABLES}


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(country, region) from nation x region."""
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = _read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey"), F.col("n_name").alias("country"), F.col("r_name").alias("region"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer_id, country, signup_date (no source: NULL), acquisition_channel, region."""
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    g = geography(spark, sf_dir)
    return c.join(g, c.c_nationkey == g.n_nationkey).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("country"),
        F.lit(None).cast("date").alias("signup_date"),
        F.col("c_mktsegment").alias("acquisition_channel"),
        F.col("region"),
    )


def transactions(spark: SparkSession, sf_dir: str, with_product: bool = True) -> DataFrame:
    """Line-grain transactions: lineitem x part x orders.

    ``part`` is joined first and ``orders`` last, so the result is
    hash-partitioned by the order key (= transaction_id) whenever the joins
    shuffle; a following aggregate keyed by (customer, transaction, ...) then
    needs no extra exchange of line-grain rows.

    ``with_product=False`` leaves out the product attributes (unit_price,
    category) and with them the part join: analyses that only look at who
    bought when (cohorts, activity, month-3 window) read lineitem x orders.
    Every line references an existing product (a declared foreign key,
    checked by the constraint audit), so the rows are the same.
    """
    return _joined(_lines(spark, sf_dir, with_product), _orders(spark, sf_dir), with_product)


def bucketed_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``transactions`` from lines (with their product attributes) and orders
    that are stored in equally many buckets of the order key: neither the join
    nor an aggregate by transaction moves a line.  The first use writes both;
    all later ones, of any analysis, read them."""
    path = lambda t: f"{sf_dir.rstrip('/')}/{t}.parquet"
    n = bucket_count(spark, [path("lineitem"), path("orders")])
    li = stored_buckets(spark, "order_lines", [path("lineitem"), path("part")], lambda: _lines(spark, sf_dir, True), "l_orderkey", n)
    o = stored_buckets(spark, "orders", [path("orders")], lambda: _orders(spark, sf_dir), "o_orderkey", n)
    return _joined(li, o, True)


def _lines(spark: SparkSession, sf_dir: str, with_product: bool) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_discount")
    if not with_product:
        return li
    p = _read(spark, sf_dir, "part").select("p_partkey", "p_type", "p_retailprice")
    return li.join(p, li.l_partkey == p.p_partkey).drop("p_partkey")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")


def _joined(li: DataFrame, o: DataFrame, with_product: bool) -> DataFrame:
    cols = [
        F.col("l_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_orderdate").cast("date").alias("transaction_date"),
        F.col("l_quantity").cast("int").alias("quantity"),
    ]
    if with_product:
        cols += [F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price")]
    cols += [F.round(F.col("l_discount") * 100).cast("decimal(5,2)").alias("discount_pct")]
    if with_product:
        cols += [F.col("p_type").alias("category")]
    return li.join(o, li.l_orderkey == o.o_orderkey).select(*cols)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part").select("p_partkey", "p_type", "p_retailprice")
    return p.select(F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category"),
                    F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"))


def audit_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The base tables under their logical names, for the constraint audit.
    Lookups are outer joins, so a row without its parent stays and shows."""
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = _read(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    li = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    p = products(spark, sf_dir)
    orders = o.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"))
    lines = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"), "left").join(
        p.select(F.col("product_id").alias("p_id"), "unit_price"), F.col("l_partkey") == F.col("p_id"), "left")
    return {
        "customers": c.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
            F.col("c_custkey").alias("customer_id"), "country", F.lit(None).cast("date").alias("signup_date")),
        "products": p,
        "orders": orders,
        "transactions": lines.select(
            F.col("l_orderkey").alias("transaction_id"), F.col("o_custkey").alias("customer_id"), F.col("l_partkey").alias("product_id"),
            F.col("o_orderdate").alias("transaction_date"), F.col("l_quantity").alias("quantity"), "unit_price"),
        "lines": li.select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id")),
    }


def transactions_with_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions plus the buyer's country (the CSV extract carries it)."""
    c = customers(spark, sf_dir).select("customer_id", "country")
    return transactions(spark, sf_dir).join(c, "customer_id")
