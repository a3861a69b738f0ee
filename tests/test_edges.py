"""Edge fixtures: lookups with defaults, NULL category, duplicate ids,
frequency 0, recovery scenarios, audit, sources and sinks."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cohortlens.functions.lookups import REGION_OF, lookup
from cohortlens.operators import extracts, metrics, segments, sheets
from cohortlens.sources import audit, defaults, files, sinks

D = dt.date


def test_country_lookups(spark):
    df = spark.createDataFrame([("US",), ("ZA",), ("AE",), ("XX",)], "country string")
    got = {r.country: (r.country_name, r.region) for r in extracts.geo_labels(df).collect()}
    assert got == {"US": ("United States", "Americas"), "ZA": ("South Africa", "Africa"),
                   "AE": ("United Arab Emirates", "Middle East"), "XX": ("XX", "Other")}


def test_lookup_with_dataframe_mapping(spark):
    df = spark.createDataFrame([("A",), ("B",)], "country string")
    mapping = spark.createDataFrame([("A", "North")], "country string, region string")
    got = {r.country: r.region for r in lookup(df, "country", mapping, "region", default="Other").collect()}
    assert got == {"A": "North", "B": "Other"}
    assert len(REGION_OF) == 37


def _txn(spark, rows):
    return spark.createDataFrame(
        [(a, b, c, d, e, Decimal(f), None if g is None else Decimal(g)) for a, b, c, d, e, f, g in rows],
        "transaction_id string, customer_id long, transaction_date date, category string, quantity int, "
        "unit_price decimal(10,2), discount_pct decimal(5,2)")


def test_null_category_dropped(spark):
    t = _txn(spark, [("a", 1, D(2021, 1, 1), None, 1, "1.00", None),
                     ("b", 1, D(2021, 1, 2), "Books", 1, "2.00", "0")])
    rows = extracts.monthly_revenue(t).collect()
    assert [(r.category, r.transactions, r.revenue) for r in rows] == [("Books", 1, 2.0)]


def test_duplicate_transaction_id(spark):
    t = _txn(spark, [("a", 1, D(2021, 1, 1), "x", 1, "1.00", None),
                     ("a", 1, D(2021, 1, 1), "x", 1, "1.00", None)])
    assert metrics.transaction_aggregates(t, D(2021, 2, 1)).first().frequency == 1
    assert metrics.rfm_base(t, D(2021, 2, 1)).first().frequency == 2


def test_frequency_zero_guard(spark):
    df = spark.createDataFrame([(1, "c", Decimal("10.00"), 5, 0, "At-Risk")],
                               "customer_id long, country string, monetary_value decimal(28,6), "
                               "recency_days int, frequency long, segment string")
    assert segments.at_risk_recovery(df).first().estimated_recoverable_revenue is None


def test_recovery_scenarios(spark):
    df = spark.createDataFrame([(1, Decimal("3524200"), 10, 1, "At-Risk"), (2, Decimal("5"), 1, 1, "Champion")],
                               "customer_id long, monetary_value decimal(28,6), recency_days int, "
                               "frequency long, segment string")
    got = [(r.scenario, r.recoverable_revenue) for r in sheets.recovery_scenarios(df).collect()]
    assert got == [("5%", 176210.0), ("8%", 281936.0), ("12%", 422904.0)]


def test_audit_one_violation_each(spark):
    c = spark.createDataFrame([(1, "US", D(2020, 1, 1)), (2, "GB", D(2020, 1, 1))],
                              "customer_id long, country string, signup_date date")
    t = spark.createDataFrame([
        ("t1", 1, D(2021, 1, 1), 0, Decimal("1.00")),     # quantity 0
        ("t2", 1, D(2021, 1, 1), 1, Decimal("1.00")),
        ("t2", 2, D(2021, 1, 1), 1, Decimal("1.00")),     # duplicate PK
        ("t3", 9, D(2021, 1, 1), 1, Decimal("1.00")),     # orphan customer
        ("t4", 2, None, 1, Decimal("1.00")),              # NULL date
    ], "transaction_id string, customer_id long, transaction_date date, quantity int, unit_price decimal(10,2)")
    got = {(r.table_name, r.rule): r.violations for r in audit.audit({"customers": c, "transactions": t}).collect()}
    assert got[("transactions", "check:quantity>0")] == 1
    assert got[("transactions", "unique:transaction_id")] == 1
    assert got[("transactions", "foreign_key:customer_id")] == 1
    assert got[("transactions", "not_null:transaction_date")] == 1
    assert got[("customers", "unique:customer_id")] == 0
    # no such column: listed, but not checked
    assert got[("customers", "unique:email")] is None and got[("transactions", "not_null:product_id")] is None


def test_witnesses_add_up_to_the_audit(spark):
    c = spark.createDataFrame([(1, "US", D(2020, 1, 1)), (1, "US", None), (1, None, None), (None, "GB", None)], "customer_id long, country string, signup_date date")
    t = spark.createDataFrame([("t1", 1, D(2021, 1, 1), 0, Decimal("1.00")), ("t2", 9, None, -1, None), ("t2", 9, None, None, None), (None, None, None, 5, None)],
                              "transaction_id string, customer_id long, transaction_date date, quantity int, unit_price decimal(10,2)")
    tables = {"customers": c, "transactions": t}
    rows = audit.witnesses(tables).collect()
    sums = {}
    for r in rows:
        sums[r.table_name, r.rule] = sums.get((r.table_name, r.rule), 0) + r.rows
    assert sums == {(r.table_name, r.rule): r.violations for r in audit.audit(tables).collect() if r.violations}
    got = {(r.rule, r.witness): r.rows for r in rows}
    assert got["unique:customer_id", "1"] == 2 and got["unique:transaction_id", "t2"] == 1 and got["foreign_key:customer_id", "9"] == 2
    assert got["check:quantity>0", "t1"] == 1 and got["not_null:transaction_date", "t2"] == 2 and got["not_null:customer_id", None] == 1
    assert audit.witnesses({"customers": c.limit(0)}).collect() == []


def test_defaults(spark):
    t = spark.createDataFrame([(None, Decimal("5.00")), ("x", None)], "transaction_id string, discount_pct decimal(5,2)")
    rows = defaults.apply_defaults(t, "transactions").collect()
    assert rows[0].transaction_id and len(rows[0].transaction_id) == 36
    assert rows[1].discount_pct == Decimal("0.00")


def test_csv_roundtrip_and_inputs(spark, tmp_path):
    from pyspark.sql import types as T
    c = spark.createDataFrame([(1, "US", D(2020, 5, 1), "email"), (2, "GB", None, None)],
                              "customer_id long, country string, signup_date date, acquisition_channel string")
    files.write_csv(c, str(tmp_path / "customers.csv"))
    back = files.read_customers(spark, str(tmp_path / "customers.csv"), T.LongType())
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, c.collect()), key=str)
    files.require_inputs(spark, str(tmp_path), ["customers.csv"])
    with pytest.raises(FileNotFoundError, match="transactions.csv"):
        files.require_inputs(spark, str(tmp_path), ["customers.csv", "transactions.csv"])


from cohortlens.sources.commits import CommittedTable


def test_materialize_and_refresh(spark, tmp_path):
    df = spark.createDataFrame([(1, 10)], "customer_id long, v int")
    p = str(tmp_path / "mv")
    assert sinks.materialize(df, p).count() == 1
    assert sinks.materialize(df.union(df), p).count() == 1  # already there: untouched
    snap = str(tmp_path / "snap")
    sinks.refresh(df, snap, D(2021, 1, 1))
    sinks.refresh(df.withColumn("v", F.lit(20)), snap, D(2021, 2, 1))
    assert sinks.latest(spark, snap).first().v == 20
    assert sinks.latest(spark, snap, D(2021, 1, 1)).first().v == 10
    assert CommittedTable(spark, snap).read().count() == 2


def test_latest_skips_unfinished_snapshots(spark, tmp_path):
    snap = str(tmp_path / "snap")
    df = spark.createDataFrame([(1, 10)], "customer_id long, v int")
    sinks.refresh(df, snap, D(2021, 1, 1))
    sinks.refresh(df.withColumn("v", F.lit(11)), snap, D(2021, 1, 1))
    df.withColumn("v", F.lit(99)).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{snap}/as_of=2022-01-01")
    assert [tuple(r) for r in sinks.latest(spark, snap).collect()] == [(1, 11)]
    with pytest.raises(FileNotFoundError):
        sinks.latest(spark, str(tmp_path))


def test_bulk_load_refuses_null_in_not_null(spark, tmp_path):
    from pyspark.sql import types as T

    from cohortlens.sources.schemas import schema_for
    rows = spark.createDataFrame([(1, "US"), (2, None)], "customer_id long, country string")
    files.write_csv(rows, str(tmp_path / "c.csv"))
    with pytest.raises(ValueError, match="country"):
        files.load_table(spark, str(tmp_path / "c.csv"), str(tmp_path / "t"), schema_for("customers", T.LongType()))
    assert not (tmp_path / "t").exists()


def test_malformed_month_raises(spark):
    from cohortlens.functions.dates import parse_month
    df = spark.createDataFrame([("2021-03",), (None,)], "m string")
    assert [r[0] for r in df.select(parse_month("m")).collect()] == [D(2021, 3, 1), None]
    with pytest.raises(Exception, match="(?i)pars|cast|invalid|date"):
        spark.createDataFrame([("March",)], "m string").select(parse_month("m")).collect()


def test_no_machine_local_intermediates_on_a_cluster(spark):
    from cohortlens.session import warehouse_folder
    assert warehouse_folder(spark, "local[4]").startswith("file:")
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            warehouse_folder(spark, master)
