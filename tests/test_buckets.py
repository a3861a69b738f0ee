"""Lines and orders in buckets of the order key: no exchange below their join,
rows as from the files, written once for a state of the files, found again by
other sessions, and built anew where the folder was removed."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from cohortlens.plans import registry
from cohortlens.session import checkpoint_dir
from cohortlens.sources import driver, sinks
from cohortlens.sources.buckets import bucket_count, stored_buckets

SF = "/root/testdata/sf0.001"


def _nodes(node):
    yield node
    ch = node.children()
    for i in range(ch.size()):
        yield from _nodes(ch.apply(i))


@pytest.fixture()
def shuffle_joins(spark):
    """As at scale: no side is small enough to broadcast; static plans."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", ["customer_metrics", "monthly_revenue", "quarter_ltv"])
def test_no_exchange_below_the_line_join(spark, shuffle_joins, name):
    if name == "quarter_ltv":  # its own query writes stages: look at the part that reads lines
        frame = registry.metrics.customer_ltv(driver.bucketed_transactions(spark, SF))
    else:
        frame = registry.QUERIES[name](spark, SF)
    joins = [x for x in _nodes(frame._jdf.queryExecution().executedPlan()) if x.nodeName().endswith("Join") and "o_orderkey" in x.toString().split("\n")[0]]
    assert len(joins) == 1
    assert not [x.nodeName() for x in _nodes(joins[0]) if "Exchange" in x.nodeName()]


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_the_first_aggregate_of_the_metrics_moves_no_line(spark, shuffle_joins):
    plan = registry.QUERIES["customer_metrics"](spark, SF)._jdf.queryExecution().executedPlan()
    above = [x for x in _nodes(plan) if "Exchange" in x.nodeName() and any("o_orderkey" in y.toString().split("\n")[0] and y.nodeName().endswith("Join") for y in _nodes(x))]
    keys = [x.toString().split("\n")[0] for x in above]
    assert len(above) == 1 and "customer_id" in keys[0], keys


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_rows_are_those_of_the_files(spark):
    a, b = driver.bucketed_transactions(spark, SF), driver.transactions(spark, SF)
    assert a.schema.simpleString() == b.schema.simpleString()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_written_once_found_again_built_anew(spark, tmp_path):
    """NULL keys and repeated rows stay; a changed input is another table; a
    declaration without its folder, and a folder without a declaration, do no harm."""
    src = str(tmp_path / "in it's")
    df = spark.range(200).select(F.when(F.col("id") % 10 != 0, F.col("id") % 37).alias("k"), F.col("id").alias("v"))
    df.union(df).write.parquet(src)
    views = checkpoint_dir(spark).removeprefix("file:") + "/cohortlens/views"

    def rows():
        return sorted((r.k is None, r.k or 0, r.v) for r in stored_buckets(spark, "trial", [src], lambda: spark.read.parquet(src), "k", 4).collect())

    def written():
        return {f: os.stat(f"{views}/{f}/_SUCCESS").st_mtime_ns for f in os.listdir(views) if f.startswith("trial-")}

    want = sorted((r.k is None, r.k or 0, r.v) for r in spark.read.parquet(src).collect())
    assert rows() == want
    first = written()
    assert rows() == want and written() == first and len(first) == 1
    table = [t.name for t in spark.catalog.listTables() if t.name.startswith("cohortlens_trial_")]
    assert len(table) == 1
    spark.sql(f"DROP TABLE {table[0]}")  # as for a new session
    assert rows() == want and written() == first
    shutil.rmtree(f"{views}/{next(iter(first))}")
    assert rows() == want and written().keys() == first.keys() and written() != first
    df.limit(1).write.mode("append").parquet(src)
    assert len(rows()) == len(want) + 1 and len(written()) == 2


def test_buckets_hold_no_more_as_the_input_grows(spark, monkeypatch):
    """F1-F16: what a task sorts and aggregates is one bucket, of at most 16 MB of input at any size."""
    from cohortlens.sources import buckets
    for mb, n in ((10, 8), (100, 8), (806, 64), (4836, 512)):
        monkeypatch.setattr(buckets.sinks, "input_files", lambda spark, paths, mb=mb: [("f", mb << 20, 0)])
        assert bucket_count(spark, ["f"]) == n and mb / n <= 16


def _ran_in(frame):
    """In how many partitions of the writing job the stored rows were grouped."""
    return frame.select("at").distinct().count()


def _grouped(spark):
    """Rows with the partition in which their group was made."""
    return spark.range(2000).groupBy((F.col("id") % 400).alias("k")).agg(F.count("*").alias("rows")).withColumn("at", F.spark_partition_id())


def test_writes_shuffle_by_their_input_not_by_the_session(spark, shuffle_joins, tmp_path, monkeypatch):
    """F2-F15: where the session's number of shuffle partitions stays (4 here), a task below the buckets (the join of
    lines and products) or below a stored view holds no more as the input grows; the session's setting is as before after it."""
    src, key = str(tmp_path / "in"), "spark.sql.shuffle.partitions"
    spark.range(5000).write.parquet(src)
    monkeypatch.setattr(sinks, "TASK_BYTES", sum(size for _, size, _ in sinks.input_files(spark, [src])) // 16, raising=False)
    old = spark.conf.get(key)
    spark.conf.set(key, "4")
    try:
        assert _ran_in(stored_buckets(spark, "ran_in", [src], lambda: _grouped(spark), "k", 16)) == 16
        assert _ran_in(sinks.stored(spark, "ran_in_view", [src], lambda: _grouped(spark))) >= 16
        assert spark.conf.get(key) == "4"
        with pytest.raises(ZeroDivisionError):
            sinks.stored(spark, "ran_in_error", [src], lambda: 1 // 0)
        assert spark.conf.get(key) == "4"
        spark.conf.set(key, "64")  # a larger number of the session stays
        assert _ran_in(stored_buckets(spark, "ran_in_more", [src], lambda: _grouped(spark), "k", 16)) > 16
    finally:
        spark.conf.set(key, old)


def test_empty_input_and_bucket_count(spark, tmp_path):
    src = str(tmp_path / "empty")
    spark.range(0).select(F.col("id").alias("k")).write.parquet(src)
    assert stored_buckets(spark, "none", [src], lambda: spark.read.parquet(src), "k", 4).count() == 0
    n = bucket_count(spark, [src])
    assert n == 8
    from cohortlens.sources import buckets
    old = buckets.BUCKET_BYTES
    try:
        buckets.BUCKET_BYTES = 1
        assert bucket_count(spark, [src]) >= 512 and bucket_count(spark, [src]) & (bucket_count(spark, [src]) - 1) == 0
    finally:
        buckets.BUCKET_BYTES = old
