"""Merged states against the metrics of all lines at once."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import metrics
from cohortlens.operators.states import MetricStates
from cohortlens.sources.commits import Conflict

AS_OF = dt.date(2022, 1, 1)
SCHEMA = "transaction_id string, customer_id long, transaction_date date, quantity int, unit_price decimal(10,2), discount_pct decimal(5,2)"


@pytest.fixture()
def customers(spark):
    return spark.createDataFrame([(i, "US", None, "email") for i in range(1, 9)], "customer_id long, country string, signup_date date, acquisition_channel string")


def lines(spark, seed, n, first=dt.date(2005, 1, 1), days=6000):
    rnd = random.Random(seed)
    rows = [(f"T{rnd.randrange(60)}", rnd.choice([1, 1, 1, 2, 3, 4, 5, 6]), first + dt.timedelta(rnd.randrange(days)), rnd.randint(1, 5),
             Decimal(rnd.randint(1, 99_999)).scaleb(-2), rnd.choice([None, Decimal("5.00")])) for _ in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return sorted(tuple(r) for r in df.withColumns({"monetary_value": F.col("monetary_value").cast("decimal(38,6)"), "frequency": F.col("frequency").cast("long")}).collect())


def test_merged_equals_whole(spark, tmp_path, customers):
    parts = [lines(spark, s, n) for s, n in ((1, 200), (2, 0), (3, 80), (4, 1))]
    states = MetricStates(spark, str(tmp_path / "s"))
    whole = None
    for i, p in enumerate(parts):
        assert states.merge(p, f"day {i}")
        whole = p if whole is None else whole.unionByName(p)
        assert rows(states.customer_metrics(customers, AS_OF)) == rows(metrics.customer_metrics(customers, whole, AS_OF))
    assert not states.merge(parts[0], "day 0")  # counts once
    states.compact()
    assert states.merge(parts[2].limit(5).withColumn("transaction_date", F.lit(dt.date(1890, 5, 5))), "late")
    whole = whole.unionByName(parts[2].limit(5).withColumn("transaction_date", F.lit(dt.date(1890, 5, 5))))
    assert rows(states.customer_metrics(customers, AS_OF)) == rows(metrics.customer_metrics(customers, whole, AS_OF))
    states.table.vacuum()
    assert rows(states.customer_metrics(customers, AS_OF)) == rows(metrics.customer_metrics(customers, whole, AS_OF))


def test_a_refresh_does_not_read_old_lines(spark, tmp_path, customers):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    lines(spark, 1, 100).write.parquet(old)
    lines(spark, 2, 10).write.parquet(new)
    states = MetricStates(spark, str(tmp_path / "s"))
    states.merge(spark.read.parquet(old), "old")
    spark.read.parquet(old).limit(0).write.mode("overwrite").parquet(f"{old}-kept")
    import shutil
    shutil.rmtree(old)  # the lines are gone; the merge needs the delta alone
    states.merge(spark.read.parquet(new), "new")
    read = states.customer_metrics(customers, AS_OF).inputFiles()
    assert read and all("/s/data/" in f for f in read)


def test_merges_that_meet(spark, tmp_path, customers):
    path = str(tmp_path / "s")
    first, second = MetricStates(spark, path), MetricStates(spark, path)
    first.merge(lines(spark, 1, 20), "a")
    seen = first.table.entries
    late = seen()
    first.table.entries = lambda g=None: late if g is None else seen(g)  # has read before the other commits
    second.merge(lines(spark, 2, 20), "b")
    with pytest.raises(Conflict):
        first.merge(lines(spark, 3, 20), "c")
    whole = lines(spark, 1, 20).unionByName(lines(spark, 2, 20))
    assert rows(second.customer_metrics(customers, AS_OF)) == rows(metrics.customer_metrics(customers, whole, AS_OF))
