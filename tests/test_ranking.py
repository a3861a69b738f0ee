"""Selected order statistics against the built-in single-task forms and
numpy: hot values, NULL values, NULL ties, NULL groups, several rounds."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortlens.operators import ranking


def _frame(spark, n, seed=7, hot_share=0.34, nulls=0.0):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        v = 1 if rnd.random() < hot_share else rnd.randint(1, 40)
        rows.append((i * 7 % (n + 3), None if rnd.random() < nulls else v, rnd.randint(0, 900)))
    return spark.createDataFrame(rows, "customer_id long, freq long, rec int")


@pytest.fixture(params=[(1024, 50_000), (16, 40)])
def rounds(request, monkeypatch):
    """As in use, and with cells and leaves so small that rounds repeat."""
    monkeypatch.setattr(ranking, "CELLS", request.param[0])
    monkeypatch.setattr(ranking, "LEAF", request.param[1])


@pytest.mark.parametrize("n_rows", [0, 1, 3, 7])
def test_tile_sizes(spark, n_rows):
    df = spark.createDataFrame([(i, i % 2) for i in range(n_rows)], "customer_id long, x long")
    tiles = sorted(r.t for r in ranking.global_ntile(df, 5, ["x"], "t").collect())
    assert tiles == {0: [], 1: [1], 3: [1, 2, 3], 7: [1, 1, 2, 2, 3, 4, 5]}[n_rows]


@pytest.mark.parametrize("nulls", [0.0, 0.2])
def test_ntiles_equal_builtin(spark, rounds, nulls):
    df = _frame(spark, 2999, nulls=nulls).withColumn("customer_id", F.when(F.col("customer_id") != 5, F.col("customer_id")))
    last = F.col("customer_id").asc_nulls_last()
    want = df.withColumn("a", F.ntile(5).over(Window.orderBy(F.col("freq").desc_nulls_last(), last))) \
             .withColumn("b", F.ntile(7).over(Window.orderBy(F.col("freq").asc_nulls_last(), last)))
    got = ranking.ntiles(want, 5, {"x": ("freq", True), "z": ("rec", False)}, source=df)
    got = ranking.ntiles(got, 7, {"y": ("freq", False)}, source=df)
    assert got.where("a <> x OR b <> y").count() == 0 and got.count() == 2999


def test_no_window_or_shuffle_of_the_table(spark):
    df = _frame(spark, 2000)
    plan = ranking.global_ntile(df, 5, ["freq"], "t")._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Window", "Exchange", "Join", "Python"))


def test_exact_quantiles_match_numpy(spark, rounds):
    df = _frame(spark, 1001)
    vals = [r.rec for r in df.collect()]
    got = ranking.exact_quantiles(df, "rec", [0.2, 0.4, 0.6, 0.8])
    assert np.allclose(got, np.quantile(np.array(vals, dtype=float), [0.2, 0.4, 0.6, 0.8]))
    assert ranking.exact_quantiles(df.limit(0), "rec", [0.5]) == []


def test_quantile_bucket_with_colliding_edges(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([1, 1, 1, 1, 1, 2, 3])], "customer_id long, x long")
    assert ranking.exact_quantiles(df, "x", [0.2, 0.4, 0.6, 0.8]) == [1.0, 1.0, 1.0, 1.8]
    got = {r.x: r.b for r in ranking.quantile_bucket(df, "x", 5, "b").collect()}
    assert got == {1: 1, 2: 5, 3: 5}


def test_grouped_median_hot_and_null_groups(spark, rounds):
    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        g = 0 if rnd.random() < 0.4 else (None if rnd.random() < 0.05 else rnd.randint(1, 6))
        rows.append((i, g, 5.0 if rnd.random() < 0.3 else float(rnd.randint(0, 200))))
    df = spark.createDataFrame(rows + [(9999, 1, None)], "customer_id long, g int, v double")
    got = {r.g: r.m for r in ranking.grouped_median(df, ["g"], "v", "m").collect()}
    assert got == {g: float(np.median([v for _, gg, v in rows if gg == g])) for g in {r[1] for r in rows}}


def test_approx_options_close_to_exact(spark):
    rows = [(i, i % 4, float((i * 37) % 1000)) for i in range(4000)]
    df = spark.createDataFrame(rows, "customer_id long, g int, v double")
    exact = {r.g: r.m for r in ranking.grouped_median(df, ["g"], "v", "m").collect()}
    approx = {r.g: r.m for r in ranking.grouped_median(df, ["g"], "v", "m", approx=True).collect()}
    assert all(abs(exact[g] - approx[g]) <= 2.0 for g in exact)
    q = ranking.approx_quantiles(df, ["v"], [0.2, 0.8])["v"]
    assert abs(q[0] - 200) < 5 and abs(q[1] - 800) < 5
