"""Packed keys against Spark's own order, for every type, and back to values."""

import datetime as dt
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import ranking
from cohortlens.operators.keys import Keys

rnd = random.Random(11)
LONGS = [0, 1, -1, (1 << 63) - 1, -(1 << 63), 1 << 62, -(1 << 62), 5, 6, 1 << 32, (1 << 32) - 1]
DOUBLES = [0.0, -0.0, 1.0, -1.0, math.nextafter(1, 2), math.nextafter(1, 0), 2.0, 4.0, 0.5, 5e-324, -5e-324, 2.2e-308, 1e-310, 1.7976931348623157e308, float("inf"), float("-inf"), float("nan"),
           *[math.nextafter(2.0 ** k, s) for k in (-1073, -1022, -901, -900, -899, 10, 52, 53, 1023) for s in (0, math.inf)],
           *[rnd.uniform(-1, 1) * 10 ** rnd.randint(-300, 300) for _ in range(60)]]


def scaled(n, s):
    return Decimal(f"{n}E-{s}")


def DIGITS(p, s):
    return [scaled(rnd.randint(-10 ** n + 1, 10 ** n - 1), s) for n in range(1, p + 1) for _ in range(3)] + [Decimal(0), scaled(10 ** p - 1, s), scaled(1 - 10 ** p, s)]


TEXTS = ["", "a", "a\0", "a\0\0", "aa", "b", "é", "語", "zzzzzzzz", "zzzzzzz", "zzzzzzzy", "zzzzzzz\0", "\U0001f600", "CUST-000001", "CUST-000002", "x" * 40]
CASES = {
    "long": LONGS, "int": [0, 1, -1, (1 << 31) - 1, -(1 << 31)], "boolean": [True, False],
    "date": [dt.date(1, 1, 1), dt.date(1969, 12, 31), dt.date(1970, 1, 1), dt.date(9999, 12, 31)],
    "timestamp": [dt.datetime(1969, 12, 31, 23, 59, 59, 999999), dt.datetime(1970, 1, 1), dt.datetime(2001, 8, 2, 1, 2, 3, 4)],
    "double": DOUBLES, "float": [0.0, 1.5, -1.5, float("inf"), float("nan"), 1.401298464324817e-45, 3.4e38],
    "decimal(18,6)": DIGITS(18, 6), "decimal(28,6)": DIGITS(28, 6), "decimal(38,18)": DIGITS(38, 18), "decimal(38,0)": DIGITS(38, 0), "decimal(38,26)": DIGITS(38, 26), "decimal(5,2)": DIGITS(5, 2),
    "string": TEXTS, "binary": [t.encode() for t in TEXTS] + [b"\xff\xfe", b"\x80"],
}


@pytest.mark.parametrize("kind", CASES)
@pytest.mark.parametrize("desc", [False, True])
def test_order(spark, kind, desc):
    values = CASES[kind] + [None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values * 2)], f"customer_id long, x {kind}")
    keys = Keys(df, {"k": [("x", desc), ("customer_id", False)]})
    assert keys.total == len(values) * 2 and all(b <= 62 for b in keys.bits("k"))
    order = F.col("x").desc_nulls_last() if desc else F.col("x").asc_nulls_last()
    want = [r.customer_id for r in df.orderBy(order, "customer_id").collect()]
    packed = df.select("customer_id", *[k.alias(f"k{i}") for i, k in enumerate(keys.longs("k"))])
    got = [r.customer_id for r in packed.orderBy(*packed.columns[1:]).collect()]
    assert got == want
    assert packed.select(*packed.columns[1:]).distinct().count() == len(values) * 2  # the tie-breaker is in the key


@pytest.mark.parametrize("kind", [k for k in CASES if k in ("long", "int", "double", "float") or k.startswith("decimal")])
@pytest.mark.parametrize("desc", [False, True])
def test_back_to_values(spark, kind, desc):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(CASES[kind] + [None])], f"customer_id long, x {kind}")
    keys = Keys(df, {"k": [("x", desc), ("customer_id", False)]})
    rows = df.select("x", *[k.alias(f"k{i}") for i, k in enumerate(keys.longs("k"))]).collect()
    for r in rows:
        back = keys.first_value("k", tuple(r[1:]))
        assert back == r.x or (back != back and r.x != r.x)


def test_one_long_for_usual_metrics(spark):
    """The bits that values use, not those of their types."""
    df = spark.range(5000).selectExpr("id AS customer_id", "cast(id * 13.37 AS decimal(28,6)) AS m", "cast(id % 900 AS int) AS r")
    assert len(Keys(df, {"m": [("m", False), ("customer_id", False)]}).bits("m")) == 1
    assert Keys(df, {"r": [("r", True)]}).bits("r") == [10]


def test_no_lambda_and_no_sample(spark, monkeypatch):
    df = spark.range(3000).selectExpr("id AS customer_id", "id % 7 AS x")
    seen = []
    collect = type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: seen.append(self._jdf.queryExecution().executedPlan().toString()) or collect(self))
    got = ranking.global_ntile(df, 5, ["x"], "t")
    plans = [*seen, got._jdf.queryExecution().executedPlan().toString()]
    assert len(plans) >= 3
    assert not any(w in p.lower() for p in plans for w in ("lambda", "sample", "sort_array", "collect_set"))


def test_equal_keys_beyond_a_leaf(spark, monkeypatch):
    """No tie-breaker tells the rows apart: the key itself is the answer."""
    monkeypatch.setattr(ranking, "LEAF", 10)
    monkeypatch.setattr(ranking, "CELLS", 4)
    df = spark.createDataFrame([(1, 5.5, g) for g in (0, 1, None) for _ in range(100)] + [(1, 9.0, 0)], "customer_id long, v double, g int")
    assert ranking.exact_quantiles(df, "v", [0.25, 0.5, 1.0]) == [5.5, 5.5, 9.0]
    assert {r.g: r.m for r in ranking.grouped_median(df, ["g"], "v", "m").collect()} == {0: 5.5, 1: 5.5, None: 5.5}


def test_texts_as_ties_and_values(spark, monkeypatch):
    monkeypatch.setattr(ranking, "LEAF", 20)
    monkeypatch.setattr(ranking, "CELLS", 16)
    from pyspark.sql import Window
    rows = [(f"CUST-{i * 7919 % 1000:06d}", rnd.choice([None, "x", "y", "yy", "longer than seven bytes"])) for i in range(500)]
    df = spark.createDataFrame(rows, "customer_id string, s string")
    want = df.withColumn("a", F.ntile(5).over(Window.orderBy(F.col("s").asc_nulls_last(), "customer_id")))
    assert ranking.ntiles(want, 5, {"b": ("s", False)}, source=df).where("a <> b").count() == 0


def test_unsupported_type_is_named(spark):
    with pytest.raises(TypeError, match="x"):
        Keys(spark.createDataFrame([(1, [1])], "customer_id long, x array<int>"), {"k": [("x", False)]})
