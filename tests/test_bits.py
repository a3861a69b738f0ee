"""Months as bits against sets in plain Python."""

import datetime as dt
import random

from pyspark.sql import functions as F

from cohortlens.operators import bits, metrics

SCHEMA = "customer_id long, category string, transaction_date date"


def trial(seed, n):
    rnd = random.Random(seed)
    day = lambda: dt.date(1899, 11, 30) + dt.timedelta(rnd.choice([rnd.randrange(60_000), rnd.randrange(40) * 365 + 31]))
    return [(rnd.choice([None, 1, 1, 1, *range(2, 9)]), rnd.choice(["a", "b", "c", None]), rnd.choice([None, day(), day(), day()])) for _ in range(n)]


def plain(rows):
    seen = {}
    for who, cat, d in rows:
        if who is None or d is None:
            continue
        for grain, first in (("month", d.replace(day=1)), ("quarter", dt.date(d.year, (d.month - 1) // 3 * 3 + 1, 1)), ("year", dt.date(d.year, 1, 1)), ("all", None)):
            seen.setdefault((cat, grain, first), set()).add(who)
    return {k: len(v) for k, v in seen.items()}


def counts(words):
    found = bits.period_counts(words, "customer_id", "category").collect()
    out = {(r.category, r.grain, r.period): r.n for r in found}
    assert len(out) == len(found)
    return out


def test_counts_equal_sets(spark):
    rows = trial(1, 600)
    df = spark.createDataFrame(rows, SCHEMA)
    words = bits.month_bits(df, "category", "customer_id")
    assert counts(words) == plain(rows)
    assert counts(bits.month_bits(df.limit(0), "category", "customer_id")) == {}


def test_words_merge_over_deltas_and_groups(spark):
    rows = trial(2, 300), trial(3, 200)
    a, b = (bits.month_bits(spark.createDataFrame(r, SCHEMA), "category", "customer_id") for r in rows)
    whole = a.unionByName(b).unionByName(b)  # a delta that comes twice changes nothing
    assert counts(bits.merged_bits(whole, "category", "customer_id")) == plain(rows[0] + rows[1])
    one = bits.merged_bits(whole, "customer_id").withColumn("category", F.lit("all of them"))
    assert counts(one) == plain([(w, "all of them", d) for w, _, d in rows[0] + rows[1]])


def test_active_months(spark):
    rows = trial(4, 300) + [(77, "a", None)]
    found = {r.customer_id: r.active_months for r in metrics.customer_active_months(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = {w: len({(d.year, d.month) for x, _, d in rows if x == w and d}) for w, _, _ in rows}
    assert found == want and found[77] == 0


def test_lines_are_shuffled_as_words(spark):
    """Every exchange lies above the merge of the words."""
    df = spark.createDataFrame(trial(5, 50), SCHEMA)
    plan = metrics.customer_active_months(df)._jdf.queryExecution().executedPlan().toString().split("\n")
    at = [i for i, x in enumerate(plan) if "Exchange" in x]
    assert at and "bit_or" in plan[at[-1] + 1] + plan[at[-1] + 2], plan
