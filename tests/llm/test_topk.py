import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import topk

SCHEMA = "vec_id long, embedding array<float>, rank int, score string"


def brute(rows, queries, k):
    q = {}
    for vid, v in rows:
        if vid is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            q.setdefault(vid, set()).add(tuple(math.floor(256 * float(np.float32(x))) for x in v))
    out = set()
    for a in q:
        if a % queries:
            continue
        best = {b: max(s) for b in q if b != a
                for s in [[sum(x * y for x, y in zip(u, w)) for u in q[a] for w in q[b] if len(u) == len(w)]] if s}
        for r, (b, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k], 1):
            out.add((a, r, b, s))
    return out


def run(spark, rows, queries, k):
    df = spark.createDataFrame([(i, v, 7, "x") for i, v in rows], SCHEMA)
    v = topk.quantized(df)
    return {tuple(r) for r in topk.top_k(v, v.where(F.col("id") % queries == 0), k).collect()}


@pytest.mark.parametrize("dims", [1, 16, 40])
def test_against_brute_force(spark, dims):
    rng = np.random.default_rng(dims)
    rows = [(i, rng.normal(size=dims).astype(np.float32).tolist()) for i in range(400)]
    assert run(spark, rows, 20, 5) == brute(rows, 20, 5)


def test_nulls_ties_repeats_lengths(spark):
    a = [1.0, 0.5]
    rows = [(0, a), (1, a), (2, a), (3, a), (3, a), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, None), (7, [None, 1.0]),
            (None, a), (8, [1.0]), (10, [-2.0, 0.1]), (10, [2.0, 0.1]), (20, []), (30, []), (40, a)]
    got = run(spark, rows, 10, 3)
    assert got == brute(rows, 10, 3)
    assert {(0, 1, 10), (20, 1, 30)} <= {r[:3] for r in got}


def test_pruning_changes_nothing(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(20, 64))
    rows = [(i, (base[i % 20] * rng.choice([1, 1, 3]) + rng.normal(size=64) * 0.05).astype(np.float32).tolist()) for i in range(3000)]
    assert run(spark, rows, 500, 5) == brute(rows, 500, 5)


def test_large_components_are_exact():
    b = topk._Block(np.array([1, 2, 3]), np.array([[1 << 40, 3], [1 << 40, 4], [5, -(1 << 40)]]))
    (qid, ids, score), = b.search(np.array([9]), np.array([[1 << 40, 1]]), 2)
    assert ids.tolist() == [2, 1] and score.tolist() == [(1 << 63) - 1] * 2 or score.tolist()[0] >= score.tolist()[1]


def test_empty_table(spark):
    assert run(spark, [], 10, 3) == set()


def test_hot_id_is_spread_and_pruned(spark):
    """A third of the rows under one id, a third of those one vector."""
    rng = np.random.default_rng(9)
    vec = lambda: rng.normal(size=40).astype(np.float32).tolist()
    same = vec()
    rows = [(i, vec()) for i in range(1500)] + [(7, vec()) for _ in range(500)] + [(7, same)] * 250
    assert run(spark, rows, 50, 5) == brute(rows, 50, 5)
    ids = np.array([r[0] for r in rows])
    block = topk._Block(ids, np.array([[math.floor(256 * x) for x in v] for _, v in rows]))
    assert block.repeats and len(block.ids) == len({(i, tuple(v)) for i, v in rows})
    part = block.f[0]
    look = block._promising(part, 40)
    assert len(set(block.ids[look])) == 40 and part[look].max() == part.max()
