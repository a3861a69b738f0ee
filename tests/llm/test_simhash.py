import tracemalloc

import numpy as np
import pytest
import xxhash

from cohortlens.llm import simhash
from cohortlens.llm.components import components

SCHEMA = "doc_id long, text string, fp int, component_id string"


def fingerprint(text, k=3):
    w = (text or "").encode().lower().split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + k]), 42) for i in range(max(1, len(w) - k + 1))] if w else []
    return sum(1 << b for b in range(64) if h and 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(values, bits):
    u = np.array(values, np.uint64)
    near = np.bitwise_count(u[:, None] ^ u[None, :]) <= bits
    root = np.arange(len(u))
    while True:
        new = np.array([root[n].min() for n in near]) if len(u) else root
        if (new == root).all():
            return root
        root = new


def run(spark, docs):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], SCHEMA)
    return sorted((r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(df).collect())


def test_documents(spark):
    rng = np.random.default_rng(1)
    words = [f"w{i}É" for i in range(50)]
    docs = []
    for g in range(12):
        base = [words[i] for i in rng.integers(0, 50, 120)]
        for c in range(8):
            own = list(base)
            for _ in range(c):
                own[rng.integers(0, 120)] = "X"
            docs.append((g * 100 + c, " ".join(own)))
    docs += [(5000, None), (5001, ""), (5002, " \t\n"), (5003, "One"), (5004, "oNE "), (5005, "one two"), (5006, "long " * 30_000), (5006, "long " * 30_000)]
    got = run(spark, docs)
    fps = [fingerprint(t) for _, t in docs]
    root = classes(fps, 3)
    ids = np.array([i for i, _ in docs])
    want = sorted((i, f, int(ids[root == r].min())) for (i, _), f, r in zip(docs, fps, root))
    assert got == want


def test_null_ids(spark):
    got = simhash.near_duplicates(spark.createDataFrame([(None, "a b c d"), (9, "a b c d"), (None, "q r s t u v")], "doc_id long, text string")).collect()
    assert sorted((r.doc_id is None, r.component_id) for r in got if r.component_id is not None) == [(False, 9), (True, 9)] and len(got) == 3


def test_empty(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("spread", [3, 12])
def test_trie_join_with_tiles(spark, spread):
    """One hot block value: many values within a few bits, dealt into tiles."""
    rng = np.random.default_rng(spread)
    v = {int(x) for x in rng.integers(0, 1 << 63, 500)}
    base = int(rng.integers(0, 1 << 62))
    while len(v) < 2500:
        x = base
        for b in rng.integers(0, 40, spread):
            x ^= 1 << int(b)
        v.add(x)
    values = sorted(v)
    signed = [x - (1 << 64) if x >> 63 else x for x in values]
    edges = components(simhash.near_pairs(spark.createDataFrame([(s,) for s in signed], "s long"), 3)).collect()
    want = classes(values, 3)
    found = {r.a: r.b for r in edges}
    groups = {}
    for s, r in zip(signed, want):
        groups.setdefault(r, []).append(s)
    assert {frozenset(g) for g in groups.values()} == {frozenset(s for s in signed if found.get(s, s) == r) for r in {found.get(s, s) for s in signed}}


def test_components_of_a_chain_and_a_star(spark):
    e = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 200)] + [(7, 7), (500, 400), (400, 500)]
    got = {r.a: r.b for r in components(spark.createDataFrame(e, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{100 + i: 100 for i in range(1, 200)}, 500: 400}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_arrays_are_made_for_a_step_at_a_time():
    """Bits of many shingles, and pairs of many fingerprints, take little memory at once."""
    rng = np.random.default_rng(2)
    h = rng.integers(0, 1 << 63, simhash.CHUNK, dtype=np.uint64)
    sizes = np.array([0, 5, simhash.CHUNK - 1005, 0, 1000])
    u = np.sort(rng.integers(0, 1 << 63, 40_000, dtype=np.uint64))
    u[1::50] = u[::50] ^ np.uint64(5)
    u = np.unique(u)
    start = np.arange(0, len(u), 2000)
    end = np.append(start[1:], len(u))
    peaks, forest = [], simhash._Forest(len(u))
    for step in (lambda: simhash._bits(h, sizes), lambda: simhash.trie_join(u, [start, end, start, end], 3, forest.link)):
        tracemalloc.start()
        got = step()
        peaks.append(tracemalloc.get_traced_memory()[1] / 1e6)
        tracemalloc.stop()
        if got is not None:
            ones = [np.unpackbits(x.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=int) for x in np.split(h, np.cumsum(sizes)[:-1])]
            assert got.tolist() == [int("".join("01"[int(2 * o > n)] for o in c), 2) for c, n in zip(ones, sizes.tolist())]
    assert max(peaks) < 70
    root = np.concatenate([s + classes(u[s:e], 3) for s, e in zip(start.tolist(), end.tolist())])
    assert np.array_equal(forest.root, root) and (root != np.arange(len(u))).sum() > 700
