"""Ranked search against the definition, term by term."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cohortlens.llm import ranked as R

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall(text.translate(UPPER)) if text else []


def brute(docs, items, k):
    bags = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    bags = [b for b in bags if b[2]]
    total_docs, total_terms = len(bags), sum(b[2] for b in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    asked = {}
    for i, t in set(items):
        if t:
            asked.setdefault(i, Counter()).update(terms(t))
    out = []
    for item, bag in asked.items():
        found = []
        for doc, own, n in bags:
            m = 75 + 25 * n * total_docs // total_terms
            score = sum(times * math.floor(1000 * math.log((2 * total_docs + 2) / (2 * df[t] + 1))) * (10**9 * own[t] // (1000 * own[t] + 12 * m))
                        for t, times in bag.items() if t in own)
            if score > 0:
                found.append((score, doc))
        found.sort(key=lambda x: (-x[0], x[1] is None, x[1]))
        out += [(item, r, doc, s) for r, (s, doc) in enumerate(found[:k], 1)]
    return sorted(out, key=str)


def run(spark, docs, items, k=20, segment_bytes=R.SEGMENT_BYTES, block_terms=R.BLOCK_TERMS):
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, score int, segment int")
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    made, n = R.index(d, segment_bytes)
    return sorted([tuple(r) for r in R.search(made, n, q, k, block_terms).collect()], key=str)


def corpus(rng, n):
    words = ["the", "of", "Über", "naïve", "語", "x9", "don", "t", "AKIA", "0", *[f"w{i}" for i in range(60)]]
    weights = [60, 50, 5, 5, 5, 5, 5, 5, 5, 5, *[60 / (i + 3) for i in range(60)]]
    join = lambda k: "".join(w + rng.choice([" ", "-", "\n", "'", "_", "\x00", "\t "]) for w in rng.choices(words, weights, k=k))
    return [(rng.choice([i, i, 7, None]), join(rng.choice([0, 1, 3, 10, 40, 200]))) for i in range(n)] + [(5000, None), (5001, ""), (5002, " \n-")]


@pytest.mark.parametrize("segment_bytes", [1500, 1 << 20])
def test_brute_force(spark, segment_bytes):
    rng = random.Random(segment_bytes)
    docs = corpus(rng, 400)
    items = [(i, t) for i, (_, t) in enumerate(corpus(rng, 25))] + [(0, "the the W1 ÜBER"), (0, "the the W1 ÜBER"), (3, "w2"), (None, "naïve"), (90, "absent"), (91, None), (92, "")]
    want = brute(docs, items, 20)
    assert run(spark, docs, items, 20, segment_bytes) == want
    assert run(spark, docs, items, 20, segment_bytes, block_terms=40) == want  # items in several passes
    assert run(spark, docs, items, 1, segment_bytes) == brute(docs, items, 1)


def test_ties_and_weights_of_zero(spark):
    docs = [(i, "alpha beta") for i in range(30, 0, -1)] + [(None, "alpha beta"), (40, "beta")]
    got = run(spark, docs, [(1, "alpha"), (2, "beta")], 5)
    assert got == brute(docs, [(1, "alpha"), (2, "beta")], 5)
    assert [g[2] for g in got if g[0] == 1] == [1, 2, 3, 4, 5]
    every = [(i, "beta" if i else "beta rare") for i in range(600)]  # floor(1000 ln(1202 / 1201)) is 0
    got = run(spark, every, [(1, "beta"), (2, "beta rare")])
    assert got == brute(every, [(1, "beta"), (2, "beta rare")], 20) and [g[:3] for g in got] == [(2, 1, 0)]
    assert run(spark, [(1, "a")], [(1, "a")]) == brute([(1, "a")], [(1, "a")], 20)


def test_empty(spark):
    assert run(spark, [], [(1, "a")]) == []
    assert run(spark, [(1, "a")], []) == []
    assert run(spark, [(1, None)], [(1, "a")]) == []


def test_long_text_and_hot_term(spark):
    docs = [(1, "the " * 200_000 + "rare"), (2, "rare"), (3, "the")] + [(i, "the end") for i in range(10, 200)]
    items = [(1, "rare the"), (2, "the end")]
    assert run(spark, docs, items, 20, 4000) == brute(docs, items, 20)


def test_terms():
    rng = random.Random(2)
    texts = ["".join(rng.choice(["a", "Z", "é", "É", " ", "\x85", " ", " ", "7", "\x7f", "\x00", "\x1f", "/", ":", "@", "[", "`", "{", "語", "\U0001f600"]) for _ in range(rng.randrange(12))) for _ in range(300)]
    words, of = R.terms_of(pa.array([t.encode() for t in texts], pa.binary()))
    got = [[] for _ in texts]
    for w, o in zip(words.to_pylist(), of.tolist()):
        got[o].append(w)
    assert got == [terms(t) for t in texts]


def test_bounds_skip_strata():
    """Strata that cannot reach the k-th score are not visited; impacts stand once for each tf."""
    m = np.repeat(np.arange(75, 375), 10)
    docs, tfs = np.arange(3000), np.ones(3000, np.int64)
    seg = R.Segment(m, [b"a"], [docs], [tfs])
    best = R._Best(3, 1)
    for doc, score in seg.search([(b"a", 5)], lambda: best.least(0)):
        best.add(0, score, doc, np.zeros(len(doc), bool))
    assert best.ids[0].tolist() == [0, 1, 2] and seg.visited <= 2
    assert len(np.unique(seg.impact)) == 300


def test_a_segment_is_cut_into_terms_a_slice_at_a_time(monkeypatch):
    """Only a slice's terms are held at once, and the index is the same for any slice."""
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["a", "Bb", "c-d", "é", "x9"]) for _ in range(rng.randrange(40))).encode() for _ in range(200)]

    def made():
        return [b.to_pylist() for b in R._segment(list(range(200)), list(texts), 5, 200, 4000)]

    whole, seen, cut = made(), [], R.terms_of
    monkeypatch.setattr(R, "SLICE_BYTES", 1000)
    monkeypatch.setattr(R, "terms_of", lambda some: seen.append(sum(map(len, some.to_pylist()))) or cut(some))
    assert made() == whole
    assert len(seen) > 10 and max(seen) < 1000 + max(map(len, texts))
