import random
from collections import Counter

import numpy as np
import pytest

from cohortlens.llm import toxicity as tx

DOCS = "doc_id long, text string, toxic string, n int"


def test_gradient():
    rng = np.random.default_rng(0)
    x = tx._Rows(np.repeat(np.arange(30), 2), rng.integers(0, 5, 60), rng.random(60), 30, 5)
    y, w, c = rng.integers(0, 4, 30), rng.normal(size=5), np.array([-0.5, 0.4, 1.7])
    f, g, gc = tx.loss_and_gradient(x, y, w, c)
    for v, grad, at in ((w, g, 2), (c, gc, 1)):
        v[at] += 1e-6
        up = tx.loss_and_gradient(x, y, w, c)[0]
        v[at] -= 1e-6
        assert abs((up - f) / 1e-6 - grad[at]) < 1e-4


def corpus(seed, n):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"w{r.randrange(300)}" for _ in range(r.randint(5, 60))]
        bad = r.random() < 0.15
        for _ in range(r.randint(1, 6) if bad else 0):
            words.insert(r.randrange(len(words)), r.choice(["Awful", "nasty!", f"hate{r.randrange(40)}"]))
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_held_out_accuracy_and_severity(spark):
    rows = corpus(1, 1500)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t, _ in rows], DOCS)
    labels = spark.createDataFrame([(i, 9, b) for i, _, b in rows[:900]] + [(5000, 9, None), (None, 9, 1), (3, 9, 7)], "doc_id long, n int, toxic int")
    model = tx.train(docs, labels)
    assert list(model.cuts) == sorted(model.cuts) and len(model.cuts) == tx.GRADES
    got = {r.doc_id: r for r in tx.graded(docs, model).collect()}
    assert len(got) == 1500
    test = rows[900:]
    assert sum(got[i].toxic == bool(b) for i, _, b in test) / len(test) > 0.98
    mean = {g: np.mean([r.severity for r in got.values() if r.grade == g]) for g in {r.grade for r in got.values()}}
    assert list(mean) and [mean[g] for g in sorted(mean)] == sorted(mean.values())
    kept = tx.without_toxic(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.toxic}
    edge = spark.createDataFrame([(1, None, "x", 1), (2, "", "x", 1), (3, "w1 " * 50_000 + "awful nasty awful", "x", 1), (3, "nasty", "x", 1)], DOCS)
    assert [r.toxic for r in tx.graded(edge, model).orderBy("doc_id", "severity").collect()][:2] == [False, False]
    assert tx.graded(edge, model).count() == 4 and tx.graded(docs.limit(0), model).collect() == []


def test_the_sample_is_bounded_and_labels_may_lack(spark):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t, _ in corpus(2, 50)], DOCS)
    for labels in ([], [(1, 0), (2, 0)], [(1, 1)]):
        model = tx.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert not model.words and {(r.toxic, r.severity) for r in tx.graded(docs, model).collect()} == {(False, 0.0)}
    assert not tx.train(docs, spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, toxic int"), max_rows=1).words


def reference(rows):
    """The fit in plain numpy: dense, every word from the start, small steps."""
    import re
    bags = []
    for _, text, _ in rows:
        words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
        bags.append(Counter(words + [w[:k] + "*" for k in tx.STEMS for w in words if len(w) > k]))
    y01 = np.array([b for *_, b in rows])
    n, p = len(rows), y01.mean()
    df = Counter(w for bag in bags for w in bag)
    vocab = sorted(w for w, k in df.items() if k >= tx.MIN_ROWS)
    hits = Counter(w for bag, b in zip(bags, y01) if b for w in bag)
    z = {w: (hits[w] - df[w] * p) / np.sqrt(df[w] * p * (1 - p) + 0.25) for w in vocab}
    odds = {w: np.log((hits[w] + 0.5) / (df[w] - hits[w] + 0.5)) - np.log(p / (1 - p)) for w in vocab if z[w] > tx.ERRORS}
    evidence = [round(sum(np.log1p(c) * max(odds[w], 0) for w, c in bag.items() if w in odds), 6) for bag in bags]
    order = [i for _, i in sorted((evidence[i], i) for i in range(n) if y01[i])]
    y = np.zeros(n, int)
    for at, i in enumerate(order):
        y[i] = 1 + at * tx.GRADES // len(order)
    x = np.array([[np.log1p(bag[w]) for w in vocab] for bag in bags])
    scale = np.sqrt((x ** 2).mean(0))
    x = x / scale

    def descend(x, w, cuts, penalty, ridge, steps):
        step = 4.0 / np.linalg.norm(x, 2) ** 2 * n
        for _ in range(steps):
            eta = x @ w
            tail = np.column_stack([np.ones(n), 1 / (1 + np.exp(cuts - eta[:, None])), np.zeros(n)])
            own = tail[np.arange(n), y] - tail[np.arange(n), y + 1]
            s = tail * (1 - tail)
            g = -(s[np.arange(n), y] - s[np.arange(n), y + 1]) / own / n
            gc = np.array([(s[y == c, c] / own[y == c]).sum() - (s[y == c - 1, c] / own[y == c - 1]).sum() for c in range(1, len(cuts) + 1)]) / n
            w = w - step * (x.T @ g + ridge * w)
            w = np.sign(w) * np.maximum(np.abs(w) - step * penalty, 0)
            cuts = cuts - step * gc
        return w, cuts

    share = np.array([(y >= c).mean() for c in range(1, y.max() + 1)])
    w, cuts = descend(x, np.zeros(len(vocab)), np.log((1 - share) / share), tx.ERRORS * np.sqrt(p * (1 - p) / n), 0.0, 6000)
    used = np.flatnonzero(w)
    return {vocab[j] for j in used}, x[:, used], scale[used], [vocab[j] for j in used], y, descend


def test_against_a_plain_fit(spark, monkeypatch):
    """Words join a few at a time; the end is the fit over all of them."""
    monkeypatch.setattr(tx, "ROUND", 4)
    rows = corpus(3, 400)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t, _ in rows], DOCS)
    model = tx.train(docs, spark.createDataFrame([(i, b) for i, _, b in rows], "doc_id long, toxic int"))
    used, x, scale, names, y, descend = reference(rows)
    assert set(model.words) == used and len(used) > 4
    w, cuts = descend(x, np.zeros(len(names)), np.array(model.cuts), 0.0, 1e-4, 20_000)
    # the sample is nearly separable, so the last fit creeps: within a few per cent
    assert np.allclose(model.cuts, cuts, rtol=0.06)
    assert np.allclose([model.words[n] for n in names], w / scale, rtol=0.06)


def test_rare_kind_and_labels_without_documents(spark):
    """Half the sample may be toxic where few labels are: every such row is
    used, and the thresholds follow the labels' own shares."""
    rows = [r for r in corpus(5, 3000) if not r[2] or r[0] % 5 == 0]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t, _ in rows], DOCS)
    labels = [(i, b) for i, _, b in rows] + [(100_000 + i, 1) for i in range(5000)]  # without a document
    model = tx.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), max_rows=400)
    got = {r.doc_id: r for r in tx.graded(docs, model).collect()}
    share = np.mean([b for *_, b in rows])
    assert abs(np.mean([r.p_toxic for r in got.values()]) - share) < 0.02
    assert np.mean([got[i].toxic == bool(b) for i, _, b in rows]) > 0.98


def test_cuts_follow_weights():
    rng = np.random.default_rng(2)
    eta = rng.normal(size=4000)
    y = (eta + rng.logistic(size=4000) > 1).astype(int) + (eta + rng.logistic(size=4000) > 9)
    y = np.minimum(y, 1)
    got = tx.fit_cuts(eta, y, np.where(y == 1, 0.1, 1.0), np.array([0.0]))
    assert abs(got[0] - (1 + np.log(10))) < 0.25


def test_a_stage_that_cannot_learn_lets_all_pass(spark, tmp_path):
    import corpus_pipeline
    docs = spark.createDataFrame([(1, "nasty words", "x", 1), (2, None, "x", 1)], DOCS)
    spark.createDataFrame([(1, 1, 0)], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = corpus_pipeline.keep_civil(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and kept.count() == 2


def test_training_starts_no_python_workers_for_words_it_knows(spark, monkeypatch):
    """A list of tuples goes through Python workers, which stay beside those of the next stages."""
    rows = corpus(5, 200)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t, _ in rows], DOCS)
    labels = spark.createDataFrame([(i, b) for i, _, b in rows], "doc_id long, toxic int")
    monkeypatch.setattr(type(spark.sparkContext), "parallelize", lambda *x, **y: pytest.fail("a Python RDD"))
    assert tx.train(docs, labels).words
