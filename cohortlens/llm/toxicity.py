"""Toxicity grades: cumulative-link (proportional odds) regression.

P(grade >= k | x) = sigmoid(w . x - c_k) with one weight vector w for all
ordered thresholds c_1 < c_2 < ...; x are log(1 + count) of the document's
words and of their beginnings (four and five letters, ``lowe*``), so that
inflected forms that the sample lacks are known by their stem.  The expected severity is the sum of P(grade >= k) over k.

Fit.  The model is fitted on at most ``max_rows`` labelled documents, half of
either kind at most, those of the smallest hashes of their ids among the labels
that have a text (a documented, bounded sample); everything else runs over all
documents.  Word statistics of the sample are grouped aggregates.  An L1
penalty at 3.5 standard errors of a word without effect leaves the words that
matter.  Every word of the sample is a candidate: the fit starts with the
``ROUND`` words that tell most about the label, an aggregate over all words then
finds those whose gradient exceeds the penalty, up to ``ROUND`` of the worst
join, and so on until none is left, which is the fit over all of them.  The
words that are left are fitted again without the penalty.  At last the
thresholds are fitted to the sample with each kind weighted by its number of
labels, as the sample's shares are not those of the labels.

Grades.  ``labels`` has toxic 0 or 1.  The grades of toxic rows come from
thirds of their own evidence (sum of log(1 + count) times log-odds of the
words that speak for toxicity): 1 mild, 2 marked, 3 severe; 0 is not toxic.

Defined results
* words are lower-cased runs of letters and digits of the whole text; null or
  empty text: no words, so the model's base rate;
* labels that are null or not 0 or 1 take no part; of repeated labels of a
  doc_id the largest counts; of repeated documents each row is scored;
* without labels of both kinds nothing can be learned: severity 0, not toxic;
* an empty table gives an empty result; other columns are ignored, and kept
  by ``without_toxic``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.common import drop, freeze, lean, table

MAX_ROWS = 8000
ROUND = 1024           # words that join the fit at a time
MIN_ROWS = 3           # a word in fewer sample documents is no feature
GRADES = 3
REJECT = 0.5           # a document goes if P(grade >= 1) reaches this
ERRORS = 3.5
STEMS = (4, 5)
_word = re.compile(r"[^\W_]+").findall


@dataclass
class Model:
    words: dict[str, float] = field(default_factory=dict)   # word -> weight
    cuts: list[float] = field(default_factory=list)         # thresholds, ascending

    def __post_init__(self):
        self.stems = {k: own for k in STEMS if (own := {w[:-1] for w in self.words if len(w) == k + 1 and w[-1] == "*"})}

    def tails(self, eta: np.ndarray) -> np.ndarray:
        """P(grade >= k) of each row, a column for each k."""
        return _sigmoid(eta[:, None] - np.array(self.cuts, float)[None, :])

    def eta(self, texts: list[str | None]) -> np.ndarray:
        get = self.words.get
        out = np.zeros(len(texts))
        for i, t in enumerate(texts):
            if t and self.words:
                words, known = _word(t.lower()), self.words
                hits = Counter(w for w in words if w in known)
                for k in STEMS:
                    if k in self.stems:
                        hits.update(f"{b}*" for w in words if len(w) > k and (b := w[:k]) in self.stems[k])
                out[i] = sum(get(w) * np.log1p(c) for w, c in sorted(hits.items()))
        return out


def _sigmoid(z):
    return 0.5 * (1 + np.tanh(z / 2))


class _Rows:
    """Sparse rows: (row, column, value), sorted by row."""

    def __init__(self, row, col, val, n, m):
        self.row, self.col, self.val, self.n, self.m = row, col, val, n, m

    def dot(self, w):
        return np.bincount(self.row, self.val * w[self.col], self.n)

    def back(self, r):
        return np.bincount(self.col, self.val * r[self.row], self.m)


def slopes(eta: np.ndarray, y: np.ndarray, cuts: np.ndarray, weight=None):
    """(mean negative log-likelihood, its slope in each row's eta, in each cut)."""
    k = len(cuts)
    n = len(eta)
    share = np.full(n, 1 / n) if weight is None else weight / weight.sum()
    tail = np.ones((n, k + 2))
    tail[:, 1:k + 1] = _sigmoid(eta[:, None] - cuts[None, :])
    tail[:, k + 1] = 0
    i = np.arange(n)
    p = np.maximum(tail[i, y] - tail[i, y + 1], 1e-12)
    slope = tail * (1 - tail)
    d_eta = -(slope[i, y] - slope[i, y + 1]) / p * share
    per = slope * (share / p)[:, None]
    d_cuts = np.array([per[y == c, c].sum() - per[y == c - 1, c].sum() for c in range(1, k + 1)])
    return -(np.log(p) * share).sum(), d_eta, d_cuts


def loss_and_gradient(x: _Rows, y: np.ndarray, w: np.ndarray, cuts: np.ndarray):
    """Mean negative log-likelihood of the grades, and its gradients."""
    loss, d_eta, d_cuts = slopes(x.dot(w), y, cuts)
    return loss, x.back(d_eta), d_cuts


def fit_cuts(eta: np.ndarray, y: np.ndarray, weight: np.ndarray, cuts: np.ndarray, steps: int = 2000) -> np.ndarray:
    """The cuts that fit best where the rows weigh ``weight`` and eta stays."""
    step, loss = 1.0, slopes(eta, y, cuts, weight)
    for _ in range(steps):
        new = np.sort(cuts - step * loss[2])
        after = slopes(eta, y, new, weight)
        if after[0] > loss[0]:
            step /= 2
            if step < 1e-9:
                break
            continue
        moved = np.abs(new - cuts).max()
        cuts, loss, step = new, after, step * 1.5
        if moved < 1e-9:
            break
    return cuts


def fit(x: _Rows, y: np.ndarray, penalty: np.ndarray, ridge: float = 0.0, steps: int = 400):
    """Weights and cuts by accelerated proximal gradient with a step search."""
    k = int(y.max())
    share = np.array([(y >= c).mean() for c in range(1, k + 1)])
    cuts = np.log((1 - share) / share)
    w, step = np.zeros(x.m), 1.0
    v, vc, momentum = w.copy(), cuts.copy(), 1.0
    for _ in range(steps):
        f, g, gc = loss_and_gradient(x, y, v, vc)
        f, g = f + ridge * v @ v / 2, g + ridge * v
        while True:
            new = v - step * g
            new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
            new_c = np.maximum.accumulate(vc - step * gc)
            new_c = new_c + 1e-6 * np.arange(k)
            d, dc = new - v, new_c - vc
            f2 = loss_and_gradient(x, y, new, new_c)[0] + ridge * new @ new / 2
            if f2 <= f + g @ d + gc @ dc + (d @ d + dc @ dc) / (2 * step) + 1e-12 or step < 1e-8:
                break
            step /= 2
        nxt = (1 + np.sqrt(1 + 4 * momentum ** 2)) / 2
        v, vc = new + (momentum - 1) / nxt * (new - w), np.sort(new_c + (momentum - 1) / nxt * (new_c - cuts))
        done = np.abs(new - w).max(initial=0) + np.abs(new_c - cuts).max() < 1e-5
        w, cuts, momentum, step = new, new_c, nxt, step * 1.2
        if done:
            break
    return w, cuts


def _beginnings(words, k: int):
    return F.transform(F.filter(words, lambda w: F.length(w) > k), lambda w: F.concat(F.substring(w, 1, k), F.lit("*")))


def _sample(docs: DataFrame, labels: DataFrame, max_rows: int) -> tuple[DataFrame, dict[int, int]]:
    """(label_id, toxic) of the sample, and the labels of either kind that have a text."""
    known = (labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col("toxic").cast("int").alias("toxic"))
             .where("label_id IS NOT NULL AND toxic IN (0, 1)").groupBy("label_id").agg(F.max("toxic").alias("toxic")))
    with_text = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("label_id"))
    known = freeze(known.join(with_text, "label_id", "left_semi"), "toxicity-labels")
    of = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    kinds = [known.where(F.col("toxic") == k).orderBy(F.xxhash64("label_id"), "label_id").limit(max_rows // 2) for k in (0, 1)]
    sample = freeze(kinds[0].unionByName(kinds[1]), "toxicity-sample")
    drop(known)
    return sample, of


def _given(spark: SparkSession, words: list[str]) -> DataFrame:
    """Words as rows, by Arrow: a list of tuples would start Python workers of its own, which stay."""
    return spark.createDataFrame(pa.table({"word": pa.array(words, pa.string())}))


def _matrix(counts: DataFrame, words: list[str], place: dict[int, int]) -> _Rows:
    """The sample's rows in the given words; at most max_rows * len(words) values."""
    spark = counts.sparkSession
    asked = _given(spark, words)
    flat = counts.join(F.broadcast(asked), "word").select("label_id", "word", "n").toArrow()
    col = {w: i for i, w in enumerate(words)}
    coded = flat.column("word").combine_chunks().dictionary_encode()
    row = np.array([place[d] for d in flat.column("label_id").to_pylist()], int)
    c = np.array([col[w] for w in coded.dictionary.to_pylist()], int)[coded.indices.to_numpy()] if len(flat) else row
    v = np.log1p(flat.column("n").to_numpy().astype(float))
    order = np.lexsort((c, row))
    return _Rows(row[order], c[order], v[order], len(place), len(words))


def _joined(a: _Rows, b: _Rows) -> _Rows:
    """The columns of both, b's behind a's."""
    row, col, val = (np.concatenate(x) for x in ((a.row, b.row), (a.col, b.col + a.m), (a.val, b.val)))
    order = np.lexsort((col, row))
    return _Rows(row[order], col[order], val[order], a.n, a.m + b.m)


def _left_out(counts: DataFrame, stats: DataFrame, words: list[str], place: dict[int, int], d_eta: np.ndarray, penalty: float) -> list[str]:
    """Up to ROUND words, the worst first, whose gradient exceeds the penalty."""
    spark = counts.sparkSession
    rows = spark.createDataFrame(pa.table({"label_id": pa.array(list(place), pa.int64()), "slope": pa.array(d_eta[list(place.values())], pa.float64())}))  # at most max_rows
    mine = _given(spark, words)
    v = F.log1p("n")
    slope = counts.join(F.broadcast(rows), "label_id").groupBy("word").agg(F.abs(F.sum(v * F.col("slope"))).alias("g"), F.sum(v * v).alias("q"))
    over = (slope.join(stats.select("word"), "word").withColumn("g", F.col("g") / F.sqrt(F.col("q") / len(place)))
            .where(F.col("g") > penalty * (1 + 1e-3)).join(F.broadcast(mine), "word", "left_anti"))
    return [r.word for r in over.orderBy(F.desc("g"), "word").limit(ROUND).collect()]


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    sample, of = _sample(docs, labels, max_rows)
    text = F.lower(F.col("text").cast("string"))
    words = F.filter(F.split(text, r"[^\p{L}\p{N}]+"), lambda w: w != "")
    stems = [_beginnings(words, k) for k in STEMS]
    # the sample is bounded, so it may be broadcast; repeated documents count once
    one = (docs.select(F.col("doc_id").cast("long").alias("label_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
           .join(F.broadcast(sample), "label_id").groupBy("label_id", "toxic").agg(F.min("text").alias("text")))
    counts = freeze(one.select("label_id", "toxic", F.explode(F.concat(words, *stems)).alias("word")).groupBy("label_id", "toxic", "word").agg(F.count(F.lit(1)).alias("n")), "toxicity-counts")
    toxic = {r.label_id: r.toxic for r in sample.collect()}
    n, n1 = len(toxic), sum(toxic.values())
    if not 0 < n1 < n:
        return Model()
    p = n1 / n
    df = counts.groupBy("word").agg(F.count(F.lit(1)).alias("df"), F.sum("toxic").alias("hits")).where(F.col("df") >= MIN_ROWS)
    z = (F.col("hits") - F.col("df") * p) / F.sqrt(F.col("df") * (p * (1 - p)) + 0.25)
    odds = F.log((F.col("hits") + 0.5) / (F.col("df") - F.col("hits") + 0.5)) - math.log(p / (1 - p))
    stats = freeze(df.withColumns({"z": z, "odds": odds}), "toxicity-words")
    ids = sorted(toxic)
    place = {d: i for i, d in enumerate(ids)}
    y01 = np.array([toxic[d] for d in ids])
    # grades: thirds of the evidence among toxic rows, over all words that speak for it
    speaks = counts.where("toxic = 1").join(stats.where(F.col("z") > ERRORS).select("word", "odds"), "word")
    found = {r.label_id: r.e for r in speaks.groupBy("label_id").agg(F.sum((F.log1p("n") * F.greatest("odds", F.lit(0.0))).cast("decimal(38,9)")).cast("double").alias("e")).collect()}
    evidence = np.array([found.get(d, 0.0) for d in ids])
    order = np.flatnonzero(y01)[np.argsort(evidence[y01 == 1], kind="stable")]
    y = np.zeros(n, int)
    y[order] = 1 + np.arange(len(order)) * GRADES // len(order)
    y = np.unique(y, return_inverse=True)[1]                                   # fewer toxic rows than grades: fewer grades
    penalty = ERRORS * math.sqrt(p * (1 - p) / n)
    vocab = [r.word for r in stats.orderBy(F.desc(F.abs("z")), "word").limit(ROUND).collect()]
    x = _matrix(counts, vocab, place)
    while vocab:
        scale = np.sqrt(np.bincount(x.col, x.val ** 2, x.m) / x.n)
        scaled = _Rows(x.row, x.col, x.val / np.maximum(scale, 1e-12)[x.col], x.n, x.m)
        w, cuts = fit(scaled, y, np.full(x.m, penalty))
        more = _left_out(counts, stats, vocab, place, slopes(scaled.dot(w), y, cuts)[1], penalty)
        if not more:
            break
        vocab, x = vocab + more, _joined(x, _matrix(counts, more, place))
    for t in (sample, counts, stats):
        drop(t)
    used = np.flatnonzero(w) if vocab else []
    if not len(used):
        return Model()
    # the words that are left, without the penalty's shrinkage
    at = np.isin(x.col, used)
    left = _Rows(scaled.row[at], np.searchsorted(used, scaled.col[at]), scaled.val[at], x.n, len(used))
    w, cuts = fit(left, y, np.zeros(len(used)), ridge=1e-4)
    if of[1] * (n - n1) != of[0] * n1:
        cuts = fit_cuts(left.dot(w), y, np.where(y01 == 1, of[1] / n1, of[0] / (n - n1)), cuts)
    return Model({vocab[j]: float(a / max(scale[j], 1e-12)) for j, a in zip(used, w)}, [float(a) for a in cuts])


def _scores(batches, model: Model):
    """(batch, expected severity, P(grade >= 1), most likely grade)."""
    for batch in batches:
        eta = model.eta(batch.column("text").to_pylist())
        tail = model.tails(eta) if model.cuts else np.zeros((len(eta), 1))
        full = np.column_stack([np.ones(len(eta)), tail, np.zeros(len(eta))])
        yield batch, tail.sum(1), tail[:, 0], np.argmax(full[:, :-1] - full[:, 1:], axis=1)


def graded(docs: DataFrame, model: Model, reject: float = REJECT) -> DataFrame:
    """(doc_id, severity, p_toxic, grade, toxic) of every row."""
    def rows(batches):
        for batch, severity, p, grade in _scores(batches, model):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(severity), pa.array(p), pa.array(grade.astype(np.int32)), pa.array(p >= reject)],
                                             ["doc_id", "severity", "p_toxic", "grade", "toxic"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(lean(rows), "doc_id long, severity double, p_toxic double, grade int, toxic boolean"))


def without_toxic(docs: DataFrame, model: Model, reject: float = REJECT) -> DataFrame:
    """``docs`` without the rows whose P(grade >= 1) reaches ``reject``."""
    def rows(batches):
        for batch, _, p, _ in _scores(batches, model):
            yield batch.filter(pa.array(p < reject))

    return docs.mapInArrow(lean(rows), docs.schema)


# ---------------------------------------------------------------- query

def op3_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return graded(docs, train(docs, table(spark, sf_dir, "labels")))


QUERIES = {"op3_toxicity": op3_toxicity}
SQL: dict[str, str] = {}
