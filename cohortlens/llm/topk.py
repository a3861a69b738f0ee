"""Exact top-k inner products: columnar branch and bound.

Distinct candidates are dealt into blocks by a hash of id and vector, so that
the vectors of a hot id are spread; every query visits every block (a stated query set against all rows, in blocks).  A block holds
its vectors by dimension (vertical layout).  For a batch of queries the
products are accumulated dimension block by dimension block; after each one
a candidate's score is at most ``partial + |rest of query| * |rest of
candidate|`` (Cauchy-Schwarz on the remaining mass), and those that cannot
reach the query's k-th best score so far are compacted away.

Components are integers, ``floor(256 * x)`` with x as double, and sums are
exact: float64 where every sum stays below 2**53, else Python integers
(a score outside the range of a long becomes the nearest long).

Defined results
* a vector that is null, holds a null or non-finite component, or has a null
  id takes no part; vectors of another length than the query's are no
  candidates for it; empty vectors score 0;
* equal scores: the smaller vec_id first;
* repeated rows count once; of several vectors under one vec_id the best
  score counts, and a query's own vec_id is never its candidate;
* an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import freeze, partitions, table

BLOCK_ROWS = 8192     # candidates of one block: its memory, whatever the table's size
DIM_BLOCK = 16
QUERY_BATCH = 64


def quantized(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, q): integer components of every vector that takes part."""
    x = F.col(vec_col)
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) != float("inf")))
    return (vectors.select(F.col(id_col).cast("long").alias("id"), x)
            .where(F.col("id").isNotNull() & x.isNotNull() & fine)
            .select("id", F.transform(x, lambda v: F.floor(v.cast("double") * 256)).alias("q")))


class _Block:
    """Candidates of one length in vertical layout, sorted by id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        rows = np.unique(np.column_stack([ids, vectors]), axis=0)  # repeated rows count once
        self.ids = rows[:, 0]
        self.v = np.ascontiguousarray(rows[:, 1:].T)
        _, self.first = np.unique(self.ids, return_index=True)  # where each id begins
        self.repeats = len(self.first) < len(self.ids)
        self.top = int(np.abs(self.v).max(initial=0))
        f = self.v.astype(np.float64)
        self.f = f
        rest = np.zeros((len(f) // DIM_BLOCK + 2, f.shape[1]))
        for b in range(-(-len(f) // DIM_BLOCK) - 1, -1, -1):
            part = f[b * DIM_BLOCK:(b + 1) * DIM_BLOCK]
            rest[b] = rest[b + 1] + (part * part).sum(0)
        self.rest = np.sqrt(rest)  # mass of the dimensions from block b on

    def _exact(self, q: np.ndarray) -> np.ndarray:
        """Scores beyond float64's exact range."""
        score = [sum(int(a) * int(b) for a, b in zip(q, c)) for c in self.v.T]
        return np.array([min(max(s, -1 << 63), (1 << 63) - 1) for s in score], dtype=object)

    def search(self, qid: np.ndarray, q: np.ndarray, k: int):
        """For each query its best ids and scores in this block."""
        dims, n = self.f.shape
        if int(np.abs(q).max(initial=0)) * self.top * max(dims, 1) >= 1 << 52:
            for i, row in zip(qid, q):
                s = self._exact(row)
                yield i, *self._best(i, np.arange(n), s, k)
            return
        qf = q.astype(np.float64)
        blocks = -(-dims // DIM_BLOCK)
        mass = np.zeros((blocks + 1, len(q)))
        for b in range(blocks - 1, -1, -1):
            part = qf[:, b * DIM_BLOCK:(b + 1) * DIM_BLOCK]
            mass[b] = mass[b + 1] + (part * part).sum(1)
        mass = np.sqrt(mass)
        # the first block of dimensions for the whole batch; what is most
        # promising after it gives each query a first bound to beat
        first = qf[:, :DIM_BLOCK] @ self.f[:DIM_BLOCK]
        seeds = min(n, 8 * k)
        for i in range(len(q)):
            part = first[i]
            at = np.arange(n)
            if n > seeds and blocks > 1:
                look = self._promising(part, seeds)
                look = look[self.ids[look] != qid[i]]
                s = part[look] + qf[i, DIM_BLOCK:] @ self.f[DIM_BLOCK:, look]
                low = np.partition(s, len(s) - k)[len(s) - k] if len(s) >= k else -np.inf
                for b in range(1, blocks):
                    # partial sums are exact; only the bound is rounded
                    stay = part + mass[b, i] * self.rest[b, at] * (1 + 1e-9) + 1e-3 >= low
                    if not stay.all():
                        at, part = at[stay], part[stay]
                    part = part + qf[i, b * DIM_BLOCK:(b + 1) * DIM_BLOCK] @ self.f[b * DIM_BLOCK:(b + 1) * DIM_BLOCK, at]
            elif blocks > 1:
                part = part + qf[i, DIM_BLOCK:] @ self.f[DIM_BLOCK:]
            yield qid[i], *self._best(qid[i], at, part, k)

    def _promising(self, part: np.ndarray, n: int) -> np.ndarray:
        """n candidates of different ids with high sums so far."""
        if not self.repeats:
            return np.argpartition(-part, n - 1)[:n]
        most = np.maximum.reduceat(part, self.first)
        some = np.argpartition(-most, min(n, len(most)) - 1)[:n]
        ends = np.append(self.first[1:], len(part))
        return np.array([self.first[g] + int(np.argmax(part[self.first[g]:ends[g]])) for g in some.tolist()], np.int64)

    def _best(self, query, at, score, k):
        own = self.ids[at] != query
        at, score = at[own], score[own]
        ids = self.ids[at]
        if len(score) > 4 * k and not self.repeats:
            low = np.partition(score, len(score) - k)[len(score) - k]
            ids, score = ids[score >= low], score[score >= low]
        order = np.lexsort((ids, -score.astype(np.float64))) if score.dtype != object else \
            np.array(sorted(range(len(ids)), key=lambda j: (-score[j], ids[j])), dtype=np.int64)
        ids, score = ids[order], score[order]
        _, one = np.unique(ids, return_index=True)  # the best of each id
        one = np.sort(one)[:k]
        return ids[one], score[one]


def _scan(batches, k: int):
    """Blocks arrive one after the other, each with its candidates first."""
    now, kept, blocks = None, [], {}
    for batch in batches:
        blk = batch.column("blk").to_numpy()
        for s, e in _pieces(blk):
            part = batch.slice(s, e - s)
            if blk[s] != now:
                now, kept, blocks = blk[s], [], {}
            kind = part.column("kind").to_numpy()
            n = int((kind == 0).sum())
            if n:
                kept.append(part.slice(0, n))
            if n == len(part):
                continue
            if kept:
                blocks = {d: _Block(*a) for d, a in _by_length(pa.Table.from_batches(kept)).items()}
                kept = []
            out = ([], [], [])
            for d, (qid, q) in _by_length(part.slice(n)).items():
                if d not in blocks:
                    continue
                for at in range(0, len(qid), QUERY_BATCH):
                    for i, ids, score in blocks[d].search(qid[at:at + QUERY_BATCH], q[at:at + QUERY_BATCH], k):
                        out[0].extend([int(i)] * len(ids))
                        out[1].extend(ids.tolist())
                        out[2].extend(int(s) for s in score)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["query_id", "vec_id", "score"])


def _pieces(values):
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
    return zip(np.concatenate(([0], cuts)).tolist(), np.append(cuts, len(values)).tolist()) if len(values) else ()


def _by_length(t) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    q = t.column("q")
    q = q.combine_chunks() if isinstance(q, pa.ChunkedArray) else q
    ids, flat = t.column("id").to_numpy(), q.flatten().to_numpy()
    length = np.diff(q.offsets.to_numpy())
    start = np.cumsum(length) - length
    return {int(d): (ids[m], flat[(start[m][:, None] + np.arange(d)).astype(np.int64)].reshape(m.sum(), d))
            for d in np.unique(length) for m in [length == d]}


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each
    query.  Both sides are ``quantized`` frames.  Each block goes to one task
    with a bounded number of candidates; the queries stream past it."""
    spark = vectors.sparkSession
    vectors = freeze(vectors.distinct(), "topk-vectors")
    n = vectors.count()
    blocks = max(1, -(-n // BLOCK_ROWS), min(partitions(spark), -(-n // 1024)))
    cand = vectors.select(F.pmod(F.xxhash64("id", "q"), F.lit(blocks)).cast("int").alias("blk"), F.lit(0).alias("kind"), "id", "q")
    ask = queries.distinct().select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("blk"), F.lit(1).alias("kind"), "id", "q")
    found = (cand.unionByName(ask).repartitionById(blocks, "blk").sortWithinPartitions("blk", "kind", "id")
             .mapInArrow(lambda b: _scan(b, k), "query_id long, vec_id long, score long"))
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


# ---------------------------------------------------------------- query

def op2_exact_topk(spark, sf_dir):
    v = quantized(table(spark, sf_dir, "embeddings"))
    return top_k(v, v.where(F.col("id") % 50 == 0), 5)


OP2_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         max(CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT)) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
  WHERE a.vec_id % 50 = 0
  GROUP BY 1, 2
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rk FROM s
)
SELECT query_id, CAST(rk AS INTEGER) AS rank, vec_id, score FROM r WHERE rk <= 5
"""

QUERIES = {"op2_exact_topk": op2_exact_topk}
SQL = {"op2_exact_topk": OP2_SQL}
