"""Ranked lexical search over a length-stratified inverted index.

Score of a document for an item: the sum, over the item's terms with repeats,
of ``weight * impact``; ``weight = floor(1000 ln((2 N + 2) / (2 df + 1)))``,
``impact = 10**9 tf div (1000 tf + 12 m)`` and the document's normaliser
``m = 75 + 25 n N div L`` (n terms in it, L in all N documents that have any).

``index`` cuts the documents into segments of a bounded number of characters.
A segment numbers its documents by (m, row), so that documents of equal m, a
stratum, lie together, and holds a row for each term: the postings of one
stratum after the other, inside it by tf, the highest first.  It is an
ordinary table: rows with a term are postings (``docs``, ``tfs``), the row
without one lists the segment's documents (``ids``) and their normalisers
(``tfs``).

``search`` joins the items' terms with the index, so only the postings of
asked terms move, and scores one segment after the other in a task.  The first
tf of a term in a stratum bounds its impact there; an item's strata are
visited in falling order of their summed bounds until the bound is below the
item's k-th best score so far, which goes on from segment to segment.  An
impact is computed once for each tf of a stratum and term, and shared by the
documents that follow.  A task sends its k best for each item.

Items go in blocks of at most about ``block_terms`` terms, a pass for each, so
what a task is sent does not grow with the number of items.

Defined results
* every row of ``docs`` is a document of its own; null or empty texts hold no
  term and are never found; very long texts are whole; null doc_ids rank after
  others of equal score;
* rows of one item_id (null is one) are one item: equal rows count once, the
  terms of different texts add up; items without terms, or with none that the
  documents hold, find nothing;
* only documents with a score above 0 are found: a term that every document
  holds may weigh 0;
* empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import freeze, lean, partitions, ranges, runs, table

#: Byte for byte: separators become spaces, A-Z a-z; bytes of other characters stay.
_FOLD = bytes(b if b > 127 else (ord(chr(b).lower()) if chr(b).isalnum() else 32) for b in range(256))
_IN_TERM = np.frombuffer(_FOLD, np.uint8) != 32
SEGMENT_BYTES = 12 << 20
SLICE_BYTES = 1 << 20
BLOCK_TERMS = 1 << 16
_INDEX = "segment long, term binary, docs array<int>, tfs array<int>, ids array<long>"


# ---------------------------------------------------------------- index

def terms_of(texts: pa.Array) -> pa.ListArray:
    """Lists of the terms (binary) of each text (binary, no nulls)."""
    size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    raw = b"".join(texts.to_pylist()).translate(_FOLD)
    ends = np.concatenate(([0], np.cumsum(size)))
    folded = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(ends), pa.py_buffer(raw))
    lists = pc.ascii_split_whitespace(folded)
    words, of = lists.flatten(), pc.list_parent_indices(lists)
    full = pc.greater(pc.binary_length(words), 0)  # not what stands before a first space or behind a last one
    return words.filter(full), of.filter(full).to_numpy().astype(np.int64)


def _counts(batches):
    """One row for each task: documents with a term, and their terms."""
    docs = terms = 0
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for at in range(0, len(batch), 64):
            some = texts.slice(at, 64).to_pylist()
            # a space before each text: terms begin where a separator ends
            inside = _IN_TERM[np.frombuffer(b" " + b" ".join(some), np.uint8)]
            begins = np.flatnonzero(inside[1:] & ~inside[:-1])
            first = np.cumsum([0, *[len(t) + 1 for t in some]])
            n = np.diff(np.searchsorted(begins, first))
            docs, terms = docs + int((n > 0).sum()), terms + int(n.sum())
    yield pa.RecordBatch.from_arrays([pa.array([docs]), pa.array([terms])], ["docs", "terms"])


def normaliser(n: np.ndarray, total_docs: int, total_terms: int) -> np.ndarray:
    return np.array([75 + 25 * x * total_docs // total_terms for x in n.tolist()], np.int64)


def impact(tf, m):
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def _slices(texts: list[bytes]):
    """Lists of texts of about ``SLICE_BYTES``; a longer text is one of its own."""
    some, size = [], 0
    for text in texts:
        some.append(text)
        size += len(text) + 64
        if size >= SLICE_BYTES:
            yield some
            some, size = [], 0
    if some:
        yield some


def _postings(texts: list[bytes]):
    """(terms of each text, vocabulary, term, text, tf).  Texts are cut into
    terms a slice at a time, and only the counts of a slice are kept: every
    term as it stands takes some 20 times the bytes of its text."""
    n, names, term, doc, tfs = [], [], [], [], []
    texts_before = names_before = 0
    for some in _slices(texts):
        words, of = terms_of(pa.array(some, pa.binary()))
        n.append(np.bincount(of, minlength=len(some)))
        coded = words.dictionary_encode()
        pair, tf = np.unique(coded.indices.to_numpy().astype(np.int64) * len(some) + of, return_counts=True)
        term.append((pair // len(some) + names_before).astype(np.int32))
        doc.append((pair % len(some) + texts_before).astype(np.int32))
        tfs.append(tf.astype(np.int32))
        names.append(coded.dictionary.cast(pa.large_binary()))
        texts_before, names_before = texts_before + len(some), names_before + len(names[-1])
    coded = pa.concat_arrays(names).dictionary_encode()
    return np.concatenate(n), coded.dictionary, coded.indices.to_numpy()[np.concatenate(term)], np.concatenate(doc), np.concatenate(tfs)


def _segment(ids: list, texts: list[bytes], number: int, total_docs: int, total_terms: int):
    n, vocabulary, term, doc, tf = _postings(texts)
    texts.clear()
    m = normaliser(n, total_docs, total_terms)
    order = np.lexsort((np.arange(len(n)), m))
    order = order[n[order] > 0]
    if not len(order):
        return
    place = np.zeros(len(n), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    m = m[order]
    doc = place[doc]
    by = np.lexsort((doc, -tf, m[doc], term))
    term, doc, tf = term[by], doc[by], tf[by]
    del by
    first, size = runs(term)
    columns = ["segment", "term", "docs", "tfs", "ids"]
    yield pa.RecordBatch.from_arrays(
        [pa.array([number]), pa.array([None], pa.binary()), pa.array([None], pa.list_(pa.int32())), pa.array([m.tolist()], pa.list_(pa.int32())),
         pa.array([[ids[i] for i in order.tolist()]], pa.list_(pa.int64()))], columns)
    for s in range(0, len(first), 8192):
        f, z = first[s:s + 8192], size[s:s + 8192]
        offsets = pa.array(np.concatenate(([0], np.cumsum(z))), pa.int32())
        part = slice(int(f[0]), int(f[-1] + z[-1]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(f), number)), vocabulary.take(pa.array(term[f])).cast(pa.binary()),
             pa.ListArray.from_arrays(offsets, pa.array(doc[part], pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(tf[part], pa.int32())),
             pa.nulls(len(f), pa.list_(pa.int64()))], columns)


def _segments(batches, total_docs: int, total_terms: int, segment_bytes: int):
    number, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0
    for batch in batches:
        for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary())):
            ids.append(i)
            texts.append(text.as_py())
            size += len(texts[-1]) + 64
            if size >= segment_bytes:
                yield from _segment(ids, texts, number, total_docs, total_terms)
                number, ids, texts, size = number + 1, [], [], 0
    if ids:
        yield from _segment(ids, texts, number, total_docs, total_terms)


def index(docs: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> tuple[DataFrame, int]:
    """The index of ``docs``, written to the shared folder, and the number of
    documents in it."""
    rows = (docs.where(F.col("text").isNotNull())
            .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    total = rows.select("text").mapInArrow(lean(_counts), "docs long, terms long").agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms")).first()
    if not total.docs:
        return rows.sparkSession.createDataFrame([], _INDEX), 0
    made = rows.mapInArrow(lean(_segments, total.docs, total.terms, segment_bytes), _INDEX)
    return freeze(made, "ranked-index"), total.docs


# ---------------------------------------------------------------- items

def _item_terms(batches):
    for batch in batches:
        texts = batch.column("text")
        words, of = terms_of(texts.cast(pa.binary()))
        ids = batch.column("item_id").take(pa.array(of))
        yield pa.RecordBatch.from_arrays([ids, words.cast(pa.binary())], ["item_id", "term"])


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, times) of the items."""
    rows = (items.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct())
    return rows.mapInArrow(_item_terms, "item_id long, term binary").groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("times"))


# ---------------------------------------------------------------- search

class _Best:
    """The k best (score, doc_id, null mark) of each item in a task."""

    def __init__(self, k: int, items: int):
        self.k = k
        self.score = [np.zeros(0, np.int64) for _ in range(items)]
        self.ids = [np.zeros(0, np.int64) for _ in range(items)]
        self.null = [np.zeros(0, bool) for _ in range(items)]

    def least(self, item: int) -> int:
        """What a further document must reach."""
        s = self.score[item]
        return int(s[-1]) if len(s) == self.k else 1

    def add(self, item: int, score, ids, null) -> None:
        score, ids, null = (np.concatenate(x) for x in ((self.score[item], score), (self.ids[item], ids), (self.null[item], null)))
        order = np.lexsort((ids, null, -score))[:self.k]
        self.score[item], self.ids[item], self.null[item] = score[order], ids[order], null[order]


class Segment:
    """The asked postings of a segment, cut by stratum."""

    def __init__(self, m: np.ndarray, terms: list[int], docs: list[np.ndarray], tfs: list[np.ndarray]):
        start, _ = runs(m)
        self.row = {t: i for i, t in enumerate(terms)}
        size = np.array([len(d) for d in docs], np.int64)
        self.docs = np.concatenate(docs).astype(np.int64)
        tf = np.concatenate(tfs).astype(np.int64)
        stratum = np.searchsorted(start, self.docs, "right") - 1
        term = np.repeat(np.arange(len(docs)), size)
        # one impact for each run of (term, stratum, tf)
        new = np.ones(len(tf), bool)
        new[1:] = (term[1:] != term[:-1]) | (stratum[1:] != stratum[:-1]) | (tf[1:] != tf[:-1])
        at = np.flatnonzero(new)
        once = impact(tf[at], m[self.docs[at]])
        self.impact = np.repeat(once, np.diff(np.append(at, len(tf))))
        # cells: the postings of a term in a stratum; the first has the bound
        new = np.ones(len(tf), bool)
        new[1:] = (term[1:] != term[:-1]) | (stratum[1:] != stratum[:-1])
        self.cell = np.flatnonzero(new)
        self.cell_size = np.diff(np.append(self.cell, len(tf)))
        self.cell_stratum = stratum[self.cell]
        self.cell_bound = self.impact[self.cell]
        self.of_term = np.searchsorted(term[self.cell], np.arange(len(docs) + 1))
        self.strata, self.n_docs = len(start), len(m)
        self.visited = 0

    def search(self, asked: list[tuple[int, int]], least):
        """Yields (documents, scores) of some strata after others; ``least()``
        is the score to reach at that time.  asked: (term, weight)."""
        asked = [(self.row[t], w) for t, w in asked if t in self.row]
        if not asked:
            return
        rows, weights = np.array(asked, np.int64).T
        first, last = self.of_term[rows], self.of_term[rows + 1]
        cells, weight = ranges(first, last - first), np.repeat(weights, last - first)
        bound = np.zeros(self.strata, np.int64)
        np.add.at(bound, self.cell_stratum[cells], weight * self.cell_bound[cells])
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        rank = np.full(self.strata, len(order))
        rank[order] = np.arange(len(order))
        by = np.argsort(rank[self.cell_stratum[cells]], kind="stable")
        cells, weight = cells[by], weight[by]
        cell_rank = rank[self.cell_stratum[cells]]
        at, some = 0, 2
        while at < len(order):
            upto = min(at + some, len(order))
            # bounds fall: the strata that can still matter
            upto = at + int(np.searchsorted(-bound[order[at:upto]], -least(), "right"))
            if upto == at:
                return
            lo, hi = np.searchsorted(cell_rank, (at, upto))
            c = cells[lo:hi]
            p = ranges(self.cell[c], self.cell_size[c])
            doc, part = self.docs[p], np.repeat(weight[lo:hi], self.cell_size[c]) * self.impact[p]
            by = np.argsort(doc, kind="stable")
            doc, part = doc[by], part[by]
            start, _ = runs(doc)
            self.visited += upto - at
            yield doc[start], np.add.reduceat(part, start)
            at, some = upto, some * 2


def _asked_segments(batches):
    """(normalisers, doc ids, terms, docs, tfs) of one segment after the other;
    rows come sorted by segment, its documents first."""
    now = None
    for batch in batches:
        segment, term = batch.column("segment").to_pylist(), batch.column("term").to_pylist()
        docs, tfs, ids = batch.column("docs"), batch.column("tfs"), batch.column("ids")
        for i, (s, t) in enumerate(zip(segment, term)):
            if t is None:
                if now is not None and now[1]:
                    yield now
                own = ids[i].values
                now = ((tfs[i].values.to_numpy().astype(np.int64), pc.fill_null(own, 0).to_numpy(), own.is_null().to_numpy(zero_copy_only=False)), [], [], [])
            else:
                now[1].append(t)
                now[2].append(docs[i].values.to_numpy())
                now[3].append(tfs[i].values.to_numpy())
    if now is not None and now[1]:
        yield now


def _search(batches, asked: dict, k: int):
    """asked: item -> [(term, weight)]."""
    items = sorted(asked, key=lambda i: (i is None, i))
    best = _Best(k, len(items))
    for (m, ids, null), terms, docs, tfs in _asked_segments(batches):
        seg = Segment(m, terms, docs, tfs)
        for n, item in enumerate(items):
            for doc, score in seg.search(asked[item], lambda n=n: best.least(n)):
                good = score >= best.least(n)
                if good.any():
                    best.add(n, score[good], ids[doc[good]], null[doc[good]])
    for n, item in enumerate(items):
        size = len(best.score[n])
        if size:
            yield pa.RecordBatch.from_arrays([pa.array([item] * size, pa.int64()), pa.array(best.ids[n], pa.int64(), mask=best.null[n]), pa.array(best.score[n])],
                                             ["item_id", "doc_id", "score"])


def search(made: DataFrame, total_docs: int, items: DataFrame, k: int = 20, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item."""
    spark = made.sparkSession
    schema = "item_id long, doc_id long, score long"
    asked = freeze(item_terms(items), "ranked-asked")
    # only the postings of asked terms, and the segments' documents
    words = freeze(asked.select(F.col("term").alias("__term")).distinct(), "ranked-words")
    hits = freeze(made.where("term IS NOT NULL").join(words, F.col("term") == F.col("__term"), "left_semi"), "ranked-hits")
    df = hits.groupBy("term").agg(F.sum(F.size("docs")).cast("long").alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log((2 * F.lit(total_docs) + 2).cast("double") / (2 * F.col("df") + 1)))
    weighted = freeze(asked.join(df, "term").select("item_id", "term", (weight * F.col("times")).alias("weight")), "ranked-weights")
    found, n = None, weighted.count()
    blocks = max(1, -(-n // block_terms))
    rows = made.where("term IS NULL").unionByName(hits)
    dealt = rows.repartition(partitions(spark), "segment").sortWithinPartitions("segment", F.col("term").asc_nulls_first())
    if n and blocks > 1:
        dealt = freeze(dealt, "ranked-dealt")
    for b in range(blocks if n else 0):
        own: dict = {}
        for r in weighted.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect():
            own.setdefault(r.item_id, []).append((bytes(r.term), r.weight))
        shared = spark.sparkContext.broadcast(own)

        def best(batches, shared=shared):
            yield from _search(batches, shared.value, k)

        part = dealt.mapInArrow(lean(best), schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], schema)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


# ---------------------------------------------------------------- query

def op11_ranked_search(spark, sf_dir):
    made, n = index(table(spark, sf_dir, "documents"))
    return search(made, n, table(spark, sf_dir, "benchmark"), 20)


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents WHERE text IS NOT NULL
), f AS (SELECT * FROM d WHERE len(ts) > 0),
s AS (SELECT count(*) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_terms FROM f),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM f) GROUP BY 1, 2),
q AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)) GROUP BY 1, 2
), w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM p GROUP BY 1), s
), x AS (
  SELECT item_id, f.doc_id, p.r,
         CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(f.ts) * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM q JOIN p USING (term) JOIN w USING (term) JOIN f ON f.r = p.r, s
  GROUP BY item_id, f.doc_id, p.r
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rk FROM x WHERE score > 0
)
SELECT item_id, CAST(rk AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rk <= 20
"""

QUERIES = {"op11_ranked_search": op11_ranked_search}
SQL = {"op11_ranked_search": OP11_SQL}
