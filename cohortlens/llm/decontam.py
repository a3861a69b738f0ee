"""Benchmark decontamination: BM25 over test items with block-max WAND.

Items are cut into units of at most 64 words; units are the indexed texts.
Every passage of every document (128 words, a new one each 64, so a whole
unit lies in some passage) is a query of its distinct words.  A unit's score
is its BM25 share, sum of the shared words' weights over the sum of all its
words' weights, and all units that reach the threshold are retrieved.

Pruning has two steps with the same block maxima: for all passages of a chunk
at once, the sum of each block's maxima tells which blocks can hold a hit;
what is left is searched by block-max WAND, document at a time.

A retrieved item is verified against the whole document: at least ``overlap``
of the five-word shingles of its question, and of its answer (its last
sentence, if it has more than one; fewer than five words: the whole
sequence), must occur there.

The index lies in shards of about ``max_units`` units, of whole items: items are
dealt by row, each shard is built by a task and written to the shared folder, and
the documents are read once, each chunk of them going past one shard after the
other.  So neither the driver nor a task holds more of the index than the few
shards that a worker keeps; an item must fit a task.  Word statistics are those
of all units.

Defined results
* words are lower-cased runs of letters and digits; a document or item
  without words matches nothing; very long texts are whole;
* repeated items with one id: the best score counts; a null item_id is an id;
* repeated documents stay rows; empty tables give empty results; other
  columns are ignored, and kept by ``decontaminated``.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import freeze, freeze_counted, get_file, lean, put_file, ranges, runs, shared_folder, table
from cohortlens.llm.substring import window_keys, word_hashes

UNIT, PASSAGE = 64, 128
K1, B = 1.2, 0.75
THRESHOLD, OVERLAP, SHINGLE = 0.6, 0.8, 5
MAX_UNITS = 2048
CHUNK_WORDS = 1 << 18
SHARDS_KEPT = 8
_word = re.compile(r"[^\W_]+").findall
_sentence = re.compile(r"(?<=[.?!])\s+|\n+")


def words_of(text: str | None) -> list[str]:
    return _word(text.lower()) if text else []


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    parts = [p for p in map(words_of, _sentence.split(text)) if p]
    return ([w for p in parts[:-1] for w in p], parts[-1]) if len(parts) > 1 else (parts[0] if parts else [], [])


def shingle_keys(words: list[str], k: int) -> np.ndarray:
    return window_keys(word_hashes([w.encode() for w in words]), k, 5)


class Index:
    """Postings of one shard, in unit order, and their maxima by block."""

    def __init__(self, units: list[tuple], df: dict[str, int], n: int, mean: float):
        """units: (item_id, words of the unit, text of its item)."""
        self.items = [u[0] for u in units]
        self.vocabulary: dict[str, int] = {}
        post: list[list[tuple[int, float]]] = []
        for u, (_, words, _) in enumerate(units):
            tf: dict[str, int] = {}
            for w in words:
                tf[w] = tf.get(w, 0) + 1
            weight = {w: math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * c * (K1 + 1) / (c + K1 * (1 - B + B * len(words) / mean)) for w, c in tf.items()}
            whole = sum(weight.values())
            for w, x in weight.items():
                t = self.vocabulary.setdefault(w, len(post))
                if t == len(post):
                    post.append([])
                post[t].append((u, x / whole))
        self.size = max(4, -(-len(units) // 64))  # units of a block
        blocks = -(-len(units) // self.size)
        self.units = [[u for u, _ in p] for p in post]
        self.weights = [[x for _, x in p] for p in post]
        self.block_max = np.zeros((len(post) + 1, blocks), np.float32)  # the last row: words of no item
        for t, p in enumerate(post):
            for u, x in p:
                b = u // self.size
                # rounded up, so that the sum of maxima stays a bound
                self.block_max[t, b] = max(self.block_max[t, b], np.nextafter(np.float32(x), np.float32(2)))
        self.list_max = [max(w) for w in self.weights]
        self.checks = []
        for _, _, text in units:
            parts = []
            for words in question_and_answer(text):
                k = min(SHINGLE, len(words))
                parts.append((k, np.unique(shingle_keys(words, k))) if k else None)
            self.checks.append(parts)

    def search(self, terms: list[int], threshold: float):
        """(unit, score) of every unit that reaches the threshold: WAND with
        block maxima.  A cursor is [unit, place, term]."""
        cursors = [[self.units[t][0], 0, t] for t in terms]
        low = threshold - 1e-9
        found = []

        def advance(c, unit):
            units = self.units[c[2]]
            at = c[1]
            while at < len(units) and units[at] < unit:
                at += 1
            c[1] = at
            c[0] = units[at] if at < len(units) else len(self.items)

        while cursors:
            cursors.sort()
            bound, pivot = 0.0, None
            for p, c in enumerate(cursors):
                bound += self.list_max[c[2]]
                if bound >= low:
                    pivot = p
                    break
            if pivot is None or cursors[pivot][0] >= len(self.items):
                break
            unit = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == unit:
                pivot += 1
            block = unit // self.size
            if sum(float(self.block_max[c[2], block]) for c in cursors[:pivot + 1]) < low:
                # no unit up to the block's end or the next list's unit
                upto = min((block + 1) * self.size, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else len(self.items))
                for c in cursors[:pivot + 1]:
                    advance(c, max(upto, unit + 1))
            elif cursors[0][0] == unit:
                score = sum(self.weights[c[2]][c[1]] for c in cursors[:pivot + 1])
                if score >= low:
                    found.append((unit, min(score, 1.0)))
                for c in cursors[:pivot + 1]:
                    advance(c, unit + 1)
            else:
                for c in cursors[:pivot]:
                    advance(c, unit)
            cursors = [c for c in cursors if c[0] < len(self.items)]
        return found

    def retrieve(self, docs: list[list[str]], threshold: float) -> list[dict[int, float]]:
        """For each document the units that some passage retrieves, with the best score."""
        out: list[dict[int, float]] = [{} for _ in docs]
        none = len(self.list_max)
        get = self.vocabulary.get
        term = np.array([get(w, none) for d in docs for w in d], np.int64)
        size = np.array([len(d) for d in docs], np.int64)
        # half passages: each one's distinct words, then sums of block maxima
        halves = -(-size // UNIT)
        first = np.cumsum(halves) - halves
        n = int(halves.sum())
        word = ranges(np.zeros(len(size), np.int64), size)
        half = np.repeat(first, size) + word // UNIT
        known = term < none
        pair = np.unique(half[known] * (none + 1) + term[known])
        if not len(pair):
            return out
        of, t = pair // (none + 1), pair % (none + 1)
        at, _ = runs(of)
        sums = np.zeros((n + 1, self.block_max.shape[1]), np.float32)
        sums[of[at]] = np.add.reduceat(self.block_max[t], at, axis=0)
        last = np.zeros(n + 1, bool)
        last[first[size > 0] + halves[size > 0] - 1] = True
        sums[:-1] += np.where(last[:-1, None], 0, sums[1:])  # a half and the next
        alone = np.zeros(n, bool)  # the last half is in the passage before it
        alone[np.flatnonzero(last[:-1])] = True
        alone[first[(size > 0) & (halves == 1)]] = False
        open_ = np.flatnonzero((sums[:-1].max(1) >= threshold - 1e-4) & ~alone)
        bounds = np.searchsorted(of, np.arange(n + 2))
        doc = np.searchsorted(first + halves, open_, "right")
        for h, d in zip(open_.tolist(), doc.tolist()):
            terms = np.unique(t[bounds[h]:bounds[h + 1] if last[h] else bounds[h + 2]])
            bound = self.block_max[terms].sum(0)
            if bound.max() < threshold - 1e-4:
                continue
            for unit, score in self.search(terms.tolist(), threshold):
                out[d][unit] = max(out[d].get(unit, 0.0), score)
        return out

    def verified(self, words: list[str], units: dict[int, float], overlap: float) -> list[tuple]:
        """(item_id, score, question overlap, answer overlap) of what the document holds."""
        best: dict = {}
        hashes = word_hashes([w.encode() for w in words])
        keys: dict[int, np.ndarray] = {}
        for unit, score in units.items():
            shares = []
            for part in self.checks[unit]:
                if part is None:
                    shares.append(None)
                    continue
                k, want = part
                if k not in keys:
                    keys[k] = window_keys(hashes, k, 5)
                shares.append(float(np.isin(want, keys[k]).mean()))
            if all(s is None or s >= overlap for s in shares):
                row = (self.items[unit], score, *shares)
                if row[0] not in best or score > best[row[0]][1]:
                    best[row[0]] = row
        return list(best.values())


def _units(batches):
    for batch in batches:
        out = []
        for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist()):
            words = words_of(text)
            out += [(row, i, words[i:i + UNIT]) for i in range(0, len(words), UNIT)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, ty) for c, ty in zip(zip(*out), (pa.int64(), pa.int32(), pa.list_(pa.string())))], ["row", "part", "words"])


def _build(batches, folder: str, n: int, mean: float):
    """One shard from all rows of a partition: (item_id, text, units)."""
    rows = [r for b in batches for r in b.to_pylist()]
    if not rows:
        return
    rows.sort(key=lambda r: (r["item_id"] is not None, r["item_id"] or 0, r["text"]))
    df, units = {}, []
    for r in rows:
        for u in sorted(r["units"], key=lambda u: u["part"]):
            df.update((w["w"], w["df"]) for w in u["words"])
            units.append((r["item_id"], [w["w"] for w in sorted(u["words"], key=lambda w: w["at"])], r["text"]))
    name = f"shard-{TaskContext.get().partitionId():06d}"
    put_file(folder, name, pickle.dumps(Index(units, df, n, mean)))
    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(units)])], ["name", "n_units"])


def shards(benchmark: DataFrame, max_units: int = MAX_UNITS) -> tuple[str, list[str]]:
    """Builds the index of the benchmark: its folder, and its shards' names."""
    spark = benchmark.sparkSession
    bench = benchmark.select(F.monotonically_increasing_id().alias("row"), F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    bench = freeze(bench.where("text IS NOT NULL"), "bm25-items")
    units, n = freeze_counted(bench.mapInArrow(_units, "row long, part int, words array<string>"), "bm25-units")
    folder = shared_folder(spark, "bm25")
    if not n:
        return folder, []
    mean = units.agg(F.avg(F.size("words"))).first()[0]
    df = freeze(units.select(F.explode(F.array_distinct("words")).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("df")), "bm25-df")
    counted = units.select("row", "part", F.posexplode("words").alias("at", "w")).join(df, "w")
    counted = counted.groupBy("row", "part").agg(F.collect_list(F.struct("at", "w", "df")).alias("words"))
    whole = counted.groupBy("row").agg(F.collect_list(F.struct("part", "words")).alias("units")).join(bench, "row")
    count = -(-n // max_units)
    dealt = whole.select(F.pmod(F.xxhash64("row"), F.lit(count)).cast("int").alias("deal"), "item_id", "text", "units").repartitionById(count, "deal")
    made = freeze(dealt.mapInArrow(lambda b: _build(b, folder, n, mean), "name string, n_units long"), "bm25-shards")
    return folder, sorted(r.name for r in made.select("name").collect())


_kept: OrderedDict[tuple[str, str], Index] = OrderedDict()


def _shard(folder: str, name: str) -> Index:
    """A shard, of which a worker keeps the last few."""
    if (folder, name) in _kept:
        _kept.move_to_end((folder, name))
    else:
        _kept[folder, name] = pickle.loads(get_file(folder, name))
        while len(_kept) > SHARDS_KEPT:
            _kept.popitem(last=False)
    return _kept[folder, name]


def _matches(batches, folder: str, names: list[str], threshold: float, overlap: float):
    """(batch, row numbers, their matches), some rows at a time, past all shards."""
    for batch in batches:
        texts = batch.column("text")
        at = 0
        while at < len(batch):
            docs, size, first = [], 0, at
            while at < len(batch) and size < CHUNK_WORDS:
                docs.append(words_of(texts[at].as_py()))
                size += len(docs[-1])
                at += 1
            best: list[dict] = [{} for _ in docs]
            for name in names:
                index = _shard(folder, name)
                for d, (words, units) in enumerate(zip(docs, index.retrieve(docs, threshold))):
                    for m in index.verified(words, units, overlap) if units else ():
                        if m[0] not in best[d] or m[1] > best[d][m[0]][1]:
                            best[d][m[0]] = m
            yield batch.slice(first, at - first), [list(b.values()) for b in best]


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP, max_units: int = MAX_UNITS) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap): a row for
    every item that a document holds."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
    folder, names = shards(benchmark, max_units)

    def rows(batches):
        for batch, found in _matches(batches, folder, names, threshold, overlap):
            flat = [(d, *m) for d, ms in zip(batch.column("doc_id").to_pylist(), found) for m in ms]
            if flat:
                yield pa.RecordBatch.from_arrays([pa.array(c, ty) for c, ty in zip(zip(*flat), types)], [x.split()[0] for x in schema.split(", ")])

    return docs.mapInArrow(lean(rows), schema)


def decontaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP, max_units: int = MAX_UNITS) -> DataFrame:
    """``docs`` without the rows that hold an item; columns as they are."""
    folder, names = shards(benchmark, max_units)

    def rows(batches):
        for batch, found in _matches(batches, folder, names, threshold, overlap):
            yield batch.filter(pa.array([not f for f in found], pa.bool_()))

    return docs.mapInArrow(lean(rows), docs.schema)


# ---------------------------------------------------------------- query

def op1_decontamination(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op1_decontamination": op1_decontamination}
SQL: dict[str, str] = {}
