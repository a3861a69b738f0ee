"""Exact repeated passages: fixed-block anchors.

A window of ``w`` words holds a whole block of b = (w + 1) // 2 words of any
division of its document into blocks.  So documents are divided into
non-overlapping blocks of b words, whose keys are the reference index, and
every rolling window of b words probes it (``match``, rule ``shared``).  The
hits are extended: every window of w words around a hit is keyed with 96
bits, and a document that is not the smallest with that key loses the window
(rule ``later``).  Runs of such windows are the maximal exact repeats.

Only keys move, eight bytes a word; texts move once to the hits and once to
the result.  Two passages count as equal when their 96-bit keys are.

Defined results
* words are ``[^\\x20\\x09-\\x0D]+``, unchanged, of the whole text; null or
  empty text: no words;
* a window goes if its words also start in a document with a smaller doc_id;
  windows are judged on the input;
* rows that repeat a doc_id do not shorten each other; a row with a null
  doc_id neither loses nor shortens anything;
* an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import drop, freeze, lean, mix, odd_numbers, ranges, table
from cohortlens.llm.match import MARKED, ROWS, buckets, matched, send

CHUNK_WORDS = 1 << 20
_KEY = np.uint64((1 << 48) - 1)  # a block key: six bytes are enough for candidates
_HALF = np.uint64((1 << 32) - 1)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def window_keys(h: np.ndarray, k: int, seed: int) -> np.ndarray:
    """A key for every k neighbouring word hashes."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    c = odd_numbers(k, seed)
    g = h[:n] * c[0]
    for i in range(1, k):
        g += h[i:i + n] * c[i]
    return mix(g)


def block_keys(h: np.ndarray, b: int) -> np.ndarray:
    return window_keys(h, b, 1) & _KEY


def _documents(batches, *more: str):
    """(doc_id, words, other columns) of each row."""
    for batch in batches:
        text = batch.column("text").cast(pa.binary())
        cols = [batch.column(c) for c in ("doc_id", *more)]
        for i in range(len(batch)):
            yield cols[0][i].as_py(), (text[i].as_py() or b"").split(), *(c[i].as_py() for c in cols[1:])


def _probe(batches, window: int, n: tuple[int, int]):
    b = (window + 1) // 2

    def rows(docs, sizes, words):
        size = np.array(sizes, np.int64)
        start = np.cumsum(size) - size
        at = ranges(start, size - b + 1)
        of = np.repeat(np.arange(len(size)), size - b + 1)
        key = block_keys(word_hashes(words), b)[at]
        flag = ((at - start[of]) % b == 0).astype(np.uint8) * np.uint8(MARKED)
        yield from send("shared", *n, key, np.array(docs, np.int64)[of], short=True, flag=flag)

    docs, sizes, words = [], [], []
    for doc, w in _documents(batches):
        if doc is None or len(w) < window:
            continue
        docs.append(doc)
        sizes.append(len(w))
        words += w
        if len(words) >= CHUNK_WORDS:
            yield from rows(docs, sizes, words)
            docs, sizes, words = [], [], []
    if docs:
        yield from rows(docs, sizes, words)


def _extend(batches, window: int, n: tuple[int, int]):
    b = (window + 1) // 2

    def rows(parts):
        doc = np.concatenate([np.full(len(a), d, np.int64) for d, a, _ in parts])
        yield from send("later", *n, np.concatenate([a for _, a, _ in parts]), doc, key2=np.concatenate([k for _, _, k in parts]))

    parts, size = [], 0
    for doc, words, hits in _documents(batches, "keys"):
        h = word_hashes(words)
        if len(h) < window:
            continue
        hit = np.isin(block_keys(h, b).astype(np.uint32), np.frombuffer(hits, np.uint32))
        seen = np.concatenate(([0], np.cumsum(hit)))
        s = np.arange(len(h) - window + 1)
        s = s[seen[s + window - b + 1] > seen[s]]
        if len(s):
            parts.append((doc, window_keys(h, window, 2)[s], window_keys(h, window, 3)[s] & _HALF))
            size += len(s)
        if size >= CHUNK_WORDS // 2:
            yield from rows(parts)
            parts, size = [], 0
    if parts:
        yield from rows(parts)


def _covered(words: list[bytes], flagged, window: int) -> np.ndarray:
    h = word_hashes(words)
    f = np.frombuffer(flagged, np.uint32).reshape(-1, 3)
    one, two = np.ascontiguousarray(f[:, :2]).view(np.uint64).ravel(), f[:, 2]
    order = np.argsort(one, kind="stable")
    one, two = one[order], two[order]
    x, y = window_keys(h, window, 2), window_keys(h, window, 3) & _HALF
    at = np.minimum(np.searchsorted(one, x), len(one) - 1)
    s = np.flatnonzero((one[at] == x) & (two[at] == y))
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, s, 1)
    np.add.at(edge, s + window, -1)
    return np.cumsum(edge[:-1]) > 0


def _result(batches, window: int):
    out, size = [], 0

    def batch(rows):
        d, n, s, k = zip(*rows)
        spans = pa.array(s, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
        return pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(n, pa.int64()), spans, pa.array(k, pa.string())],
                                          ["doc_id", "n_words", "spans", "kept"])

    for doc, words, flagged in _documents(batches, "keys"):
        spans, kept = [], words
        if flagged and len(words) >= window:
            gone = np.concatenate(([False], _covered(words, flagged, window), [False]))
            edge = np.flatnonzero(gone[1:] != gone[:-1])
            spans = [{"start": s, "end": e} for s, e in edge.reshape(-1, 2).tolist()]
            if spans:
                kept = [w for w, g in zip(words, gone[1:-1].tolist()) if not g]
        text = b" ".join(kept)
        out.append((doc, len(words), spans, text))
        size += len(text)
        if size > 8 << 20 or len(out) >= 4096:
            yield batch(out)
            out, size = [], 0
    if out:
        yield batch(out)


def _with_hits(docs: DataFrame, hits: DataFrame, how: str) -> DataFrame:
    """Texts with their keys; the keys, one row a document, are the side to hash."""
    return docs.join(hits.hint("shuffle_hash"), F.col("doc_id") == F.col("doc"), how).select("doc_id", "text", "keys")


def repeated_passages(docs: DataFrame, window: int = 13) -> DataFrame:
    """(doc_id, n_words, spans, kept) for every row: word spans [start, end)
    that repeat a document with a smaller id, and the other words, joined by
    one space."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n = buckets(docs)
    probes = docs.mapInArrow(lean(_probe, window, n), ROWS)
    hits = freeze(matched(probes, n[1], "shared", short=True).select("doc", "keys"), "passages-hits")
    near = _with_hits(docs, hits, "inner")
    later = freeze(matched(near.mapInArrow(lean(_extend, window, n), ROWS), n[1], "later").select("doc", "keys"), "passages-later")
    drop(hits)
    return _with_hits(docs, later, "left").mapInArrow(
        lean(_result, window), "doc_id long, n_words long, spans array<struct<start:long,end:long>>, kept string")


# ---------------------------------------------------------------- query

def op6_substring_anchors(spark, sf_dir):
    found = repeated_passages(table(spark, sf_dir, "documents"), window=13)
    return found.select("doc_id", "n_words",
                        F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]).alias("n_removed"),
                        F.sha2("kept", 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)
), low AS (
  SELECT k, min(doc_id) AS first_doc FROM win GROUP BY k
), gone AS (
  SELECT DISTINCT doc_id, p FROM (
    SELECT doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN low USING (k) WHERE first_doc < doc_id)
), word AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
  FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

QUERIES = {"op6_substring_anchors": op6_substring_anchors}
SQL = {"op6_substring_anchors": OP6_SQL}
