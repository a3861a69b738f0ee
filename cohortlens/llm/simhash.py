"""SimHash near-duplicates by a binary trie self-join.

Fingerprint: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, k-word shingles
with repeats; a bit is 1 if it is set in over half of the shingles' XXH64
values (seed 42).

Join.  Two 64-bit values that differ in at most d bits agree on one of d + 1
blocks of bits, so every distinct fingerprint goes to d + 1 groups, one for
each block's value.  Inside a group the fingerprints form a binary trie that
is joined with itself: pairs of nodes descend together from the first bit on,
add one where their branches differ, and end when the sum exceeds d.  A group
with more rows than a task's fair share is dealt into tiles, and each pair of
tiles is joined in a task of its own.  Tasks return spanning forests, not
pairs, so a group of thousands of near copies yields as many rows as it has
fingerprints.  ``components`` joins the forests.

Defined results
* null, empty and blank texts have the fingerprint 0, linked like any other;
* equal fingerprints are one node: copies cost nothing beyond their row;
* repeated rows stay rows; rows with a null doc_id link like others, and
  component_id is the smallest doc_id that is not null (null if none is);
* an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import drop, freeze, freeze_counted, lean, partitions, ranges, runs, table
from cohortlens.llm.components import components

CHUNK = 1 << 18        # shingles, or rows of groups, that are worked on at a time
STEP = 1 << 15         # of these, or of their pairs, as many as arrays are made for at once
DIRECT = 256           # node pairs of so few leaf pairs are compared leaf by leaf


def _shingle_hashes(text: bytes | None, k: int) -> list[int]:
    words = (text or b"").lower().split()  # bytes: A-Z and ASCII white space only
    if len(words) <= k:
        return [xxhash.xxh64_intdigest(b" ".join(words), 42)] if words else []
    line = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    first, last = (end - size)[:len(words) - k + 1].tolist(), end[k - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(line[a:b], 42) for a, b in zip(first, last)]


def _bits(h: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Fingerprints of documents whose hashes follow one another."""
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    ones = np.zeros((len(full), 64), np.int64)
    start = (np.cumsum(sizes) - sizes)[full]
    # in pieces, so that a very long text needs no more memory than others
    for at in range(0, len(h), STEP):
        part = np.unpackbits(h[at:at + STEP].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        doc = np.searchsorted(start, np.arange(at, at + len(part)), "right") - 1
        at_doc, _ = runs(doc)
        ones[doc[at_doc]] += np.add.reduceat(part, at_doc, axis=0, dtype=np.int32)
    set_ = (2 * ones > sizes[full][:, None]).astype(np.uint8)
    out[full] = np.packbits(set_, axis=1).view(">u8").ravel().astype(np.uint64)
    return out


def _fingerprints(batches, k: int):
    for batch in batches:
        others, texts = batch.drop_columns(["text"]), batch.column("text").cast(pa.binary())
        at = 0
        while at < len(texts):
            hashes, sizes, first = [], [], at
            while at < len(texts) and len(hashes) < CHUNK:
                h = _shingle_hashes(texts[at].as_py(), k)
                hashes += h
                sizes.append(len(h))
                at += 1
            fp = _bits(np.array(hashes, np.uint64), np.array(sizes, np.int64))
            yield pa.RecordBatch.from_arrays([*others.slice(first, at - first).columns, pa.array(fp.view(np.int64))], [*others.schema.names, "fp"])


def text_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def fingerprints(docs: DataFrame, shingle: int = 3, digests: bool = False) -> DataFrame:
    """(doc_id, fp): the fingerprint of every row, as a signed long;
    ``digests``: with ``text_sha``, which tells rows of one doc_id apart."""
    text = F.col("text").cast("string")
    more = [text_digest(text).alias("text_sha")] if digests else []
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), *more, text.alias("text"))
            .mapInArrow(lean(_fingerprints, shingle), f"doc_id long, {'text_sha binary, ' if digests else ''}fp long"))


class _Forest:
    """Union of rows, by the smallest row of each class."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.root[i], self.root[j]
            open_ = a != b
            if not open_.any():
                return
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up


def trie_join(u: np.ndarray, pairs: list[np.ndarray], max_bits: int, found) -> None:
    """Descend node pairs together.  ``u``: values, each node a sorted range;
    ``pairs``: start and end of the first and of the second node.  A node
    paired with itself stands for its pairs of different leaves.  ``found``
    gets the rows of every pair of leaves within ``max_bits``."""
    ones: dict[int, np.ndarray] = {}
    stack = [(63, *pairs, np.zeros(len(pairs[0]), np.int64))]
    while stack:
        bit, alo, ahi, blo, bhi, err = stack.pop()
        if len(alo) > STEP:  # depth first: the open pairs stay few
            half = len(alo) // 2
            stack += [(bit, *(x[half:] for x in (alo, ahi, blo, bhi, err))), (bit, *(x[:half] for x in (alo, ahi, blo, bhi, err)))]
            continue
        small = ((ahi - alo) * (bhi - blo) <= DIRECT) | (bit < 0)
        if small.any():
            _leaves(u, alo[small], ahi[small], blo[small], bhi[small], max_bits, found)
            alo, ahi, blo, bhi, err = (x[~small] for x in (alo, ahi, blo, bhi, err))
        if not len(alo):
            continue
        if bit not in ones:
            ones[bit] = np.concatenate(([0], np.cumsum((u >> np.uint64(bit)) & np.uint64(1)))).astype(np.int64)
        c = ones[bit]
        amid, bmid = ahi - (c[ahi] - c[alo]), bhi - (c[bhi] - c[blo])
        own = (alo == blo) & (ahi == bhi)
        other = ~own
        kids = [(alo, amid, blo, bmid, err), (amid, ahi, bmid, bhi, err), (alo, amid, bmid, bhi, err + 1),
                tuple(x[other] for x in (amid, ahi, blo, bmid, err + 1))]
        joined = [np.concatenate(x) for x in zip(*kids)]
        alo, ahi, blo, bhi, err = joined
        live = (ahi > alo) & (bhi > blo) & (err <= max_bits) & ~((alo == blo) & (ahi == bhi) & (ahi - alo == 1))
        if live.any():
            stack.append((bit - 1, *(x[live] for x in joined)))


def _leaves(u, alo, ahi, blo, bhi, max_bits, found):
    na, nb = ahi - alo, bhi - blo
    size = na * nb
    cuts = np.searchsorted(np.cumsum(size), np.arange(1, int(size.sum()) // (4 * STEP) + 1) * 4 * STEP)
    for s, e in zip(np.concatenate(([0], cuts)), np.append(cuts, len(size))):
        if s == e:
            continue
        k = ranges(np.zeros(e - s, np.int64), size[s:e])
        n = np.repeat(nb[s:e], size[s:e])
        i = np.repeat(alo[s:e], size[s:e]) + k // n
        j = np.repeat(blo[s:e], size[s:e]) + k % n
        near = (np.bitwise_count(u[i] ^ u[j]) <= max_bits) & (i != j)
        found(i[near], j[near])


def _group_forests(batches, max_bits: int):
    """Rows sorted by group, side and value -> edges (a, b) of each group's forest."""
    rest = []

    def edges(t):
        cols = {n: t.column(n).to_numpy() for n in t.schema.names}
        s = cols["s"]
        u = s.view(np.uint64) ^ np.uint64(1 << 63)  # the order of signed values
        same = np.ones(len(s), bool)
        same[0] = False
        for n in ("blk", "val", "x", "y"):
            same[1:] &= cols[n][1:] == cols[n][:-1]
        start = np.flatnonzero(~same)
        end = np.append(start[1:], len(s))
        # a group of two different tiles joins the first with the second
        own = cols["x"][start] == cols["y"][start]
        first = np.concatenate(([0], np.cumsum(cols["side"] == cols["x"])))
        mid = start + first[end] - first[start]
        alo, ahi = start, np.where(own, end, mid)
        blo, bhi = np.where(own, start, mid), end
        live = (ahi > alo) & (bhi > blo) & ~(own & (end - start == 1))
        forest = _Forest(len(s))
        trie_join(u, [x[live] for x in (alo, ahi, blo, bhi)], max_bits, forest.link)
        at = np.flatnonzero(forest.root != np.arange(len(s)))
        return pa.RecordBatch.from_arrays([pa.array(s[at]), pa.array(s[forest.root[at]])], ["a", "b"])

    for batch in batches:
        rest.append(batch)
        if sum(map(len, rest)) < CHUNK:
            continue
        t = pa.Table.from_batches(rest).combine_chunks()
        keys = [t.column(n).to_numpy() for n in ("blk", "val", "x", "y")]
        cut = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0))
        if len(cut):  # all but the last group are whole
            yield edges(t.slice(0, cut[-1] + 1).combine_chunks())
            rest = t.slice(cut[-1] + 1).to_batches()
    if sum(map(len, rest)):
        yield edges(pa.Table.from_batches(rest).combine_chunks())


def near_pairs(values: DataFrame, max_bits: int = 3) -> DataFrame:
    """(a, b): forests that connect what links at ``max_bits`` or fewer
    differing bits.  ``values``: distinct longs in column s."""
    p = partitions(values.sparkSession)
    cuts = [64 * i // (max_bits + 1) for i in range(max_bits + 2)]
    blocks = F.array(*[F.struct(F.lit(i).alias("blk"), F.shiftrightunsigned(F.shiftleft("s", 64 - hi), 64 - hi + lo).alias("val"))
                       for i, (lo, hi) in enumerate(zip(cuts, cuts[1:]))])
    rows = values.select("s", F.explode(blocks).alias("g")).select("s", "g.*")
    sizes, n = freeze_counted(rows.groupBy("blk", "val").agg(F.count(F.lit(1)).alias("n")), "simhash-sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    tile = min(1 << 16, max(512, total // p // 4))
    rows = rows.join(sizes.where(F.col("n") > tile), ["blk", "val"], "left")
    rows = rows.withColumn("tiles", F.coalesce(F.ceil(F.col("n") / tile), F.lit(1)).cast("int"))
    rows = rows.withColumn("side", F.pmod(F.xxhash64("s", "blk"), F.col("tiles")).cast("int"))
    rows = rows.withColumn("z", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    rows = rows.select("blk", "val", F.least("side", "z").alias("x"), F.greatest("side", "z").alias("y"), "side", "s")
    return (rows.repartition(p, "blk", "val", "x", "y").sortWithinPartitions("blk", "val", "x", "y", "side", "s")
            .mapInArrow(lean(_group_forests, max_bits), "a long, b long"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, digests: bool = False) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``; ``digests``: with
    ``text_sha`` and ``root``, a value of each component alone (where a doc_id
    is repeated, or null, components can have the same component_id)."""
    rows = freeze(fingerprints(docs, shingle, digests), "simhash-fp")
    classes = freeze(rows.groupBy("fp").agg(F.min("doc_id").alias("doc")), "simhash-classes")
    edges = components(near_pairs(classes.select(F.col("fp").alias("s")), max_bits))
    named = classes.join(edges.select(F.col("a").alias("fp"), F.col("b").alias("root")), "fp", "left")
    named = named.select("fp", "doc", F.coalesce("root", "fp").alias("root"))
    least = freeze(named.groupBy("root").agg(F.min("doc").alias("component_id")), "simhash-least")
    more = ["root"] if digests else []
    of = freeze(named.join(least, "root").select("fp", *more, "component_id"), "simhash-of")
    for t in (least, edges, classes):
        drop(t)
    return rows.join(of, "fp").select("doc_id", *(["text_sha"] if digests else []), "fp", *more, "component_id")


# ---------------------------------------------------------------- query

def op7_simhash_trie(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


QUERIES = {"op7_simhash_trie": op7_simhash_trie}
SQL: dict[str, str] = {}
