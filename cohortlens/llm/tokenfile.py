"""Token-id files: patched frame-of-reference blocks.

Texts are range-partitioned and sorted by doc_id (and by more where many rows
share one, so that a hot id is split), encoded, and written by
each task as shards of a bounded number of ids.  A shard's ids are cut into
blocks of 1,024.  Of each block the minimum is subtracted; the rest is packed
at the width that 90 % of the values need; the others keep their low bits
there and stand whole in the block's exception list.  An index of block starts
lets ``read_ids`` unpack only the blocks it needs.

Shard layout (little-endian)
    magic 8 bytes | documents u64, ids u64, blocks u64
    doc ids i64[documents] | null marks u8[documents] | lengths u64[documents]
    minima u32[blocks] | widths u8[blocks] | exceptions u16[blocks]
    block starts u64[blocks + 1], from the data's start
    data: of each block 16 * width packed u64, positions u16[exceptions], values u32[exceptions]

A task writes under a name of its own attempt and renames the whole file, so
a task that runs again, or twice, leaves the same shard.  Names sort in
ascending order of documents.

The text is cut at ASCII white space, a chunk's words are numbered with Arrow's
dictionaries, and a word that a worker does not remember is encoded once; that equals encoding the whole text for vocabularies whose
pre-tokenizer drops white space (checked when the vocabulary is loaded).

Defined results
* null text: empty, which is the end id alone; null doc_id sorts first;
* repeated doc_ids stay rows, in order of their texts' first 24 characters
  (null first), then of their hashes;
* an empty table gives no file and an empty result; other columns are ignored;
* the folder must be one that ``pyarrow.fs`` opens and all executors share.
"""

from __future__ import annotations

import os
import zlib
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import freeze, partitions, put_file, ranges, shared_folder, table

MAGIC = b"PFORids1"
BLOCK = 1024
PACKED = 512             # blocks that are packed together
SHARD_IDS = 8 << 20
PERCENT = 90
WORDS_KEPT = 1_500_000  # distinct words whose ids a worker remembers, besides a chunk's own
CHUNK_BYTES = 4 << 20
_first = itemgetter(0)

# ---------------------------------------------------------------- blocks


def _lanes(width: int):
    """For each of 64 values: its word, its shift, and whether it goes on."""
    for i in range(64):
        word, shift = divmod(i * width, 64)
        yield i, word, np.uint64(shift), shift + width > 64


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """(m, BLOCK) values below 2**width -> (m, 16 * width) words."""
    v = values.astype(np.uint64).reshape(-1, 64).T.copy()
    out = np.zeros((width, v.shape[1]), np.uint64)
    for i, word, shift, on in _lanes(width):
        if width:
            out[word] |= v[i] << shift
        if on:
            out[word + 1] |= v[i] >> (np.uint64(64) - shift)
    return np.ascontiguousarray(out.T).reshape(len(values), -1)


def unpack(words: np.ndarray, width: int) -> np.ndarray:
    m = len(words)
    if not width:
        return np.zeros((m, BLOCK), np.uint64)
    w = words.reshape(-1, width).T.copy()
    out = np.empty((64, w.shape[1]), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for i, word, shift, on in _lanes(width):
        x = w[word] >> shift
        if on:
            x = x | (w[word + 1] << (np.uint64(64) - shift))
        out[i] = x & mask
    return np.ascontiguousarray(out.T).reshape(m, BLOCK)


def encode_shard(doc_ids: list, lengths: list[int], ids: np.ndarray) -> bytes:
    n = len(ids)
    blocks = -(-n // BLOCK)
    v = np.zeros(blocks * BLOCK, np.uint32)
    v[:n] = ids
    if n < len(v):
        v[n:] = ids[-(n % BLOCK):].min()  # filled up with the block's minimum
    v = v.reshape(blocks, BLOCK)
    low = v.min(1, initial=0) if not blocks else v.min(1)
    d = v - low[:, None]
    most = np.partition(d, BLOCK * PERCENT // 100 - 1, axis=1)[:, BLOCK * PERCENT // 100 - 1] if blocks else low
    width = np.zeros(blocks, np.uint8)
    for b in range(32):
        width += (most >> np.uint32(b)) > 0
    out = d >= (np.uint64(1) << width.astype(np.uint64))[:, None]
    n_out = out.sum(1)
    packed: list[bytes] = [b""] * blocks
    for w in np.unique(width):
        same = np.flatnonzero(width == w)
        for at in (same[s:s + PACKED] for s in range(0, len(same), PACKED)):
            rows = pack(d[at] & np.uint32((1 << int(w)) - 1), int(w))
            for i, r in zip(at.tolist(), rows):
                packed[i] = r.tobytes()
    row, pos = np.nonzero(out)
    pos, val = pos.astype("<u2"), v[out].astype("<u4")
    end = np.cumsum(n_out)
    data = [x for i, (s, e) in enumerate(zip((end - n_out).tolist(), end.tolist()))
            for x in (packed[i], pos[s:e].tobytes(), val[s:e].tobytes())]
    starts = np.concatenate(([0], np.cumsum(width.astype(np.int64) * 128 + n_out * 6)))
    return b"".join([MAGIC, np.array([len(doc_ids), n, blocks], "<u8").tobytes(),
                     np.array([0 if x is None else x for x in doc_ids], "<i8").tobytes(),
                     np.array([x is None for x in doc_ids], np.uint8).tobytes(), np.array(lengths, "<u8").tobytes(),
                     low.astype("<u4").tobytes(), width.tobytes(), n_out.astype("<u2").tobytes(), starts.astype("<u8").tobytes(), *data])


class Shard:
    """A shard's parts, without its ids."""

    def __init__(self, content: bytes):
        if content[:8] != MAGIC:
            raise ValueError("not a token-id shard")
        self.content, self.at = content, 8
        n_docs, self.n_ids, blocks = (int(x) for x in self._take("<u8", 3))
        ids, null = self._take("<i8", n_docs), self._take(np.uint8, n_docs)
        self.doc_ids = [None if z else i for i, z in zip(ids.tolist(), null.tolist())]
        self.lengths = self._take("<u8", n_docs).astype(np.int64)
        self.low, self.width = self._take("<u4", blocks), self._take(np.uint8, blocks)
        self.n_out, self.starts = self._take("<u2", blocks).astype(np.int64), self._take("<u8", blocks + 1).astype(np.int64)

    def _take(self, dtype, n):
        x = np.frombuffer(self.content, dtype, n, self.at)
        self.at += x.nbytes
        return x

    def read_ids(self, start: int, n: int) -> np.ndarray:
        """ids[start:start + n], from the blocks that hold them."""
        first, last = start // BLOCK, -(-(start + n) // BLOCK)
        out = np.empty((last - first, BLOCK), np.uint32)
        at = self.at + self.starts[first:last]
        width, n_out = self.width[first:last].astype(np.int64), self.n_out[first:last]
        for w in np.unique(width):
            rows = np.flatnonzero(width == w)
            words = np.empty((len(rows), 16 * int(w)), np.uint64)
            for i, s in enumerate(at[rows].tolist()):
                words[i] = np.frombuffer(self.content, "<u8", 16 * int(w), s)
            out[rows] = unpack(words, int(w)).astype(np.uint32) + self.low[first:last][rows][:, None]
        for b in np.flatnonzero(n_out).tolist():
            k, s = int(n_out[b]), int(at[b] + 128 * width[b])
            out[b, np.frombuffer(self.content, "<u2", k, s)] = np.frombuffer(self.content, "<u4", k, s + 2 * k)
        return out.ravel()[start - first * BLOCK:start - first * BLOCK + n]


# ---------------------------------------------------------------- words

def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of binary texts between ASCII white space, and whose they are."""
    raw = texts.cast(pa.large_binary())
    lists = pc.ascii_split_whitespace(pa.Array.from_buffers(pa.large_string(), len(raw), raw.buffers(), offset=raw.offset))
    words, of = lists.flatten(), pc.list_parent_indices(lists)
    full = pc.greater(pc.binary_length(words), 0)  # not what stands before a first space or behind a last one
    return words.filter(full), of.filter(full).to_numpy().astype(np.int64)


class _Memory:
    """Numbers of words that were met, by 128 bits of hash: sorted arrays."""

    def __init__(self):
        self.one, self.two, self.number = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)

    @staticmethod
    def hashes(words: list[str]) -> np.ndarray:
        return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), "<u8").reshape(-1, 2)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Each word's number; -1: not met."""
        if not len(self.one):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.one, h[:, 0]), len(self.one) - 1)
        return np.where((self.one[at] == h[:, 0]) & (self.two[at] == h[:, 1]), self.number[at], -1)

    def add(self, h: np.ndarray, number: np.ndarray) -> None:
        order = np.argsort(h[:, 0], kind="stable")
        at = np.searchsorted(self.one, h[order, 0])
        self.one, self.two, self.number = (np.insert(x, at, y[order]) for x, y in ((self.one, h[:, 0]), (self.two, h[:, 1]), (self.number, number)))


class WordEncoder:
    """ids of texts, by way of their distinct words.

    A word of ASCII alone is known without its capitals, and every word without
    one last comma or full stop, where that changes nothing but the ids added
    at the end.  New words are encoded many at a time, joined by spaces, and
    told apart by the ids that end a word or the places the ids come from."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        probe = " a\tb  c'\n's\x0b\x0c9 9\r<|endoftext|> Ab\u0301 \u0301x"
        self.by_word = self._one(probe) == [i for w in probe.encode().split() for i in self._one(w.decode())]
        self.lower = self._one("AbC CAn'T") == self._one("abc can't")
        self.marks = [[], self._one(","), self._one(".")]
        self.cut = all(self._one(w + c) == self._one(w) + m for w in ("a", "the", "x9", "it's") for c, m in zip(("", ",", "."), self.marks))
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)   # ids that end a word
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True
        words = ["a", "the<", ">x9", "\u0301x", "'s", "|", "Ab\u0301", "\u8a9e9", "\U0001f600\u0301", "9"]
        order, ids, size = self._encoded(words, joins=True)
        want = [self._one(words[i]) for i in order]
        self.joins = self.by_word and ids.tolist() == [i for w in want for i in w] and size.tolist() == [len(w) for w in want]
        self._forget()

    def _forget(self):
        self.known = _Memory()   # stem -> its number
        self.ids, self.first, self.size = (np.zeros(0, t) for t in (np.uint32, np.int64, np.int64))

    def _one(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _encoded(self, words: list[str], joins: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places of the words in another order, their ids one after the other,
        how many each has)."""
        kind = np.array([0 if not joins or "<|" in w else 1 if w.isalpha() else 2 for w in words], np.int8)
        order, ids, size = [], [], []

        def groups(places):
            return [places[at:at + 64] for at in range(0, len(places), 64)]

        def add(group, found, n):
            order.append(group)
            ids.append(found)
            size.append(n)

        # words of letters alone are one piece each: it ends with the only id that ends a word
        other = [np.flatnonzero(kind == 2)]
        some = groups(np.flatnonzero(kind == 1))
        for at in range(0, len(some), 128):
            for group, e in zip(some[at:at + 128], self.tokenizer.encode_batch_fast([" ".join([words[i] for i in g]) for g in some[at:at + 128]], add_special_tokens=False)):
                found = np.array(e.ids, np.uint32)
                ends = np.flatnonzero(self.ends[found])
                if len(ends) == len(group) and len(found) == ends[-1] + 1:
                    add(group, found, np.diff(ends, prepend=-1))
                else:
                    other.append(group)
        # the others by the places that their ids come from
        some = groups(np.concatenate(other))
        for at in range(0, len(some), 128):
            for group, e in zip(some[at:at + 128], self.tokenizer.encode_batch([" ".join([words[i] for i in g]) for g in some[at:at + 128]], add_special_tokens=False)):
                n = np.fromiter((len(words[i]) + 1 for i in group), np.int64, len(group))
                of = np.searchsorted(np.cumsum(n) - n, np.fromiter(map(_first, e.offsets), np.int64, len(e.ids)), "right") - 1
                add(group, np.array(e.ids, np.uint32), np.bincount(of, minlength=len(group)))
        alone = np.flatnonzero(kind == 0)
        for at in range(0, len(alone), 1024):
            found = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast([words[i] for i in alone[at:at + 1024]], add_special_tokens=False)]
            add(alone[at:at + 1024], np.concatenate(found), np.fromiter(map(len, found), np.int64, len(found)))
        return np.concatenate(order), np.concatenate(ids), np.concatenate(size)

    def _stems(self, words: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """What stands for each distinct word, and the number of its mark."""
        special = pc.match_substring(words, "<|")  # a special token's name may stand in it
        # a capital and its mark may have no composed form where the small letter has one
        stems = pc.if_else(pc.and_not(pc.string_is_ascii(words), special), pc.ascii_lower(words), words) if self.lower else words
        mark = np.zeros(len(words), np.int64)
        if self.cut:
            for k, c in ((1, ","), (2, ".")):
                has = pc.and_not(pc.match_substring_regex(stems, f"[0-9A-Za-z][{c}]$"), special)
                mark[has.to_numpy(zero_copy_only=False)] = k
            shorter = pc.utf8_slice_codeunits(stems, 0, -1)
            stems = pc.if_else(pa.array(mark > 0), shorter, stems)
        return stems, mark

    def _numbers(self, stems: pa.Array) -> np.ndarray:
        """The number of each distinct stem; new ones are encoded."""
        words = stems.to_pylist()
        h = _Memory.hashes(words)
        number = self.known.find(h)
        new = np.flatnonzero(number < 0)
        if len(new):
            order, ids, size = self._encoded([words[i] for i in new], self.joins)
            number[new[order]] = len(self.size) + np.arange(len(order))
            self.known.add(h[new], number[new])
            self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(size) - size])
            self.ids, self.size = np.concatenate([self.ids, ids]), np.concatenate([self.size, size])
        return number

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, their number in each text)."""
        texts = pc.fill_null(texts.cast(pa.binary()), b"")
        words, of = split_words(texts) if self.by_word else (texts.cast(pa.large_string()), np.arange(len(texts)))
        if not len(words):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        if len(self.size) > WORDS_KEPT:
            self._forget()
        coded = words.dictionary_encode()
        stems, mark = self._stems(coded.dictionary) if self.by_word else (coded.dictionary, np.zeros(len(coded.dictionary), np.int64))
        coded_stems = stems.dictionary_encode()
        number = self._numbers(coded_stems.dictionary)[coded_stems.indices.to_numpy()]
        # the ids of each distinct word: its stem's, then its mark's
        marks = np.array([x for m in self.marks for x in m], np.uint32)
        mark_size = np.array([len(m) for m in self.marks], np.int64)
        pool = np.concatenate([self.ids, marks])
        first = np.column_stack([self.first[number], (len(self.ids) + np.cumsum(mark_size) - mark_size)[mark]]).ravel()
        size = np.column_stack([self.size[number], mark_size[mark]]).ravel()
        own = pool[ranges(first, size)]
        size = size.reshape(-1, 2).sum(1)
        first = np.cumsum(size) - size
        at = coded.indices.to_numpy()
        return own[ranges(first[at], size[at])], np.bincount(of, size[at], len(texts)).astype(np.int64)

    def __call__(self, texts: list[bytes | None]) -> list[bytes]:
        ids, n = self.encode(pa.array(texts, pa.binary()))
        return [x.tobytes() for x in np.split(ids, np.cumsum(n)[:-1])] if texts else []


_encoders: dict[str, WordEncoder] = {}


def encoder(vocabulary: str) -> WordEncoder:
    if vocabulary not in _encoders:
        _encoders[vocabulary] = WordEncoder(vocabulary)
    return _encoders[vocabulary]


# ---------------------------------------------------------------- tasks

def _write(batches, vocabulary: str, folder: str, end_id: int, shard_ids: int):
    enc, part = encoder(vocabulary), TaskContext.get().partitionId()
    docs, parts, lengths, size, shards = [], [], [], 0, []

    def flush():
        nonlocal docs, parts, lengths, size
        name = f"ids-{part:06d}-{len(shards):06d}.pfor"
        put_file(folder, name, encode_shard(docs, lengths, np.concatenate(parts)))
        shards.append((name, len(docs), size))
        docs, parts, lengths, size = [], [], [], 0

    for batch in batches:
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary())
        chars = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
        at = 0
        while at < len(batch):
            upto = max(at + 1, int(np.searchsorted(chars, (chars[at - 1] if at else 0) + CHUNK_BYTES, "right")))
            found, n = enc.encode(texts.slice(at, upto - at))
            whole = np.full(len(found) + len(n), end_id, np.uint32)
            ends = np.cumsum(n + 1) - 1
            inside = np.ones(len(whole), bool)
            inside[ends] = False
            whole[inside] = found
            docs += ids[at:upto]
            lengths += (n + 1).tolist()
            parts.append(whole)
            size += len(whole)
            at = upto
            if size >= shard_ids:
                flush()
    if docs:
        flush()
    if shards:
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*shards), (pa.string(), pa.int64(), pa.int64()))], ["shard", "n_docs", "n_ids"])


def _read(batches):
    for batch in batches:
        names, contents = batch.column("shard").to_pylist(), batch.column("content")
        for i, name in enumerate(names):
            s = Shard(contents[i].as_py())
            end = np.cumsum(s.lengths)
            crc, at = [], 0
            while at < len(end):  # some millions of ids at a time
                first = int(end[at] - s.lengths[at])
                upto = max(at + 1, int(np.searchsorted(end, first + (4 << 20))))
                raw = s.read_ids(first, int(end[upto - 1]) - first).astype("<u4").tobytes()
                crc += [zlib.crc32(raw[4 * (int(e) - int(n) - first):4 * (int(e) - first)]) for e, n in zip(end[at:upto], s.lengths[at:upto])]
                at = upto
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(crc)), pa.array(s.doc_ids, pa.int64()), pa.array(end - s.lengths), pa.array(s.lengths), pa.array(crc, pa.int64())],
                ["shard", "doc_id", "at", "n_tokens", "ids_crc32"])


def write_ids(docs: DataFrame, vocabulary: str, folder: str, end_id: int = 1, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write shards into ``folder``; (shard, n_docs, n_ids, start): each
    shard's documents and ids, and the number of ids before it."""
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .withColumns({"head": F.substring("text", 1, 24), "digest": F.xxhash64("text"), "row": F.monotonically_increasing_id()}))
    # rows of one doc_id part by their heads, those of one text anywhere
    rows = (rows.repartitionByRange(partitions(docs.sparkSession), "doc_id", "head", "digest", "row")
            .sortWithinPartitions("doc_id", "head", "digest").select("doc_id", "text"))
    shards = freeze(rows.mapInArrow(lambda b: _write(b, vocabulary, folder, end_id, shard_ids), "shard string, n_docs long, n_ids long"), "ids-shards")
    # one row for each file
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long"))


def read_documents(shards: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    spark = shards.sparkSession
    if shards.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "ids-*.pfor").load(folder)
    files = files.select(F.substring_index("path", "/", -1).alias("shard"), "content")
    found = files.mapInArrow(_read, "shard string, doc_id long, at long, n_tokens long, ids_crc32 long")
    return found.join(shards.select("shard", "start"), "shard").select(
        "doc_id", (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


# ---------------------------------------------------------------- query

def op10_token_ids(spark, sf_dir):
    import public_tokenizers

    folder = shared_folder(spark, "ids")
    shards = write_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), folder)
    return read_documents(shards, folder)


QUERIES = {"op10_token_ids": op10_token_ids}
SQL: dict[str, str] = {}
