import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cohortlens.llm import tokenfile as tf

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("ids", [
    [], [7], [0] * 3000, list(range(5000)), [1 << 31] + [5] * 2047 + [(1 << 32) - 1], [9] * 1024, [3] * 1025])
def test_shard_round_trip(ids):
    ids = np.array(ids, np.uint32)
    s = tf.Shard(tf.encode_shard([4, None], [len(ids), 0], ids))
    assert s.doc_ids == [4, None] and s.lengths.tolist() == [len(ids), 0]
    assert (s.read_ids(0, len(ids)) == ids).all() if len(ids) else s.n_ids == 0
    for start, n in ((0, 1), (1020, 10), (len(ids) - 1, 1), (len(ids) // 2, 40)):
        if 0 <= start and start + n <= len(ids):
            assert (s.read_ids(start, n) == ids[start:start + n]).all()


def test_random_ids_use_exceptions():
    rng = np.random.default_rng(0)
    ids = np.where(rng.random(20_000) < 0.04, rng.integers(0, 1 << 32, 20_000), rng.integers(100, 400, 20_000)).astype(np.uint32)
    content = tf.encode_shard([1], [20_000], ids)
    s = tf.Shard(content)
    assert (s.read_ids(0, 20_000) == ids).all() and set(s.width.tolist()) <= {8, 9} and s.n_out.sum() > 500
    assert len(content) < 20_000 * 2
    with pytest.raises(ValueError):
        tf.Shard(b"x" * 40)


def test_files(spark, tmp_path):
    long = "Straße 'tis 42nd — word " * 20_000
    docs = [(5, "b The cat's"), (3, None), (9, ""), (1, long), (5, "a\tb"), (None, "x <|endoftext|> y"), (7, " ́é  z\x1f1 ")]
    df = spark.createDataFrame([(d, t, 1, "s") for d, t in docs], "doc_id long, text string, start int, shard string")
    folder = f"file://{tmp_path}/ids"
    shards = tf.write_ids(df, VOCABULARY, folder, shard_ids=50_000)
    got = sorted((tuple(r) for r in tf.read_documents(shards, folder).collect()), key=lambda r: r[1])
    tok, start, want = Tokenizer.from_file(VOCABULARY), 0, []
    for d, t in sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")):
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want


def test_empty(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    folder = f"file://{tmp_path}/ids"
    assert tf.read_documents(tf.write_ids(df, VOCABULARY, folder), folder).collect() == []


@pytest.mark.parametrize("word", ["H̱amza", "J̌", "T̈a", "W̊", "Y̊", "T̈́a", "Éa", "ÉA", "ABC,"])
def test_capitals_with_marks(word):
    """A capital's composed form may be missing where the small letter has one."""
    text = f"The {word} {word.lower()} {word}, AND {word}x."
    want = np.array(Tokenizer.from_file(VOCABULARY).encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert tf.encoder(VOCABULARY)([text.encode()]) == [want]


def test_ids_equal_whole_texts(monkeypatch):
    """Random hostile texts in chunks that share and forget words."""
    monkeypatch.setattr(tf, "WORDS_KEPT", 50)
    rng = random.Random(3)
    pieces = ["The", "the,", "THE.", "É", "é.", "H̱a", "<|endoftext|>", "<|", "|>", "<", "a<", ">b", "<|startoftext|>x", "9.9", "it's", "--", ",", ".", "..", "x,.", "語", "語.", " ", " ", " ", "\n", "\t",
              "\x0b", "\x1f", "\x85", " ", "don't", "ﬁ", "İ", "\U0001f600", "\x00"]
    tok, enc = Tokenizer.from_file(VOCABULARY), tf.WordEncoder(VOCABULARY)
    assert enc.by_word and enc.joins
    for _ in range(60):
        texts = ["".join(rng.choice(pieces) + rng.choice(["", "", " "]) for _ in range(rng.randrange(30))) for _ in range(rng.randrange(1, 30))]
        want = [np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        assert enc([t.encode() for t in texts]) == want
    ids, n = enc.encode(pa.array([None, b"", b" "], pa.binary()))
    assert len(ids) == 0 and n.tolist() == [0, 0, 0]


def test_documents_of_the_tables(spark):
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").limit(300).collect()]
    tok, enc = Tokenizer.from_file(VOCABULARY), tf.WordEncoder(VOCABULARY)
    assert enc([t.encode() for t in texts]) == [np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_hot_doc_id_is_split(spark, tmp_path):
    """A third of the rows under one doc_id, half of them one text."""
    rows = [(i, f"text {i}") for i in range(400)] + [(7, f"w{i} x" * 20) for i in range(100)] + [(7, "same text " * 30)] * 100
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    folder = f"file://{tmp_path}/ids"
    shards = tf.write_ids(df, VOCABULARY, folder)
    got = sorted((tuple(r) for r in tf.read_documents(shards, folder).collect()), key=lambda r: r[1])
    assert [g[0] for g in got] == sorted(r[0] for r in rows)
    tok = Tokenizer.from_file(VOCABULARY)
    crc = lambda t: zlib.crc32(np.array(tok.encode(t, add_special_tokens=False).ids + [1], "<u4").tobytes())
    assert sorted(g[3] for g in got if g[0] == 7) == sorted(crc(t) for i, t in rows if i == 7)
    assert [g[1] for g in got] == [0, *np.cumsum([g[2] for g in got])[:-1].tolist()]
    assert sum(1 for r in shards.collect() if r.n_docs) >= 4
    assert max(r.n_docs for r in shards.collect()) < 200  # 201 rows have that id
