import math
import re
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from cohortlens.llm import pieces as pc

MODEL = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, sample int, tokens string"


def distribution(v, text):
    """Every segmentation of a short text, with its log-probability."""
    t = pc.SPACE + text.replace(pc.SPACE, pc.OWN_MARK).replace(" ", pc.SPACE)
    names = {b.decode("utf8", "replace").replace(" ", pc.SPACE): i for i, b in enumerate(v.bytes) if i >= 259}
    out = {}

    def go(i, ids, w):
        if i == len(t):
            out[tuple(ids)] = w
            return
        if t[i] not in names:
            raw = (pc.SPACE if t[i] == pc.OWN_MARK else t[i]).encode()
            go(i + 1, ids + [int(v.byte_id[x]) for x in raw], w - len(raw) * math.log(v.size))
        for n in range(1, 17):
            if i + n <= len(t) and t[i:i + n] in names:
                go(i + n, ids + [names[t[i:i + n]]], w + v.weight[names[t[i:i + n]]])

    go(0, [], 0.0)
    z = np.logaddexp.reduce(list(out.values()))
    return {k: x - z for k, x in out.items()}


def test_sampling_without_replacement():
    v, text, n, k = pc.vocabulary(MODEL), "the cat\n", 4000, 3
    want = distribution(v, text)
    first, estimate = Counter(), Counter()
    rows = list(pc._chunk(v, list(range(n)), [text] * n, k, 17))
    assert len(rows) == n * k
    for doc, sample, ids, logp, value, score, again in rows:
        key = tuple(ids.tolist())
        assert again and abs(want[key] - logp) < 1e-9
        first[key] += sample == 1
        estimate[key] += math.exp(logp) / score     # inclusion scores make sums unbiased
    assert len({(r[0], tuple(r[2].tolist())) for r in rows}) == n * k
    by_doc = np.array([r[4] for r in rows]).reshape(n, k)
    assert (np.diff(by_doc, axis=1) <= 0).all()
    for key, x in want.items():
        p = math.exp(x)
        assert abs(first[key] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-3
    for key in sorted(want, key=want.get)[-4:]:
        assert abs(estimate[key] / n - math.exp(want[key])) < 0.02


def test_round_trip_and_edges(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = [(1, "Hello,  wörld_ 42!\n\tok"), (2, "a▁b ▁"), (3, "日本 \U0001F600́"), (4, "x" * 30_000), (5, ""), (6, None), (None, "the cat"), (7, "the cat"), (7, "the cat"), (8, " lead")]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], DOCS)
    rows = pc.sampled(df, MODEL, k=3, seed=5).collect()
    text = {d: t or "" for d, t in docs}
    assert all(r.round_trip and (r.doc_id == 2 or sp.decode(r.tokens) == text[r.doc_id]) for r in rows)
    seven = sorted((r.sample, tuple(r.tokens), r.inclusion) for r in rows if r.doc_id == 7)
    assert len(seven) == 6 and seven[0] == seven[1] and len({x[1] for x in seven}) == 3
    assert [(r.tokens, r.log_prob, r.inclusion) for r in rows if r.doc_id in (5, 6)] == [([], 0.0, 1.0)] * 2
    again = pc.sampled(df.repartition(3), MODEL, k=3, seed=5).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    back = pc.decoded(pc.sampled(df, MODEL, 1, 5).drop("round_trip"), MODEL)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in back.collect()) == sorted((d is None, d or 0, t or "") for d, t in docs)


def test_few_segmentations_and_empty(spark):
    v = pc.vocabulary(MODEL)
    rows = list(pc._chunk(v, [1], ["a▁b"], 5, 1))
    want = distribution(v, "a▁b")
    assert len(rows) == len(want) and all(r[5] == 1.0 for r in rows) or len(rows) == 5
    assert pc.sampled(spark.createDataFrame([], DOCS), MODEL).collect() == []


def test_text_that_comes_back_is_told_by_its_bytes(monkeypatch):
    """No sample of a readable text is decoded; ``stands_for`` is ``decode(ids) == text`` for any ids."""
    v = pc.vocabulary(MODEL)
    rng = np.random.default_rng(5)
    for ids in [[], [int(v.byte_id[0xFF])], [int(v.byte_id[0xC3])], *rng.integers(0, v.size, (50, 7)).tolist()]:
        text = v.decode(ids)
        for t in (text, text + "x", "�"):
            assert v.stands_for(ids, t, t.encode()) == (v.decode(ids) == t)
    monkeypatch.setattr(pc.Vocabulary, "decode", lambda self, ids: pytest.fail("decoded"))
    rows = list(pc._chunk(v, [1, 2, 3], ["a word, twice: a word", "", "über ▁ 日本"], 2, 7))
    assert len(rows) == 5 and all(r[-1] for r in rows)


def test_units_are_arrays_and_rows_get_their_bytes_at_once(monkeypatch):
    """Units are cut where the expression cuts, and numbered by first appearance; the pieces and bytes of a chunk's rows are looked up once."""
    v = pc.vocabulary(MODEL)
    letters = "".join(re.escape(chr(c)) for c in np.flatnonzero(v.kinds == 1))
    unit = re.compile(rf"▁*[{letters}]+|▁*[^{letters}▁]+|▁+")
    texts = ["a word,  twice: a word", "", "▁ über▁▁", "  ", "\0日本 \U0001F600\U0010FFFF\n!!7x ", "x" * 50]
    chars, at, starts = v.units(texts)
    got = ["".join(map(chr, x.tolist())) for x in np.split(chars, at[1:])]
    want = [unit.findall(pc.SPACE + t.replace(pc.SPACE, pc.OWN_MARK).replace(" ", pc.SPACE)) if t else [] for t in texts]
    assert got == sum(want, []) and np.diff(np.searchsorted(at, starts)).tolist() == list(map(len, want))
    number, distinct, size = pc._distinct(chars, at)
    names = ["".join(map(chr, x.tolist())) for x in np.split(distinct, np.cumsum(size)[:-1])]
    assert names == list(dict.fromkeys(got)) and [names[i] for i in number] == got
    calls, raws, pieces = Counter(), pc.Vocabulary.raws, pc.Lattice.pieces
    monkeypatch.setattr(pc.Vocabulary, "raws", lambda *x: calls.update(["raws"]) or raws(*x))
    monkeypatch.setattr(pc.Lattice, "pieces", lambda *x: calls.update(["pieces"]) or pieces(*x))
    rows = list(pc._chunk(v, list(range(6)), texts, 2, 7))
    assert calls == {"raws": 1, "pieces": 1} and all(r[-1] for r in rows)
    assert {r[0] for r in rows} == set(range(6)) and list(pc._chunk(v, [1, None], ["", ""], 2, 7))[1][:2] == (None, 1)


def test_lattices_of_blocks_are_those_of_one_and_need_little_beside(monkeypatch):
    """Building a chunk's lattices takes less than they hold; blocks of units give the same ones, also a unit larger than a block."""
    v = pc.vocabulary(MODEL)
    text = " ".join(map("".join, np.random.default_rng(3).choice(list("etaoinshrdlué7"), (30_000, 8)))) + " " + "x" * 3000
    chars, at, _ = v.units([text])
    _, distinct, size = pc._distinct(chars, at)
    names = ("start", "end", "first", "src", "dst", "id", "logp", "cum")
    tracemalloc.start()
    want = pc.Lattice(v, distinct, size)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 2 * held
    for block in (1000, 1 << 30):
        monkeypatch.setattr(pc, "BLOCK_CHARS", block)
        got = pc.Lattice(v, distinct, size)
        assert all(np.array_equal(getattr(got, x), getattr(want, x)) for x in names)
    assert all(len(getattr(pc.Lattice(v, distinct[:0], size[:0]), x)) == 0 for x in names)
