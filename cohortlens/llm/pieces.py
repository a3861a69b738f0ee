"""Sampled SentencePiece segmentations: Gumbel top-k without replacement.

A text's segmentations are the paths of a lattice over its characters; a
piece of rank r (its place in the vocabulary) weighs 1 / (r + 2), a character
that is no piece weighs 1 / size for each byte of its byte-fallback pieces,
and a path's probability is proportional to the product.  Sums over all ways
to the end (backward) turn the lattice into a tree whose nodes have known
probability, and the k samples are those with the highest Gumbel-perturbed
log-probabilities, which is sampling without replacement.

They are found top-down, best first, without building the tree (A* with exact
bounds): a node's perturbed maximum is known before it is opened.  The child
that holds the maximum is drawn by its probability, so one walk through the
text finds the best leaf.  The leaves that a walk passed by form an open set
of known mass, whose maximum is drawn from a Gumbel truncated at the walk's;
the queue holds these sets.  The set with the highest bound is opened: the
step and the edge at which its best leaf left the walk are drawn by their
masses, a walk goes on from there, and the set without that subtree and the
new walk's own set go back to the queue.

No piece crosses from letters and digits to other characters or to a space
mark, so the lattice falls into units there (checked for the vocabulary; else
the whole text is one unit).  A chunk's units are cut and numbered as arrays of
characters, the lattices of its distinct units are built together, and the walks
through all its texts take their steps together.

Random numbers come from a counter-based generator keyed by (seed, doc_id):
a row's samples do not depend on its place or its neighbours.

Defined results
* null or empty text: one sample without pieces, log-probability 0, score 1;
* fewer than k segmentations: all of them, each with inclusion score 1;
* null doc_id: the key 2**63; repeated rows get the same samples;
* a space mark U+2581 of the text itself is written in bytes, so decoding
  gives every text back; an empty table gives an empty result; other columns
  are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import lean, ranges, runs, table

SPACE, OWN_MARK = "▁", "\udfff"  # the latter stands for U+2581 of a text; no UTF-8 text holds it
CHUNK_CHARS = 1 << 20
BLOCK_CHARS = 1 << 16   # of distinct units whose lattices are built at a time
SLOTS = 20
_mul = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)]


def _kinds(pieces) -> np.ndarray:
    """The kind of each character (the last entry: of all that follow): 1 for
    letters, digits and their marks, 2 for a space mark, 0 for anything else.
    A text may be cut between kinds, but not after a space mark, if no piece goes
    across; else all characters are of one kind."""
    letters = sorted({c for p in pieces for c in p if unicodedata.category(c) in ("Lu", "Ll", "Lt", "Lm", "Lo", "Mn", "Mc", "Nd", "Nl")})
    if letters:
        a = "".join(map(re.escape, letters))
        unit = rf"▁*[{a}]+|▁*[^{a}▁]+|▁+"
        if all(re.fullmatch(unit, p) for p in pieces):
            kinds = np.zeros(max(ord(letters[-1]), ord(SPACE)) + 2, np.uint8)
            kinds[list(map(ord, letters))] = 1
            kinds[ord(SPACE)] = 2
            return kinds
    return np.zeros(1, np.uint8)


def _extend(h: np.ndarray, c: np.ndarray) -> np.ndarray:
    h = (h ^ c.astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Vocabulary:
    """Pieces by a hash of their characters, and their weights and bytes."""

    def __init__(self, model: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.size = sp.get_piece_size()
        self.bytes: list[bytes] = []
        self.byte_id = np.zeros(256, np.int32)
        found: dict[str, int] = {}
        for i in range(self.size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[3:-1], 16)] = i
                self.bytes.append(bytes([int(piece[3:-1], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i):
                self.bytes.append(b"")
            else:
                found[piece] = i
                self.bytes.append(piece.replace(SPACE, " ").encode())
        self.of_id = pa.array(self.bytes, pa.large_binary())
        self.weight = -np.log(np.arange(self.size) - min(found.values(), default=0) + 2.0, where=np.arange(self.size) >= min(found.values(), default=0), out=np.zeros(self.size))
        self.kinds = _kinds(found)
        # all beginnings of pieces: a search ends where no piece goes on
        prefix = {p[:n]: -1 for p in found for n in range(1, len(p) + 1)} | found
        self.longest = max(map(len, found), default=0)
        names = list(prefix)
        self.piece = np.array([prefix[x] for x in names], np.int32)
        h = np.zeros(len(names), np.uint64)
        for n in range(self.longest):
            at = [i for i, x in enumerate(names) if len(x) > n]
            h[at] = _extend(h[at], np.array([ord(names[i][n]) for i in at]))
        self.hash = h
        # two tables; what collides in the first is in the second
        self.slots = np.full((2, 1 << SLOTS), -1, np.int32)
        left = np.arange(len(names))
        for t in (0, 1):
            slot = self._slot(h[left], t)
            _, first = np.unique(slot, return_index=True)
            self.slots[t][slot[first]] = left[first]
            left = np.delete(left, first)
        self.rest = {int(h[i]): int(i) for i in left}  # a handful

    def _slot(self, h, t):
        return ((h * _mul[t]) >> np.uint64(64 - SLOTS)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Entry of each hash, or -1."""
        at = self.slots[0][self._slot(h, 0)]
        no = np.flatnonzero((at < 0) | (self.hash[at] != h))
        other = self.slots[1][self._slot(h[no], 1)]
        at[no] = np.where((other >= 0) & (self.hash[other] == h[no]), other, -1)
        if self.rest:
            keys = np.array(list(self.rest), np.uint64)
            for i in np.flatnonzero(np.isin(h, keys)):
                at[i] = self.rest[int(h[i])]
        return at

    def units(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The characters of all texts, each but an empty one behind a space
        mark, where each unit starts, and where each text does, and the end."""
        chars = np.frombuffer("".join([" " + t if t else "" for t in texts]).encode("utf-32-le"), np.uint32).copy()
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        begin = np.concatenate(([0], np.cumsum(size + (size > 0))))
        chars[chars == ord(SPACE)] = ord(OWN_MARK)
        chars[chars == ord(" ")] = ord(SPACE)
        kind = self.kinds[np.minimum(chars, len(self.kinds) - 1)]
        cut = np.zeros(len(chars), bool)
        cut[1:] = (kind[1:] != kind[:-1]) & (kind[:-1] != 2)
        cut[begin[:-1][size > 0]] = True
        return chars, np.flatnonzero(cut), begin

    def raws(self, ids: np.ndarray, cut: np.ndarray) -> tuple[memoryview, list[int]]:
        """The bytes of all pieces in a row, and where those before each of ``cut`` end."""
        taken = self.of_id.take(pa.array(ids))
        _, offsets, data = taken.buffers()
        ends = np.frombuffer(offsets, np.int64, len(taken) + 1)
        return memoryview(data or b""), ends[cut].tolist()

    def decode(self, ids) -> str:
        ids = np.asarray(ids, np.int64)
        data, (_, end) = self.raws(ids, np.array([0, len(ids)]))
        return _unmarked(data[:end]).decode("utf-8", "replace")

    def same(self, raw, text: str, coded: bytes) -> bool:
        """Whether pieces of these bytes give ``text``, whose UTF-8 is ``coded``."""
        raw = _unmarked(raw)
        return raw == coded or raw.decode("utf-8", "replace") == text

    def stands_for(self, ids, text: str, coded: bytes) -> bool:
        """Whether ``decode`` gives ``text``, whose UTF-8 is ``coded``."""
        ids = np.asarray(ids, np.int64)
        data, (_, end) = self.raws(ids, np.array([0, len(ids)]))
        return self.same(data[:end], text, coded)


def _unmarked(raw) -> bytes:
    """Without the space that stands before every text."""
    return bytes(raw[1:] if raw[:1] == b" " else raw)


def _widths(chars: np.ndarray) -> np.ndarray:
    """Bytes of each character in UTF-8 (U+2581 has as many as ``OWN_MARK`` would)."""
    return 1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000)


def _distinct(chars: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The number of each unit, by first appearance, and the characters and
    sizes of the distinct ones."""
    at = np.append(starts, len(chars))
    every = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(4 * at), pa.py_buffer(chars)])
    every = every.dictionary_encode()
    _, offsets, data = every.dictionary.buffers()
    at = np.frombuffer(offsets, np.int64, len(every.dictionary) + 1) // 4
    return every.indices.to_numpy().astype(np.int64), np.frombuffer(data, np.uint32, at[-1]), np.diff(at)


def _edges(v: Vocabulary, units: np.ndarray, size: np.ndarray):
    """The edges of these units' lattices, by source: how many each node has,
    and each one's target, piece, log-probability and running sum."""
    start = np.cumsum(size + 1) - size - 1
    n = int((size + 1).sum())
    end = np.zeros(n, bool)
    end[start + size] = True
    nodes = at = np.flatnonzero(~end)
    chars = np.zeros(n, np.uint32)
    chars[nodes] = units
    left = np.repeat(start + size, size + 1) - np.arange(n)
    # edges: from each character the pieces that start there
    far = to_end = left[nodes]
    h = np.zeros(len(at), np.uint64)
    src, ids = [], []
    for length in range(1, v.longest + 1):
        h = _extend(h, chars[at + (length - 1)])
        entry = v.find(h)
        piece = v.piece[entry]
        piece[entry < 0] = -1
        hit = np.flatnonzero(piece >= 0)
        src.append(at[hit])
        ids.append(piece[hit])
        if length == 1:
            raw = at[np.flatnonzero(piece < 0)]  # no piece of its own: its bytes
        on = np.flatnonzero((entry >= 0) & (to_end > length))
        if not len(on):
            break
        at, h, to_end = at[on], h[on], to_end[on]
    lengths = [*range(1, len(src) + 1), 1]
    src.append(raw)
    ids.append(-1 - chars[raw].astype(np.int32))
    # by source, then length: each list is in order of its sources already
    count = np.zeros(n, np.int64)
    rank = []
    for x in src:
        rank.append(count[x])
        count[x] += 1
    first = np.cumsum(count) - count
    edges = int(count.sum())
    id_, dst = np.empty(edges, np.int32), np.empty(edges, np.int64)
    for x, r, i, length in zip(src, rank, ids, lengths):
        place = first[x] + r
        id_[place] = i
        dst[place] = x + length
    w = v.weight[np.maximum(id_, 0)]
    own = np.flatnonzero(id_ < 0)
    w[own] = -math.log(v.size) * _widths(-1 - id_[own])
    # backward: sums over all ways to the end, nodes of equal distance together
    back = np.zeros(n)
    if len(far) and far.max() < 1 << 16:
        far = far.astype(np.uint16)  # sorted by its digits
    order = np.argsort(far, kind="stable")
    nodes, far = nodes[order], far[order]
    cnt = count[nodes]
    by = ranges(first[nodes], cnt)
    begin = np.cumsum(cnt) - cnt
    by_w, by_dst = w[by], dst[by]
    s0, ln = runs(far)
    for s, m in zip(s0.tolist(), ln.tolist()):
        heads, sizes = begin[s:s + m] - begin[s], cnt[s:s + m]
        e = slice(int(begin[s]), int(begin[s] + heads[-1] + sizes[-1]))
        x = by_w[e] + back[by_dst[e]]
        top = np.maximum.reduceat(x, heads)
        back[nodes[s:s + m]] = top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, sizes)), heads))
    logp = np.minimum(w + back[dst] - np.repeat(back, count), 0.0)
    # running sums of each node on its own: they do not depend on the chunk
    cum = np.exp(logp)
    some = count > 0
    node, cnt = first[some], count[some]
    e, more_of = node, cnt
    for r in range(1, int(cnt.max(initial=1))):
        more = np.flatnonzero(more_of > r)
        e, more_of = e[more] + 1, more_of[more]
        cum[e] += cum[e - 1]
    cum[node + cnt - 1] = 2.0  # the last edge takes what rounding leaves
    return count, dst, id_, logp, cum


class Lattice:
    """Lattices of units, one node for each character and one for each end."""

    def __init__(self, v: Vocabulary, units: np.ndarray, size: np.ndarray):
        self.v = v
        self.start = np.cumsum(size + 1) - size - 1
        n = int((size + 1).sum())
        self.end = np.zeros(n, bool)
        self.end[self.start + size] = True
        kind = np.int32 if n < 1 << 31 else np.int64
        # units do not touch each other: what building takes beside the result is that of a block of them
        at = np.concatenate(([0], np.cumsum(size)))
        first, more = runs((at[1:] - 1) // BLOCK_CHARS)
        columns = [[np.zeros(0, x)] for x in (np.int64, kind, np.int32, float, float)]
        for i, m in zip(first.tolist(), more.tolist()):
            count, dst, *rest = _edges(v, units[at[i]:at[i + m]], size[i:i + m])
            for column, part in zip(columns, (count, (dst + self.start[i]).astype(kind), *rest)):
                column.append(part)
        count, self.dst, self.id, self.logp, self.cum = (np.concatenate(columns.pop(0)) for _ in range(5))
        self.first = np.cumsum(count) - count
        self.src = np.repeat(np.arange(n, dtype=kind), count)

    def pieces(self, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        """The pieces' ids, and how many each edge has (None: one each)."""
        ids = self.id[edges]
        own = np.flatnonzero(ids < 0)
        if not len(own):
            return ids, None
        chars, which = np.unique(-1 - ids[own], return_inverse=True)
        coded = [SPACE.encode() if c == ord(OWN_MARK) else chr(c).encode() for c in chars.tolist()]
        size = np.array(list(map(len, coded)), np.int64)
        width = np.ones(len(ids), np.int64)
        width[own] = size[which]
        ids = np.repeat(ids, width)
        raw = self.v.byte_id[np.frombuffer(b"".join(coded), np.uint8)]
        ids[np.flatnonzero(ids < 0)] = raw[ranges((np.cumsum(size) - size)[which], size[which])]
        return ids, width

    def walk(self, units: np.ndarray, u: np.ndarray, at: np.ndarray):
        """A path through each unit: (edges, steps of each unit).  A step from
        character o of unit i uses u[at[i] + o]."""
        node = self.start[units]
        shift = at - node
        who = np.arange(len(units))
        picks = []
        while len(who):
            x = u[node + shift]
            e = self.first[node]
            more = np.flatnonzero(self.cum[e] < x)
            while len(more):
                e[more] += 1
                more = more[self.cum[e[more]] < x[more]]
            picks.append((who, e))
            node = self.dst[e]
            on = np.flatnonzero(~self.end[node])
            who, node, shift = who[on], node[on], shift[on]
        steps = np.zeros(len(units), np.int64)
        for w, _ in picks:
            steps[w] += 1
        first = np.cumsum(steps) - steps
        path = np.empty(int(steps.sum()), np.int64)
        for t, (w, e) in enumerate(picks):
            path[first[w] + t] = e
        return path, steps

    def one_walk(self, node: int, u) -> list[int]:
        """The rest of a unit from a node on."""
        out = []
        while not self.end[node]:
            e, x = int(self.first[node]), u()
            while self.cum[e] < x:
                e += 1
            out.append(e)
            node = int(self.dst[e])
        return out


def _truncated(phi: float, top: float, noise: float) -> float:
    """A Gumbel(phi) variable that is known to be below ``top``."""
    return phi - math.log(math.exp(min(phi - top, 700.0)) + noise)


class _Path:
    """A sample, and the set of leaves its walk passed by: those that leave
    the path at a step from ``start`` on, of mass exp(before) - exp(total).
    ``logp``: of the steps from ``start`` on."""

    def __init__(self, edges, ends, logp, value: float, before: float, start: int, total: float):
        self.edges, self.ends, self.logp, self.value, self.before, self.start, self.total = edges, ends, logp, value, before, start, total
        self.mass = -math.expm1(min(total - before, 0.0))  # as a share of exp(before)
        self.bound = -math.inf
        self.taken: set[tuple[int, int]] = set()

    def open(self, rng) -> None:
        """Draw the perturbed maximum of the set, which is below ``value``
        or, after a sample was taken from it, below that sample's."""
        self.bound = _truncated(self.before + math.log(self.mass), self.value, rng.exponential()) if self.mass > 1e-12 else -math.inf


def samples(lat: Lattice, walks, logp, total: float, rng, k: int):
    """Up to k distinct paths: ([(edges, log-probability, value)], threshold).
    ``walks``: k independent walks (edges, end of each unit) through the text;
    ``logp``: of the first one's steps, and their sum."""
    edges, ends = walks[0]
    paths = [_Path(edges, ends, logp, -math.log(rng.exponential()), 0.0, 0, total)]
    found = [(edges, total, paths[0].value)]
    paths[0].open(rng)
    while True:
        p = max(paths, key=lambda x: x.bound)
        if p.bound == -math.inf or len(found) == k:
            return found, p.bound
        # the step at which the sample leaves the path, and by which edge
        away = -p.logp.cumsum()
        while True:
            n = min(int(away.searchsorted(-math.log1p(-rng.random() * -math.expm1(-away[-1])))), len(away) - 1)
            own = int(p.edges[p.start + n])
            node = int(lat.src[own])
            others = [e for e in range(int(lat.first[node]), int(lat.first[node + 1])) if e != own]
            if not others:
                continue
            weight = np.exp(lat.logp[others]).cumsum()
            e = others[min(int(weight.searchsorted(rng.random() * weight[-1], "right")), len(others) - 1)]
            if (n, e) not in p.taken:
                break
        p.taken.add((n, e))
        before = p.before + (float(-away[n - 1]) if n else 0.0) + float(lat.logp[e])
        step = p.start + n
        unit = int(p.ends.searchsorted(step, "right"))
        tail = lat.one_walk(int(lat.dst[e]), rng.random)
        other, after = walks[len(found)]
        path = np.concatenate([p.edges[:step], np.array([e, *tail], np.int64), other[after[unit]:]])
        ends = np.concatenate([p.ends[:unit], [step + 1 + len(tail)], step + 1 + len(tail) + after[unit + 1:] - after[unit]]) if len(found) + 1 < k else None
        logp = lat.logp[path[step + 1:]]
        new = _Path(path, ends, logp, p.bound, before, step + 1, before + float(logp.sum()))
        found.append((path, new.total, p.bound))
        # what is left of the set, without the leaves below the edge taken
        p.value, p.mass = p.bound, p.mass - math.exp(before - p.before)
        p.open(rng)
        new.open(rng)
        paths.append(new)


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary(model: str) -> Vocabulary:
    if model not in _vocabularies:
        _vocabularies[model] = Vocabulary(model)
    return _vocabularies[model]


def _chunk(v: Vocabulary, docs: list, texts: list[str], k: int, seed: int):
    """Rows (doc, sample, ids, log-probability, value, inclusion, text again?)."""
    chars, at, starts = v.units(texts)
    units, distinct, size = _distinct(chars, at)
    lat = Lattice(v, distinct, size)
    del chars, distinct
    bounds = np.searchsorted(at, starts)
    sizes, starts = np.diff(bounds), starts.tolist()
    rngs = [np.random.Generator(np.random.Philox(key=np.array([seed, (1 << 63) if d is None else d % (1 << 64)], np.uint64))) for d in docs]
    walks, u = [], np.empty(starts[-1])
    for _ in range(k if len(units) else 0):
        for r, start, last in zip(rngs, starts, starts[1:]):
            r.random(out=u[start:last])
        path, steps = lat.walk(units, u, at)
        ends = np.concatenate(([0], np.cumsum(steps)))
        walks.append((path, ends, ends[bounds].tolist()))
    del u
    if walks:
        path, ends, cut = walks[0]
        logp = lat.logp[path]
        total, some = np.zeros(len(sizes)), np.flatnonzero(sizes)
        total[some] = np.add.reduceat(logp, ends[bounds[:-1][some]])
    rows = []
    for i, (doc, rng, first, last) in enumerate(zip(docs, rngs, bounds.tolist(), bounds[1:].tolist())):
        if first == last:
            rows.append((i, 1, np.zeros(0, np.int64), 0.0, 0.0, 1.0))
            continue
        mine = [(p[c[i]:c[i + 1]], e[first + 1:last + 1] - c[i]) for p, e, c in walks]
        found, limit = samples(lat, mine, logp[cut[i]:cut[i + 1]], float(total[i]), rng, k)
        for n, (edges, lp, value) in enumerate(found):
            score = -math.expm1(-math.exp(min(lp - limit, 700.0))) if limit > -np.inf else 1.0
            rows.append((i, n + 1, edges, lp, value, score))
    if not rows:
        return
    # pieces and bytes of all rows at once
    ids, width = lat.pieces(np.concatenate([r[2] for r in rows]))
    cut = np.concatenate(([0], np.cumsum([len(r[2]) for r in rows])))
    if width is not None:
        cut = np.concatenate(([0], np.cumsum(width)))[cut]
    del lat, walks
    raw, byte_cut = v.raws(ids, cut)
    last, coded = -1, b""
    for (i, n, _, lp, value, score), s, e, bs, be in zip(rows, cut.tolist(), cut[1:].tolist(), byte_cut, byte_cut[1:]):
        if i != last:
            last, coded = i, texts[i].encode()
        yield docs[i], n, ids[s:e], lp, value, score, v.same(raw[bs:be], texts[i], coded)


SCHEMA = "doc_id long, sample int, tokens array<int>, log_prob double, perturbed double, inclusion double, round_trip boolean"


def _encode(batches, model: str, k: int, seed: int):
    v = vocabulary(model)
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def batch(docs, texts):
        rows, size = [], 0
        for row in _chunk(v, docs, texts, k, seed):
            rows.append(row)
            size += len(row[2])
            if size > 1 << 20:
                yield out(rows)
                rows, size = [], 0
        if rows:
            yield out(rows)

    def out(rows):
        d, s, ids, *more = zip(*rows)
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
        cols = [pa.array(d, pa.int64()), pa.array(s, pa.int32()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids), pa.int32()))]
        return pa.RecordBatch.from_arrays(cols + [pa.array(x) for x in more], names)

    docs, texts, size = [], [], 0
    for b in batches:
        for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
            docs.append(doc)
            texts.append(text.as_py() or "")
            size += len(texts[-1])
            if size >= CHUNK_CHARS:
                yield from batch(docs, texts)
                docs, texts, size = [], [], 0
    if docs:
        yield from batch(docs, texts)


def sampled(docs: DataFrame, model: str, k: int = 2, seed: int = 17) -> DataFrame:
    """(doc_id, sample, tokens, log_prob, perturbed, inclusion, round_trip):
    up to k distinct segmentations of every text, best perturbed first."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lean(_encode, model, k, seed), SCHEMA)


def decoded(rows: DataFrame, model: str) -> DataFrame:
    """``rows`` with ``tokens`` plus ``text``, the text they stand for."""
    def texts(batches):
        v = vocabulary(model)
        for b in batches:
            yield b.append_column("text", pa.array([None if t is None else v.decode(t) for t in b.column("tokens").to_pylist()], pa.string()))

    return rows.mapInArrow(texts, rows.drop("text").schema.add("text", "string"))


# ---------------------------------------------------------------- query

K, SEED = 2, 17


def op8_gumbel_pieces(spark, sf_dir):
    import public_tokenizers

    return sampled(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), K, SEED)


QUERIES = {"op8_gumbel_pieces": op8_gumbel_pieces}
SQL: dict[str, str] = {}
