"""Near-duplicate lines: segment-partition edit join.

Lines x and y with at most t edits: cut the shorter into t + 1 segments, and
one of them occurs in the longer unchanged, at a place that the lengths and
the other segments' edits bound.  So each distinct line indexes its t + 1
segments, keyed by segment number, line length and text, and probes with the
substrings at those places for every length from its own down to t less.
Keys meet in packed buckets (``match``, rule ``shared``), together with the
keys of whole lines that settle equal lines (rule ``later``).  Only lines with
a hit are fetched; those of one key form a group, a group larger than a
task's fair share is dealt into tiles, and each pair of tiles is a task's
work.  Candidates pass a filter by character counts and are verified by
banded bit-parallel edit distance (Hyyrö 2003), many pairs at a time.  A pair
is counted under its first common segment alone.  Tasks return one row for
each line, not pairs.

Lines too short for segments of two characters, and those up to t longer, are
keyed by what is left of them without up to t characters instead (deletion
neighbourhoods: lines within t edits share such a rest), and go the same way; a
pair counts under its least common rest.  Lines of at most t characters are
all within t edits of each other: they are counted, not paired.

A line occurrence goes if an earlier one, by (doc_id, line number), has a
text within t edits; lines are judged on the input.

Defined results
* lines end at ``\\n``; lines of fewer than ``min_chars`` code points are not
  compared by edits, those of fewer than ``exact_chars`` (``min_chars`` where
  it is not given) always stay; between the two an earlier equal line alone
  removes a line; null text: no lines, and stays null;
* rows that repeat a doc_id count as one document: equal lines at equal
  places do not remove each other; a row with a null doc_id neither loses
  nor removes lines;
* an empty table gives an empty result; other columns are kept as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm.common import drop, freeze, freeze_counted, lean, mix, partitions, ranges, runs, table
from cohortlens.llm.match import MARKED, ROWS, buckets, matched, send

CHUNK_CHARS = 3 << 19
PAIRS = 1 << 18            # candidate pairs that are looked at together
BINS = 16
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    if base not in _powers or len(_powers[base]) < n:
        p = np.full(max(n, CHUNK_CHARS), base, np.uint64)
        p[0] = 1
        _powers[base] = np.cumprod(p, dtype=np.uint64)
    return _powers[base][:n]


class Lines:
    """Code points of lines one after the other, with keys of any substring."""

    def __init__(self, texts: list[str]):
        self.c = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        self.size = np.fromiter(map(len, texts), np.int64, len(texts))
        self.start = np.cumsum(self.size) - self.size
        # a character's own bits are spread first: the sum is then a hash of places too
        x = mix(self.c.astype(np.uint64) + np.uint64(1))
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x * _power(_BASE, len(x)), dtype=np.uint64)))

    def key(self, start: np.ndarray, size) -> np.ndarray:
        back = _power(_BACK, len(self.sums))
        return (self.sums[start + size] - self.sums[start]) * back[start]

    def counts(self) -> np.ndarray:
        out = np.zeros((len(self.size), BINS), np.int32)
        np.add.at(out, (np.repeat(np.arange(len(self.size)), self.size), (self.c % BINS).astype(np.int64)), 1)
        return out


def _segment(size: np.ndarray, i: int, t: int):
    """Start and length of segment i of t + 1 even ones of a line."""
    short, long_ = size // (t + 1), size % (t + 1)  # the last ``long_`` are one longer
    return i * short + np.maximum(0, i - (t + 1 - long_)), short + (i >= t + 1 - long_)


def _reach(i: int, delta: int, t: int) -> range:
    """Places, against segment i's own, where a line ``delta`` longer can hold it."""
    return range(max(-i, delta - (t - i)), min(i, delta + (t - i)) + 1)


def segment_keys(lines: Lines, t: int):
    """(line, segment, probe?, key): index keys first, then probes."""
    n = np.arange(len(lines.size))
    for delta in range(t + 1):
        size = lines.size - delta  # of the lines that are looked for
        for i in range(t + 1):
            at, length = _segment(size, i, t)
            tag = np.uint64((i + 1) * _BACK % (1 << 64)) + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            if delta == 0:
                yield n, i, 0, mix(lines.key(lines.start + at, length) + tag)
            for s in _reach(i, delta, t):
                # the own place of equally long lines is in the index as well
                fits = (at + s >= 0) & (at + s + length <= lines.size) & (length > 0)
                k = n[fits]
                yield k, i, 1, mix(lines.key((lines.start + at + s)[fits], length[fits]) + tag[fits])


def segment_chars(t: int) -> int:
    """Code points from which segments are long enough to tell lines apart."""
    return 2 * (t + 1)


def deletion_keys(texts: list[str], t: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, key) of what is left of each line without up to t characters;
    two lines within t edits have one in common.  Nothing left is no key."""
    of, keys = [], []
    for n, x in enumerate(texts):
        left, level = {x}, {x}
        for _ in range(t):
            level = {y[:i] + y[i + 1:] for y in level for i in range(len(y))}
            left |= level
        left.discard("")
        of += [n] * len(left)
        keys += [xxhash.xxh3_64_intdigest(y, 7) for y in left]
    return np.array(of, np.int64), np.array(keys, np.uint64)


def short_within(x: Lines, i: np.ndarray, j: np.ndarray, t: int) -> np.ndarray:
    """``within`` for lines of a few characters: plain columns, all pairs together."""
    la, lb = x.size[i], x.size[j]
    top, m = int(la.max(initial=0)), int(lb.max(initial=0))
    at = lambda start, k: x.c[np.minimum(start + k, max(len(x.c) - 1, 0))]
    row = np.tile(np.arange(m + 1), (len(i), 1))
    result = np.where(la == 0, lb, 0)
    for a in range(top):
        now = np.empty_like(row)
        now[:, 0] = a + 1
        c = at(x.start[i], a)
        for b in range(m):
            now[:, b + 1] = np.minimum(np.minimum(now[:, b], row[:, b + 1]) + 1, row[:, b] + (c != at(x.start[j], b)))
        row = now
        done = la == a + 1
        result[done] = row[done, lb[done]]
    return result <= t


def within(x: Lines, i: np.ndarray, j: np.ndarray, t: int) -> np.ndarray:
    """Whether lines i and j (of x) are within t edits: banded bit-parallel
    columns, a 64-bit word for each pair.  Both have at least t characters."""
    good = np.zeros(len(i), bool)
    order = np.argsort(x.size[j], kind="stable")
    for s in range(0, len(order), PAIRS):
        at = order[s:s + PAIRS]
        good[at] = _within(x, i[at], j[at], t)
    return good


def _within(x: Lines, i, j, t):
    one, top = np.uint64(1), np.uint64(63)
    a0, la, b0, lb = x.start[i], x.size[i], x.start[j], x.size[j]
    result = np.zeros(len(i), bool)
    who = np.flatnonzero(np.abs(la - lb) <= t)
    a0, la, b0, lb = (v[who] for v in (a0, la, b0, lb))
    vp = np.full(len(who), ((1 << (t + 1)) - 1) << (63 - t), np.uint64)
    vn = np.zeros(len(who), np.uint64)
    dist, row = np.full(len(who), t), np.full(len(who), 62, np.uint64)
    c, col = x.c, 0
    while len(who):
        y = c[np.minimum(b0 + col, len(c) - 1)]
        pm = np.zeros(len(who), np.uint64)
        for d in range(-t, t + 1):  # bit 63 is the pattern's character t ahead
            if col + d >= 0:
                p = col + d
                hit = (p < la) & (c[np.minimum(a0 + p, len(c) - 1)] == y)
                pm |= hit.astype(np.uint64) << np.uint64(63 - t + d)
        d0 = (((pm & vp) + vp) ^ vp) | pm | vn
        hp, hn = vn | ~(d0 | vp), d0 & vp
        diagonal = col < la - t
        dist = dist + np.where(diagonal, 1 - (d0 >> top).astype(np.int64),
                               ((hp >> row) & one).astype(np.int64) - ((hn >> row) & one).astype(np.int64))
        row = np.where(diagonal, row, row - one)
        d0 >>= one
        vp, vn = hn | ~(d0 | hp), d0 & hp
        col += 1
        end = col >= lb
        result[who[end & (dist <= t)]] = True
        stay = ~end & ~((col <= la - t) & (dist > 2 * t + lb - la))
        if not stay.all():
            who, a0, la, b0, lb, vp, vn, dist, row = (v[stay] for v in (who, a0, la, b0, lb, vp, vn, dist, row))
    return result


# ---------------------------------------------------------------- tasks

def _line_hash(line: str) -> tuple[int, int]:
    raw = line.encode()
    return xxhash.xxh64_intdigest(raw, 42), xxhash.xxh3_64_intdigest(raw)


def _all_keys(texts: list[str], t: int, min_chars: int):
    """(line, segment, probe?, key) by segments, and, where lines too short for
    them take part, by deletions (segment t + 1, of lines that can meet one)."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    least = segment_chars(t)
    long_ = np.flatnonzero(size >= least)
    if len(long_):
        for k, seg, probe, key in segment_keys(Lines([texts[i] for i in long_]), t):
            yield long_[k], seg, probe, key
    if min_chars < least:
        short = np.flatnonzero(size < least + t)
        k, key = deletion_keys([texts[i] for i in short], t)
        yield short[k], t + 1, 0, key


def _keys(batches, t: int, min_chars: int, exact_chars: int, n: tuple[int, int]):
    def rows(occ):
        docs, nos, texts = zip(*occ)
        doc, no = np.array(docs, np.int64), np.array(nos, np.int32)
        one, two = np.array([_line_hash(x) for x in texts], np.uint64).T.copy()
        yield from send("later", *n, one, doc, 0, 2, key2=two & np.uint64((1 << 32) - 1), line=no)
        # each distinct line once, at its first place
        order = np.lexsort((no, doc, two, one))
        new = np.ones(len(order), bool)
        new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
        first = order[new]
        first = first[np.fromiter((len(texts[i]) >= min_chars for i in first), bool, len(first))]
        if not len(first):
            return
        first = first[np.lexsort((no[first], doc[first]))]
        found = list(_all_keys([texts[i] for i in first], t, min_chars))
        at = first[np.concatenate([k for k, *_ in found])]
        flag = np.concatenate([np.full(len(k), 0 if probe else MARKED, np.uint8) for k, _, probe, _ in found])
        yield from send("shared", *n, np.concatenate([x for *_, x in found]), doc[at], 1, 2, line=no[at], who=one[at], flag=flag)

    occ, size = [], 0
    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            text = text.as_py()
            if doc is None or not text:
                continue
            for no, line in enumerate(text.split("\n")):
                if len(line) >= exact_chars:
                    occ.append((doc, no, line))
                    size += max(len(line), 16)  # short ones weigh their row
            if size >= CHUNK_CHARS:
                yield from rows(occ)
                occ, size = [], 0
    if occ:
        yield from rows(occ)


def _fetch(batches, t: int, min_chars: int):
    """Lines that were hit, a row for each of their hit keys."""
    def rows(found):
        hit = np.concatenate([np.frombuffer(x[3], np.uint64) for x in found])
        of = np.repeat(np.arange(len(found)), [len(x[3]) // 8 for x in found])
        out = []
        for k, seg, probe, key in _all_keys([x[2] for x in found], t, min_chars):
            # a line's own hits, not those of its neighbours
            both = np.isin(mix(key.copy() + k.astype(np.uint64)), mix(hit + of.astype(np.uint64)))
            # what is left after deletions is index and probe alike
            out += [(int(np.int64(x)), seg, p, i) for x, i in zip(key[both].view(np.int64), k[both].tolist()) for p in ((0, 1) if seg > t else (probe,))]
        h = [np.uint64(_line_hash(x[2])[0]).view(np.int64).item() for x in found]
        for s in range(0, len(out), 4096):
            part = out[s:s + 4096]
            cols = [*zip(*[(key, seg, probe, h[i], found[i][0], found[i][1], found[i][2]) for key, seg, probe, i in part])]
            types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, ty) for c, ty in zip(cols, types)], ["key", "seg", "probe", "h", "doc", "line", "text"])

    found, size = [], 0
    for batch in batches:
        for doc, text, hits in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("hits")):
            lines = text.as_py().split("\n")
            for x in hits.as_py():
                if x["line"] < len(lines):  # else of another row with this doc_id
                    found.append((doc, x["line"], lines[x["line"]], x["keys"]))
                    size += max(len(lines[x["line"]]), 16)
            if size >= CHUNK_CHARS // 4:
                yield from rows(found)
                found, size = [], 0
    if found:
        yield from rows(found)


def _links(batches, t: int):
    """Rows sorted by group, tile and role -> (h, doc, line, near_doc, near_line, links)."""
    rest, size = [], 0

    def linked(tab):
        key, x, y, side, probe, h = (tab.column(n).to_numpy() for n in ("key", "x", "y", "side", "probe", "h"))
        same = np.ones(len(key), bool)
        same[0] = False
        for v in (key, x, y, side, probe):
            same[1:] &= v[1:] == v[:-1]
        again = same.copy()
        again[1:] &= h[1:] == h[:-1]  # the same line from a later place
        tab = tab.filter(pa.array(~again))
        key, x, y, side, probe, h, seg = (tab.column(n).to_numpy() for n in ("key", "x", "y", "side", "probe", "h", "seg"))
        doc, line = tab.column("doc").to_numpy(), tab.column("line").to_numpy()
        group = np.zeros(len(key), np.int64)
        group[1:] = np.cumsum((key[1:] != key[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1]))
        part = (side != x) * 2 + probe
        n_groups = int(group[-1]) + 1
        edge = np.searchsorted(group * 4 + part, np.arange(4 * n_groups + 1))
        lo, hi = edge[:-1].reshape(-1, 4), edge[1:].reshape(-1, 4)
        own = (x == y)[lo.min(1)]
        # index and probe entries that meet: of one tile, or across two
        first = np.concatenate([lo[own, 0], lo[~own, 0], lo[~own, 2]]), np.concatenate([hi[own, 0], hi[~own, 0], hi[~own, 2]])
        second = np.concatenate([lo[own, 1], lo[~own, 3], lo[~own, 1]]), np.concatenate([hi[own, 1], hi[~own, 3], hi[~own, 1]])
        texts = tab.column("text").to_pylist()
        lines = Lines(texts)
        sig, left = lines.counts(), _left(texts, np.flatnonzero(seg > t), t)
        near = np.full(len(key), -1)
        links = np.zeros(len(key), np.int64)
        na, nb = first[1] - first[0], second[1] - second[0]
        total = na * nb
        for s, e in _slices(total, PAIRS):
            k = ranges(np.zeros(e - s, np.int64), total[s:e])
            w = np.repeat(nb[s:e], total[s:e])
            i, j = np.repeat(first[0][s:e], total[s:e]) + k // np.maximum(w, 1), np.repeat(second[0][s:e], total[s:e]) + k % np.maximum(w, 1)
            li, lj = lines.size[i], lines.size[j]
            ok = (h[i] != h[j]) & (lj - li <= t) & ((li < lj) | ((li == lj) & (h[i] < h[j])))
            i, j = i[ok], j[ok]
            ok = np.abs(sig[i] - sig[j]).sum(1) <= 2 * t
            i, j = i[ok], j[ok]
            cut = seg[i] > t
            si, sj = _first_deletion(left, lines, i[cut], j[cut], key, t)
            ok = short_within(lines, si, sj, t)
            si, sj = si[ok], sj[ok]
            i, j = _first_segment(lines, i[~cut], j[~cut], seg[i[~cut]], t)
            ok = within(lines, i, j, t)
            i, j = np.concatenate([i[ok], si]), np.concatenate([j[ok], sj])
            np.add.at(links, i, 1)
            np.add.at(links, j, 1)
            for a, b in ((i, j), (j, i)):
                order = np.lexsort((line[b], doc[b], a))
                at, _ = runs(a[order])
                for p, q in zip(a[order][at].tolist(), b[order][at].tolist()):
                    if near[p] < 0 or (doc[q], line[q]) < (doc[near[p]], line[near[p]]):
                        near[p] = q
        at = np.flatnonzero(near >= 0)
        return pa.RecordBatch.from_arrays(
            [pa.array(v) for v in (h[at], doc[at], line[at], doc[near[at]], line[near[at]], links[at])],
            ["h", "doc", "line", "near_doc", "near_line", "links"])

    for batch in batches:
        rest.append(batch)
        size += batch.nbytes
        if size < 8 << 20:
            continue
        tab = pa.Table.from_batches(rest).combine_chunks()
        keys = [tab.column(n).to_numpy() for n in ("key", "x", "y")]
        cut = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0))
        if len(cut):
            yield linked(tab.slice(0, cut[-1] + 1).combine_chunks())
            rest = tab.slice(cut[-1] + 1).to_batches()
            size = sum(b.nbytes for b in rest)
    if sum(map(len, rest)):
        yield linked(pa.Table.from_batches(rest).combine_chunks())


def _left(texts: list[str], rows: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """(place of each row, a line of sorted deletion keys for each of ``rows``,
    filled up with what no other has)."""
    place = np.zeros(len(texts), np.int64)
    place[rows] = np.arange(len(rows))
    of, keys = deletion_keys([texts[i] for i in rows.tolist()], t)
    _, n = runs(of)
    width = int(n.max(initial=0)) if len(of) else 0
    out = np.full((len(rows), width), np.iinfo(np.int64).max)
    order = np.lexsort((keys.view(np.int64), of))
    out[of, ranges(np.zeros(len(n), np.int64), n)] = keys.view(np.int64)[order]
    return place, out


def _first_deletion(left, lines: Lines, i, j, key, t: int):
    """Pairs that this group counts: one line too short for segments, not both
    so short that any two are within t edits, and no smaller key in common."""
    place, keys = left
    ok = (lines.size[i] < segment_chars(t)) & (lines.size[j] > t)
    i, j = i[ok], j[ok]
    keep = np.ones(len(i), bool)
    for s in range(0, len(i), 1 << 13):
        a, b = keys[place[i[s:s + (1 << 13)]]], keys[place[j[s:s + (1 << 13)]]]
        top = np.iinfo(np.int64).max
        both = np.where((a[:, :, None] == b[:, None, :]).any(2), a, top).min(1)
        keep[s:s + (1 << 13)] = both == key[i[s:s + (1 << 13)]]
    return i[keep], j[keep]


def _slices(total: np.ndarray, most: int):
    """Ranges of groups with about ``most`` pairs each."""
    if not len(total):
        return
    ends = np.cumsum(total)
    cuts = np.unique(np.searchsorted(ends, np.arange(1, int(ends[-1]) // most + 1) * most, "left") + 1)
    cuts = np.concatenate(([0], cuts[cuts < len(total)], [len(total)]))
    yield from zip(cuts[:-1].tolist(), cuts[1:].tolist())


def _first_segment(lines: Lines, i, j, seg, t: int):
    """Without the pairs that share an earlier segment too: they are another group's."""
    keep = np.ones(len(i), bool)
    li, delta = lines.size[i], lines.size[j] - lines.size[i]
    for d in range(t + 1):
        for s in range(t):
            at, length = _segment(li, s, t)
            for shift in _reach(s, d, t):
                look = keep & (seg > s) & (delta == d) & (at + shift >= 0) & (at + shift + length <= lines.size[j])
                if look.any():
                    k = np.flatnonzero(look)
                    mine = lines.key(lines.start[i[k]] + at[k], length[k])
                    keep[k[mine == lines.key(lines.start[j[k]] + at[k] + shift, length[k])]] = False
    return i[keep], j[keep]


_STATS = ("n_lines", "n_removed", "n_links")


def _without(batches, text_at: int):
    """Each row's columns with its text without the lines that go, and its counts."""
    for batch in batches:
        columns, texts = list(batch.columns), batch.column(text_at)
        gone, links = columns.pop(-2), columns.pop(-1)
        removed = np.zeros(len(batch), np.int64)
        changed: dict[int, str] = {}
        for i in np.flatnonzero(pc.greater(pc.fill_null(pc.list_value_length(gone), 0), 0).to_numpy(zero_copy_only=False)).tolist():
            text = texts[i].as_py()
            if text is None:
                continue
            lines, away = text.split("\n"), gone[i].values
            # another row with this doc_id may have other lines there
            bad = {n for n, h in zip(away.field("line").to_pylist(), away.field("h").to_numpy().view(np.uint64).tolist())
                   if n < len(lines) and _line_hash(lines[n])[0] == h}
            if bad:
                removed[i] = len(bad)
                changed[i] = "\n".join([x for n, x in enumerate(lines) if n not in bad])
        if changed:
            at = list(changed)
            mask = np.zeros(len(batch), bool)
            mask[at] = True
            columns[text_at] = pc.replace_with_mask(texts, pa.array(mask), pa.array(list(changed.values()), texts.type))
        n = np.where(texts.is_valid().to_numpy(zero_copy_only=False), pc.fill_null(pc.count_substring(texts, "\n"), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1, 0)
        stats = pa.StructArray.from_arrays([pa.array(n), pa.array(removed), pc.fill_null(links, 0)], list(_STATS))
        yield pa.RecordBatch.from_arrays([*columns, stats], [*batch.schema.names[:-2], "line_stats"])


def _task(make, *args):
    """``lean``, after which the tables of powers are gone too."""
    def cleared(batches, *more):
        try:
            yield from make(batches, *more)
        finally:
            _powers.clear()

    return lean(cleared, *args)


# ---------------------------------------------------------------- operator

def _exact(batches):
    for b in batches:
        keys = b.column("keys").to_pylist()
        h = pa.array([int.from_bytes(k[:8], "little", signed=True) for k in keys], pa.int64())
        yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("line"), h], ["doc", "line", "h"])


def _tiny_links(docs: DataFrame, t: int, min_chars: int) -> DataFrame:
    """Lines of at most t characters: any two are within t edits, so each has
    all the others as links, and the first of the others is nearest.  They are
    counted, not paired."""
    places = F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(i.alias("line"), x.alias("x")))
    few = F.filter(places, lambda p: F.length(p["x"]).between(min_chars, t))
    tiny = docs.where("doc_id IS NOT NULL").select("doc_id", F.explode(few).alias("p"))
    tiny = tiny.groupBy(F.xxhash64("p.x").alias("h")).agg(F.min(F.struct(F.col("doc_id").alias("doc"), F.col("p.line").alias("line"))).alias("own"))
    tiny = freeze(tiny.select("h", "own.doc", "own.line"), "lines-tiny")
    first = tiny.orderBy("doc", "line").limit(2).collect()
    n = tiny.count()
    if n < 2:
        return tiny.limit(0).select("h", "doc", "line", F.col("doc").alias("near_doc"), F.col("line").alias("near_line"), F.lit(0).cast("long").alias("links"))
    is_first = (F.col("doc") == first[0].doc) & (F.col("line") == first[0].line)
    near = lambda c: F.when(is_first, F.lit(first[1][c])).otherwise(F.lit(first[0][c])).cast(tiny.schema[c].dataType).alias(f"near_{c}")
    return tiny.select("h", "doc", "line", near("doc"), near("line"), F.lit(n - 1).cast("long").alias("links"))


def line_marks(docs: DataFrame, max_edits: int = 2, min_chars: int = 16, exact_chars: int | None = None) -> DataFrame:
    """(doc, line, h, gone, links): the line occurrences that go, and the
    first places of the lines that have links, with the number of different
    texts within ``max_edits``.  ``h`` is the line's ``xxhash64``."""
    min_chars = max(1, min_chars)
    exact_chars = min_chars if exact_chars is None else max(1, min(exact_chars, min_chars))
    spark, t = docs.sparkSession, max_edits
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    p, n = partitions(spark), buckets(docs)
    hits = freeze(matched(docs.mapInArrow(_task(_keys, t, min_chars, exact_chars, n), ROWS), n[1], "later", "shared"), "lines-hits")
    later = hits.where("kind = 0").select("doc", "line", "keys").mapInArrow(_exact, "doc long, line int, h long")
    near = hits.where("kind = 1").groupBy(F.col("doc").alias("hit_doc")).agg(F.collect_list(F.struct("line", "keys")).alias("hits"))
    fetched = docs.where("text IS NOT NULL").join(near.hint("shuffle_hash"), F.col("doc_id") == F.col("hit_doc"))
    rows = freeze(fetched.select("doc_id", "text", "hits").mapInArrow(
        _task(_fetch, t, min_chars), "key long, seg int, probe int, h long, doc long, line int, text string"), "lines-rows")
    sizes, _ = freeze_counted(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "lines-sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    tile = min(1 << 14, max(256, total // p // 4))
    dealt = rows.join(sizes.where(F.col("n") > tile), "key", "left")
    dealt = dealt.withColumn("tiles", F.coalesce(F.ceil(F.col("n") / tile), F.lit(1)).cast("int"))
    dealt = dealt.withColumn("side", F.pmod(F.xxhash64("h", "key"), F.col("tiles")).cast("int"))
    dealt = dealt.withColumn("z", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    dealt = dealt.select("key", F.least("side", "z").alias("x"), F.greatest("side", "z").alias("y"), "side", "seg", "probe", "h", "doc", "line", "text")
    links = (dealt.repartition(p, "key", "x", "y").sortWithinPartitions("key", "x", "y", "side", "probe", "h", "doc", "line")
             .mapInArrow(_task(_links, t), "h long, doc long, line int, near_doc long, near_line int, links long"))
    if min_chars <= t:
        links = links.unionByName(_tiny_links(docs, t, min_chars))
    linked = (links.groupBy("h").agg(F.min(F.struct("doc", "line")).alias("own"), F.min(F.struct(F.col("near_doc").alias("doc"), F.col("near_line").alias("line"))).alias("near"),
                                     F.sum("links").alias("links"))
              .select("own.doc", "own.line", "h", (F.col("near") < F.col("own")).alias("gone"), "links"))
    marks = freeze(later.select("doc", "line", "h", F.lit(True).alias("gone"), F.lit(0).cast("long").alias("links")).unionByName(linked), "lines-marks")
    for x in (hits, rows, sizes):
        drop(x)
    return marks


def without_duplicate_lines(docs: DataFrame, max_edits: int = 2, min_chars: int = 16, exact_chars: int | None = None) -> DataFrame:
    """``docs`` with ``text`` without its duplicate lines, and columns
    ``line_stats``: struct<n_lines, n_removed, n_links>."""
    marks = line_marks(docs, max_edits, min_chars, exact_chars)
    by = marks.groupBy(F.col("doc").alias("__doc")).agg(
        F.collect_list(F.when(F.col("gone"), F.struct("line", "h"))).alias("__gone"), F.sum("links").alias("__links"))
    joined = docs.join(by.hint("shuffle_hash"), F.col("doc_id").cast("long") == F.col("__doc"), "left").select(*docs.columns, "__gone", "__links")
    schema = T.StructType([*docs.schema.fields, T.StructField("line_stats", T.StructType([T.StructField(n, T.LongType()) for n in _STATS]))])
    return joined.mapInArrow(lean(_without, docs.columns.index("text")), schema)


# ---------------------------------------------------------------- query

#: Every line that is not empty takes part, by segments or by deletions.
MAX_EDITS, MIN_CHARS, EXACT_CHARS = 2, 1, 1


def op9_line_edit_join(spark, sf_dir):
    """One row per document: its lines, how many go, the links of the line
    texts that occur here first, and the digest of what is kept."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = without_duplicate_lines(docs, MAX_EDITS, MIN_CHARS, EXACT_CHARS)
    return found.select("doc_id", "line_stats.*", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


QUERIES = {"op9_line_edit_join": op9_line_edit_join}
SQL: dict[str, str] = {}
