"""Equal keys across all rows, with packed shuffles.

Each task looks through its rows in chunks.  Keys that occur often are
settled where they are: within a chunk only one entry of a key is sent on, so
a key that a third of all rows hold costs one entry for each chunk.  Entries
are packed by bucket of the key into binary columns (about eight bytes an
entry after compression) and each bucket is grouped at once.  A task holds a
bucket whole, and a part of the documents that hits go back to, so their numbers
follow the bytes of the texts (``buckets``): as the entries of a key are settled
by chunk, what is held does not grow with the data.  A shuffle partition takes
one bucket after the other, and all take equally many.  What a chunk or a bucket finds is packed again, by
document, and unpacked to one row for each place.

Two rules:
* ``shared``: the rows whose key belongs to two or more identities, one entry
  at least being marked (bit 0);
* ``later``: the rows that are not the smallest (doc, line) of their key.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import mix, partitions, planes, runs, trim, unplanes

MARKED, MANY = 1, 2
_SHORT = np.uint64((1 << 32) - 1)
#: Packed entries of a bucket (part null), or packed hits of a part of the documents.
ROWS = "bucket int, part int, keys binary, keys2 binary, docs binary, lines binary, who binary, flags binary"
HITS = "part int, keys binary, keys2 binary, docs binary, lines binary, kind int"


def _grouped(key, key2):
    order = np.argsort(key, kind="stable") if key2 is None else np.lexsort((key2, key))
    k = key[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    if key2 is not None:
        k2 = key2[order]
        new[1:] |= k2[1:] != k2[:-1]
    start = np.flatnonzero(new)
    return order, start, np.cumsum(new) - 1


def _smallest(doc, line, order, start):
    """Position (in order) of the smallest (doc, line) of each group."""
    d, n = doc[order], np.diff(np.append(start, len(order)))
    least = np.minimum.reduceat(d, start)
    at = np.flatnonzero(d == np.repeat(least, n))
    if line is not None:
        l = np.where(d == np.repeat(least, n), line[order], np.iinfo(np.int32).max)
        at = at[l[at] == np.repeat(np.minimum.reduceat(l, start), n)[at]]
    group = np.searchsorted(start, at, "right") - 1
    _, one = np.unique(group, return_index=True)
    return at[one]


def settle(rule: str, key, doc, key2=None, line=None, who=None, flag=None):
    """One pass over entries at hand: (entries to send on, hits), as row numbers,
    and the flags of the former."""
    order, start, group = _grouped(key, key2)
    if rule == "later":
        low = _smallest(doc, line, order, start)
        d, g = doc[order], group
        later = d > d[low][g]
        if line is not None:
            later |= (d == d[low][g]) & (line[order] > line[order][low][g])
        return order[low], order[later], None
    end = np.append(start[1:], len(order))
    w = (doc if who is None else who)[order]
    changed = np.zeros(len(w), np.int64)
    changed[1:] = w[1:] != w[:-1]
    changed[start] = 0
    f = np.zeros(len(order), np.uint8) if flag is None else flag[order]
    f = np.bitwise_or.reduceat(f, start) if len(start) else f
    many = (np.add.reduceat(changed, start) > 0 if len(start) else np.zeros(0, bool)) | ((f & MANY) > 0)
    f = f | (many * np.uint8(MANY))
    first = order[start] if line is None and who is None else order[_smallest(doc, line, order, start)]
    return first, order[many[group]], f


def packed(at_: np.ndarray, key, doc, key2=None, line=None, who=None, flag=None):
    """(place, packed columns) for each place of ``at_``."""
    order = np.lexsort((doc, at_))
    start, size = runs(at_[order])
    for s, n in zip(start.tolist(), size.tolist()):
        at = order[s:s + n]
        d = doc[at]
        yield (int(at_[at[0]]), planes(key[at]), None if key2 is None else planes(key2[at]),
               planes(np.diff(d, prepend=d[:1] * 0)), None if line is None else planes(line[at].astype(np.int32)),
               None if who is None else planes(who[at]), None if flag is None else flag[at].tobytes())


def _parts(doc: np.ndarray, n: int) -> np.ndarray:
    """The part that a document's hits go to: ids with a common stride spread as well."""
    return (mix(doc.astype(np.uint64)) % np.uint64(n)).astype(np.int32)


def send(rule: str, buckets: int, parts: int, key, doc, kind: int = 0, kinds: int = 1, short: bool = False, **more):
    """Rows of one chunk: packed entries, and what is settled here already.
    Where several kinds of keys share a shuffle, a bucket's number modulo
    ``kinds`` is its kind.  ``short``: 32 bits of a key are enough for hits."""
    if not len(key):
        return
    keep, hit, flags = settle(rule, key, doc, **more)
    pick = lambda at: {n: x[at] for n, x in more.items() if x is not None}
    entries = packed((key[keep] % np.uint64(buckets)).astype(np.int32), key[keep], doc[keep], **(pick(keep) | ({} if flags is None else {"flag": flags})))
    rows = [(b * kinds + kind, None, *x) for b, *x in entries]
    p = pick(hit)
    found = key[hit] & _SHORT if short else key[hit]
    rows += [(d * kinds + kind, d, *x) for d, *x in packed(_parts(doc[hit], parts), found, doc[hit], p.get("key2"), p.get("line"))]
    types = [pa.int32(), pa.int32(), *[pa.binary()] * 6]
    names = [x.split()[0] for x in ROWS.split(", ")]
    for s in range(0, len(rows), 1024):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[s:s + 1024]), types)], names)


def _column(t: pa.Table, name: str, dtype):
    parts = [x for x in t.column(name).to_pylist() if x is not None]
    return np.concatenate([unplanes(x, dtype) for x in parts]) if parts else None


def _documents(t: pa.Table) -> np.ndarray:
    return np.concatenate([np.cumsum(unplanes(x, np.int64)) for x in t.column("docs").to_pylist()])


def _receive(t: pa.Table, rule: str, n: int, short: bool) -> pa.Table:
    """Packed hits by part of the documents: those settled before, and the bucket's."""
    names = ["part", "keys", "keys2", "docs", "lines"]
    settled = t.filter(t.column("part").is_valid()).select(names)
    t = t.filter(t.column("part").is_null())
    out = [settled]
    if len(t):
        doc = _documents(t)
        key, key2, line, who, flag = (_column(t, c, ty) for c, ty in (("keys", np.uint64), ("keys2", np.uint64), ("lines", np.int32), ("who", np.uint64), ("flags", np.uint8)))
        if rule == "later":
            _, hit, _ = settle(rule, key, doc, key2, line)
        else:
            # entries of keys that two identities hold, with a mark among them
            order, start, group = _grouped(key, key2)
            w = (doc if who is None else who)[order]
            changed = np.zeros(len(w), np.int64)
            changed[1:] = w[1:] != w[:-1]
            changed[start] = 0
            f = np.bitwise_or.reduceat(flag[order], start)
            good = ((np.add.reduceat(changed, start) > 0) | ((f & MANY) > 0)) & ((f & MARKED) > 0)
            hit = order[good[group]]
        if len(hit):
            found = key[hit] & _SHORT if short else key[hit]
            rows = [x[:5] for x in packed(_parts(doc[hit], n), found, doc[hit], None if key2 is None else key2[hit], None if line is None else line[hit])]
            out.append(pa.table([pa.array(c, ty) for c, ty in zip(zip(*rows), (pa.int32(), *[pa.binary()] * 4))], names))
    return pa.concat_tables(out)


def _by_place(t: pa.Table, short: bool) -> pa.Table:
    """One row for each document, or line of it, with all its keys: 32-bit
    words, one (short) or two for a key, and one for its second part."""
    doc, key, key2, line = _documents(t), _column(t, "keys", np.uint64), _column(t, "keys2", np.uint64), _column(t, "lines", np.int32)
    order = np.argsort(doc, kind="stable") if line is None else np.lexsort((line, doc))
    d = doc[order]
    new = np.ones(len(d), bool)
    new[1:] = d[1:] != d[:-1]
    if line is not None:
        ln = line[order]
        new[1:] |= ln[1:] != ln[:-1]
    start = np.flatnonzero(new)
    words = key.view(np.uint32).reshape(-1, 2)  # little-endian halves
    if short:
        words = words[:, :1]
    if key2 is not None:
        words = np.column_stack([words, key2.astype(np.uint32)])
    raw, width = np.ascontiguousarray(words[order]).tobytes(), 4 * words.shape[1]
    keys = [raw[s * width:e * width] for s, e in zip(start.tolist(), np.append(start[1:], len(d)).tolist())]
    lines = pa.nulls(len(start), pa.int32()) if line is None else pa.array(ln[start])
    return pa.table([pa.array(d[start]), lines, pa.array(keys, pa.binary())], ["doc", "line", "keys"])


def matched(sent: DataFrame, parts: int, *rules: str, short: bool = False) -> DataFrame:
    """Hits (doc, line, keys, kind) of what ``send`` made of all chunks, one
    row for each place; a rule for each kind."""
    def receive(key, t):
        kind = key[0].as_py() % len(rules)
        found = _receive(t, rules[kind], parts, short)
        trim()
        return found.append_column("kind", pa.array([kind] * len(found), pa.int32()))

    def place(key, t):
        found = _by_place(t, short)
        trim()
        return found.append_column("kind", pa.array([key[1].as_py()] * len(found), pa.int32()))

    # numbers, not their hashes, say the partition: each takes as many as any other
    n = partitions(sent.sparkSession)
    hits = sent.repartitionById(n, "bucket").groupBy("bucket").applyInArrow(receive, HITS)
    return hits.repartitionById(n, "part").groupBy("part", "kind").applyInArrow(place, "doc long, line int, keys binary, kind int")


#: Bytes of text that one bucket of keys, or one part of the documents, answers for.
BUCKET_TEXT = 32 << 20


def buckets(docs: DataFrame, share: int | None = None) -> tuple[int, int]:
    """Buckets of keys, and parts of the documents that hits go back to: one
    for each ``share`` bytes of ``text``, and enough for all shuffle partitions."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    p, n = partitions(docs.sparkSession), -(-int(size) // (share or BUCKET_TEXT))
    return max(2 * p, n), max(24, p, n)
