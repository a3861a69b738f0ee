"""Secret scans: parts of credentials, linked where complementary ones meet.

Strong parts stand by themselves (the base kinds): ``assign`` (a keyword with
a value), ``access`` (an access identifier), ``hex`` (a long hex run).  Weak
parts mean little alone: ``key`` (a long string of mixed classes, or the value
of a weaker keyword), ``identifier`` (a user or client name given a value) and
``endpoint`` (an address or a host given a value).  A weak part is reported
only when a complementary one co-occurs: a ``key`` needs an identifier or an
endpoint, these need a secret.  The roles are

    identifier: access, identifier    secret: assign, hex, key    endpoint: endpoint

Parts meet within a scope: a paragraph (blank lines part them), and at most
``reach`` code points between them; parts that overlap do not complement each
other.  The meeting is an interval join on (document, paragraph, place): parts
of a chunk of documents are sorted by their ends and by their starts, and two
binary searches give each part its nearest partner of a role before and after
it.  So the cost is that of sorting the parts, however many share a scope, and
no pair is formed but the nearest.  Texts never leave their rows: no shuffle.

All patterns are of ASCII, so they run over UTF-8 bytes, a chunk of documents
at a time, parted by line breaks, which no pattern crosses; places are turned
into code points afterwards.

Defined results
* matches of a base kind are leftmost and do not overlap; those too short
  still use up their text; spans are of whole matches, in code points, the end
  exclusive; a weak part that overlaps a base span is not one;
* null or empty text: no spans; very long texts are whole; repeated rows and
  doc_ids, null ones too, stay rows of their own;
* an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import lean, table

REACH = 256            # code points between parts that belong together
CHUNK_BYTES = 4 << 20
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "key", "identifier", "endpoint")
_GIVEN = rb"[\"']?\x20*[:=]\x20*[\"']?"

# on lower-cased bytes where letters count in either case
_assign = re.compile(rb"(?:password|passwd|secret|token|api_?key)" + _GIVEN + rb"([a-z0-9+/_.=-]+)")
_access = re.compile(rb"AKIA[A-Z0-9]{16,}")
_hex = re.compile(rb"[0-9a-f]{24,}")
_mixed = re.compile(rb"[A-Za-z0-9+/]{32,}={0,2}")
_weaker = re.compile(rb"\b(?:pwd|pass|auth|credentials?|private_?key|access_?key|signature)" + _GIVEN + rb"([a-z0-9+/_.=-]{6,})")
_named = re.compile(rb"\b(?:user(?:_?name)?|login|client_?id|account(?:_?id)?|(?:access_?)?key_?id)" + _GIVEN + rb"([a-z0-9@+/_.-]{2,})")
_address = re.compile(rb"\b(?:https?|ftp|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\x00-\x20\"'<>\x7f-\xff]+|\b(?:host(?:_?name)?|endpoint|server)" + _GIVEN + rb"[a-z0-9-]+(?:[.:][a-z0-9-]+)+")
_blank = re.compile(rb"\n[\x20\t\r]*\n")


def _is_mixed(value: bytes) -> bool:
    """Upper and lower case and digits, and many different characters."""
    return (any(48 <= c < 58 for c in value) and any(65 <= c < 91 for c in value)
            and any(97 <= c < 123 for c in value) and len(set(value)) >= 16)


def _found(raw: bytes):
    """(kind number, start, end) of every part in bytes, base kinds whole."""
    low = raw.lower()
    for m in _assign.finditer(low):
        if m.end(1) - m.start(1) >= 6:
            yield 0, m.start(), m.end()
    for kind, pattern in ((1, _access), (2, _hex)):
        for m in pattern.finditer(raw):
            yield kind, m.start(), m.end()
    for m in _mixed.finditer(raw):
        if _is_mixed(m[0]):
            yield 3, m.start(), m.end()
    for kind, pattern in ((3, _weaker), (4, _named), (5, _address)):
        for m in pattern.finditer(low):
            yield kind, m.start(), m.end()


def _overlaps(start, end, by_start, by_end) -> np.ndarray:
    """Whether some interval of a set without overlaps (its sorted starts and
    ends) shares a place with each [start, end)."""
    return np.searchsorted(by_start, end, "left") > np.searchsorted(by_end, start, "right")


def nearest(start, end, other_start, other_end, reach: int):
    """For each interval the number of the nearest other one that ends before
    it or starts behind it, with at most ``reach`` between; -1: none."""
    out = np.full(len(start), -1)
    if not len(start) or not len(other_start):
        return out
    by_end, by_start = np.lexsort((other_start, other_end)), np.lexsort((other_end, other_start))
    before = np.searchsorted(other_end[by_end], start, "right") - 1
    after = np.searchsorted(other_start[by_start], end, "left")
    b, a = by_end[np.maximum(before, 0)], by_start[np.minimum(after, len(by_start) - 1)]
    gap_b = np.where(before >= 0, start - other_end[b], reach + 1)
    gap_a = np.where(after < len(by_start), other_start[a] - end, reach + 1)
    out = np.where(gap_b <= gap_a, b, a)
    out[np.minimum(gap_b, gap_a) > reach] = -1
    return out


def linked(kind, start, end, scope, reach: int):
    """(parts that stay, (secret, identifier, endpoint) numbers of linked ones)."""
    # scopes lie farther apart than any reach
    far = int(end.max(initial=0)) + reach + 1
    s, e = start + scope * far, end + scope * far
    strong = kind < len(BASE)
    bad = np.zeros(len(kind), bool)
    for k in range(len(BASE)):
        own = np.flatnonzero(kind == k)
        bad |= ~strong & _overlaps(s, e, np.sort(s[own]), np.sort(e[own]))
    role = np.select([(kind == 1) | (kind == 4), kind == 5], [1, 2], 0)
    at = [np.flatnonzero(~bad & (role == r)) for r in range(3)]
    near = np.full((3, len(kind)), -1)
    for r in range(3):
        if len(at[r]):
            n = nearest(s, e, s[at[r]], e[at[r]], reach)
            near[r] = np.where(n >= 0, at[r][n], -1)
    partner = np.where(role == 0, np.maximum(near[1], near[2]), near[0]) >= 0
    stay = strong | (~bad & partner)
    secret = np.flatnonzero(stay & (role == 0) & partner)
    return stay, np.column_stack([secret, near[1][secret], near[2][secret]])


def _chunk(ids, texts: list[bytes], reach: int, names: list[str]):
    raw = b"\n".join(texts)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    first = np.cumsum(size + 1) - size - 1
    parts = list(_found(raw))
    n = len(texts)
    spans, links = [[] for _ in range(n)], [[] for _ in range(n)]
    if parts:
        kind, start, end = np.array(parts, np.int64).T
        doc = np.searchsorted(first, start, "right") - 1
        order = np.lexsort((end, kind, start))
        kind, start, end, doc = kind[order], start[order], end[order], doc[order]
        cuts = np.fromiter((m.start() for m in _blank.finditer(raw)), np.int64)
        scope = doc + np.searchsorted(cuts, start, "right")  # rises at documents and at blank lines
        # code points before each byte
        points = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
        start, end = points[start] - points[first[doc]], points[end] - points[first[doc]]
        stay, found = linked(kind, start, end, scope, reach)
        for i in np.flatnonzero(stay).tolist():
            spans[doc[i]].append({"kind": KINDS[kind[i]], "start": int(start[i]), "end": int(end[i])})
        place = lambda i: None if i < 0 else {"kind": KINDS[kind[i]], "start": int(start[i]), "end": int(end[i])}
        for row in found.tolist():
            links[doc[row[0]]].append(dict(zip(("secret", "identifier", "endpoint"), map(place, row))))
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(spans, _SPANS), pa.array(links, _LINKS)], names)


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_SPANS = pa.list_(_SPAN)
_LINKS = pa.list_(pa.struct([(x, _SPAN) for x in ("secret", "identifier", "endpoint")]))
_S = "struct<kind:string,start:bigint,end:bigint>"


def _scan(batches, reach: int):
    for batch in batches:
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary())
        at = 0
        while at < len(batch):
            some, size, begin = [], 0, at
            while at < len(batch) and size < CHUNK_BYTES:
                some.append(texts[at].as_py() or b"")
                size += len(some[-1]) + 1
                at += 1
            yield _chunk(ids[begin:at], some, reach, ["doc_id", "spans", "links"])


def credentials(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """(doc_id, spans, links), one row for each of ``docs``: the spans that are
    reported, by start, then kind in the order of ``KINDS``, then end; and for
    every reported secret with a partner its nearest identifier and endpoint."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lean(_scan, reach), f"doc_id long, spans array<{_S}>, links array<struct<secret:{_S},identifier:{_S},endpoint:{_S}>>")


# ---------------------------------------------------------------- query

def joined(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op13_credential_links(spark, sf_dir):
    """One row per document: its base spans counted and digested, and all spans."""
    found = credentials(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"), F.size("links").cast("long").alias("n_links"))


QUERIES = {"op13_credential_links": op13_credential_links}
SQL: dict[str, str] = {}
