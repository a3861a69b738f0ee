import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortlens.llm import lines, match


def edits(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (x != y)))
        prev = cur
    return prev[-1]


def brute(docs, t, m):
    first = {}
    for d, x in sorted((d, x) for d, x in docs if d is not None and x):
        for n, ln in enumerate(x.split("\n")):
            if len(ln) >= m:
                first.setdefault(ln, (d, n))
    near = {a: [b for b in first if b != a and abs(len(a) - len(b)) <= t and edits(a, b) <= t] for a in first}
    out = []
    for d, x in docs:
        if x is None:
            out.append((d, 0, 0, 0, hashlib.sha256(b"").hexdigest()))
            continue
        kept, links = [], 0
        for n, ln in enumerate(x.split("\n")):
            if d is not None and len(ln) >= m:
                links += len(near[ln]) if first[ln] == (d, n) else 0
                if first[ln] < (d, n) or any(first[y] < (d, n) for y in near[ln]):
                    continue
            kept.append(ln)
        out.append((d, len(x.split("\n")), len(x.split("\n")) - len(kept), links, hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, docs, t=2, m=8):
    df = spark.createDataFrame([(d, x, 1, "g") for d, x in docs], "doc_id long, text string, line int, gone string")
    found = lines.without_duplicate_lines(df, t, m)
    assert found.columns == ["doc_id", "text", "line", "gone", "line_stats"]
    return sorted((tuple(r) for r in found.select("doc_id", "line_stats.*", F.sha2(F.coalesce("text", F.lit("")), 256)).collect()), key=str)


def changed(r, s, n):
    s = list(s)
    for _ in range(n):
        k, at = r.randint(0, 2), r.randrange(len(s))
        s[at:at + (k != 0)] = [] if k == 2 else [r.choice("abcé\U0001F600")]
    return "".join(s)


def test_against_brute_force(spark):
    r = random.Random(11)
    pool = ["".join(r.choice("abcdé ") for _ in range(r.randint(8, 40))) for _ in range(40)]
    docs = []
    for i in range(70):
        part = [changed(r, r.choice(pool), r.randint(0, 4)) if r.random() < 0.7 else r.choice(["", "ab", "x" * 9, "zz" * 5]) for _ in range(r.randint(1, 6))]
        docs.append(((i * 31) % 71, "\n".join(part)))
    docs += [(None, pool[0] + "\n" + pool[1]), (300, None), (301, ""), (302, "\n\n"), (303, "long line " * 9000), (304, "long line " * 8999 + "long lime "),
             (305, pool[3]), (305, pool[3])]
    got = {g[0]: g for g in run(spark, docs) if g[0] is not None and g[0] != 305}
    want = {w[0]: w for w in brute([d for d in docs if d[0] not in (303, 304, 305)] + [(305, pool[3])], 2, 8) if w[0] is not None and w[0] != 305}
    assert {k: v for k, v in got.items() if k not in (303, 304)} == want
    assert got[303][1:4] == (1, 0, 1) and got[304][1:4] == (1, 1, 1)


def test_hot_segment_is_dealt_into_tiles(spark):
    """Hundreds of lines share a segment; each is two edits from some others."""
    r = random.Random(2)
    base = "the very same beginning of a line "
    docs = [(i, base + "".join(r.choice("ab") for _ in range(9))) for i in range(700)]
    assert run(spark, docs) == brute(docs, 2, 8)


def test_many_small_buckets(spark, monkeypatch):
    """Buckets of a few bytes of text: ids with a common stride, the same lines everywhere."""
    monkeypatch.setattr(match, "BUCKET_TEXT", 50)
    r = random.Random(4)
    pool = ["".join(r.choice("abcd ") for _ in range(r.randint(8, 30))) for _ in range(20)]
    docs = [(24 * i, "\n".join(["the same line in all of them", *(changed(r, r.choice(pool), r.randint(0, 3)) for _ in range(3))])) for i in range(60)]
    assert run(spark, docs) == brute(docs, 2, 8)


def test_one_edit_and_empty(spark):
    docs = [(1, "abcdefgh"), (2, "abcdefg!"), (3, "abcdef!!"), (4, "Abcdefgh\nabcdefgh")]
    assert run(spark, docs, 1) == brute(docs, 1, 8)
    assert run(spark, []) == []


@settings(max_examples=150, deadline=None)
@given(st.text("ab", min_size=6, max_size=30), st.text("ab", min_size=6, max_size=30), st.integers(1, 3))
def test_banded_distance(a, b, t):
    x = lines.Lines([a, b])
    assert bool(lines.within(x, np.array([0]), np.array([1]), t)[0]) == (edits(a, b) <= t)


@settings(max_examples=100, deadline=None)
@given(st.text("ab", min_size=8, max_size=24), st.lists(st.tuples(st.integers(0, 2), st.integers(0, 30), st.sampled_from("ab")), max_size=2))
def test_a_pair_within_two_edits_shares_a_key(a, changes):
    b = list(a)
    for kind, at, c in changes:
        at = min(at, len(b) - 1)
        b[at:at + (kind != 0)] = [] if kind == 2 else [c]
    b = "".join(b)
    short, long_ = sorted((a, b), key=len)
    keys = list(lines.segment_keys(lines.Lines([short, long_]), 2))
    index = {int(k) for n, _, probe, key in keys for i, k in zip(n, key) if i == 0 and not probe}
    probes = {int(k) for n, _, probe, key in keys for i, k in zip(n, key) if i == 1 and probe}
    assert index & probes


def test_lines_of_any_length(spark):
    """From 1 character on, by segments, deletions and counting, against all pairs."""
    r = random.Random(7)
    docs = [(i * 24, "\n".join("".join(r.choice("ab\U0001F600" if i % 2 else "abcdefgh") for _ in range(r.randint(0, 12))) for _ in range(r.randint(0, 9)))) for i in range(60)]
    assert run(spark, docs, 2, 1) == brute(docs, 2, 1)
    assert run(spark, docs, 2, 4) == brute(docs, 2, 4)
    assert run(spark, docs, 1, 1) == brute(docs, 1, 1)


@settings(max_examples=150, deadline=None)
@given(st.text("ab", max_size=7), st.text("ab", max_size=7), st.integers(1, 3))
def test_short_distance_and_deletions(a, b, t):
    x = lines.Lines([a, b])
    near = edits(a, b) <= t
    assert bool(lines.short_within(x, np.array([0]), np.array([1]), t)[0]) == near
    of, keys = lines.deletion_keys([a, b], t)
    if near and max(len(a), len(b)) > t:
        assert set(keys[of == 0]) & set(keys[of == 1])


def test_repeated_lines_cost_their_number(spark):
    """Twice the lines of two equal documents: no more than thrice the time."""
    import time
    took = []
    for n in (1000, 16_000, 32_000):
        text = "\n".join(f"line number {i:06d} of this text" for i in range(n))
        began = time.time()
        # edits are not at issue here: lines differ in a few digits
        found = lines.without_duplicate_lines(spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string"), 2, 1000, 1)
        assert sorted(r.line_stats.n_removed for r in found.collect()) == [0, n]
        took.append(time.time() - began)
    assert took[2] < 3 * took[1]


def test_query_takes_short_lines(spark, tmp_path):
    """Every line that is not empty takes part."""
    docs = [(1, "Read more\nok\n\nfirst of all the lines here"), (2, "ok\nRead mode\n\nsecond, which differs from the others"),
            (3, "Read more\nab\n\nok"), (4, "abcde\nabcdef"), (5, "abcdX\nabcdeX\nabcdefgh"), (6, "wxyz"), (7, "1234")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(((r.doc_id, r.n_lines, r.n_removed, r.n_links, r.kept_sha256) for r in lines.op9_line_edit_join(spark, str(tmp_path)).collect()), key=str)
    assert got == brute(docs, 2, 1)
    assert [g[2] for g in got] == [0, 2, 3, 1, 3, 0, 0]
