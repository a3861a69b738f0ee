import hashlib
import random

from cohortlens.llm import match, substring

SCHEMA = "doc_id long, text string, keys int, n_words string"


def brute(docs, w=13):
    low = {}
    split = [(d, (t or "").encode().split()) for d, t in docs]
    for d, x in split:
        for i in range(len(x) - w + 1):
            k = tuple(x[i:i + w])
            if d is not None:
                low[k] = min(low.get(k, d), d)
    out = []
    for d, x in split:
        gone = [False] * len(x)
        for i in range(len(x) - w + 1):
            if d is not None and low[tuple(x[i:i + w])] < d:
                gone[i:i + w] = [True] * w
        out.append((d, len(x), sum(gone), hashlib.sha256(b" ".join(a for a, g in zip(x, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def run(spark, docs, w=13):
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], SCHEMA)
    return sorted(((r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), hashlib.sha256(r.kept.encode()).hexdigest())
                   for r in substring.repeated_passages(df, w).collect()), key=str)


def test_against_brute_force(spark):
    r = random.Random(3)
    text = lambda n: [r.choice("abcdefgh") * r.randint(1, 3) for _ in range(n)]
    shared = [text(n) for n in (13, 14, 20, 40, 12)]
    docs = []
    for i in range(60):
        x = text(r.randint(0, 60))
        for _ in range(r.randint(0, 3)):
            at = r.randint(0, len(x))
            x[at:at] = r.choice(shared)
        docs.append((i * 7 % 61, r.choice([" ", "\n", "\t "]).join(x)))
    docs += [(200, None), (201, ""), (202, " \x0b "), (203, "a b " * 40), (204, "a b " * 40), (205, "same " * 5000), (206, "same " * 5000)]
    docs += [(10, " ".join(shared[3])), (10, " ".join(shared[3])), (None, " ".join(shared[3])), (None, None)]
    assert run(spark, docs) == brute(docs)
    assert run(spark, docs, 5) == brute(docs, 5)


def test_copies_across_chunks(spark, monkeypatch):
    docs = [(i, " ".join(f"w{(i % 3)}_{j}" for j in range(40))) for i in range(90)]
    assert run(spark, docs) == brute(docs)


def test_many_small_buckets(spark, monkeypatch):
    """Buckets follow the bytes of the texts; ids with a common stride, and one
    doc_id with a third of the rows, come out as in few buckets."""
    r = random.Random(5)
    passage = [f"p{i}" for i in range(30)]
    docs = [(24 * i, " ".join([*(r.choice("abcde") for _ in range(r.randint(0, 30))), *passage[r.randint(0, 9):], "end"])) for i in range(60)]
    docs += [(7, " ".join([f"x{i}", *passage[: 13 + i % 17]])) for i in range(30)]
    few = match.buckets(spark.createDataFrame(docs, "doc_id long, text string"))
    monkeypatch.setattr(match, "BUCKET_TEXT", 40)
    many = match.buckets(spark.createDataFrame(docs, "doc_id long, text string"))
    size = sum(len(t) for _, t in docs)
    assert few == (16, 24) and many == (-(-size // 40),) * 2
    assert match.buckets(spark.createDataFrame([(1, None)], "doc_id long, text string")) == few
    assert run(spark, docs) == brute(docs)


def test_empty(spark):
    assert run(spark, []) == []


def test_spans_are_maximal(spark):
    a = [f"a{i}" for i in range(30)]
    df = spark.createDataFrame([(1, " ".join(a)), (2, " ".join(["x", *a[5:25], "y", *a[:13]]))], "doc_id long, text string")
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in substring.repeated_passages(df).collect()}
    assert spans == {1: [], 2: [(1, 21), (22, 35)]}
