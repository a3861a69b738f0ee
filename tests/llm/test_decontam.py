import math
import random
from collections import Counter

from cohortlens.llm import decontam as dc

DOCS = "doc_id long, text string, item_id int, score string"
ITEMS = "item_id long, text string, doc_id int"


def brute(docs, bench):
    units = [(i, ws[k:k + 64], t) for i, t in bench for ws in [dc.words_of(t)] for k in range(0, len(ws), 64)]
    df, n = Counter(w for _, ws, _ in units for w in set(ws)), len(units)
    mean = sum(len(u[1]) for u in units) / max(n, 1)
    out = {}
    for d, t in docs:
        ws = dc.words_of(t)
        passages = [set(ws[i:i + 128]) for i in range(0, max(1, len(ws)), 64) if i == 0 or i + 64 < len(ws)]
        for item, own, text in units:
            x = {w: math.log(1 + (n - df[w] + .5) / (df[w] + .5)) * c * 2.2 / (c + 1.2 * (.25 + .75 * len(own) / mean)) for w, c in Counter(own).items()}
            s = max(sum(v for w, v in x.items() if w in p) for p in passages) / sum(x.values())
            if s < dc.THRESHOLD - 1e-9:
                continue
            shares = []
            for part in dc.question_and_answer(text):
                k = min(5, len(part))
                grams = lambda v: {tuple(v[i:i + k]) for i in range(len(v) - k + 1)}
                shares.append(len(grams(part) & grams(ws)) / len(grams(part)) if k else None)
            if all(v is None or v >= dc.OVERLAP for v in shares):
                out[d, item] = max(out.get((d, item), 0), round(min(s, 1.0), 9))
    return out


def found(spark, docs, bench, **kw):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], DOCS)
    b = spark.createDataFrame([(i, t, 1) for i, t in bench], ITEMS)
    return {(r.doc_id, r.item_id): round(r.score, 9) for r in dc.contaminated(d, b, **kw).collect()}


def corpus(seed=4):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    sentence = lambda n: " ".join(r.choice(vocab) for _ in range(n)).capitalize() + "."
    bench = [(i, " ".join(sentence(r.randint(6, 14)) for _ in range(r.randint(1, 4)))) for i in range(30)]
    bench += [(50, sentence(150)), (51, "Tiny one."), (52, None), (53, ""), (51, "Tiny one."), (54, "?!")]
    docs = []
    for i in range(80):
        parts = [sentence(r.randint(1, 60)) for _ in range(r.randint(0, 4))]
        if i % 3 == 0:
            words = r.choice(bench[:31])[1].split()
            for _ in range(r.randint(0, 6)):
                words[r.randrange(len(words))] = "zzz"
            parts.insert(r.randint(0, len(parts)), r.choice([str.upper, str.lower])(" ".join(words)))
        docs.append((i, "\n".join(parts)))
    docs += [(500, None), (501, ""), (502, "tiny   ONE"), (502, "tiny   ONE"), (503, "filler " * 40_000 + bench[0][1])]
    return docs, bench


def test_against_brute_force(spark):
    docs, bench = corpus()
    want = brute(docs, bench)
    assert len(want) > 7 and (503, 0) in want and (502, 51) in want
    assert found(spark, docs, bench) == want


def test_search_equals_all_scores():
    docs, bench = corpus(9)
    units = [(i, w, t) for i, t in bench if t for w in [dc.words_of(t)[:64]] if w]
    df = Counter(w for _, ws, _ in units for w in set(ws))
    index = dc.Index(units, df, len(units), 20.0)
    for _, t in docs[:80]:
        terms = sorted({index.vocabulary[w] for w in dc.words_of(t) if w in index.vocabulary})
        score = Counter()
        for x in terms:
            for u, w in zip(index.units[x], index.weights[x]):
                score[u] += w
        for threshold in (0.2, 0.6):
            assert {u: round(s, 9) for u, s in index.search(terms, threshold)} == {u: round(min(s, 1.0), 9) for u, s in score.items() if s >= threshold - 1e-9}


def test_many_shards_in_one_pass(spark, monkeypatch):
    """Both functions past more shards than a worker keeps, in one plan over the documents."""
    docs, bench = corpus()
    b = spark.createDataFrame([(i, t, 1) for i, t in bench], ITEMS)
    assert len(dc.shards(b, max_units=4)[1]) > dc.SHARDS_KEPT
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], DOCS)
    want = brute(docs, bench)
    assert found(spark, docs, bench, max_units=4) == want
    kept = dc.decontaminated(d, b, max_units=4)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in docs if i not in {x for x, _ in want})
    for frame in (kept, dc.contaminated(d, b, max_units=4)):
        assert frame._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_hot_item_id_is_dealt_by_row(spark):
    """A third of the benchmark under one id, or none: shards stay even."""
    docs, bench = corpus()
    bench = [(7 if i % 3 else None, t) for i, t in bench] * 3
    b = spark.createDataFrame([(i, t, 1) for i, t in bench], ITEMS)
    folder, names = dc.shards(b, max_units=20)
    sizes = [len(dc._shard(folder, n).items) for n in names]
    assert sum(sizes) == sum(-(-len(dc.words_of(t)) // 64) for _, t in bench) and max(sizes) < 60
    assert found(spark, docs, bench, max_units=20) == brute(docs, bench)


def test_empty(spark):
    docs, bench = corpus()
    assert found(spark, [], bench) == {} and found(spark, docs, []) == {} and found(spark, docs, [(1, None)]) == {}
