import random
import re

import xxhash

import __spark_entry__ as entry
import corpus_pipeline as cp
from cohortlens.llm import registry


def test_entry_lists_every_operator():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in registry.queries()} == {f"op{i}" for i in range(1, 14)}
    assert set(registry.queries()) | {"pipeline"} <= names and set(registry.oracle_sql()) <= set(entry.oracle_sql())


def tables(spark, folder, docs, extra=False):
    r = random.Random(0)
    item = "Which river runs past the old mill town before the sea? The wide and slow Nether Brook does."
    bench = [(1, item)]
    rows = [(d, t, "en", "s", len(t) if t is not None else None, "k") for d, t in docs]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, keep string")
    (df if extra else df.drop("keep")).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(d, 1, int("vile" in (t or ""))) for d, t in docs if d is not None and d < 400]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return r, item


def documents():
    r = random.Random(7)
    line = lambda n: " ".join(f"{r.choice('bcdfg')}{r.randrange(900)}{r.choice('aeiou')}" for _ in range(n))
    docs = [(i, "\n".join(line(12) for _ in range(4))) for i in range(300)]
    for i in range(0, 120, 3):
        docs[i] = (i, docs[i][1].replace(" ", " vile rotten ", 3))
    return docs, line


def fingerprint(text):
    """The contract's fingerprint, bit by bit: 3-word shingles, XXH64 with seed 42."""
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(len(words) - 2)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_stages_take_effect(spark, tmp_path):
    docs, line = documents()
    item = "Which river runs past the old mill town before the sea? The wide and slow Nether Brook does."
    shared = line(14)
    docs += [(500, docs[1][1]), (501, line(30) + "\n" + item), (502, shared + "\n" + line(20)), (503, line(20) + "\n" + shared),
             (504, None), (505, ""), (506, line(40)), (507, "a " + line(300))]
    near = docs[-1][1].split()
    docs += [(508, " ".join(near[:150] + ["changed"] + near[151:]) + "\n"), (506, docs[-2][1])]
    tables(spark, tmp_path, docs, extra=True)
    d, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in cp.STAGES:
        out = stage(spark, d, str(tmp_path))
        if name != cp.STAGES[-1][0]:
            assert out.columns == d.columns
        out.write.parquet(f"{tmp_path}/{name}")
        d = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = {r.doc_id: r for r in d.collect()}
    toxic = {i for i, t in docs if "vile" in (t or "")}
    assert set(seen["toxicity"]) == {i for i, _ in docs} - toxic
    lines = seen["line_dedup"]
    assert set(lines) == set(seen["toxicity"]) - {500} and lines[503].text == docs[303][1].split("\n")[0]
    assert lines[503].n_chars == len(lines[503].text) and lines[502].keep == "k"
    assert len({i for i in (504, 505) if i in seen["simhash_near_dedup"]}) == 1
    # 508 differs from 507 in one word of 300: it goes just if the contract's bits say so
    differing = bin(fingerprint(lines[507].text) ^ fingerprint(lines[508].text)).count("1")
    assert set(lines) - set(seen["simhash_near_dedup"]) == ({505, 508} if differing <= 3 else {505})
    assert set(seen["simhash_near_dedup"]) - set(seen["benchmark_decontamination"]) == {501}
    assert set(seen["sentencepiece_encoding"]) == set(seen["benchmark_decontamination"]) and all(r.round_trip for r in seen["sentencepiece_encoding"].values())
    run = cp.run(spark, str(tmp_path))
    assert {(r.doc_id, r.sample, tuple(r.tokens)) for r in run.collect()} == {(r.doc_id, r.sample, tuple(r.tokens)) for r in d.collect()}


def test_empty_documents(spark, tmp_path):
    tables(spark, tmp_path, [])
    assert cp.run(spark, str(tmp_path)).collect() == []


def test_near_copies_are_told_by_row(spark):
    """Rows that share a doc_id, or have none, go only with their own component."""
    r = random.Random(3)
    words = lambda: " ".join(f"{r.choice('bcdfg')}{r.randrange(900)}" for _ in range(300))
    a, b, c, d, e, f = (words() for _ in range(6))
    docs = [(1, a), (7, a), (7, b), (7, c), (8, c), (8, d), (8, d), (9, e), (9, e.upper()), (None, a), (None, f), (None, f + "\n")]
    rows = [(i, t, "en", n) for n, (i, t) in enumerate(docs)]
    df = spark.createDataFrame([*rows, (5, b, None, 90), (5, b, None, 91)], "doc_id long, text string, lang string, n int")
    got = cp.one_of_each_group(spark, df, "")
    assert got.columns == df.columns
    assert sorted(((x.doc_id, x.text, x.n) for x in got.collect()), key=str) == sorted(
        [(1, a, 0), (5, b, 90), (7, c, 3), (8, d, 5), (9, e.upper(), 8), (None, f, 10)], key=str)
