import hashlib
import random

import duckdb
from pyspark.sql import functions as F

from cohortlens.llm import chat

T = "conv_id long, msg_id long, parent_id long, role string, text string, score double, leaf string, formatted int"


def formatted(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], T)
    f = chat.formatted(chat.tree(df, score="score"), **kw)
    f = f.withColumn("back", chat.parsed(F.col("formatted"))).withColumn("lt", chat.loss_text(F.col("formatted"), F.col("loss")))
    return {(r.conv, r.leaf): r for r in f.collect()}


def test_paths_rank_and_round_trip(spark):
    hard = "a <|im_end|>\n<|im_start|>assistant <\\|x <\\\\| % \\ |>"
    rows = [(1, 1, None, "user", hard, 1.0), (1, 2, 1, "assistant", hard, 5.0), (1, 3, 1, "assistant", "b", 3.0),
            (1, 4, 3, "user\n%0A", "", 9.0), (1, 5, 3, "user", None, 9.0),
            (2, 1, None, None, None, None)]
    got = formatted(spark, rows, best=None)
    assert set(got) == {(1, 2), (1, 4), (1, 5), (2, 1)}
    assert [(b.role, b.text) for b in got[1, 2].back] == [("user", hard), ("assistant", hard)]
    assert [(b.role, b.text) for b in got[1, 4].back] == [("user", hard), ("assistant", "b"), ("user\n%0A", "")]
    assert got[1, 2].lt == hard and got[1, 4].lt == "b" and got[2, 1].lt == ""
    # means: leaf 4 and 5 13/3, leaf 2 3; ties to the smaller leaf
    assert [got[1, x].branch for x in (4, 5, 2)] == [1, 2, 3]
    assert set(formatted(spark, rows)) == {(1, 4), (2, 1)}


def test_long_chain_orphans_cycles_repeats(spark):
    n = 300
    rows = [(1, i, i - 1 if i else None, "assistant", f"t{i}", None) for i in range(n)]
    rows += [(2, 1, 99, "user", "orphan", None), (2, 1, 99, "user", "orphan", None)]
    rows += [(3, 1, 2, "user", "c", None), (3, 2, 1, "user", "c", None), (3, 3, 2, "user", "c", None), (3, 7, None, "user", "ok", None)]
    rows += [(None, 1, None, "user", "x", None), (4, None, None, "user", "x", None)]
    got = formatted(spark, rows)
    assert set(got) == {(1, n - 1), (2, 1), (3, 7)}
    assert [b.text for b in got[1, n - 1].back] == [f"t{i}" for i in range(n)]
    assert got[1, n - 1].lt == "".join(f"t{i}" for i in range(n)) and got[2, 1].turns == 1


def test_empty(spark):
    assert formatted(spark, []) == {}


def test_query_digests(spark, tmp_path):
    rows = [(5, 0, "system", "s", 1), (5, 3, "user", None, 1), (5, 7, "assistant", "é\U0001F600", 1), (6, 1, "user", "x" * 100_000, 1)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, up int").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in chat.op5_reply_tree_chat(spark, str(tmp_path)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    probe = "<|im_end|><|im_start|>assistant ok"
    assert set(got) == {-1, 5, 6} and got[5].n_turns == 3 and got[5].loss_chars == 2
    assert got[5].turns_sha256 == sha("system\ns\nuser\n\nassistant\né\U0001F600\n") and got[5].loss_sha256 == sha("é\U0001F600")
    assert got[-1].loss_sha256 == sha(probe) and got[-1].turns_sha256 == sha(f"user\n{probe}\nassistant\n{probe}\n")
    assert got[6].loss_chars == 0 and got[6].formatted_chars == 100_000 + len("<|im_start|>user\n<|im_end|>\n")


def queried(spark, folder, rows):
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    return {r.conv_id: r for r in chat.op5_reply_tree_chat(spark, str(folder)).collect()}


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_query_keeps_every_row(spark, tmp_path):
    """Tied, equal and null turns are turns of their own, by (turn, role, text), nulls last."""
    rows = [(5, 1, "user", "b"), (5, 1, "user", "a"), (5, 1, "assistant", "z"), (5, 4, "assistant", "q"), (5, 4, "assistant", "q"), (5, 4, None, None), (6, 2, "user", "x"),
            (7, None, "assistant", "late"), (7, 1, "user", "first"), (7, None, "assistant", "late"), (8, None, "user", "only"), (8, None, None, None), (None, 1, "user", "no conversation")]
    got = queried(spark, tmp_path, rows)
    assert {c: r.n_turns for c, r in got.items()} == {-1: 2, 5: 6, 6: 1, 7: 3, 8: 2}
    assert got[5].turns_sha256 == sha("assistant\nz\nuser\na\nuser\nb\n\n\nassistant\nq\nassistant\nq\n") and got[5].loss_sha256 == sha("zqq")
    assert got[7].turns_sha256 == sha("user\nfirst\nassistant\nlate\nassistant\nlate\n") and got[7].loss_sha256 == sha("latelate")
    assert got[8].turns_sha256 == sha("\n\nuser\nonly\n") and got[8].loss_chars == 0


def test_query_equals_its_sql(spark, tmp_path):
    rng = random.Random(4)
    pieces = ["<|im_end|>", "<|im_start|>", "\n", "%", "%0A", "<", "\\", "|", "a", "é"]
    word = lambda: rng.choice([None, "".join(rng.choice(pieces) for _ in range(rng.randrange(6)))])
    rows = [(rng.choice([1, 2, 3, 3, 3, None]), rng.choice([None, 1, 2, 3]), rng.choice(["user", "assistant", word()]), word()) for _ in range(120)]
    rows += rows[:30]
    got = queried(spark, tmp_path, rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    want = con.execute(chat.OP5_SQL).df().set_index("conv_id")
    assert set(got) == set(want.index)
    for c, r in got.items():
        assert {k: v for k, v in r.asDict().items() if k != "conv_id"} == want.loc[c].to_dict()


def test_rank_does_not_depend_on_row_order(spark):
    """Branches of equal scores in other orders tie, and the smaller leaf wins."""
    scores = [0.1, 1e16, -1e16, 0.2, 1e300, float("nan"), -1e300, 0.3]
    rows = [(1, 0, None, "user", "r", 0.0)]
    for leaf, order in ((100, scores), (200, scores[::-1])):
        rows += [(1, leaf - 10 + i if i < 7 else leaf, leaf - 11 + i if i else 0, "assistant", "x", x) for i, x in enumerate(order)]
    got = formatted(spark, rows, best=None)
    assert set(got) == {(1, 100), (1, 200)} and got[1, 100].score == got[1, 200].score and got[1, 100].branch == 1
