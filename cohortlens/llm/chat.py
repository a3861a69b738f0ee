"""Chat formatting: reply trees to conversations, with DataFrame functions only.

A reply tree is a set of messages that name their parents.  Every
root-to-leaf path is one conversation.  Paths are enumerated by iterative
self-joins on ids alone (pointer doubling): the table of 2**r-th ancestors is
joined with itself, about log2(depth) times, and then every leaf collects its
ancestors, halving the step each time.  So a chain of any length costs a few
joins, and no task holds more than its rows.  Texts join once, at the end.

Branches of a tree rank by the mean score of their messages (to 12 decimals,
within 1e20; none or NaN: 0), then by leaf id; ``best`` keeps the highest of
each tree.  They are ranked before any text is joined.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each message.  Inside
roles and texts every ``<``, some backslashes, ``|`` gets one backslash more,
so no control string can occur there and the step back is exact; in roles,
which end at a line break, ``%`` and line breaks are written ``%25``,
``%0A``.  The loss mask covers the texts of the trained role.

Defined results
* null role or text: empty; rows with a null conversation or message id are
  no messages; repeated (conversation, message) ids: one of them counts, the
  smallest (parent, role, text, score);
* a parent that does not exist makes its message a root; messages on or
  below a cycle of parents belong to no path;
* a conversation is one row of output, so its text must fit one row;
* empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import freeze, freeze_counted, table

START, END = "<|im_start|>", "<|im_end|>"
_SCORE_LIMIT = 1e20


def escaped(x: Column) -> Column:
    return F.regexp_replace(x, r"<(\\*)\|", r"<$1\\|")


def unescaped(x: Column) -> Column:
    return F.regexp_replace(x, r"<(\\*)\\\|", r"<$1|")


def _role(x: Column) -> Column:
    return F.replace(F.replace(escaped(x), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def _role_back(x: Column) -> Column:
    return unescaped(F.replace(F.replace(x, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%")))


def tree(messages: DataFrame, conv: str = "conv_id", msg: str = "msg_id", parent: str = "parent_id",
         role: str = "role", text: str = "text", score: str | None = None) -> DataFrame:
    """The messages that take part, one row for each (conv, msg)."""
    value = F.coalesce(F.col(score).cast("double"), F.lit(0.0)) if score else F.lit(0.0)
    rows = messages.select(
        F.col(conv).cast("long").alias("conv"), F.col(msg).cast("long").alias("msg"),
        F.struct(F.col(parent).cast("long").alias("parent"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                 F.coalesce(F.col(text), F.lit("")).alias("text"), value.alias("score")).alias("m"))
    return (rows.where(F.col("conv").isNotNull() & F.col("msg").isNotNull())
            .groupBy("conv", "msg").agg(F.min("m").alias("m")).select("conv", "msg", "m.*"))


def branches(nodes: DataFrame) -> DataFrame:
    """(conv, leaf, msg, up): every message of every root-to-leaf path, with
    its distance from the leaf."""
    ids = freeze(nodes.select("conv", "msg", "parent"), "chat-ids")
    known = ids.select("conv", F.col("msg").alias("up"))
    jump, n = freeze_counted(
        ids.where("parent IS NOT NULL").select("conv", "msg", F.col("parent").alias("up")).join(known, ["conv", "up"]), "chat-up")
    jumps, rounds = [], math.ceil(math.log2(n + 1)) + 1 if n else 0
    while n and len(jumps) < rounds:
        jumps.append(jump)
        on = jump.select("conv", F.col("msg").alias("up"), F.col("up").alias("far"))
        jump, n = freeze_counted(jump.join(on, ["conv", "up"]).select("conv", "msg", F.col("far").alias("up")), "chat-up")
    # what still has an ancestor farther than there are messages hangs on a cycle
    ids = ids.join(jump.select("conv", "msg"), ["conv", "msg"], "left_anti") if n else ids
    parents = ids.join(jumps[0], ["conv", "msg"]).select("conv", F.col("up").alias("msg")).distinct() if jumps else None
    leaves = ids.join(parents, ["conv", "msg"], "left_anti") if jumps else ids
    paths = leaves.select("conv", F.col("msg").alias("leaf"), "msg", F.lit(0).cast("long").alias("up"))
    for r in range(len(jumps) - 1, -1, -1):
        step = jumps[r].select("conv", "msg", F.col("up").alias("far"))
        paths = freeze(paths, "chat-paths") if r % 4 == 3 else paths
        paths = paths.join(step, ["conv", "msg"], "left").select(
            "conv", "leaf", F.explode(F.expr(
                f"CASE WHEN far IS NULL THEN array(struct(msg, up)) "
                f"ELSE array(struct(msg, up), struct(far AS msg, up + {1 << r}L AS up)) END")).alias("p")
        ).select("conv", "leaf", "p.msg", "p.up")
    return paths


def ranked_branches(nodes: DataFrame, paths: DataFrame, best: int | None) -> DataFrame:
    """(conv, leaf, branch, score) of the branches that are kept, by mean score
    and leaf.  Scores are summed as decimals, so the order in which rows
    arrive does not matter."""
    limit = F.lit(_SCORE_LIMIT)
    score = F.when(F.isnan("score"), F.lit(0.0)).otherwise(F.greatest(F.least("score", limit), -limit)).cast("decimal(38,12)")
    sums = (paths.join(nodes.select("conv", "msg", score.alias("score")), ["conv", "msg"])
            .groupBy("conv", "leaf").agg((F.sum("score").cast("double") / F.count(F.lit(1))).alias("score")))
    ranked = sums.withColumn("branch", F.row_number().over(Window.partitionBy("conv").orderBy(F.desc("score"), "leaf")))
    return ranked if best is None else ranked.where(F.col("branch") <= best)


def formatted(nodes: DataFrame, best: int | None = 1, train: str = "assistant") -> DataFrame:
    """(conv, leaf, branch, score, turns, formatted, loss): one row for each
    chosen path; ``loss`` lists (start, length) in code points of what the
    loss covers.  Branches are ranked on ids and scores; only the chosen ones
    get their texts."""
    nodes = freeze(nodes, "chat-nodes")
    paths = freeze(branches(nodes), "chat-branches")
    chosen = ranked_branches(nodes, paths, best)
    rows = chosen.join(paths, ["conv", "leaf"]).join(nodes.select("conv", "msg", "role", "text"), ["conv", "msg"])
    rows = rows.select("conv", "leaf", "up", "score", "branch", (F.col("role") == train).alias("trained"),
                       F.concat(F.lit(START), _role(F.col("role")), F.lit("\n")).alias("head"), escaped(F.col("text")).alias("body"))
    path = (rows.groupBy("conv", "leaf", "branch", "score")
            .agg(F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("at"), "trained", "head", "body"))).alias("t")))
    tail = F.lit(f"{END}\n")
    pieces = F.transform("t", lambda m: F.concat(m["head"], m["body"], tail))
    # running start of each message's text, then the trained ones
    sizes = F.aggregate("t", F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,length:int>>)").alias("spans")),
                        lambda a, m: F.struct(
                            (a["at"] + F.length(m["head"]) + F.length(m["body"]) + len(END) + 1).alias("at"),
                            F.when(m["trained"], F.array_append(a["spans"], F.struct(
                                (a["at"] + F.length(m["head"])).alias("start"), F.length(m["body"]).alias("length"))))
                            .otherwise(a["spans"]).alias("spans")))
    return path.select("conv", "leaf", "branch", "score", F.size("t").alias("turns"),
                       F.array_join(pieces, "").alias("formatted"), sizes["spans"].alias("loss"))


def parsed(formatted_text: Column) -> Column:
    """array<struct<role, text>> read back from a formatted conversation."""
    parts = F.split(formatted_text, r"<\|im_end\|>\n", -1)
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)  # what follows the last end mark is empty
    return F.transform(parts, lambda p: F.struct(
        _role_back(F.substring_index(F.substring(p, len(START) + 1, 1 << 30), "\n", 1)).alias("role"),
        unescaped(F.substr(p, F.locate("\n", p) + 1)).alias("text")))


def loss_text(formatted_text: Column, loss: Column) -> Column:
    """What the loss covers, without escapes."""
    return F.array_join(F.transform(loss, lambda s: unescaped(F.substr(formatted_text, s["start"] + 1, s["length"]))), "")


# ---------------------------------------------------------------- query

def op5_reply_tree_chat(spark, sf_dir):
    """All rows of all conversations; a row replies to the one before it, by
    (turn, role, text), a null turn last; equal rows are turns of their own."""
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                                         F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.where("conv_id IS NOT NULL")
    probe = f"{END}{START}assistant ok"
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text"))
    rows = rows.unionByName(own)
    # turns may leave gaps, be tied or null: a row's number in its conversation is
    # its message id.  Texts are sorted within a turn alone, turns by their counts
    nth = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1))
    turns = (rows.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.coalesce(before, F.lit(0)))
             .select(F.col("conv_id").alias("__conv"), F.col("turn").alias("__turn"), "before"))
    same = (F.col("conv_id") == F.col("__conv")) & F.col("turn").eqNullSafe(F.col("__turn"))
    rows = rows.withColumn("nth", nth).join(turns, same).withColumn("msg_id", F.col("before") + F.col("nth"))
    f = formatted(tree(rows.withColumn("parent_id", F.when(F.col("msg_id") > 1, F.col("msg_id") - 1))))
    f = f.withColumn("back", parsed(F.col("formatted"))).withColumn("covered", loss_text(F.col("formatted"), F.col("loss")))
    return f.select(
        F.col("conv").alias("conv_id"), F.size("back").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("covered").cast("long").alias("loss_chars"), F.sha2("covered", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


OP5_SQL = r"""
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  WHERE conv_id IS NOT NULL
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), e AS (
  SELECT *, length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) AS body,
         length(replace(replace(regexp_replace(role, '<(\\*)\|', '<\1\\|', 'g'), '%', '%25'), chr(10), '%0A')) AS head
  FROM m
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(12 + head + 1 + body + 11) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

QUERIES = {"op5_reply_tree_chat": op5_reply_tree_chat}
SQL = {"op5_reply_tree_chat": OP5_SQL}
