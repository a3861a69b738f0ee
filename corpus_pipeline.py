"""A corpus pipeline: documents -> clean, distinct, decontaminated token ids.

Each stage calls one operator of ``cohortlens.llm`` on all rows that its
predecessor kept; its result is written and read again before the next.  All
stages but the last return the columns of ``documents``.

Defined results: a null text passes the first stage, has no lines to lose and
no words; of near copies a row with a null doc_id stays only where no other
has a doc_id; an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import decontam, lines, pieces, simhash, toxicity
from cohortlens.llm.common import freeze, table


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: documents whose P(grade >= 1) reaches one half go."""
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: lines equal to an earlier one or within two edits of one go,
    and with them documents that had such lines and have no text left."""
    found = lines.without_duplicate_lines(docs, lines.MAX_EDITS, lines.MIN_CHARS, lines.EXACT_CHARS)
    emptied = (F.col("line_stats.n_removed") > 0) & (F.trim(F.regexp_replace("text", r"\s+", " ")) == "")
    found = found.where(F.col("text").isNull() | ~emptied)
    sizes = {"n_chars": F.when(F.col("line_stats.n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))} if "n_chars" in docs.columns else {}
    return found.withColumns(sizes).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: 3-word shingles, 3 bits; of each component one row
    stays, that of the smallest (doc_id, text, other columns), a null doc_id
    last.  A row is known by doc_id and the digest of its text, so rows that
    only share their doc_id do not touch each other."""
    groups = freeze(simhash.near_duplicates(docs, shingle=3, max_bits=3, digests=True), "pipeline-groups")
    id_, sha = F.col("doc_id").cast("long"), simhash.text_digest(F.col("text").cast("string"))
    same_row = id_.eqNullSafe(F.col("__id")) & sha.eqNullSafe(F.col("__sha"))
    least = F.col("doc_id").eqNullSafe(F.col("component_id"))
    row = [F.col("doc_id").alias("__id"), F.col("text_sha").alias("__sha")]
    others = freeze(groups.where(~least).select(*row).distinct(), "pipeline-others")
    first = docs.join(others, same_row, "left_anti")
    # components whose smallest doc_id has several rows, or that have none but null
    tied = freeze(groups.where(least).groupBy("root").count().where("count > 1").select("root"), "pipeline-tied")
    again = freeze(groups.where(least).join(tied, "root").select(*row, F.col("root").alias("__root")).distinct(), "pipeline-again")
    if again.isEmpty():
        return first
    text_first = ["text", *[c for c in docs.columns if c != "text"]]
    repeated = (first.join(again, same_row).groupBy("__root").agg(F.min(F.struct(*text_first)).alias("__row"))
                .select(*[F.col("__row")[c].alias(c) for c in docs.columns]))
    return first.join(again, same_row, "left_anti").unionByName(repeated)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a test item go."""
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece: sampled segmentations of every text, as token ids."""
    return pieces.sampled(docs, public_tokenizers.path("piece_bpe_32k.model"), pieces.K, pieces.SEED)


STAGES = [
    ("toxicity", keep_civil),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", one_of_each_group),
    ("benchmark_decontamination", drop_benchmark_copies),
    ("sentencepiece_encoding", encode_pieces),
]

#: No SQL expresses the fitted model, the edit join or the sampling.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = freeze(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
