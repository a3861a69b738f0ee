"""Queries of this package: name -> builder ``(spark, sf_dir) -> DataFrame``,
and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from cohortlens.llm import chat, credentials, decontam, langid, lines, pieces, ranked, simhash, substring, tokenfile, topk, toxicity, whitening

MODULES = (topk, chat, simhash, substring, tokenfile, lines, decontam, toxicity, langid, pieces, ranked, whitening, credentials)


def queries():
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def oracle_sql():
    return {name: q for m in MODULES for name, q in m.SQL.items()}
