"""Connected components by alternating large-star and small-star steps.

Every step maps an edge list to one with the same components; the steps end
in stars whose centres are the smallest nodes.  Minima are partial
aggregates, and each is written before it is joined, so Spark can split the
join of a node with very many neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import drop, freeze


def _large(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = freeze(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "star-low")
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(e: DataFrame) -> DataFrame:
    low = freeze(e.groupBy("a").agg(F.min("b").alias("m")), "star-low")
    others = e.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionByName(low.select("a", F.col("m").alias("b")))


def _state(e: DataFrame):
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(a, b): each node that has an edge and is not the smallest of its
    component, with the smallest.  ``edges``: (a, b), any direction."""
    e = freeze(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "star-edges")
    state = _state(e)
    while state[0]:
        # every edge of a large step goes from a node to a smaller one
        large = freeze(_large(e).distinct(), "star-edges")
        new = freeze(_small(large).distinct(), "star-edges")
        drop(large)
        drop(e)
        e, before, state = new, state, _state(new)
        if state == before:
            break
    return e
