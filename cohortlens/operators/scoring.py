"""RFM scoring: three global NTILE(5) scores (SQL flavour) or three exact
quantile buckets (pandas flavour), the composite score and the segment.

The customer table is frozen once (``stable``) because every score reads it
several times (key bounds, cell counts, the selected cells); the
upstream transaction join and aggregation therefore run exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.segments import segment_expr
from fractions import Fraction

from cohortlens.operators.ranking import bucket_by_edges, exact_quantiles_multi, ntiles
from cohortlens.session import stable

SCORES = ("r_score", "f_score", "m_score")


def with_scores(df: DataFrame) -> DataFrame:
    """Composite ``rfm_total`` = r + f + m and ``rfm_cell`` = 'rfm' text."""
    return df.withColumns({
        "rfm_total": (F.col("r_score") + F.col("f_score") + F.col("m_score")).cast("int"),
        "rfm_cell": F.concat(*[F.col(s).cast("string") for s in SCORES]),
    })


def ntile_scores(metrics: DataFrame, n: int = 5, tie: str = "customer_id", freeze: bool = True) -> DataFrame:
    """r = NTILE(n) by recency DESC, f = by frequency ASC, m = by monetary
    ASC; ties broken by ``tie`` ascending (deterministic)."""
    m = stable(metrics, "scores") if freeze else metrics
    return ntiles(m, n, {"r_score": ("recency_days", True), "f_score": ("frequency", False), "m_score": ("monetary_value", False)},
                  tie=(tie,))


def quantile_scores(metrics: DataFrame, n: int = 5, tie: str = "customer_id", freeze: bool = True) -> DataFrame:
    """Equal-frequency buckets by value (ties stay together): recency labels
    reversed (n..1), frequency and monetary 1..n."""
    m = stable(metrics, "scores") if freeze else metrics
    probs = [Fraction(i, n) for i in range(1, n)]
    edges = exact_quantiles_multi(m, ["recency_days", "frequency", "monetary_value"], probs, tie=(tie,))
    return m.withColumns({
        "r_score": bucket_by_edges("recency_days", edges["recency_days"], n, reverse=True),
        "f_score": bucket_by_edges("frequency", edges["frequency"], n),
        "m_score": bucket_by_edges("monetary_value", edges["monetary_value"], n),
    })


def segmented(metrics: DataFrame, method: str = "ntile", n: int = 5, freeze: bool = True) -> DataFrame:
    """Scores + composite + segment, all columns of ``metrics`` kept.
    ``freeze=False`` where ``metrics`` is a written table already."""
    scored = ntile_scores(metrics, n, freeze=freeze) if method == "ntile" else quantile_scores(metrics, n, freeze=freeze)
    return with_scores(scored).withColumn("segment", segment_expr())


def rfm_segments(metrics: DataFrame, freeze: bool = True) -> DataFrame:
    """Final RFM table: one row per customer, monetary rounded to 2 dp,
    ordered by composite score (then customer for a total order)."""
    from cohortlens.functions.money import round_half_up
    seg = segmented(metrics, "ntile", freeze=freeze)
    return seg.select(
        "customer_id", "country", "acquisition_channel",
        F.col("recency_days").cast("int").alias("recency_days"),
        F.col("frequency").cast("long").alias("frequency"),
        round_half_up("monetary_value", 2).alias("monetary_value"),
        "r_score", "f_score", "m_score", "rfm_total", "rfm_cell", "segment",
    ).orderBy(F.col("rfm_total").desc(), F.col("customer_id").asc())
