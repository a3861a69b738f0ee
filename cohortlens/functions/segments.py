"""RFM score -> named segment.

The rules are data: an ordered list of score boxes.  The first box that
contains ``(r, f, m)`` names the segment; anything no box covers is the
fallback.  ``segment_expr`` folds the list into one native CASE WHEN, so the
mapping runs inside whole-stage codegen (no Python UDF).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ANY = (1, 5)

# ---- fixed values (must equal the reference's segmentation) ---------------
# Ordered rules, first match wins. Each entry: segment, r range, f range,
# m range (inclusive score bounds on a 1..5 scale).  At-Risk is the union of
# two boxes (f >= 3 or m >= 3), listed together at its position in the order.
SEGMENT_RULES: list[tuple[str, tuple[int, int], tuple[int, int], tuple[int, int]]] = [
    ("Champion", (5, 5), (4, 5), (4, 5)),
    ("Loyal Customer", ANY, (4, 5), (3, 5)),
    ("Potential Loyalist", (4, 5), (2, 4), ANY),
    ("New Customer", (4, 5), (1, 2), ANY),
    ("Promising", (3, 3), (1, 2), ANY),
    ("Need Attention", (3, 3), (3, 3), (3, 3)),
    ("At-Risk", (1, 2), (3, 5), ANY),
    ("At-Risk", (1, 2), ANY, (3, 5)),
    ("Cannot Lose Them", (1, 1), (4, 5), ANY),
    ("Hibernating", (1, 2), (1, 2), (2, 5)),
]
FALLBACK_SEGMENT = "Lost"

# Sort rank of each segment in the BI extract; unknown labels rank 10.
SEGMENT_RANK: dict[str, int] = {
    "Champion": 1, "Loyal Customer": 2, "Potential Loyalist": 3,
    "New Customer": 4, "Promising": 5, "Need Attention": 6,
    "At-Risk": 7, "Hibernating": 8, "Cannot Lose Them": 9, "Lost": 10,
}
SEGMENT_RANK_DEFAULT = 10
# ---------------------------------------------------------------------------


def _within(c: Column, bounds: tuple[int, int]) -> Column | None:
    lo, hi = bounds
    if (lo, hi) == ANY:
        return None
    if lo == hi:
        return c == lo
    if lo == ANY[0]:
        return c <= hi
    if hi == ANY[1]:
        return c >= lo
    return c.between(lo, hi)


def _box(r: Column, f: Column, m: Column, box) -> Column:
    parts = [p for p in (_within(r, box[0]), _within(f, box[1]), _within(m, box[2])) if p is not None]
    cond = parts[0]
    for p in parts[1:]:
        cond = cond & p
    return cond


def segment_expr(r="r_score", f="f_score", m="m_score", rules=None, fallback: str = FALLBACK_SEGMENT) -> Column:
    """CASE WHEN chain over the ordered rule boxes."""
    r, f, m = (F.col(x) if isinstance(x, str) else x for x in (r, f, m))
    expr = None
    for label, *box in (rules or SEGMENT_RULES):
        cond = _box(r, f, m, box)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(fallback))


def segment_rank(segment="segment") -> Column:
    """Segment -> display rank (default 10) as a literal map lookup."""
    from cohortlens.functions.lookups import map_column
    return F.coalesce(map_column(SEGMENT_RANK, segment), F.lit(SEGMENT_RANK_DEFAULT)).cast("int")
