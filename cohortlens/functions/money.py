"""Exact money arithmetic and engine-independent rounding."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

REVENUE_TYPE = "decimal(18,6)"


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def line_revenue(quantity="quantity", unit_price="unit_price", discount_pct="discount_pct") -> Column:
    """quantity x unit_price x (1 - discount/100), NULL discount counts as 0.

    Computed as ``q * p * (100 - d) * 0.01`` in DECIMAL, which is exact (at most
    six decimals for a 2-dp price and a 2-dp percent), then pinned to
    DECIMAL(18,6) so that sums do not widen to DECIMAL(38,x).
    """
    d = F.coalesce(_c(discount_pct), F.lit(Decimal("0")).cast("decimal(5,2)"))
    gross = _c(quantity).cast("decimal(10,0)") * _c(unit_price).cast("decimal(10,2)")
    net = gross * (F.lit(Decimal("100")).cast("decimal(5,2)") - d) * F.lit(Decimal("0.01"))
    return net.cast(REVENUE_TYPE)


def round_half_up(c, digits: int) -> Column:
    """Round half away from zero through DECIMAL(28,8) and return DOUBLE.

    Going through a fixed decimal makes the result identical whatever the
    input type (decimal average, double ratio) and whichever engine computes
    it; a bare ``round(double)`` depends on binary representation.
    """
    return F.round(_c(c).cast("decimal(28,8)"), digits).cast("double")


def pct(part, whole, digits: int = 2) -> Column:
    """``part * 100 / whole`` in DOUBLE, NULL when ``whole`` is 0, rounded."""
    ratio = _c(part).cast("double") * F.lit(100.0) / F.nullif(_c(whole).cast("double"), F.lit(0.0))
    return round_half_up(ratio, digits)
