"""Aggregate helpers whose results do not depend on summation order.

``mean(x)`` is ``CAST(SUM(x) AS DOUBLE) / COUNT(x)``: the sum is exact
(integer or DECIMAL), so the only floating-point step is one division and
every engine (and every partitioning) yields the same double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def mean(c) -> Column:
    c = _c(c)
    return F.sum(c).cast("double") / F.nullif(F.count(c), F.lit(0)).cast("double")


def total(c) -> Column:
    return F.sum(_c(c))
