"""Calendar helpers (month buckets, quarters, month offsets, day gaps)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(d: ColumnOrName) -> Column:
    """First day of the month as a DATE (``trunc`` keeps DateType)."""
    return F.trunc(_c(d), "month")


def quarter(d: ColumnOrName) -> Column:
    return F.quarter(_c(d))


def year(d: ColumnOrName) -> Column:
    return F.year(_c(d))


def month_number(activity: ColumnOrName, cohort: ColumnOrName) -> Column:
    """Whole calendar months from ``cohort`` to ``activity`` (both any day of
    their month): 12 * year difference + month difference, as INT."""
    a, c = _c(activity), _c(cohort)
    return ((F.year(a) - F.year(c)) * 12 + (F.month(a) - F.month(c))).cast("int")


def days_between(end: ColumnOrName, start: ColumnOrName) -> Column:
    """``end - start`` in days, as INT."""
    return F.datediff(_c(end), _c(start))


def month_label(d: ColumnOrName) -> Column:
    """``yyyy-MM`` text of a date's month."""
    return F.date_format(_c(d), "yyyy-MM")


def parse_month(s: ColumnOrName) -> Column:
    """``yyyy-MM`` (or a full date) text to the month's first day; NULL stays
    NULL, and malformed text raises (in ANSI mode, Spark's default)."""
    c = _c(s)
    return F.trunc(F.coalesce(F.try_to_date(c, "yyyy-MM"), F.to_date(c, "yyyy-MM-dd")), "month")
