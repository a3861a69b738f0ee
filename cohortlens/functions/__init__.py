"""Column-level helpers: every function returns a ``pyspark.sql.Column``
built from built-in Spark expressions (no Python UDFs)."""

from cohortlens.functions.dates import (days_between, month_label, month_number, month_start,
                                        parse_month, quarter, year)
from cohortlens.functions.lookups import COUNTRY_NAMES, REGION_OF, lookup, map_column
from cohortlens.functions.money import line_revenue, pct, round_half_up
from cohortlens.functions.segments import SEGMENT_RANK, SEGMENT_RULES, segment_expr

__all__ = [
    "COUNTRY_NAMES", "REGION_OF", "SEGMENT_RANK", "SEGMENT_RULES", "days_between", "line_revenue",
    "lookup", "map_column", "month_label", "month_number", "month_start", "parse_month", "pct",
    "quarter", "round_half_up", "segment_expr", "year",
]
