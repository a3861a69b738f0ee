"""Column defaults of the declared tables: generated ids, creation
timestamps and a zero discount, applied where a value is NULL."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULTS = {
    "customers": {"customer_id": "uuid", "created_at": "now"},
    "products": {"product_id": "uuid", "created_at": "now"},
    "transactions": {"transaction_id": "uuid", "created_at": "now", "discount_pct": Decimal("0")},
}


def _default_expr(kind, dtype):
    if kind == "uuid":
        return F.expr("uuid()").cast(dtype)
    if kind == "now":
        return F.current_timestamp().cast(dtype)
    return F.lit(kind).cast(dtype)


def apply_defaults(df: DataFrame, table: str) -> DataFrame:
    """COALESCE each defaulted column that exists in ``df`` with its default.

    Generated ids are only produced for string keys (a numeric key column
    keeps its NULLs, which the audit then reports)."""
    out = df
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    for col, kind in DEFAULTS[table].items():
        if col not in types:
            continue
        if kind == "uuid" and types[col].simpleString() != "string":
            continue
        out = out.withColumn(col, F.coalesce(F.col(col), _default_expr(kind, types[col])))
    return out
