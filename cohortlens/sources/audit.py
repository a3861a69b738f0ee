"""Constraint audit: the declared table constraints (primary key / unique,
NOT NULL, CHECK, foreign key) re-aimed as a report of violating rows.

All NOT NULL / CHECK rules and the key uniqueness count of a table are one
aggregate, unpivoted to (table, rule, violations) rows.  A foreign key counts
child rows by key first (a partial aggregate), so the ``left_anti`` join meets
each key once.  A rule whose column the table lacks is listed as unchecked:
its violations are NULL.  ``witnesses`` gives the violating keys themselves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RULES = {
    "customers": {"unique": ["customer_id", "email"], "not_null": ["customer_id", "email", "country", "signup_date"]},
    "products": {"unique": ["product_id"], "not_null": ["product_id", "product_name", "unit_price"]},
    "transactions": {"unique": ["transaction_id"],
                     "not_null": ["transaction_id", "customer_id", "product_id", "transaction_date", "quantity", "unit_price"],
                     "checks": {"quantity>0": ("quantity", "quantity > 0")}},
}
# child table, its column, parent table, its column
FOREIGN_KEYS = [("transactions", "customer_id", "customers", "customer_id"),
                ("transactions", "product_id", "products", "product_id")]


def table_audit(df: DataFrame, table: str, unique=(), not_null=(), checks=None) -> DataFrame:
    unchecked = F.lit(None).cast("long")
    rules = {}
    for c in unique:
        rules[f"unique:{c}"] = F.count(F.col(c)) - F.count_distinct(c) if c in df.columns else unchecked
    for c in not_null:
        rules[f"not_null:{c}"] = F.count_if(F.col(c).isNull()) if c in df.columns else unchecked
    for name, (c, cond) in (checks or {}).items():
        rules[f"check:{name}"] = F.count_if(~F.expr(cond)) if c in df.columns else unchecked
    # count(*) keeps a table of unchecked rules an aggregate
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.max(v).alias(k) if v is unchecked else v.cast("long").alias(k) for k, v in rules.items()])
    return one.drop("_rows").unpivot([], list(rules), "rule", "violations").select(F.lit(table).alias("table_name"), "rule", "violations")


def foreign_key_audit(child: DataFrame, child_table: str, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    keys = child.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    orphans = keys.join(parent.select(F.col(parent_col).alias("_key")), "_key", "left_anti")
    return orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("violations")).select(
        F.lit(child_table).alias("table_name"), F.lit(f"foreign_key:{col}").alias("rule"), "violations")


def audit(tables: dict[str, DataFrame], rules=None, foreign_keys=None) -> DataFrame:
    """(table_name, rule, violations) for every rule over the given tables."""
    parts = [table_audit(tables[name], name, r.get("unique", ()), r.get("not_null", ()), r.get("checks"))
             for name, r in (RULES if rules is None else rules).items() if name in tables]
    parts += [foreign_key_audit(tables[child], child, col, tables[parent], pcol)
              for child, col, parent, pcol in (FOREIGN_KEYS if foreign_keys is None else foreign_keys) if child in tables and parent in tables]
    return reduce(DataFrame.unionByName, parts)


def table_witnesses(df: DataFrame, table: str, unique=(), not_null=(), checks=None) -> DataFrame:
    """The keys behind ``table_audit``: a value that rows share, or the key of
    rows with a NULL or a failed check (the first unique column)."""
    columns = set(df.columns)
    rules = {f"not_null:{c}": F.col(c).isNull() for c in not_null if c in columns}
    rules |= {f"check:{name}": ~F.expr(cond) for name, (c, cond) in (checks or {}).items() if c in columns}
    key = next((F.col(c).cast("string") for c in unique if c in columns), F.lit(None).cast("string"))
    parts = []
    if rules:
        broken = F.array_compact(F.array(*[F.when(v, F.lit(r)) for r, v in rules.items()]))
        parts.append(df.select(F.explode(broken).alias("rule"), key.alias("witness")).groupBy("rule", "witness").agg(F.count(F.lit(1)).alias("rows")))
    for c in unique:
        if c in columns:
            shared = df.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("witness")).agg((F.count(F.lit(1)) - 1).alias("rows"))
            parts.append(shared.where("rows > 0").select(F.lit(f"unique:{c}").alias("rule"), "witness", "rows"))
    if not parts:
        return df.sparkSession.createDataFrame([], "table_name string, rule string, witness string, rows long")
    return reduce(DataFrame.unionByName, parts).select(F.lit(table).alias("table_name"), "rule", "witness", F.col("rows").cast("long").alias("rows"))


def witnesses(tables: dict[str, DataFrame], rules=None, foreign_keys=None) -> DataFrame:
    """(table_name, rule, witness, rows): what ``audit`` counts, by key; the
    rows of a rule add up to its violations.  Keys are counted before any
    shuffle, and a foreign key's join meets each of them once."""
    parts = [table_witnesses(tables[name], name, r.get("unique", ()), r.get("not_null", ()), r.get("checks"))
             for name, r in (RULES if rules is None else rules).items() if name in tables]
    for child, col, parent, pcol in (FOREIGN_KEYS if foreign_keys is None else foreign_keys):
        if child in tables and parent in tables:
            keys = tables[child].where(F.col(col).isNotNull()).groupBy(F.col(col).alias("_key")).agg(F.count(F.lit(1)).alias("rows"))
            orphans = keys.join(tables[parent].select(F.col(pcol).alias("_key")), "_key", "left_anti")
            parts.append(orphans.select(F.lit(child).alias("table_name"), F.lit(f"foreign_key:{col}").alias("rule"), F.col("_key").cast("string").alias("witness"), "rows"))
    return reduce(DataFrame.unionByName, parts)
