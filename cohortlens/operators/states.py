"""Mergeable states of the customer metrics: a refresh reads new lines only.

What ``customer_metrics`` needs of a customer is kept in three tables, each of
which a delta can be merged into:

    totals     customer -> first and last date, revenue, lines, transactions
               (min, max, sum, sum, sum)
    months     customer, word of five years -> a bit for each active month (bit_or)
    purchases  the distinct (customer, transaction) pairs, in folders that are
               only added to

A delta's pairs that no folder holds yet are new transactions: their number
per customer is added to ``totals``, and they become a folder of their own.  So
the work of a merge is that of the delta, one pass over the customer-grain
states and a join of the delta's pairs with the pairs; the line table is not
read.  The tables change together by one commit (``commits``), which fails
where another merge came in between; a delta's name is kept, so that it counts
once however often it is sent.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions.dates import days_between
from cohortlens.functions.money import line_revenue
from cohortlens.operators.bits import merged_bits, month_bits
from cohortlens.operators.metrics import _as_of_col
from cohortlens.sources.commits import CommittedTable, Conflict

_MERGED = {"first_purchase_date": F.min, "last_purchase_date": F.max, "monetary_value": F.sum, "lines": F.sum, "frequency": F.sum}


def line_totals(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("customer_id").agg(
        F.min("transaction_date").alias("first_purchase_date"), F.max("transaction_date").alias("last_purchase_date"),
        F.sum(line_revenue()).cast("decimal(38,6)").alias("monetary_value"), F.count(F.lit(1)).alias("lines"), F.lit(0).cast("long").alias("frequency"))


def purchases(transactions: DataFrame) -> DataFrame:
    return transactions.where("transaction_id IS NOT NULL").select("customer_id", "transaction_id").distinct()


class MetricStates:
    def __init__(self, spark: SparkSession, path: str):
        self.table = CommittedTable(spark, path)

    def _pairs(self, entries: dict) -> list[DataFrame]:
        return [self.table.frame(e) for k, e in sorted(entries.items()) if k.startswith("purchases-")]

    def merge(self, transactions: DataFrame, delta: str) -> bool:
        """Add the lines of ``transactions``, which must hold none that was
        added before; False where the delta of this name is in already."""
        entries = self.table.entries()
        if delta in entries.get("totals", {}).get("deltas", ()):
            return False
        pairs = purchases(transactions)
        for known in self._pairs(entries):
            same = [F.col("customer_id").eqNullSafe(F.col("__c")), F.col("transaction_id") == F.col("__t")]
            pairs = pairs.join(known.select(F.col("customer_id").alias("__c"), F.col("transaction_id").alias("__t")), same, "left_anti")
        added = self.table.write(pairs)
        new = self.table.frame(added).groupBy("customer_id").agg(F.count(F.lit(1)).alias("frequency"))
        empty = {c: F.lit(None).cast("date") for c in ("first_purchase_date", "last_purchase_date")} | {"monetary_value": F.lit(None).cast("decimal(38,6)"), "lines": F.lit(0).cast("long")}
        totals = line_totals(transactions).unionByName(new.withColumns(empty))
        months = month_bits(transactions, "customer_id")
        if "totals" in entries:
            totals, months = totals.unionByName(self.table.frame(entries["totals"])), months.unionByName(self.table.frame(entries["months"]))
        totals = totals.groupBy("customer_id").agg(*[f(c).cast("decimal(38,6)" if c == "monetary_value" else totals.schema[c].dataType).alias(c) for c, f in _MERGED.items()])
        months = merged_bits(months, "customer_id")
        changed = {"totals": self.table.write(totals, deltas=[*entries.get("totals", {}).get("deltas", ()), delta]), "months": self.table.write(months)}

        def change(now: dict) -> dict:
            if now.get("totals") != entries.get("totals"):
                raise Conflict("another merge was committed in between: merge this delta again")
            return {**now, **changed, f"purchases-{added['folder']}": added}

        try:
            self.table.commit(change)
        except Conflict:
            for e in (added, *changed.values()):
                self.table.discard(e)
            raise
        return True

    def totals(self) -> DataFrame:
        return self.table.frame(self.table.entries()["totals"])

    def active_months(self) -> DataFrame:
        """(customer_id, active_months)."""
        months = self.table.frame(self.table.entries()["months"])
        return months.groupBy("customer_id").agg(F.sum(F.bit_count("bits")).cast("int").alias("active_months"))

    def customer_metrics(self, customers: DataFrame, as_of=None) -> DataFrame:
        """The columns of ``metrics.customer_metrics`` over all merged lines."""
        attrs = customers.select("customer_id", "country", "signup_date", "acquisition_channel")
        m = attrs.join(self.totals(), "customer_id").join(self.active_months(), "customer_id", "left")
        return m.select("customer_id", "country", "signup_date", "acquisition_channel", "frequency", "last_purchase_date",
                        days_between(_as_of_col(as_of), "last_purchase_date").alias("recency_days"), "monetary_value", "first_purchase_date",
                        F.coalesce("active_months", F.lit(0)).alias("active_months"))

    def compact(self) -> None:
        """Write the purchase folders as one."""
        entries = self.table.entries()
        old = [k for k in entries if k.startswith("purchases-")]
        if len(old) < 2:
            return
        whole = self.table.write(reduce(DataFrame.unionByName, self._pairs(entries)))

        def change(now: dict) -> dict:
            if not all(k in now for k in old):
                raise Conflict("the folders were compacted in between")
            return {k: e for k, e in now.items() if k not in old} | {f"purchases-{whole['folder']}": whole}

        self.table.commit(change)
