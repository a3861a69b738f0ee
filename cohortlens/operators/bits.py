"""Months as bits, and distinct counts that roll up from them.

A set of months is words of five calendar years, a bit a month, made by
``bit_or``: words merge over tasks, deltas and groups, and their size does not
grow with the lines.  Months, quarters and years lie within one word, so who was
active in a period is told by one row, and the distinct counts of all of them
come from one table of words: counts of shorter periods cannot be added up,
words can be merged.  Of lines only words are shuffled, after a map-side merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

YEARS = 5
MONTHS = 12 * YEARS     # of a word


def month_number(date: Column) -> Column:
    """Months since year 0, a number that a word and a bit come from."""
    return F.year(date) * 12 + F.month(date) - 1


def month_bits(transactions: DataFrame, *by: str) -> DataFrame:
    """(by, word, bits): the months of each group's lines.  Lines without a
    date give a NULL word without bits, so the group stays."""
    word, bit = F.expr(f"cast(_n div {MONTHS} AS int)"), F.expr(f"shiftleft(1L, cast(_n % {MONTHS} AS int))")
    numbered = transactions.select(*by, month_number(F.col("transaction_date")).alias("_n"))
    return merged_bits(numbered.select(*by, word.alias("word"), bit.alias("bits")), *by)


def merged_bits(words: DataFrame, *by: str) -> DataFrame:
    """Words of a coarser grouping, or of several tables of words together."""
    return words.groupBy(*by, "word").agg(F.bit_or("bits").alias("bits"))


def _active(grain: str, months: int) -> str:
    """SQL: the periods of so many months in which the word has a bit."""
    n, mask = MONTHS // months, (1 << months) - 1
    return (f"transform(filter(sequence(0, {n - 1}), i -> (shiftright(bits, i * {months}) & {mask}L) <> 0), "
            f"i -> struct('{grain}' AS grain, make_date(cast((word * {MONTHS} + i * {months}) div 12 AS int), (i * {months}) % 12 + 1, 1) AS period))")


def period_counts(words: DataFrame, who: str, *by: str, name: str = "n") -> DataFrame:
    """(by, grain, period, n): how many different ``who`` are active in each
    month, quarter and year (``period``: its first day; periods without any
    have no row) and in ``all`` (NULL period), from their words.  A NULL ``who``
    is nobody.  Each row of ``words`` is one (by, who, word), so counting rows
    counts ``who``; only the whole looks at ``who`` once more."""
    words = words.where(F.col(who).isNotNull() & F.col("word").isNotNull())
    parts = ", ".join([_active("month", 1), _active("quarter", 3), _active("year", 12)])
    active = words.select(*by, F.explode(F.expr(f"concat({parts})")).alias("p")).select(*by, "p.grain", "p.period")
    whole = words.select(*by, who).distinct().select(*by, F.lit("all").alias("grain"), F.lit(None).cast("date").alias("period"))
    return active.unionByName(whole).groupBy(*by, "grain", "period").agg(F.count(F.lit(1)).alias(name))
