"""Order-preserving integer keys of a table's sort orders.

A sort column becomes one or more 64-bit words whose order, word after word,
is the column's: integers as they are, dates as days, timestamps as
microseconds, decimals as their digits in groups of up to 18, doubles as
exponent and mantissa, texts as seven bytes a word and their length at last.
A descending column's words are complemented, which turns every order round
without overflow.  In front of a nullable column stands a word that is 1 for
NULL, so NULLs are last, ascending or descending.

``Keys`` takes the least and greatest value of every word in one aggregate and
lays the words out with just the bits they use, as few longs as those need
(commonly one).  Everything is plain column arithmetic: it runs inside
generated code, and a prefix of the bits is a range of the order.
"""

from __future__ import annotations

from decimal import Context, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LONG_BITS = 62          # of a packed long: sums and shifts stay positive
_DIGITS, _FRACTION = 18, 9   # of a decimal in one word, before and behind the point
_MOST_SCALE = 26             # what Spark's decimals can multiply without loss
_TEXT_BYTES = 7
_INF, _NAN = 4000, 5000  # beyond every exponent
_EXACT = Context(prec=100)
_SUBNORMAL = 1100       # added to exponents: all are positive


def _whole_words(x: Column, digits: int) -> list[Column]:
    """A whole decimal of so many digits, 18 a word, the highest first; every
    word has the number's sign."""
    out, limit = [], F.lit(Decimal(10) ** _DIGITS)
    while digits > _DIGITS:
        low = x % limit
        out.append(low.cast("long"))
        digits -= _DIGITS
        x = ((x - low) / limit).cast(T.DecimalType(digits, 0))
    return [x.cast("long"), *out[::-1]]


def _fraction_words(x: Column, digits: int) -> list[Column]:
    """A decimal from 0 to below 1, nine digits a word."""
    out = []
    for at in range(0, digits, _FRACTION):
        x = x * F.lit(Decimal(10) ** min(_FRACTION, digits - at))
        out.append(F.floor(x).cast("long"))
        x = F.pmod(x, F.lit(Decimal(1)))
    return out


def _double_words(x: Column) -> list[Column]:
    finite = (x != 0) & (F.abs(x) < float("inf"))  # NaN is above infinity
    a = F.when(finite, F.abs(x)).otherwise(F.lit(1.0))
    small = a < 2.0 ** -900
    a = F.when(small, a * 2.0 ** 200).otherwise(a)
    e = F.floor(F.log2(a)).cast("double")
    m = a * F.pow(F.lit(2.0), -e)  # a power of two: exact, and the logarithm at most one off
    e, m = F.when(m >= 2, e + 1).when(m < 1, e - 1).otherwise(e), F.when(m >= 2, m / 2).when(m < 1, m * 2).otherwise(m)
    e = (e + F.when(small, _SUBNORMAL - 200).otherwise(_SUBNORMAL)).cast("long")
    m = ((m - 1) * 2.0 ** 52).cast("long")
    sign = F.when(x < 0, F.lit(-1)).otherwise(F.lit(1)).cast("long")
    special = F.when(F.isnan(x), F.lit(_NAN)).when(x == 0, F.lit(0)).when(~finite, sign * _INF)
    return [F.coalesce(special.cast("long"), sign * e), F.when(finite, sign * m).otherwise(F.lit(0).cast("long"))]


def _before_point(kind: T.DecimalType) -> int:
    return kind.precision - kind.scale + (1 if kind.scale else 0)


def words(name: str, kind: T.DataType, longest: int = 0) -> list[Column]:
    """The words of a column (NULL where it is), for ascending order."""
    x = F.col(name)
    if isinstance(kind, T.DecimalType):
        if kind.precision <= _DIGITS:
            return [(x * F.lit(Decimal(10) ** kind.scale)).cast("long")]
        if kind.scale <= _MOST_SCALE:
            # floor may be one digit longer than what stands before the point
            whole = F.floor(x) if kind.scale else x
            return _whole_words(whole, _before_point(kind)) + _fraction_words(F.pmod(x, F.lit(Decimal(1))), kind.scale)
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return [x.cast("long")]
    if isinstance(kind, T.DateType):
        return [F.unix_date(x).cast("long")]
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return [F.unix_micros(x.cast("timestamp"))]
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return _double_words(x.cast("double"))
    if isinstance(kind, (T.StringType, T.BinaryType)):
        raw = x.cast("binary")
        part = lambda i: F.conv(F.rpad(F.hex(F.substring(raw, i * _TEXT_BYTES + 1, _TEXT_BYTES)), 2 * _TEXT_BYTES, "0"), 16, 10).cast("long")
        return [*[part(i) for i in range(-(-longest // _TEXT_BYTES))], F.octet_length(raw).cast("long")]
    raise TypeError(f"no order-preserving key for column {name!r} of type {kind.simpleString()}")


def value(parts: list[int], kind: T.DataType):
    """A number back from its words."""
    if isinstance(kind, T.DecimalType):
        if kind.precision <= _DIGITS:
            return _EXACT.scaleb(Decimal(parts[0]), -kind.scale)
        n_whole = -(-_before_point(kind) // _DIGITS)
        whole = fraction = 0
        for w in parts[:n_whole]:
            whole = whole * 10 ** _DIGITS + w
        for i, w in enumerate(parts[n_whole:]):
            fraction = fraction * 10 ** min(_FRACTION, kind.scale - i * _FRACTION) + w
        return _EXACT.add(Decimal(whole), _EXACT.scaleb(Decimal(fraction), -kind.scale))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        e, m = parts
        if abs(e) in (_INF, _NAN) or not e:
            return {_INF: float("inf"), -_INF: float("-inf"), _NAN: float("nan"), 0: 0.0}[e]
        x = (1 + abs(m) / 2.0 ** 52) * 2.0 ** max(abs(e) - _SUBNORMAL, -1000) * 2.0 ** min(abs(e) - _SUBNORMAL + 1000, 0)
        return -x if e < 0 else x
    if isinstance(kind, T.IntegralType):
        return parts[0]
    raise TypeError(f"no number: {kind.simpleString()}")


class Keys:
    """The packed keys of several sort orders of one table.

    ``orders``: name -> [(column, descending)], the last columns being the
    tie-breaker.  ``total`` is the table's number of rows."""

    def __init__(self, df: DataFrame, orders: dict[str, list[tuple[str, bool]]]):
        self.fields = {f.name: f for f in df.schema.fields}
        self.orders = orders
        names = list(dict.fromkeys(c for o in orders.values() for c, _ in o))
        texts = [c for c in names if isinstance(self.fields[c].dataType, (T.StringType, T.BinaryType))]
        longest = df.agg(*[F.max(F.octet_length(c)).alias(c) for c in texts]).first().asDict() if texts else {}
        # (column, word): a NULL mark, or a word of the value
        self.words: dict[str, list[Column]] = {}
        for c in names:
            mark = [F.col(c).isNull().cast("long")] if self.fields[c].nullable else []
            self.words[c] = mark + words(c, self.fields[c].dataType, longest.get(c) or 0)
        stats = [s.alias(f"{end}{i}_{k}") for i, c in enumerate(names) for k, w in enumerate(self.words[c]) for end, s in (("a", F.min(w)), ("b", F.max(w)))]
        row = df.agg(F.count(F.lit(1)).alias("n"), *stats).first()
        self.total = row.n
        self.span = {c: [(row[f"a{i}_{k}"] or 0, row[f"b{i}_{k}"] or 0) for k in range(len(self.words[c]))] for i, c in enumerate(names)}
        self.layout = {name: self._laid_out(order) for name, order in orders.items()}

    def _laid_out(self, order):
        """[[(column, word, descending, low, bits, high half?)]] for each long."""
        longs: list[list] = []
        for c, desc in order:
            for k, (low, high) in enumerate(self.span[c]):
                bits = (high - low).bit_length()
                if bits > LONG_BITS:  # both halves of the word, each within a long
                    pieces = [(c, k, desc, low >> 32, ((high >> 32) - (low >> 32)).bit_length(), "high"), (c, k, desc, 0, 32, "low")]
                else:
                    pieces = [(c, k, desc, low, bits, "")] if bits else []
                for piece in pieces:
                    if not longs or sum(p[4] for p in longs[-1]) + piece[4] > LONG_BITS:
                        longs.append([])
                    longs[-1].append(piece)
        return longs or [[]]

    def bits(self, name: str) -> list[int]:
        return [sum(p[4] for p in pieces) for pieces in self.layout[name]]

    def longs(self, name: str) -> list[Column]:
        """The packed key of an order, to be compared one long after the other."""
        out = []
        for pieces in self.layout[name]:
            packed = None
            for c, k, desc, low, bits, half in pieces:
                w = self.words[c][k]
                w = F.shiftright(w, 32) if half == "high" else w.bitwiseAND(F.lit(0xFFFFFFFF)) if half == "low" else w
                x = F.coalesce(w - F.lit(low).cast("long"), F.lit(0).cast("long"))
                if desc and not (k == 0 and self.fields[c].nullable):  # a NULL stays last
                    x = F.lit((1 << bits) - 1).cast("long") - x
                packed = x if packed is None else F.shiftleft(packed, bits) + x
            out.append(F.lit(0).cast("long") if packed is None else packed)
        return out

    def first_value(self, name: str, key: tuple[int, ...]):
        """The number that a packed key has as its first column (None: NULL)."""
        c, _ = self.orders[name][0]
        parts = [low for low, _ in self.span[c]]
        for packed, pieces in zip(key, self.layout[name]):
            for col, k, desc, low, bits, half in reversed(pieces):
                x, packed = packed & ((1 << bits) - 1), packed >> bits
                if col != c:
                    continue
                if desc and not (k == 0 and self.fields[c].nullable):
                    x = (1 << bits) - 1 - x
                if half:
                    parts[k] = (low + x << 32) + (parts[k] & 0xFFFFFFFF) if half == "high" else (parts[k] >> 32 << 32) + x
                else:
                    parts[k] = low + x
        if self.fields[c].nullable:
            if parts[0]:
                return None
            parts = parts[1:]
        return value(parts, self.fields[c].dataType)
