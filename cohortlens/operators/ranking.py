"""Exact order statistics by radix selection: NTILE, quantiles and medians
without sorting, shuffling or gathering the table.

``F.ntile(n).over(Window.orderBy(x))`` plans ``Exchange SinglePartition``:
every customer goes through one task.  But NTILE(n) needs only the n - 1 rows
at which tiles end, a quantile the two rows around it, a median the middle
ones.  Every sort order becomes a packed integer key (``keys``), a prefix of
whose bits is a range of the order, so positions are found digit by digit:

1. one aggregate counts rows by the key's next bits (at most ``CELLS``
   values), for all metrics of a table or all groups at once; it is combined
   before the shuffle and its result does not grow with the table;
2. running sums over those counts say which cells hold a wanted position, and
   only their rows go on: to their next bits while a cell holds more than
   ``LEAF`` rows, else to a window over the cell.

Every size takes this path; a round leaves about one row in ``CELLS /
positions``, and the bits of a key bound the rounds.  Keys end with a unique
tie-breaker, so a value shared by a third of all rows is cut like any other;
where a key's bits are used up, its rows are equal in every part, and the key
itself is the answer.  There is no sample, no table of split points, and no
lambda: cells are shifts of a long.  NULLs sort last in every part of a key,
and a NULL group is a group.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.operators.keys import Keys
from cohortlens.session import stable_counted

CELLS = 1024            # of one round, a power of two
LEAF = 50_000           # rows that one task may sort

RANK = "_rank"


# ---------------------------------------------------------------- whole tables

class _Cell:
    """Rows whose key begins with ``done`` (whole longs) and ``prefix``."""

    def __init__(self, metric: int, bits: list[int], n: int, wanted: list[int], done=(), prefix=0, left=None, before=0):
        self.metric, self.bits, self.n, self.wanted = metric, bits, n, wanted
        self.done, self.prefix, self.before = done, prefix, before
        self.left = bits[len(done)] if left is None and len(done) < len(bits) else left or 0
        while len(self.done) < len(bits) and not self.left:  # on to the next long
            self.done, self.prefix = (*self.done, self.prefix), 0
            self.left = bits[len(self.done)] if len(self.done) < len(bits) else 0

    @property
    def whole(self) -> bool:
        return len(self.done) == len(self.bits)

    def holds(self, longs: list[Column]) -> Column:
        """Whether a row of this cell's metric lies in it."""
        at = F.col("_m") == self.metric
        for k, x in zip(longs, self.done):
            at = at & (k == x)
        if not self.whole and self.left < self.bits[len(self.done)]:
            at = at & (F.shiftright(longs[len(self.done)], self.left) == self.prefix)
        return at

    def step(self) -> int:
        return min(CELLS.bit_length() - 1, self.left)

    def digit(self, longs: list[Column]) -> Column:
        """The next bits of a row in this cell."""
        return F.shiftright(longs[len(self.done)], self.left - self.step()).bitwiseAND(F.lit((1 << self.step()) - 1))

    def split(self, counts: dict[int, int]):
        """The cells one digit deeper that hold wanted positions."""
        before = self.before
        for digit in sorted(counts):
            n = counts[digit]
            wanted = [p for p in self.wanted if before < p <= before + n]
            if wanted:
                yield _Cell(self.metric, self.bits, n, wanted, self.done, self.prefix << self.step() | digit, self.left - self.step(), before)
            before += n


def _keys_at(df: DataFrame, keys: Keys, positions: list[int]) -> dict[str, dict[int, tuple[int, ...]]]:
    """For each order of ``keys`` the packed key at each 1-based position."""
    names = list(keys.orders)
    width = max(len(keys.bits(m)) for m in names)
    longs = {m: keys.longs(m) + [F.lit(0).cast("long")] * (width - len(keys.bits(m))) for m in names}
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("_m"), *[x.alias(f"_k{j}") for j, x in enumerate(longs[m])]) for i, m in enumerate(names)]))
    rows = df.select(each.alias("_r")).select("_r.*")
    cols = [F.col(f"_k{j}") for j in range(width)]
    out: dict[str, dict[int, tuple[int, ...]]] = {m: {} for m in names}
    cells = [_Cell(i, keys.bits(m), keys.total, positions) for i, m in enumerate(names)]
    leaves = []

    def chosen(some: list[_Cell], what) -> Column:
        found = None
        for i, c in enumerate(some):
            x = what(i, c)
            found = F.when(c.holds(cols), x) if found is None else found.when(c.holds(cols), x)
        return found

    first = True
    while cells:
        done = [c for c in cells if c.whole]
        leaves += [c for c in cells if not c.whole and c.n <= LEAF and not first]
        cells = [c for c in cells if not c.whole and (c.n > LEAF or first)]
        for c in done:
            out[names[c.metric]] |= {p: c.done for p in c.wanted}
        if cells:
            counted = (rows.select(chosen(cells, lambda i, c: F.lit(i)).alias("_c"), chosen(cells, lambda i, c: c.digit(cols)).alias("_d"))
                       .where("_c IS NOT NULL").groupBy("_c", "_d").agg(F.count(F.lit(1)).alias("_n")))
            counts: dict[int, dict[int, int]] = {}
            for r in counted.collect():  # at most CELLS for each open cell
                counts.setdefault(r["_c"], {})[r["_d"]] = r["_n"]
            cells = [x for i, c in enumerate(cells) for x in c.split(counts.get(i, {}))]
        first = False
    if leaves:
        inside = rows.withColumn("_c", chosen(leaves, lambda i, c: F.lit(i))).where("_c IS NOT NULL")
        inside = inside.withColumn(RANK, F.row_number().over(Window.partitionBy("_c").orderBy(*cols)))
        want = None
        for i, c in enumerate(leaves):
            hit = (F.col("_c") == i) & F.col(RANK).isin([p - c.before for p in c.wanted])
            want = hit if want is None else want | hit
        for r in inside.where(want).collect():
            c = leaves[r["_c"]]
            out[names[c.metric]][r[RANK] + c.before] = tuple(r[f"_k{j}"] for j in range(len(c.bits)))
    return out


def tile_ends(total: int, n: int) -> list[int]:
    """Last 1-based position of each NTILE(n) tile but the last: the first
    ``total % n`` tiles hold one row more."""
    q, rem = divmod(total, n)
    ends = [t * q + min(t, rem) for t in range(1, n)]
    return [e for e in ends if 0 < e < total]


def _above(longs: list[Column], edge: tuple[int, ...]) -> Column:
    """key > edge, one long after the other."""
    above = longs[-1] > edge[-1]
    for x, e in zip(longs[-2::-1], edge[-2::-1]):
        above = (x > e) | ((x == e) & above)
    return above


def ntiles(df: DataFrame, n: int, scores: dict[str, tuple[str, bool]], tie=("customer_id",),
           total: int | None = None, source: DataFrame | None = None) -> DataFrame:
    """Add ``NTILE(n) OVER (ORDER BY col [DESC], tie)`` for each
    ``{out: (col, desc)}``: the keys of the tiles' last rows are selected, all
    metrics in one pass, and each row's key is compared with them; ``df``
    itself is neither shuffled nor joined.  ``source``: a written table with
    the same rows.  ``total`` is not needed, the selection counts the rows."""
    src = df if source is None else source
    keys = Keys(src, {m: [(c, bool(desc)), *[(t, False) for t in tie]] for m, (c, desc) in scores.items()})
    ends = tile_ends(keys.total, n)
    edges = _keys_at(src, keys, ends) if ends else {m: {} for m in scores}
    out = {}
    for m in scores:
        tile = F.lit(1)
        for e in ends:
            tile = tile + _above(keys.longs(m), edges[m][e]).cast("int")
        # fewer rows than tiles: each row is a tile of its own
        out[m] = tile.cast("int")
    return df.withColumns(out)


def global_ntile(df: DataFrame, n: int, order, out: str, tie=("customer_id",), total: int | None = None,
                 source: DataFrame | None = None) -> DataFrame:
    """``NTILE(n) OVER (ORDER BY order, tie)`` for one column."""
    o, = order
    return ntiles(df, n, {out: (o, False) if isinstance(o, str) else (o[0], bool(o[1]))}, tie, total, source)


def _positions(total: int, probs):
    """0-based (lower, upper, fraction) order statistics per probability."""
    out = {}
    for p in probs:
        h = (total - 1) * Fraction(str(p))
        lo = math.floor(h)
        out[p] = (lo, min(lo + 1, total - 1), h - lo)
    return out


def exact_quantiles_multi(df: DataFrame, cols, probs, tie=("customer_id",), total: int | None = None) -> dict[str, list[float]]:
    """Linearly interpolated quantiles (numpy/pandas default, SQL
    ``quantile_cont``), exact, for several non-null columns in one selection;
    at most 2 * len(probs) values a column reach the driver."""
    keys = Keys(df, {c: [(c, False), *[(t, False) for t in tie]] for c in cols})
    if keys.total == 0:
        return {c: [] for c in cols}
    wanted = _positions(keys.total, probs)
    positions = sorted({x + 1 for lo, hi, _ in wanted.values() for x in (lo, hi)})
    got = _keys_at(df, keys, positions)
    out = {}
    for c in cols:
        at = {p: float(keys.first_value(c, k)) for p, k in got[c].items()}
        out[c] = [at[lo + 1] if frac == 0 or at[lo + 1] == at[hi + 1] else at[lo + 1] + (at[hi + 1] - at[lo + 1]) * float(frac)
                  for lo, hi, frac in (wanted[p] for p in probs)]
    return out


def exact_quantiles(df: DataFrame, col: str, probs, tie=("customer_id",), total: int | None = None) -> list[float]:
    return exact_quantiles_multi(df, [col], probs, tie=tie, total=total)[col]


def bucket_by_edges(col: str, edges, n: int, reverse: bool = False) -> Column:
    """1 + #{edges < x} (right-closed bins, lowest included); ``reverse``
    labels n..1.  Tied edges leave a bucket empty instead of failing."""
    x = F.col(col).cast("double")
    b = F.lit(1)
    for e in edges:
        b = b + (x > F.lit(float(e))).cast("int")
    b = b.cast("int")
    return (F.lit(n + 1) - b).cast("int") if reverse else b


def quantile_bucket(df: DataFrame, col: str, n: int, out: str, reverse: bool = False,
                    tie=("customer_id",), total: int | None = None, source: DataFrame | None = None) -> DataFrame:
    """Equal-frequency buckets by value (quantile cut): bucket = 1 + number
    of interior quantile edges below x."""
    edges = exact_quantiles(df if source is None else source, col, [Fraction(i, n) for i in range(1, n)], tie=tie, total=total)
    return df.withColumn(out, bucket_by_edges(col, edges, n, reverse))


def approx_quantiles(df: DataFrame, cols, probs, accuracy: int = 10_000) -> dict[str, list[float]]:
    """Opt-in approximate edges: ``percentile_approx`` keeps a bounded
    sketch per task (O(accuracy) entries) and merges sketches, so memory
    does not grow with the data.  One aggregate for all columns."""
    arr = F.array(*[F.lit(float(p)) for p in probs])
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), arr, accuracy).alias(c) for c in cols]).first()
    return {c: [float(v) for v in (row[c] or [])] for c in cols}


def grouped_median(df: DataFrame, group: list[str], col: str, out: str = "median",
                   tie=("customer_id",), approx: bool = False, accuracy: int = 10_000) -> DataFrame:
    """Exact median per group (the mean of the one or two middle rows), by
    selection: no group is gathered into one task.  ``df`` is read once a
    round: pass a written table."""
    if approx:
        # Bounded sketch per group instead of the exact rank.
        return df.groupBy(*group).agg(F.percentile_approx(F.col(col).cast("double"), 0.5, accuracy).alias(out))
    base = df.where(F.col(col).isNotNull()).select(*group, col, *tie)
    keys = Keys(base, {"k": [(col, False), *[(t, False) for t in tie]]})
    longs, bits = keys.longs("k"), keys.bits("k")
    names = [f"_g{i}" for i in range(len(group))]
    rows = base.select(*[F.col(g).alias(n) for g, n in zip(group, names)], F.col(col).alias("_v"), *[x.alias(f"_k{i}") for i, x in enumerate(longs)],
                       F.lit(0).cast("long").alias("_cell"))
    # rows of one cell share the group and all bits so far; a digit is the next ones
    held, digits = None, [(i, left - step, step) for i, b in enumerate(bits) for left in _lefts(b) for step in [min(CELLS.bit_length() - 1, left)]]
    same = [F.col(n).eqNullSafe(F.col(f"_h{i}")) for i, n in enumerate(names)]
    for at, (k, shift, step) in enumerate(digits or [(0, 0, 0)]):
        rows = rows.withColumn("_d", F.shiftright(f"_k{k}", shift).bitwiseAND(F.lit((1 << step) - 1)))
        counts = rows.groupBy(*names, "_cell", "_d").agg(F.count(F.lit(1)).alias("_n"))
        # the counts are few: cells of a round, and groups
        below = Window.partitionBy(*names, "_cell").orderBy("_d").rowsBetween(Window.unboundedPreceding, -1)
        every = Window.partitionBy(*names)
        if held is None:
            counts = counts.withColumns({"_size": F.sum("_n").over(every), "_before": F.lit(0).cast("long")})
        else:
            counts = counts.join(held.select(*[F.col(n).alias(f"_h{i}") for i, n in enumerate(names)], F.col("_new").alias("_hc"), "_size", F.col("_from").alias("_before")),
                                 [*same, F.col("_cell") == F.col("_hc")]).drop("_hc", *[f"_h{i}" for i in range(len(names))])
        counts = counts.withColumn("_from", F.col("_before") + F.coalesce(F.sum("_n").over(below), F.lit(0)))
        low, high = F.floor((F.col("_size") + 1) / 2), F.floor(F.col("_size") / 2) + 1
        inside = lambda p: (p > F.col("_from")) & (p <= F.col("_from") + F.col("_n"))
        kept = counts.where(inside(low) | inside(high))
        # at most two cells of a group stay, so a bit a round tells them apart
        new = (F.col("_cell") * 2 + F.row_number().over(Window.partitionBy(*names, "_cell").orderBy("_d")) - 1).cast("long")
        held, _ = stable_counted(kept.select(*names, "_cell", "_d", "_n", "_from", "_size", new.alias("_new")), "median-cells")
        to = held.select(*[F.col(n).alias(f"_h{i}") for i, n in enumerate(names)], F.col("_cell").alias("_hc"), F.col("_d").alias("_hd"), "_new", "_from", "_size")
        rows = rows.join(to, [*same, F.col("_cell") == F.col("_hc"), F.col("_d") == F.col("_hd")])
        rows = rows.select(*names, "_v", *[f"_k{i}" for i in range(len(bits))], F.col("_new").alias("_cell"), "_from", "_size")
        most = held.agg(F.max("_n")).first()[0] or 0
        if most <= LEAF or at == len(digits) - 1:
            break
        rows, _ = stable_counted(rows.drop("_from", "_size"), "median-rows")
    low, high = F.floor((F.col("_size") + 1) / 2), F.floor(F.col("_size") / 2) + 1
    if most <= LEAF:
        nth = F.row_number().over(Window.partitionBy(*names, "_cell").orderBy(*[f"_k{i}" for i in range(len(bits))])) + F.col("_from")
        middle = rows.withColumn(RANK, nth).where((F.col(RANK) == low) | (F.col(RANK) == high)).groupBy(*names).agg(F.avg("_v").alias(out))
    else:
        # all bits are used: a cell's rows are equal, one stands for its wanted positions
        value = rows.groupBy(*names, "_cell").agg(F.min("_v").alias("_v"))
        middle = value.groupBy(*names).agg(F.avg("_v").alias(out))
    return middle.select(*[F.col(n).alias(g) for g, n in zip(group, names)], out)


def _lefts(bits: int) -> list[int]:
    """How many bits of a long are left before each digit."""
    return list(range(bits, 0, -(CELLS.bit_length() - 1)))
