"""Embedding whitening: exact covariance from bit-sliced cross-products.

Components are integers, ``floor(256 * x)`` with x as double.  The fit list
holds each distinct vector once.  A task takes it a chunk of rows at a time:
each dimension is shifted by its least value in the chunk, and every bit plane
of the shifted values is packed across the rows into 64-bit words.  A product
sum of two dimensions is then the sum, over pairs of their planes, of
2**(a + b) times the number of rows with both bits set, an AND and a popcount;
the shifts are put back as whole numbers.  Sums of all chunks and tasks are
added as 32-bit limbs, so they are exact for any size of table and values.
Centring, n * sum(x y) - sum(x) * sum(y), is done in integers as well; only
the quotient by n**2 is a double, and goes to ``eigh``.

Every table has a fit for each length of vectors it holds (commonly one);
``n``, components and the identity error belong to the length.

Work: a task sends one row for each pair of dimensions, whatever its rows; one
task solves a length's eigenproblem, of d x d numbers; the rows are whitened
where they lie, with no shuffle but the one that makes the fit list distinct.
The models reach the tasks in groups of at most ``MODEL_CELLS`` numbers, a pass
over the rows for each group, so no broadcast grows with the table.

Defined results
* a vector that is null or holds a null or non-finite component is dropped;
* repeated rows, null or repeated vec_ids stay rows; the fit counts a vector once;
* a component's largest entry (the first of equals) is positive; components
  without variance are left out, so a table of one distinct vector, or of empty
  ones, has no rows; equal eigenvalues take the axes that ``eigh`` gives;
* a deviation beyond a long is the largest long;
* an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import freeze, lean, table

CHUNK_ROWS = 4096        # 64 words of each plane
UNIT_BITS = 16           # planes whose weighted counts are added as machine integers
LIMBS = 7                # of 32 bits: sums of products below 2**(64 + 64 + 64)
MODEL_CELLS = 1 << 20
TOL = 1e-13              # of the trace: what is below is no variance
_LONG = (1 << 63) - 1


def quantized(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, x): integer components of every vector that takes part."""
    v = F.col(vec_col)
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) != float("inf")))
    return (vectors.where(v.isNotNull() & fine)
            .select(F.col(id_col).cast("long").alias("vec_id"), F.transform(v, lambda c: F.floor(c.cast("double") * 256)).alias("x")))


# ---------------------------------------------------------------- scatter

class Planes:
    """Bit planes of a chunk's shifted dimensions, packed across rows."""

    def __init__(self, x: np.ndarray):
        """x: (rows, dims) of int64."""
        self.low = x.min(0)
        u = x.T.astype(np.uint64) - self.low.astype(np.uint64)[:, None]  # modulo 2**64: always the true difference
        bits = [int(m).bit_length() for m in u.max(1)]
        words = -(-len(x) // 64)
        flat = np.zeros((sum(bits), words * 64), np.uint8)
        at, self.dim, self.bit = 0, [], []
        for d, b in enumerate(bits):
            for k in range(b):
                flat[at, :len(x)] = (u[d] >> np.uint64(k)) & np.uint64(1)
                self.dim.append(d)
                self.bit.append(k)
                at += 1
        self.words = np.packbits(flat, axis=1, bitorder="little").view("<u8")
        # a unit is a dimension's run of planes whose weights stay small
        unit = [(d, b // UNIT_BITS) for d, b in zip(self.dim, self.bit)]
        self.first = [i for i in range(at) if i == 0 or unit[i] != unit[i - 1]]
        self.units = [unit[i] for i in self.first]
        self.of = np.searchsorted(self.first, np.arange(at), "right") - 1
        self.weight = np.array([1 << (b % UNIT_BITS) for b in self.bit], np.int64)

    def sums(self) -> list[int]:
        out = [0] * len(self.low)
        for d, b, n in zip(self.dim, self.bit, np.bitwise_count(self.words).sum(1, dtype=np.int64).tolist()):
            out[d] += n << b
        return out

    def products(self) -> np.ndarray:
        """Sums of u_i * u_j as Python integers, (dims, dims)."""
        by_unit = np.zeros((len(self.units), len(self.units)), np.int64)
        for i in range(len(self.words)):
            both = np.bitwise_count(self.words[i:] & self.words[i]).sum(1, dtype=np.int64) * self.weight[i:]
            both[1:] *= 2  # planes i and j as j and i
            first = int(self.of[i])
            starts = np.maximum(np.array(self.first[first:]) - i, 0)
            by_unit[first, first:] += self.weight[i] * np.add.reduceat(both, starts)
        dims = len(self.low)
        out = np.zeros((dims, dims), object)
        for p, (d, a) in enumerate(self.units):
            for q in np.flatnonzero(by_unit[p]).tolist():
                e, b = self.units[q]
                out[d, e] += int(by_unit[p, q]) << (UNIT_BITS * (a + b))
        # a pair of planes counted twice above: once in each triangle
        half = np.triu(out, 1) // 2
        return np.diag(np.diag(out)) + half + half.T


def scatter(x: np.ndarray):
    """(sums, products) of the columns of x, exact, as Python integers."""
    p = Planes(x)
    u, uu, low, n = np.array(p.sums(), object), p.products(), p.low.astype(object), len(x)
    cross = np.outer(low, u)
    return u + n * low, uu + cross + cross.T + n * np.outer(low, low)


def _limbs(value: int) -> list[int]:
    """Little-endian 32-bit limbs; the last one has the sign."""
    return [*(value >> (32 * k) & 0xFFFFFFFF for k in range(LIMBS - 1)), value >> (32 * (LIMBS - 1))]


def _by_length(batch, column: str):
    """(dims, row numbers, (rows, dims) values) for each length in a batch."""
    col = batch.column(column)
    offsets = col.offsets.to_numpy()
    flat = col.values.to_numpy(zero_copy_only=False)
    size = np.diff(offsets)
    for d in np.unique(size).tolist():
        rows = np.flatnonzero(size == d)
        yield d, rows, flat[offsets[:-1][rows][:, None] + np.arange(d)] if d else np.zeros((len(rows), 0), np.int64)


def _scatter(batches):
    total: dict[int, list] = {}
    for batch in batches:
        for d, _, x in _by_length(batch, "x"):
            n, s, ss = total.get(d, (0, np.zeros(d, object), np.zeros((d, d), object)))
            for at in range(0, len(x) if d else 0, CHUNK_ROWS):
                part_s, part_ss = scatter(x[at:at + CHUNK_ROWS])
                s, ss = s + part_s, ss + part_ss
            total[d] = [n + len(x), s, ss]
    for d, (n, s, ss) in sorted(total.items()):
        # row -1 holds the sums, (-1, -1) the number of rows
        cells = [(-1, -1, n), *((-1, j, int(s[j])) for j in range(d)), *((i, j, int(ss[i, j])) for i in range(d) for j in range(i, d))]
        for at in range(0, len(cells), 1 << 16):
            part = cells[at:at + (1 << 16)]
            limbs = zip(*[_limbs(v) for *_, v in part])
            yield pa.RecordBatch.from_arrays([pa.array([d] * len(part), pa.int32()), *[pa.array(c, pa.int32()) for c in list(zip(*part))[:2]],
                                              *[pa.array(c, pa.int64()) for c in limbs]], ["dims", "i", "j", *_LIMB_NAMES])


_LIMB_NAMES = [f"l{k}" for k in range(LIMBS)]
_CELLS = "dims int, i int, j int, " + ", ".join(f"{x} long" for x in _LIMB_NAMES)
_MODEL = "dims int, n long, sums array<decimal(38,0)>, axes array<double>, values array<double>, trace double, identity_error double"


def solve(n: int, s: np.ndarray, ss: np.ndarray, k: int):
    """(axes (k, d), eigenvalues, trace, identity error) from exact sums."""
    centred = n * ss - np.outer(s, s)  # n**2 times the covariance, whole numbers
    v = np.array([[float(Fraction(int(c), n * n)) for c in row] for row in centred], np.float64).reshape(len(s), len(s))
    e, q = np.linalg.eigh(v)
    order = np.argsort(-e, kind="stable")[:k]
    trace = float(Fraction(int(np.trace(centred)), n * n)) if len(s) else 0.0
    order = order[e[order] > TOL * trace]
    axes, e = q[:, order].T, e[order]
    if len(axes):
        big = axes[np.arange(len(axes)), np.abs(axes).argmax(1)]
        axes = axes * np.where(big < 0, -1.0, 1.0)[:, None]
    scaled = axes / np.sqrt(e)[:, None]
    error = float(np.abs(scaled @ v @ scaled.T - np.eye(len(e))).max(initial=0.0))
    return axes, e, trace, error


def _fit(key, t: pa.Table, k: int) -> pa.Table:
    d = key[0].as_py()
    limbs = [t.column(x).to_pylist() for x in _LIMB_NAMES]
    value = [sum(x << (32 * i) for i, x in enumerate(row)) for row in zip(*limbs)]
    n, s, ss = 0, np.zeros(d, object), np.zeros((d, d), object)
    for i, j, v in zip(t.column("i").to_pylist(), t.column("j").to_pylist(), value):
        if j < 0:
            n = v
        elif i < 0:
            s[j] = v
        else:
            ss[i, j] = ss[j, i] = v
    axes, e, trace, error = solve(n, s, ss, k)
    return pa.Table.from_arrays([pa.array([d], pa.int32()), pa.array([n], pa.int64()), pa.array([[Decimal(int(x)) for x in s]], pa.list_(pa.decimal128(38, 0))),
                                 pa.array([axes.ravel().tolist()], pa.list_(pa.float64())), pa.array([e.tolist()], pa.list_(pa.float64())),
                                 pa.array([trace]), pa.array([error])], [x.split()[0] for x in _MODEL.split(", ")])


def fit(quantized_vectors: DataFrame, k: int = 4) -> DataFrame:
    """The model of each vector length: a row (dims, n, sums, axes (k x dims,
    one axis after the other), values, trace, identity_error)."""
    distinct = quantized_vectors.select("x").distinct()
    cells = distinct.mapInArrow(lean(_scatter), _CELLS).groupBy("dims", "i", "j").agg(*[F.sum(x).alias(x) for x in _LIMB_NAMES])
    return freeze(cells.groupBy("dims").applyInArrow(lambda key, t: _fit(key, t, k), _MODEL), "whitening-model")


# ---------------------------------------------------------------- whitened rows

_ROWS = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened_block(x: np.ndarray, model: dict):
    """(deviation of each row, (rows, k) projections)."""
    n, s = model["n"], model["sums"]
    d = len(s)
    top = max(int(np.abs(x.astype(object)).max()) if x.size and (x == -1 << 63).any() else int(np.abs(x).max(initial=0)), 1)
    most = n * top + max(abs(v) for v in s)
    if most * most * d < 1 << 63:
        c = n * x - np.array(s, np.int64)
        deviation = (c * c).sum(1)
    else:
        c = n * x.astype(object) - np.array(s, object)
        deviation = np.array([min(int(v), _LONG) for v in (c * c).sum(1)], np.int64)
    centred = c.astype(np.float64) / n
    return deviation, centred @ (model["axes"] / np.sqrt(model["values"])[:, None]).T


def _whiten(batches, models: dict[int, dict]):
    for batch in batches:
        for d, rows, x in _by_length(batch, "x"):
            m = models.get(d)
            if m is None or not len(m["values"]):
                continue
            deviation, w = whitened_block(x, m)
            k, size = w.shape[1], len(rows)
            ids = batch.column("vec_id").take(pa.array(np.repeat(rows, k)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)), pa.array(np.full(size * k, m["n"])), pa.array(np.repeat(deviation, k)),
                 pa.array(w.ravel()), pa.array(np.tile(m["values"] / m["trace"], size)), pa.array(np.full(size * k, m["identity_error"]))],
                [x.split()[0] for x in _ROWS.split(", ")])


def whitened(quantized_vectors: DataFrame, models: DataFrame, model_cells: int = MODEL_CELLS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error):
    a row for each vector and component, from a frozen ``fit``."""
    spark = quantized_vectors.sparkSession
    out = None
    upto = F.sum(F.size("axes") + F.size("sums")).over(Window.orderBy("dims"))  # a row for each length
    groups = models.where(F.size("values") > 0).select("dims", F.floor(upto / model_cells).alias("g"))
    for g in [r.g for r in groups.select("g").distinct().orderBy("g").collect()]:
        some = {}
        for r in models.join(groups.where(F.col("g") == g), "dims").collect():
            values = np.array(r["values"])
            some[r.dims] = {"n": r.n, "sums": [int(v) for v in r.sums], "values": values, "trace": r.trace, "identity_error": r.identity_error,
                            "axes": np.array(r.axes).reshape(len(values), r.dims)}
        shared = spark.sparkContext.broadcast(some)

        def rows(batches, shared=shared):
            yield from _whiten(batches, shared.value)

        part = quantized_vectors.where(F.size("x").isin(list(some))).mapInArrow(lean(rows), _ROWS)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], _ROWS) if out is None else out


# ---------------------------------------------------------------- query

def op12_whitening(spark, sf_dir):
    v = quantized(table(spark, sf_dir, "embeddings"))
    return whitened(v, fit(v, 4))


QUERIES = {"op12_whitening": op12_whitening}
SQL: dict[str, str] = {}
