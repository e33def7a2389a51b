"""Embedding whitening (operator 11): an exact covariance from bit planes.

Every entry becomes the integer ``floor(256 c)``. The fit list holds each distinct vector once. Its entries are shifted
by the least of their dimension, and the bit planes of every dimension are packed across rows into 64-bit words: bit ``r`` of a word
of plane ``(d, b)`` is bit ``b`` of row ``r`` in dimension ``d``. The sum over rows of the product of two dimensions is then the sum over
pairs of their planes of ``2^(a+b) popcount(plane_a AND plane_b)``, exactly, and so are the sums (a plane with itself). The
scatter ``n XY - S_x S_y`` is centred in integers of any length; only the quotient by ``n^2`` is rounded, before ``eigh``.

A task holds one block of rows and the counts of its plane pairs. What reaches the driver is one row for each pair of dimensions,
whatever the number of vectors: ranges, sums and products are added up by Spark first.

Defined results: rows with a null vector, a null or a non-finite entry, or no entry are left out. Entries beyond 64 bits count
as the nearest 64-bit integer. Vectors of another length are a table of their own (``dims`` tells which). A component whose eigenvalue is 0 up to rounding
has a null ``whitened``, and ``explained`` is null where nothing varies. ``deviation`` is exact in ``deviation_exact`` (decimal) at
any size, and null as a long where it exceeds 64 bits. Rows with one ``vec_id`` each have their own results. Further columns of the
input, also clashing ones, are ignored."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.base import arrow_limits, pick, saved

COMPONENTS = 4
SCALE = 256
BLOCK = 4_096        # rows whose planes are counted at once
LIMB = 60            # bits of a product that one row of a partial result carries
_ROUNDING = 1e-12    # an eigenvalue below this share of the greatest is 0


def integers(vectors: DataFrame) -> DataFrame:
    """``(vec_id, x)`` of the rows that take part; ``x`` is ``array<bigint>``."""
    v = pick(vectors, "vec_id", "embedding").filter("embedding is not null and size(embedding) > 0")
    bad = F.exists("embedding", lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return v.filter(~bad).select("vec_id", F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE)).alias("x"))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix of 64-bit integers."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return flat.reshape(len(column), -1)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The matrices of a task's batches, joined to about ``BLOCK`` rows."""
    held: list[np.ndarray] = []
    for batch in batches:
        if batch.num_rows:
            held.append(matrix(batch.column(0)))
        if sum(map(len, held)) >= BLOCK:
            yield np.concatenate(held)
            held = []
    if held:
        yield np.concatenate(held)


def planes(x: np.ndarray, low: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Bit planes of the rows, one line of 64-bit words for each bit of each dimension."""
    u = x.astype(np.uint64) - low.astype(np.uint64)       # modulo 2^64: exact, for the difference fits
    words = -(-len(u) // 64)
    out = np.zeros((int(bits.sum()), words * 8), np.uint8)
    at = 0
    for d, n in enumerate(bits):
        column = u[:, d]
        for b in range(int(n)):
            line = np.packbits(((column >> np.uint64(b)) & np.uint64(1)).astype(np.uint8))
            out[at, :len(line)] = line
            at += 1
    return out.view(np.uint64)


def plane_counts(x: np.ndarray, low: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """``popcount(plane_i AND plane_j)`` for ``i <= j``."""
    p = planes(x, low, bits)
    out = np.zeros((len(p), len(p)), np.int64)
    for i in range(len(p)):
        out[i, i:] = np.bitwise_count(p[i:] & p[i]).sum(axis=1, dtype=np.int64)
    return out


def weighted(counts: np.ndarray, bits: np.ndarray) -> tuple[list[list[int]], list[int]]:
    """Products of all pairs of dimensions, and the sums, from the counts of their planes."""
    full = counts + np.triu(counts, 1).T
    ends = np.concatenate([[0], np.cumsum(bits)]).astype(int)
    weight = [np.array([1 << b for b in range(int(n))], object) for n in bits]
    d = len(bits)
    products = [[0] * d for _ in range(d)]
    for i in range(d):
        for j in range(i, d):
            block = full[ends[i]:ends[i + 1], ends[j]:ends[j + 1]].astype(object)
            products[i][j] = int(weight[i] @ block @ weight[j]) if block.size else 0
    alone = np.diagonal(full)
    return products, [int(weight[i] @ alone[ends[i]:ends[i + 1]].astype(object)) if bits[i] else 0 for i in range(d)]


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    low = high = None
    for x in blocks(batches):
        low = x.min(0) if low is None else np.minimum(low, x.min(0))
        high = x.max(0) if high is None else np.maximum(high, x.max(0))
    if low is not None:
        yield pa.RecordBatch.from_arrays([pa.array(range(len(low)), pa.int32()), pa.array(low), pa.array(high)], names=["d", "low", "high"])


def _limbs(i: int, j: int, value: int) -> Iterator[tuple[int, int, int, Decimal]]:
    limb = 0
    while value or not limb:
        yield i, j, limb, Decimal(value & ((1 << LIMB) - 1))
        value >>= LIMB
        limb += 1


@dataclass
class Whitening:
    """A fitted transform of vectors of one length."""
    n: int
    sums: list[int]
    values: np.ndarray       # eigenvalues, falling
    vectors: np.ndarray      # unit eigenvectors, as columns
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def kept(self, components: int) -> list[int]:
        """Components whose eigenvalue is more than rounding."""
        return [k for k in range(min(components, len(self.values))) if self.values[k] > max(self.values[0], 0) * _ROUNDING]

    def project(self, x: np.ndarray, components: int) -> np.ndarray:
        """Whitened coordinates, NaN where the eigenvalue is 0."""
        out = np.full((len(x), min(components, len(self.values))), np.nan)
        kept = self.kept(components)
        out[:, kept] = ((x - self.mean) @ self.vectors[:, kept]) / np.sqrt(self.values[kept])
        return out

    def deviation(self, x: np.ndarray) -> list[int]:
        """``sum over dimensions of (n x - S)^2``, exactly."""
        top = max(map(abs, self.sums), default=0) + self.n * int(max(abs(int(x.min())), abs(int(x.max()))))
        if len(self.sums) * top * top < 1 << 62:
            y = self.n * x - np.array(self.sums, np.int64)
            return (y * y).sum(1).tolist()
        y = self.n * x.astype(object) - np.array(self.sums, object)
        return [int(v) for v in (y * y).sum(1)]


def fit(x: DataFrame) -> Whitening | None:
    """The transform of the distinct vectors of ``x`` (column ``x``, all of one length); None without rows."""
    arrow_limits(x.sparkSession)
    ranges = x.select("x").mapInArrow(_ranges, "d int, low long, high long")
    ranges = ranges.groupBy("d").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("d").collect()   # a row for each dimension
    if not ranges:
        return None
    low = np.array([r["low"] for r in ranges], np.int64)
    bits = np.array([(r["high"] - r["low"]).bit_length() for r in ranges])

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = None, 0
        for block in blocks(batches):
            more = plane_counts(block, low, bits)
            counts, n = more if counts is None else counts + more, n + len(block)
        if not n:
            return
        cross, sums = weighted(counts, bits)
        rows = [(-1, -1, 0, Decimal(n))]
        for i in range(len(bits)):
            rows += _limbs(-1, i, sums[i])
            for j in range(i, len(bits)):
                rows += _limbs(i, j, cross[i][j])
        i, j, limb, value = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(limb, pa.int32()),
                                          pa.array(value, pa.decimal128(38, 0))], names=["i", "j", "limb", "value"])

    parts = x.select("x").mapInArrow(products, "i int, j int, limb int, value decimal(38,0)")
    total: dict[tuple[int, int], int] = {}
    for r in parts.groupBy("i", "j", "limb").agg(F.sum("value").alias("value")).collect():   # a row for each pair of dimensions and limb
        total[r["i"], r["j"]] = total.get((r["i"], r["j"]), 0) + (int(r["value"]) << (LIMB * r["limb"]))
    return solved(total[-1, -1], [total[-1, d] for d in range(len(bits))], lambda i, j: total[i, j], low.tolist())


def solved(n: int, sums: list[int], product, low: list[int]) -> Whitening:
    """Eigenvalues and vectors of the covariance, from the shifted sums and products."""
    d = len(sums)
    v = np.empty((d, d))
    for i in range(d):
        for j in range(i, d):
            v[i, j] = v[j, i] = (n * product(i, j) - sums[i] * sums[j]) / (n * n)
    values, vectors = np.linalg.eigh(v)
    return Whitening(n, [s + n * a for s, a in zip(sums, low, strict=True)], values[::-1].copy(), vectors[:, ::-1].copy(), float(np.trace(v)))


def _moments(x: DataFrame, model: Whitening, components: int, centre: np.ndarray | None) -> np.ndarray:
    """Sums of the whitened coordinates, or of the products of the centred ones, over the rows of ``x``."""
    kept = model.kept(components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for block in blocks(batches):
            w = model.project(block, components)[:, kept]
            total = total + (w.sum(0) if centre is None else ((w - centre).T @ (w - centre)).ravel())
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["k", "v"])

    rows = x.select("x").mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).orderBy("k").collect()
    return np.array([r["v"] for r in rows])


def identity_error(x: DataFrame, model: Whitening, components: int = COMPONENTS) -> float | None:
    """Largest absolute entry of the covariance of the whitened distinct vectors, less the identity."""
    k = len(model.kept(components))
    if not k:
        return None
    mean = _moments(x, model, components, None) / model.n
    cov = _moments(x, model, components, mean).reshape(k, k) / model.n
    return float(np.abs(cov - np.eye(k)).max())


def _applied(rows: DataFrame, model: Whitening, error: float | None, components: int) -> DataFrame:
    schema = ("vec_id long, component int, dims int, n long, deviation long, deviation_exact decimal(38,0), whitened double, "
              "explained double, identity_error double")
    k = min(components, len(model.sums))
    explained = [float(model.values[i] / model.trace) if model.trace > 0 else None for i in range(k)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(1))
            w = model.project(x, components).ravel()
            exact = [Decimal(v) if v < 10 ** 38 else None for v in model.deviation(x)]
            small = [int(v) if v is not None and v < 1 << 63 else None for v in exact]
            m = len(x) * k
            ids = np.repeat(np.arange(len(x)), k)
            cols = [batch.column(0).take(pa.array(ids)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(m, len(model.sums), np.int32)), pa.array(np.full(m, model.n, np.int64)),
                    pa.array(small, pa.int64()).take(pa.array(ids)), pa.array(exact, pa.decimal128(38, 0)).take(pa.array(ids)),
                    pa.array(w, pa.float64(), mask=np.isnan(w)), pa.array(explained * len(x), pa.float64()), pa.array([error] * m, pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, names=[f.split()[0] for f in schema.split(", ")])

    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(run, schema)


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """For each vector and component: ``vec_id, component, dims, n, deviation, deviation_exact, whitened, explained, identity_error``."""
    rows = integers(vectors)
    arrow_limits(vectors.sparkSession)
    distinct = saved(rows.select("x").dropDuplicates(["x"]), "wh-distinct")
    out = []
    for r in distinct.select(F.size("x").alias("dims")).distinct().orderBy("dims").collect():   # lengths of vectors, as a rule one
        own = distinct.filter(F.size("x") == r["dims"])
        model = fit(own)
        out.append(_applied(rows.filter(F.size("x") == r["dims"]), model, identity_error(own, model, components), components))
    if not out:
        empty = Whitening(1, [0], np.ones(1), np.ones((1, 1)), 1.0)
        return _applied(rows, empty, None, components)
    return reduce(DataFrame.unionByName, out)
