"""Embedding near-duplicates (operator 1): int8 tile products with error bounds.

Each vector is scaled to length 1 and rounded to int8, ``u = s q + r``, and ``e = |r|`` is kept. For two
vectors ``|u . v - s_u s_v (q_u . q_v)| <= e_u + e_v + e_u e_v`` (Cauchy-Schwarz), so a pair whose
integer product falls short of the threshold by more than that cannot link. Tiles of integer products
are computed exactly as float32 matrix products; the pairs that the bound cannot rule out, and only those,
are computed again in double precision from the vectors.

Equal vectors are one class. The classes are dealt into blocks of at most about ``BLOCK``; each pair
of blocks is a task of its own, of bounded size however many vectors there are. A task returns, for each vector, its number of links in the
task and one link towards the smallest member it is connected with there, so rows grow with vectors times
blocks and never with pairs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.base import arrow_limits, pick, saved
from marketlens.llm.components import components, merge_labels

THRESHOLD = 0.9
BLOCK = 8_192      # classes in a block, on average
TILE = 1_024
_EXACT = 1_024     # dimensions whose int8 products float32 adds up exactly
_SLACK = 1e-9      # for rounding of the bounds themselves
_PAIRS = 65_536    # pairs recomputed at once


def quantised(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 values (as float32, for the matrix product), scales and error bounds of unit vectors."""
    s = np.abs(u).max(axis=1) / 127
    q = np.rint(u / s[:, None])
    e = np.sqrt(((u - s[:, None] * q) ** 2).sum(axis=1)) * (1 + _SLACK) + _SLACK
    return q.astype(np.float32), s, e


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if a.shape[1] <= _EXACT:
        return a @ b.T
    return sum((a[:, i:i + _EXACT] @ b[:, i:i + _EXACT].T).astype(np.float64) for i in range(0, a.shape[1], _EXACT))


def linked_pairs(u: np.ndarray, v: np.ndarray, x: np.ndarray, y: np.ndarray, threshold: float, same: bool):
    """Yields ``(i, j)`` arrays of pairs of rows of ``x`` and ``y`` with cosine at least the threshold;
    ``u`` and ``v`` are the rows at length 1. ``same``: only pairs ``i < j`` of one set."""
    qa, sa, ea = quantised(u)
    qb, sb, eb = (qa, sa, ea) if same else quantised(v)
    nx, ny = np.sqrt((x * x).sum(1)), np.sqrt((y * y).sum(1))
    a_order, b_order = np.argsort(sa, kind="stable"), np.argsort(sb, kind="stable")   # like scales in a tile
    for at in range(0, len(u), TILE):
        rows = a_order[at:at + TILE]
        for to in range(at if same else 0, len(v), TILE):
            cols = b_order[to:to + TILE]
            product = _product(qa[rows], qb[cols])
            # a bound for the whole tile first, then for each pair
            least = (threshold - ea[rows] - eb[cols].max() * (1 + ea[rows])) / sa[rows]
            least = least / np.where(least > 0, sb[cols].max(), sb[cols].min())
            i, j = np.nonzero(product >= (least - 1e-6 * np.abs(least) - 1e-3)[:, None])
            p, i, j = product[i, j].astype(np.float64), rows[i], cols[j]
            may = p * sa[i] * sb[j] + ea[i] + eb[j] + ea[i] * eb[j] >= threshold - _SLACK
            if same and at == to:
                may &= i < j
            i, j = i[may], j[may]
            for k in range(0, len(i), _PAIRS):
                a, b = i[k:k + _PAIRS], j[k:k + _PAIRS]
                cosine = np.einsum("ij,ij->i", x[a], y[b]) / (nx[a] * ny[b])
                ok = cosine >= threshold
                if ok.any():
                    yield a[ok], b[ok]


def _matrix(column: pa.ChunkedArray, d: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return np.asarray(flat, dtype=np.float64).reshape(-1, d)


def usable(vectors: DataFrame, embedding: str = "embedding") -> DataFrame:
    """``(vec_id, embedding, bad)``: bad if null, empty, or with a null or non-finite component."""
    v = pick(vectors, "vec_id", embedding).toDF("vec_id", "embedding").withColumn("vec_id", F.col("vec_id").cast("bigint"))
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.withColumn("bad", F.coalesce(odd | (F.size("embedding") < 1), F.lit(True)))


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``. Vectors that are null, empty, zero or hold
    null or non-finite components, and vectors of different lengths, link with nothing. Rows that
    repeat an id and its vector are one row. Rows with one id and different vectors are one vertex that links where any of them does (their links add up). Rows
    with a null id come out once with null component and no links. An empty table gives no rows."""
    spark = vectors.sparkSession
    v = usable(vectors)
    zero = ~F.exists("embedding", lambda x: x != 0)
    keyed = v.withColumn("ok", ~F.col("bad") & ~F.coalesce(zero, F.lit(True)) & F.col("vec_id").isNotNull()).select(
        "vec_id", "ok", F.when(F.col("ok"), F.col("embedding")).alias("embedding"),
        F.when(F.col("ok"), F.xxhash64(F.lit(1), "embedding")).alias("h1"), F.when(F.col("ok"), F.xxhash64(F.lit(2), "embedding")).alias("h2"))
    ids = saved(keyed.select("vec_id", "ok", "h1", "h2").distinct(), "nv-ids")
    classes = keyed.filter("ok").groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"), F.first("embedding").alias("embedding"))
    sizes = ids.filter("ok").groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("many"))
    classes = saved(classes.join(sizes, ["h1", "h2"]).withColumn("d", F.size("embedding")), "nv-classes")
    blocks = max(1, -(-classes.count() // block))
    mine = classes.select("rep", "h1", "many", "embedding", "d", F.pmod(F.xxhash64(F.lit(3), "h1", "h2"), F.lit(blocks)).alias("block"))
    cells = mine.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(
        "d", F.least("block", "other").cast("int").alias("low"), F.greatest("block", "other").cast("int").alias("high"),
        F.col("block").cast("int").alias("block"), "rep", "h1", "many", "embedding")
    arrow_limits(spark)

    def cell(cell_of, rows):
        d, low, high = (k.as_py() for k in cell_of)
        x = _matrix(rows.column("embedding"), d)
        rep, key, many, own = (np.asarray(rows.column(c)) for c in ("rep", "h1", "many", "block"))
        order = np.argsort(rep, kind="stable")
        x, rep, key, many, own = x[order], rep[order], key[order], many[order], own[order]
        y = x / np.abs(x).max(axis=1, keepdims=True)
        u = y / np.sqrt((y * y).sum(1))[:, None]
        norms = (x * x).sum(1)
        if not (np.isfinite(norms) & (norms > 1e-290)).all():   # squares out of range
            x = y
        links, label = np.zeros(len(rep), np.int64), np.arange(len(rep))
        a = np.flatnonzero(own == low)
        b = a if low == high else np.flatnonzero(own == high)
        for i, j in linked_pairs(u[a], u[b], x[a], x[b], threshold, low == high):
            i, j = a[i], b[j]
            links += np.bincount(i, many[j], minlength=len(rep)).astype(np.int64) + np.bincount(j, many[i], minlength=len(rep)).astype(np.int64)
            merge_labels(label, i, j)
        some = np.flatnonzero(links)
        return pa.table({"h1": key[some], "rep": rep[some], "links": links[some], "root": rep[label[some]]}, schema=pa.schema([(n, pa.int64()) for n in ("h1", "rep", "links", "root")]))

    found = saved(cells.groupBy("d", "low", "high").applyInArrow(cell, "h1 bigint, rep bigint, links bigint, root bigint"), "nv-links")
    near = found.groupBy("h1").agg(F.sum("links").alias("near"))
    # an id with several vectors ties their classes together
    twice = ids.filter("ok").groupBy("vec_id").count().filter("count > 1").select("vec_id")
    tied = ids.filter("ok").join(twice, "vec_id", "left_semi").join(classes.select("h1", "h2", "rep"), ["h1", "h2"]).select("rep", F.col("vec_id").alias("root"))
    top = components(found.select("rep", "root").unionByName(tied), "rep", "root").withColumnRenamed("node", "rep")
    member = ids.join(classes.select("h1", "h2", "rep", "many"), ["h1", "h2"], "left").join(near, "h1", "left").join(top, "rep", "left")
    out = member.select("vec_id", (F.coalesce("many", F.lit(1)) - 1 + F.coalesce("near", F.lit(0))).alias("n_links"), F.coalesce("component", "rep", "vec_id").alias("component_id"))
    out = out.groupBy("vec_id").agg(F.sum("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
