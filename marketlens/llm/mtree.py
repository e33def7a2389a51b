"""Exact top-k search (operator 2): M-tree best-first search.

Vectors become integers, ``floor(256 x)``, and the score is their inner product. With ``M`` the
largest norm, the vector ``(x, sqrt(M^2 - |x|^2))`` and the query ``(q, 0)`` lie at the squared
distance ``|q|^2 + M^2 - 2 q.x``, so the highest products are the nearest neighbours of a metric
space, which an M-tree can index.

The index is a table of pages: every page holds up to ``PAGE`` entries with a centre, a covering radius, the
distance to the parent's centre, and a child page or the ids of a vector. The rows are dealt to
subtrees by the nearest of a bounded sample of pivots; a pivot that attracts many rows is split by a hash, so a subtree
has at most about ``SUBTREE`` entries. Equal vectors are one entry with its smallest ids: no search can return
more than ``k`` of them besides the query itself.

Queries run in blocks. Each first searches the subtree nearest to it; the distance of its k-th
result then rules out every other subtree whose nearest possible point is further away. Inside a tree the
page with the least lower bound is taken first, for all queries of the block that it can still concern, as one product; an entry whose bound ``|d(q, parent) - d(entry, parent)| - radius``
exceeds the k-th distance is passed over without computing its distance. Scores are computed in exact integers; bounds have a
margin for rounding, so ties are never cut."""

from __future__ import annotations

import heapq
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.base import arrow_limits, saved
from marketlens.llm.vectors import usable

SCALE = 256
K = 5
PAGE = 64              # entries in a page
SUBTREE = 8_192        # entries in a subtree, on average
QUERIES = 1_024        # queries in a block, on average
PIVOTS = 256           # routing vectors, at most: a bounded sample
_MARGIN = 1e-6         # of the largest norm, for rounding
_PART = 256            # subtrees whose covers a block of queries is held against at once


def _lifted(x: np.ndarray, top: float) -> np.ndarray:
    """Integer vectors with the coordinate that makes all norms ``sqrt(top)``."""
    return np.concatenate([x, np.sqrt(np.maximum(top - (x * x).sum(1), 0.0))[:, None]], axis=1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T), 0.0))


def build(points: np.ndarray, page: int = PAGE) -> list[dict]:
    """Pages of an M-tree over the rows of ``points`` (bulk load: pivots by farthest-first, rows to
    the nearest). Page 0 is the root. Each page: ``leaf, entry`` (rows or child pages), ``centre`` (row of
    the centre), ``radius``, ``to_parent``."""
    pages: list[dict] = []

    def grow(rows: np.ndarray, centre: int) -> int:
        number = len(pages)
        pages.append({})
        from_centre = _distances(points[rows], points[[centre]])[:, 0]
        if len(rows) <= page:
            pages[number] = {"leaf": True, "entry": rows, "centre": rows, "radius": np.zeros(len(rows)), "to_parent": from_centre}
            return number
        fan = min(page, -(-len(rows) // page) + 1)
        pivots = [int(np.argmax(from_centre))]
        near = _distances(points[rows], points[rows[pivots]])[:, 0]
        of = np.zeros(len(rows), np.int64)
        while len(pivots) < fan and near.max() > 0:
            pivots.append(int(np.argmax(near)))
            d = _distances(points[rows], points[rows[pivots[-1:]]])[:, 0]
            closer = d < near
            near[closer], of[closer] = d[closer], len(pivots) - 1
        if len(pivots) == 1 or np.bincount(of).max() == len(rows):   # all alike: parts of equal size
            of = np.arange(len(rows)) * fan // len(rows)
            near = np.zeros(len(rows))
            pivots = [int(np.flatnonzero(of == i)[0]) for i in range(fan)]
            near = np.concatenate([_distances(points[rows[of == i]], points[rows[[p]]])[:, 0] for i, p in enumerate(pivots)])
        entries, centres, radii, up = [], [], [], []
        for i, p in enumerate(pivots):
            mine = of == i
            if mine.any():
                entries.append(grow(rows[mine], int(rows[p])))
                centres.append(int(rows[p]))
                radii.append(float(near[mine].max()))
                up.append(float(from_centre[p]))
        pages[number] = {"leaf": False, "entry": np.array(entries), "centre": np.array(centres), "radius": np.array(radii), "to_parent": np.array(up)}
        return number

    grow(np.arange(len(points)), 0)
    return pages


def search_block(pages: list[dict], q: np.ndarray, own: np.ndarray, top: float, k: int, worst: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Best-first search for the integer vectors ``q``; ``worst``: distances known to hold ``k`` results. A page is held against all
    queries that it can still concern at once, each with its own bound. Returns the results as ``(position of the query, id,
    score)`` arrays and the number of distances computed."""
    n = len(q)
    lifted = np.concatenate([q, np.zeros((n, 1))], axis=1)
    reach = (q * q).sum(1) + top
    score, ident = np.full((n, k), -np.inf), np.zeros((n, k), np.int64)   # falling scores, ties by rising id
    limit = worst + margin
    order = count()
    queue = [(0.0, next(order), 0, np.arange(n), np.zeros(n), None)]
    computed = 0
    while queue:
        _, _, number, rows, least, to_centre = heapq.heappop(queue)
        open_ = least <= limit[rows]
        if not open_.any():
            continue
        rows, least, page = rows[open_], least[open_], pages[number]
        if to_centre is None:   # the root has no parent
            live = np.ones((len(rows), len(page["radius"])), bool)
        else:
            live = np.abs(to_centre[open_, None] - page["to_parent"]) - page["radius"] <= limit[rows, None]
        computed += int(live.sum())
        if page["leaf"]:
            found = q[rows] @ page["x"].T
            i, j = np.nonzero(live & (found >= score[rows, -1:]))
            many = np.array([len(x) for x in page["ids"]])[j]
            s, i = np.repeat(found[i, j], many), np.repeat(rows[i], many)
            ids = np.array([v for e in j for v in page["ids"][e]], np.int64)
            other = ids != own[i]
            met = np.unique(i[other])
            if not len(met):
                continue
            i, s, ids = (np.concatenate([x, y[other]]) for x, y in ((np.repeat(met, k), i), (score[met].ravel(), s), (ident[met].ravel(), ids)))
            by = np.lexsort((ids, -s, i))
            i, s, ids = i[by], s[by], ids[by]
            begins = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
            best = begins[:, None] + np.arange(k)
            score[met], ident[met] = s[best], ids[best]
            full = met[score[met, -1] > -np.inf]
            limit[full] = np.minimum(worst[full], np.sqrt(np.maximum(reach[full] - 2.0 * score[full, -1], 0.0))) + margin
        else:
            d = np.sqrt(np.maximum(reach[rows, None] - 2.0 * (lifted[rows] @ page["lifted"].T), 0.0))
            lower = np.maximum(d - page["radius"], least[:, None])
            live &= lower <= limit[rows, None]
            for e in np.flatnonzero(live.any(0)):
                at = live[:, e]
                heapq.heappush(queue, (float(lower[at, e].min()), next(order), int(page["entry"][e]), rows[at], lower[at, e], d[at, e]))
    i, j = np.nonzero(score > -np.inf)
    return i, ident[i, j], score[i, j], computed


def search(pages: list[dict], q: np.ndarray, own: int, top: float, k: int, worst: float, margin: float) -> tuple[list, int]:
    """``search_block`` for one vector. Returns the results as ``(score, -id)`` and the number of distances computed."""
    _, ids, scores, computed = search_block(pages, np.asarray(q, dtype=np.float64)[None, :], np.array([own]), top, k, np.array([worst], np.float64), margin)
    return [(float(s), -int(i)) for s, i in zip(scores, ids, strict=True)], computed


_PAGE = "d int, tree long, page int, leaf boolean, entry array<int>, radius array<double>, to_parent array<double>, x array<double>, ids array<array<long>>"
_HIT = "query_id bigint, h bigint, vec_id bigint, score bigint"


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows), kind))


def _matrix(column, d: int) -> np.ndarray:
    return np.asarray(column.combine_chunks().flatten(), dtype=np.float64).reshape(-1, d)


def index(vectors: DataFrame, k: int, subtree: int = SUBTREE, page: int = PAGE, pivots: int = PIVOTS) -> tuple[DataFrame, DataFrame, dict]:
    """``(points, pages, tops)``: integer vectors; the page table, in which page -1 holds a
    subtree's centre and covering radius; and the largest squared norm for each length."""
    spark = vectors.sparkSession
    v = usable(vectors).filter("not bad and vec_id is not null")
    points = v.select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("double")).alias("x")).distinct()
    points = saved(points.withColumn("d", F.size("x")).withColumn("h", F.xxhash64(F.lit(11), "x")), "mt-points")
    # equal vectors: the k + 1 smallest ids, first inside each task's part of a group
    rank = F.row_number().over(Window.partitionBy("d", "h", "part").orderBy("vec_id"))
    small = points.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(64))).withColumn("r", rank).filter(F.col("r") <= k + 1)
    ids = small.groupBy("d", "h").agg(F.slice(F.array_sort(F.collect_list("vec_id")), 1, k + 1).alias("ids"), F.min("vec_id").alias("vec_id"), F.first("x").alias("x"))
    entries = saved(ids, "mt-entries")
    sizes = {r["d"]: (r["n"], r["top"]) for r in entries.groupBy("d").agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("x", F.lit(0.0), lambda a, x: a + x * x)).alias("top")).collect()}
    # routing vectors: the smallest hashes of each length, at most ``pivots`` and no more than subtrees
    want = {d: max(1, min(pivots, n // subtree)) for d, (n, _) in sizes.items()}
    chosen = entries.withColumn("r", F.row_number().over(Window.partitionBy("d").orderBy(F.xxhash64(F.lit(7), "h"), "h")))
    rows = chosen.filter(F.col("r") <= F.create_map(*[F.lit(x) for d, n in want.items() for x in (d, n)])[F.col("d")]).select("d", "x").collect() if want else []
    routes = {d: _lifted(np.array([r["x"] for r in rows if r["d"] == d]), top) for d, (_, top) in sizes.items()}
    tops = {d: top for d, (_, top) in sizes.items()}
    arrow_limits(spark)

    def route(batches):
        for b in batches:
            d_of, xs, home = np.asarray(b.column("d")), b.column("x"), np.zeros(b.num_rows, np.int64)
            for d in np.unique(d_of):
                at = np.flatnonzero(d_of == d)
                x = np.asarray(xs.take(pa.array(at)).flatten()).reshape(-1, d)
                home[at] = _distances(_lifted(x, tops[d]), routes[d]).argmin(1)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("d", "h", "vec_id", "x", "ids")], pa.array(home)], names=["d", "h", "vec_id", "x", "ids", "home"])

    homes = saved(entries.select("d", "h", "vec_id", "x", "ids").mapInArrow(route, "d int, h bigint, vec_id bigint, x array<double>, ids array<bigint>, home bigint"), "mt-homes")
    # a home with many rows is split
    full = homes.groupBy("d", "home").agg(F.count(F.lit(1)).alias("n"))
    dealt = homes.join(full, ["d", "home"]).withColumn("split", F.pmod(F.xxhash64(F.lit(13), "h"), F.ceil(F.col("n") / subtree)))
    dealt = dealt.select("d", (F.col("home") * F.lit(1 << 32) + F.col("split")).alias("tree"), "vec_id", "x", "ids")

    def pages_of(key, rows):
        d, tree = (v.as_py() for v in key)
        rows = rows.sort_by("vec_id")
        x = _matrix(rows.column("x"), d)
        ids = rows.column("ids").to_pylist()
        lifted = _lifted(x, tops[d])
        made = build(lifted, page)
        middle = lifted.mean(0)
        radius = np.sqrt(((lifted - middle) ** 2).sum(1)).max() + _MARGIN * (np.sqrt(tops[d]) + 1)
        made.append({"leaf": False, "entry": np.empty(0), "radius": np.array([radius]), "to_parent": np.empty(0)})
        n = len(made)
        number = [*range(n - 1), -1]
        return pa.table([pa.array([d] * n, pa.int32()), pa.array([tree] * n, pa.int64()), pa.array(number, pa.int32()), pa.array([p["leaf"] for p in made]),
                         _lists([p["entry"].astype(np.int32) for p in made], pa.int32()), _lists([p["radius"] for p in made], pa.float64()), _lists([p["to_parent"] for p in made], pa.float64()),
                         _lists([x[p["centre"]].ravel() if "centre" in p else middle for p in made], pa.float64()),
                         pa.array([[ids[i] for i in p["entry"]] if p["leaf"] else [] for p in made], pa.list_(pa.list_(pa.int64())))],
                        names=[f.split()[0] for f in _PAGE.split(", ")])

    return points, saved(dealt.groupBy("d", "tree").applyInArrow(pages_of, _PAGE), "mt-pages"), tops


def _covers(queries: DataFrame, pages: DataFrame, parts: int, tops: dict, rule) -> DataFrame:
    """Holds blocks of queries against the covers (centre and radius) of all subtrees, some hundred at a time.
    ``rule(least, query rows)`` chooses ``(query, subtree)`` positions from the least possible distances."""
    trees = pages.filter("page = -1").select("d", "tree", "x", F.element_at("radius", 1).alias("radius"), F.pmod(F.xxhash64("tree"), F.lit(parts).cast("bigint")).alias("part"))
    blocks = queries.select("d", "block").distinct()
    held = trees.join(blocks, "d")
    held = held.toDF(*held.columns)   # columns of its own, beside those of the queries
    asked = queries.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))))

    def run(key, q, t):
        d = key[0].as_py()
        if not q.num_rows or not t.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "h": pa.array([], pa.int64()), "tree": pa.array([], pa.int64()), "least": pa.array([], pa.float64())})
        x = np.concatenate([_matrix(q.column("x"), d), np.zeros((q.num_rows, 1))], axis=1)
        least = np.maximum(_distances(x, _matrix(t.column("x"), d + 1)) - np.asarray(t.column("radius")), 0.0)
        i, j = rule(least, q, t)
        return pa.table({"query_id": np.asarray(q.column("query_id"))[i], "h": np.asarray(q.column("h"))[i], "tree": np.asarray(t.column("tree"))[j], "least": least[i, j]})

    keys = ("d", "block", "part")
    return asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(run, "query_id bigint, h bigint, tree bigint, least double")


def _nearest(least, q, t):
    return np.arange(len(least)), least.argmin(1)


def _within(least, q, t):
    home, worst = np.asarray(q.column("home")), np.asarray(q.column("worst"))
    return np.nonzero((least <= worst[:, None]) & (np.asarray(t.column("tree"))[None, :] != home[:, None]))


def _visit(asked: DataFrame, pages: DataFrame, tops: dict, k: int) -> DataFrame:
    """The ``k`` best of each query in each subtree it is to visit."""
    asked = asked.select("d", "tree", "block", "query_id", "h", "x", "worst")
    held = pages.filter("page >= 0").join(asked.select("d", "tree", "block").distinct(), ["d", "tree"])
    held = held.toDF(*held.columns)

    def run(key, q, p):
        d = key[0].as_py()
        tree = []
        for r in p.sort_by("page").to_pylist():
            x = np.array(r["x"]).reshape(-1, d)
            tree.append({"leaf": r["leaf"], "entry": np.array(r["entry"]), "radius": np.array(r["radius"]), "to_parent": np.array(r["to_parent"]),
                         "x": x, "lifted": _lifted(x, tops[d]), "ids": r["ids"]})
        if not q.num_rows or not tree:
            return pa.table([pa.array([], pa.int64())] * 4, names=["query_id", "h", "vec_id", "score"])
        own, h, worst = (np.asarray(q.column(c)) for c in ("query_id", "h", "worst"))
        i, ids, scores, _ = search_block(tree, _matrix(q.column("x"), d), own, tops[d], k, worst, _MARGIN * (np.sqrt(tops[d]) + 1))
        return pa.table([own[i], h[i], ids, scores.astype(np.int64)], names=["query_id", "h", "vec_id", "score"])

    keys = ("d", "tree", "block")
    return asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(run, _HIT)


def top_k(vectors: DataFrame, k: int = K, is_query=None, subtree: int = SUBTREE, page: int = PAGE, pivots: int = PIVOTS, block: int = QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the ``k`` highest scores among the other vectors of its
    length (all, if fewer), ties to the smaller id. ``is_query``: a function from the id column to a condition.
    Vectors that are null, empty or hold null or non-finite components take no part, nor do
    rows with a null id. Equal rows are one; rows with one id and different vectors all take part, each
    as a query of its own. Scores are exact up to 2^53. An empty table gives no rows."""
    is_query = is_query or (lambda i: i % 50 == 0)
    points, pages, tops = index(vectors, k, subtree, page, pivots)
    queries = points.filter(is_query(F.col("vec_id")))
    blocks = max(1, -(-queries.count() // block))
    parts = max(1, -(-pages.filter("page = -1").count() // _PART))
    queries = saved(queries.select("d", F.col("vec_id").alias("query_id"), "h", "x", F.pmod(F.xxhash64(F.lit(17), "vec_id"), F.lit(blocks)).alias("block")), "mt-queries")
    near = _covers(queries, pages, parts, tops, _nearest).groupBy("query_id", "h").agg(F.min_by("tree", F.struct("least", "tree")).alias("tree"))
    first = saved(queries.join(near, ["query_id", "h"]).withColumn("worst", F.lit(float("inf"))), "mt-first")
    home = saved(_visit(first, pages, tops, k), "mt-home")
    # the k-th distance of the first subtree, with a margin; infinite if it held fewer
    kth = home.groupBy("query_id", "h").agg(F.min("score").alias("s"), F.count(F.lit(1)).alias("n"))
    top = F.create_map(*[F.lit(v) for d, t in tops.items() for v in (d, float(t))])[F.col("d")] if tops else F.lit(0.0)
    norm = F.aggregate("x", F.lit(0.0), lambda a, x: a + x * x)
    edge = F.sqrt(F.greatest(norm + top - 2 * F.col("s"), F.lit(0.0))) + _MARGIN * (F.sqrt(top) + F.sqrt(norm) + 1)
    known = first.withColumnRenamed("tree", "home").drop("worst").join(kth, ["query_id", "h"], "left")
    known = saved(known.withColumn("worst", F.when(F.col("n") >= k, edge).otherwise(F.lit(float("inf")))).drop("s", "n"), "mt-known")
    more = _covers(known, pages, parts, tops, _within)
    found = home.unionByName(_visit(known.drop("home").join(saved(more, "mt-more"), ["query_id", "h"]), pages, tops, k))
    rank = F.row_number().over(Window.partitionBy("query_id", "h").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
