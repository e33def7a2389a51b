"""Embedding near-duplicates and top-k search against brute force."""

import math
import random

import numpy as np
import pytest

from marketlens.llm import mtree, vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def f32(rows):
    return [[None if x is None else float(np.float32(x)) for x in r] if r is not None else None for r in rows]


def awkward(spark):
    nan, inf = float("nan"), float("inf")
    rows = f32([[1, 0], [1, 0], [0.99, 0.1], None, [], [0, 0], [None, 1], [nan, 1], [inf, 1], [1, 0, 0], [-1, 0], [0, 1]])
    data = [(i, r, 0) for i, r in enumerate(rows)] + [(0, rows[0], 1), (None, rows[0], 1), (20, rows[0], 0), (20, rows[11], 0)]
    df = spark.createDataFrame([(*x, "x", 1) for x in data], SCHEMA + ", e string, rank int")
    return df.toDF("vec_id", "embedding", "label", "EMBEDDING", "rank")


def clustered(seed, n=700, d=24):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, d))
    for i in range(0, 200, 2):                 # near pairs on both sides of the threshold
        base[i + 1] = base[i] + rng.uniform(0.2, 0.7) * rng.standard_normal(d)
    for i in range(201, 260):                  # chains
        base[i] = base[i - 1] + 0.42 * rng.standard_normal(d)
    base[300:420] = base[300]                  # equal vectors
    base[420:500] = base[300] + 0.3 * rng.standard_normal((80, d))
    return f32((base * rng.uniform(0.01, 50, (n, 1))).tolist())


def brute_links(rows, threshold=0.9):
    ok = {i: np.array(r, float) for i, r in rows if r and None not in r and all(map(math.isfinite, r)) and any(r)}
    links = {i: set() for i, _ in rows}
    for a in ok:
        for b in ok:
            if a < b and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] / (np.linalg.norm(ok[a]) * np.linalg.norm(ok[b])) >= threshold:
                links[a].add(b)
                links[b].add(a)
    out = {}
    for i in sorted(links):
        todo, seen = [i], {i}
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[i] = (len(links[i]), min(seen))
    return out


@pytest.mark.parametrize("block", [8192, 100])
def test_near_vectors(spark, block):
    rows = list(enumerate(clustered(block)))
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(i, r, 0) for i, r in rows], SCHEMA)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.near_vectors(df, block=block).collect()}
    assert got == brute_links(rows)


def test_near_vectors_edges(spark):
    out = {r["vec_id"]: r for r in vectors.near_vectors(awkward(spark)).collect()}
    assert set(out) == {*range(12), 20, None}
    assert (out[0]["n_links"], out[1]["n_links"], out[2]["n_links"]) == (3, 3, 3)
    assert all(out[i]["n_links"] == 0 and out[i]["kept"] for i in range(3, 11))
    assert out[11]["n_links"] == 1 and out[11]["component_id"] == 0 and out[20]["n_links"] == 4   # one id, two vectors
    assert out[None]["component_id"] is None
    assert vectors.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(3)
    u = rng.standard_normal((200, 33)) ** 3
    u /= np.linalg.norm(u, axis=1)[:, None]
    q, s, e = vectors.quantised(u)
    near = (q.astype(float) @ q.T) * s[:, None] * s
    assert (np.abs(u @ u.T - near) <= e[:, None] + e + e[:, None] * e).all()
    assert np.abs(q).max() <= 127


def brute_top(rows, k):
    ok = [(i, np.floor(256 * np.array(r, float))) for i, r in rows if r and None not in r and all(map(math.isfinite, r))]
    out = []
    for i, q in ok:
        if i % 50 == 0:
            best = sorted((-int(q @ x), j) for j, x in ok if j != i and len(x) == len(q))[:k]
            out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"subtree": 64, "page": 8, "block": 3, "pivots": 5}])
def test_top_k(spark, options):
    rows = list(enumerate(f32([[x / 20 for x in r] for r in clustered(5)])))
    df = spark.createDataFrame([(i, r, 0) for i, r in rows], SCHEMA)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in mtree.top_k(df, **options).collect())
    assert got == brute_top(rows, 5)


def test_top_k_edges(spark):
    df = awkward(spark).filter("coalesce(vec_id, 0) <> 20")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in mtree.top_k(df).collect())
    rows = {r["vec_id"]: r["embedding"] for r in df.collect() if r["vec_id"] is not None}
    assert got == brute_top(sorted(rows.items()), 5)
    assert mtree.top_k(spark.createDataFrame([], SCHEMA)).count() == 0


def test_search_passes_over_pages():
    rng = np.random.default_rng(4)
    centres = rng.integers(-4000, 4000, (20, 6))
    x = np.floor(np.repeat(centres, 100, axis=0) + rng.normal(0, 40, (2000, 6)))
    top = float((x * x).sum(1).max())
    lifted = mtree._lifted(x, top)
    pages = mtree.build(lifted, 32)
    for p in pages:
        p |= {"x": x[p["centre"]], "lifted": lifted[p["centre"]], "ids": [[int(i)] for i in p["entry"]] if p["leaf"] else []}
    computed = 0
    for i in range(0, 2000, 40):
        hits, n = mtree.search(pages, x[i], i, top, 5, float("inf"), 1e-3)
        best = sorted((-int(x[i] @ y), j) for j, y in enumerate(x) if j != i)[:5]
        assert sorted((-int(s), -j) for s, j in hits) == best
        computed += n
    assert computed < 50 * 1200          # of 2000 and the inner entries


def test_a_block_of_queries_meets_a_page_once():
    """Queries share the product of a page, each with its own bound: as many results as alone, in far less time than one by one."""
    rng = np.random.default_rng(5)
    centres = rng.integers(-4000, 4000, (20, 6))
    x = np.floor(np.repeat(centres, 100, axis=0) + rng.normal(0, 40, (2000, 6)))
    x[100:140] = x[100]
    top = float((x * x).sum(1).max())
    lifted = mtree._lifted(x, top)
    pages = mtree.build(lifted, 32)
    for p in pages:
        p |= {"x": x[p["centre"]], "lifted": lifted[p["centre"]], "ids": [[int(i), int(i) + 5000] for i in p["entry"]] if p["leaf"] else []}
    asked = np.arange(0, 2000, 10)
    i, ids, scores, computed = mtree.search_block(pages, x[asked], asked, top, 5, np.full(len(asked), np.inf), 1e-3)
    for at, own in enumerate(asked):
        every = [(-int(x[own] @ y), j + more) for j, y in enumerate(x) for more in (0, 5000) if j + more != own]
        assert [(-int(s), int(v)) for s, v in zip(scores[i == at], ids[i == at], strict=True)] == sorted(every)[:5]
    assert computed < len(asked) * 1200          # of 2000 and the inner entries
    near = np.sqrt(np.maximum((x[asked] ** 2).sum(1) + top - 2 * scores.reshape(len(asked), 5)[:, -1], 0))
    again = mtree.search_block(pages, x[asked], asked, top, 5, near, 1e-3)
    assert (again[1] == ids).all() and (again[2] == scores).all() and again[3] <= computed
