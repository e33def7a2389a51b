"""Whitening, Merkle manifest and line dedup against plain versions."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from marketlens.llm import lines, merkle, whitening
from tests.llm.test_text_ops import docs_of

SPACE = " \t\n\x0b\x0c\r"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


# --- whitening -----------------------------------------------------------------

def plain_whitening(rows):
    ok = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows
          if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(v) for _, v in ok})
    n, d = len(fit), len(fit[0])
    s = [sum(v[k] for v in fit) for k in range(d)]
    x = np.array(fit, float) - np.array(s) / n
    v = x.T @ x / n
    e, w = np.linalg.eigh(v)
    e, w = e[::-1], w[:, ::-1]
    out = {}
    for i, r in ok:
        dev = sum((n * a - b) ** 2 for a, b in zip(r, s, strict=True))
        y = (np.array(r) - np.array(s) / n) @ w[:, :4] / np.sqrt(e[:4])
        out.setdefault(i, []).append((n, dev, y, e[:4] / np.trace(v)))
    return out


def vectors_of(spark, rows):
    data = [(i, v, 0, "x", 1) for i, v in rows]
    return spark.createDataFrame(data, "vec_id long, embedding array<float>, label int, e string, c int").toDF(
        "vec_id", "embedding", "label", "EMBEDDING", "component")


def test_whitening_equals_plain(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((300, 12)) @ rng.standard_normal((12, 12)) * 0.2
    base[50:150] = base[50]                                 # copies count once
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    rows += [(900, None), (901, []), (902, [None] * 12), (903, [float("nan")] * 12), (904, [float("inf")] + [0.0] * 11),
             (None, rows[3][1]), (5, rows[5][1])]
    random.Random(2).shuffle(rows)
    got = whitening.whitened(vectors_of(spark, rows).repartition(5)).collect()
    want = plain_whitening(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], []).append(r)
    assert set(by_id) == set(want) and len(got) == 4 * sum(map(len, want.values()))
    errors = {r["identity_error"] for r in got}
    assert len(errors) == 1 and errors.pop() < 1e-9
    sign = {}
    for i, found in want.items():
        for c in range(4):
            for r, (n, dev, y, explained) in zip([r for r in by_id[i] if r["component"] == c + 1], found, strict=True):
                assert (r["n"], r["deviation"], int(r["deviation_exact"])) == (n, dev, dev)
                assert abs(r["explained"] / explained[c] - 1) < 1e-9
                if abs(y[c]) > 1e-3:
                    assert sign.setdefault(c, np.sign(r["whitened"] * y[c])) == np.sign(r["whitened"] * y[c])
                assert abs(abs(r["whitened"]) - abs(y[c])) < 1e-8


@pytest.mark.parametrize("spread", [1, 1000, 1 << 40])
def test_plane_products_are_exact(spread):
    rng = random.Random(spread)
    x = np.array([[rng.randint(-spread, spread) if d else 7 for d in range(5)] for _ in range(333)], np.int64)
    low, high = x.min(0), x.max(0)
    bits = np.array([(int(b) - int(a)).bit_length() for a, b in zip(low, high, strict=True)])
    cross, sums = whitening.weighted(whitening.plane_counts(x, low, bits), bits)
    u = (x - low).astype(object)
    assert sums == [int(s) for s in u.sum(0)]
    for i in range(5):
        for j in range(i, 5):
            assert cross[i][j] == int((u[:, i] * u[:, j]).sum())


def test_whitening_of_odd_tables(spark):
    empty = vectors_of(spark, []).filter("false")
    assert whitening.whitened(empty).collect() == []
    assert whitening.whitened(vectors_of(spark, [(1, None), (2, [])])).collect() == []
    one = whitening.whitened(vectors_of(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).collect()   # nothing varies
    assert sorted((r["vec_id"], r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one) == [
        (i, c, 1, 0, None, None, None) for i in (1, 2) for c in (1, 2)]
    flat = whitening.whitened(vectors_of(spark, [(i, [float(i), 1.0, 2.0]) for i in range(9)])).collect()
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in flat)
    big = float(np.float32(3e18))
    far = whitening.whitened(vectors_of(spark, [(1, [big, 0.0]), (2, [-big, 0.0]), (3, [0.0, 1e-3]), (4, [1.0])])).collect()
    assert {r["vec_id"]: r["dims"] for r in far} == {1: 2, 2: 2, 3: 2, 4: 1}
    assert all(r["deviation"] is None for r in far if r["vec_id"] < 3)


# --- Merkle manifest --------------------------------------------------------------

def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows):
    def f(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def climb(digests):
        """Root, and for each place the runs on its path."""
        paths = [[] for _ in digests]
        level, at = list(digests), list(range(len(digests)))
        while len(level) > 1:
            for p in range(len(digests)):
                run = level[at[p] // 16 * 16:at[p] // 16 * 16 + 16]
                k = at[p] % 16
                paths[p].append((run[:k], run[k + 1:]))
                at[p] //= 16
            level = [sha(*level[i:i + 16]) for i in range(0, len(level), 16)]
        return level[0], paths

    sources = {}
    for r in rows:
        leaf = sha(*map(f, r))
        bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
        other = sha(*map(f, r[:4]), f(None if r[4] is None else lower(r[4]))) if bad else leaf
        sources.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf, r[0], other))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([x[2] for x in sorted(sources[s])]) for s in order}
    root, tops = climb([trees[s][0] for s in order])
    out = []
    for s, top in zip(order, tops, strict=True):
        for x, path in zip(sorted(sources[s]), trees[s][1], strict=True):
            at, seen = x[4], []
            for left, right in path + top:
                at = sha(*left, at, *right)
                seen += left + right
            out.append((x[3], x[2], trees[s][0], root, sha(*seen), at, at == root))
    return out


def test_merkle_equals_plain(spark):
    rng = random.Random(4)
    rows = []
    for source, n in [(None, 3), ("", 1), ("a", 16), ("b", 17), ("é", 1), ("zz", 257), ("Z", 33), ("\U0001f600", 2), ("￿", 2)] + [(f"s{i}", 1) for i in range(12)]:
        rows += [(rng.randint(0, 5000), source, rng.choice(["en", None, ""]), rng.choice([None, 0, 77]), rng.choice([None, "", "Äb C\nD", "LONG " * 999])) for _ in range(n)]
    rows += [(7, "a", "en", 1, "X")] * 3 + [(7, "a", "en", 1, "Y"), (None, "a", None, None, "Q"), (None, None, None, None, None)]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, lg, s, n, "x") for i, s, lg, n, t in rows], "doc_id long, text string, lang string, source string, n_chars long, x string")
    docs = docs.toDF("doc_id", "text", "lang", "source", "n_chars", "TEXT").repartition(7)
    got = merkle.verified(docs)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(map(tuple, got.collect())) == Counter(plain_manifest(rows))


def test_merkle_of_few_rows(spark):
    docs = docs_of(spark, ["Only One"])
    assert merkle.verified(docs.limit(0)).collect() == []
    assert [tuple(r) for r in merkle.verified(docs).collect()] == plain_manifest(
        [(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in docs.collect()])


# --- line dedup -------------------------------------------------------------------

def plain_lines(rows, min_docs=2, min_chars=10):
    held = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            key = lower(line.strip(SPACE))
            if len(key) >= min_chars:
                held.setdefault(key, set()).add(i)
    out = []
    for i, t in rows:
        all_lines, kept = (t or "").split("\n"), []
        for line in all_lines:
            ids = held.get(lower(line.strip(SPACE)), set())
            if len(ids) < min_docs or i == min(ids, key=lambda v: (v is None, v or 0)):
                kept.append(line)
        out.append((i, "\n".join(kept), len(all_lines), len(all_lines) - len(kept)))
    return out


@pytest.mark.parametrize("share", [lines.HOT_SHARE, 50])
@pytest.mark.parametrize("min_docs", [2, 3])
def test_line_dedup_equals_plain(spark, monkeypatch, share, min_docs):
    monkeypatch.setattr(lines, "HOT_SHARE", share)
    rng = random.Random(5)
    pool = [f"  Shared Line {i} \t" for i in range(30)] + ["short", "", " ", "\x0bÄÖÜ äöü ßß\x0c", " nbsp line stays ", "éééééééééé", "ééééééééé", "\U0001f600" * 10]
    rows = []
    for i in range(120):
        body = [rng.choice([rng.choice(pool), rng.choice(pool).lower(), f"own line number {rng.randint(0, 10**6)}"]) for _ in range(rng.randint(0, 12))]
        rows.append((i, "\n".join(["THE VERY common line", *body] if i % 3 else body)))
    rows += [(500, None), (501, ""), (502, "\n"), (503, "\r\n\r\n"), (3, rows[3][1]), (3, "The very common line\nanother text of 3\nanother text of 3"),
             (None, "the very common line \nonly in null rows"), (None, "only in null rows"), (504, "a long line of one document\n" * 5000 + "the very common line")]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, x string").toDF("doc_id", "text", "Text").repartition(6)
    got = lines.without_repeated_lines(docs, min_docs=min_docs)
    assert Counter(map(tuple, got.collect())) == Counter(plain_lines(rows, min_docs))


def test_line_dedup_of_an_empty_table_and_native_plan(spark):
    docs = docs_of(spark, ["some long enough line\nsome long enough line"])
    assert lines.digest(docs.limit(0)).collect() == []
    assert [r["n_dropped"] for r in lines.digest(docs).collect()] == [0]
    plan = lines.digest(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
