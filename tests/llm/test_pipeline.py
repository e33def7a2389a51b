"""The corpus pipeline on the smallest tables, stage by stage."""

import random
import re

import numpy as np
import pytest

from marketlens.llm import jaccard

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    import corpus_pipeline as cp
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, seen = docs.columns, {r["doc_id"]: r for r in docs.collect()}
    for i, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, SMALL)
        rows = out.collect()
        got = {r["doc_id"]: r for r in rows}
        assert len(got) == len(rows) and (out.columns == columns or i == 4)
        if name == "near_copies":
            comp = brute({k: r["text"] for k, r in seen.items()}, cp.NEAR["shingle"], cp.NEAR["num"])
            assert set(got) == {k for k, c in comp.items() if c == k}
        elif name != "toxicity":
            assert set(got) == set(seen)
        if name == "secrets":
            assert not any(re.search(r"(?<![0-9a-f])[0-9a-f]{24,}", r["text"]) for r in rows)
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
        docs = spark.createDataFrame(rows, out.schema)
        seen = got


def test_run_and_empty(spark, tmp_path):
    import corpus_pipeline as cp
    out = cp.run(spark, SMALL)
    assert "token_ids" in out.columns and 0 < out.count() < 200
    for t in ("documents", "labels"):
        spark.read.parquet(f"{SMALL}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_near_copies_of_two_percent_and_repeated_ids(spark):
    import corpus_pipeline as cp
    from tests.llm.test_text_ops import docs_of
    long = [f"w{i}" for i in range(50)]
    texts = [" ".join(long), " ".join(long[:25] + ["other"] + long[26:]), " ".join(f"v{i}" for i in range(100)), " ".join("u" if i in (30, 70) else f"v{i}" for i in range(100))]
    docs = docs_of(spark, texts)
    assert sorted(r["doc_id"] for r in cp.without_near_copies(spark, docs, SMALL).collect()) == [0, 2]
    again = docs.unionByName(docs.filter("doc_id = 0")).unionByName(docs.filter("doc_id = 2").selectExpr("0L as doc_id", "'quite another text' as text", "lang", "source", "n_chars"))
    got = sorted((r["doc_id"], r["text"]) for r in cp.without_near_copies(spark, again, SMALL).collect())
    assert got == [(0, "quite another text"), (0, texts[0]), (2, texts[2])]


def brute(texts, n, num):
    """Components by all pairs."""
    sets = {}
    for i, t in texts.items():
        w = (t or "").lower().split()
        sets[i] = {tuple(w[j:j + n]) for j in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    top = {i: i for i in sets}

    def find(x):
        return x if top[x] == x else find(top[x])

    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                top[y] = x
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("block", [(2_048, 1 << 20), (3, 400)])
def test_near_copies_equal_brute_force(spark, monkeypatch, block):
    """With blocks of few classes, clusters are cut by size."""
    import corpus_pipeline as cp
    monkeypatch.setattr(jaccard, "BLOCK_DOCS", block[0])
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", block[1])
    from tests.llm.test_text_ops import docs_of
    rng, texts = random.Random(6), ["", None, "one", "One", "one two three four five"]
    passage = " ".join(f"p{i}" for i in range(12))
    for size in (6, 9, 14, 20, 27, 40, 60, 90, 140, 250, 400):
        base = [f"s{size}x{i}" for i in range(size)]
        for i in range(14):
            words = list(base)
            for _ in range(rng.randint(0, max(1, size // 30))):
                words[rng.randrange(size)] = f"n{rng.randint(0, 10**6)}"
            texts.append(" ".join(words[:size - rng.randint(0, size // 10)] + ([passage] if i % 3 == 0 else [])))
    docs = docs_of(spark, texts)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.near_copies(docs, **cp.NEAR).collect()}
    assert got == brute(dict(enumerate(texts)), cp.NEAR["shingle"], cp.NEAR["num"])
    assert len(set(got.values())) < len(texts) - 40


def test_signatures_at_the_bound_of_the_pipeline():
    rng = random.Random(9)
    for _ in range(600):
        a = {rng.getrandbits(64) for _ in range(rng.choice([rng.randint(1, 80), rng.randint(1, 700)]))}
        b = last = set(a)
        while b and 100 * len(a & b) >= 80 * len(a | b):
            last = set(b)
            if rng.random() < 0.5:
                b.remove(rng.choice(sorted(b)))
            if rng.random() < 0.7:
                b.add(rng.getrandbits(64))
        common = np.array(sorted(rng.sample(sorted(a), rng.choice([0, len(a) // 10, len(a) // 2, len(a)])) + [1, 1 << 63]), np.uint64)
        x, y = (np.array(sorted(s), np.uint64) for s in (a, last))
        for c in (None, common):
            assert set(jaccard.signatures(x, 80, 100, c).tolist()) & set(jaccard.signatures(y, 80, 100, c).tolist())


def test_mix_order_comes_with_the_token_ids(spark, tmp_path):
    """The encode stage reads many files in any order; sorted by slot and place each source keeps to its target."""
    import corpus_pipeline as cp
    from marketlens.llm import mixing
    from marketlens.llm.queries import TARGETS
    from tests.llm.test_text_ops import docs_of
    rng = random.Random(8)
    size = mixing.BLOCK_CHARS // 4
    sources = [rng.choice(["src0", "src0", "src1", "src2", "src3", "a", "b", "c"]) for _ in range(240)]
    docs = docs_of(spark, [f"{i} " + "x" * (size - len(str(i)) - 1) for i in range(240)], sources)
    cp.mixed(spark, docs, SMALL).repartition(7, "doc_id").write.parquet(f"{tmp_path}/mix")
    rows = cp.encoded(spark, spark.read.schema(docs.schema).parquet(f"{tmp_path}/mix"), SMALL).drop("text").collect()
    want = {r["doc_id"]: (r["slot"], r["place"]) for r in mixing.schedule(docs, TARGETS).collect()}
    assert {r["doc_id"]: (r["slot"], r["place"]) for r in rows} == want
    rows.sort(key=lambda r: (r["slot"], r["place"]))
    targets = {k: w for k, w in TARGETS.items() if k != "*"} | dict.fromkeys("abc", TARGETS["*"] / 3)
    of = [r["source"] for r in rows]
    blocks = {k: -(-of.count(k) // 4) for k in targets}
    sent, slots = dict.fromkeys(targets, 0), {}
    for r, k in zip(rows, of, strict=True):
        slots[r["slot"]] = k
    for n, slot in enumerate(sorted(slots), 1):
        sent[slots[slot]] += 1
        if any(sent[k] == blocks[k] for k in targets):   # a source runs out: its slots go to the others
            break
        assert all(abs(sent[k] - n * w / mixing.CYCLE) < 1 for k, w in mixing.shares(targets).items())
    assert n > 20


def test_blocks_of_signatures_come_back():
    rng = np.random.default_rng(3)
    for bits, ranges, n in ((40, 16, 5_000), (64, 3, 70_000), (48, 7, 1), (40, 1, 0)):
        sigs = np.concatenate([rng.integers(0, 1 << 64, n, np.uint64), np.array([0, (1 << 64) - 1], np.uint64)])
        sigs = np.concatenate([sigs, sigs[: len(sigs) // 3]])
        owner = rng.integers(0, max(1, n), len(sigs))
        docs = rng.integers(-(1 << 62), 1 << 62, max(1, n))
        out = jaccard.packed(sigs, owner, docs, bits, ranges)
        got = [jaccard.unpacked(*(out[c][i] for c in ("first", "steps", "owners", "docs"))) for i in range(len(out["part"]))]
        first = {}
        for s, o in sorted((int(s) >> (64 - bits), int(o)) for s, o in zip(sigs, owner, strict=True)):
            first.setdefault(s, []).append(int(docs[o]))
        assert sorted((int(s), int(d)) for v, w in got for s, d in zip(v, w, strict=True)) == sorted((s, d[0]) for s, d in first.items())
        pairs = {(int(a), int(b)) for x in out["links"] for a, b in np.reshape(x, (-1, 2))}
        assert pairs == {(d[0], x) for d in first.values() for x in d[1:] if x != d[0]}


def test_small_tables_are_written_in_few_files(spark, monkeypatch):
    """Not in a file for each shuffle partition, where Spark does not coalesce them."""
    from marketlens.llm import components
    from marketlens.llm.base import saved
    written = []

    def kept(df, name, *rows):
        out = saved(df, name, *rows)
        written.append((name, len(out.inputFiles())))
        return out

    held = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "60"}
    before = {k: spark.conf.get(k) for k in held}
    for module in (components, jaccard):
        monkeypatch.setattr(module, "saved", kept)
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        words = [f"w{i}" for i in range(400)]
        texts = [" ".join(words[i:i + 60]) for i in range(150)] + [" ".join(words[i:i + 60] + ["x"]) for i in range(150)]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
        got = jaccard.one_of_each(docs, 3, 80, 100).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r.doc_id for r in got} == {r.doc_id for r in jaccard.one_of_each(docs, 3, 80, 100).collect()}
    most = spark.sparkContext.defaultParallelism
    assert {name for name, _ in written} >= {"nj-classes", "nj-members", "cc-links", "cc-hook", "nj-clusters", "nj-of", "nj-info"}
    assert not [(name, n) for name, n in written if n > most + 1 and name != "nj-links"]
