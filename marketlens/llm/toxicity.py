"""Toxicity (operator 3): cumulative-link ordinal regression on sparse text features.

``P(grade >= k) = sigmoid(w . x - theta_k)`` for the ordered grades k = 1, 2, 3: one
weight vector shared by all thresholds, ``theta_1 < theta_2 < theta_3``. The expected
severity is the sum of the three probabilities; a document is rejected when
``P(grade >= 1) >= 0.5``.

Features are words (letters and digits, lower case) and their beginnings of 3 to 6
letters, ``x = 1 + log(count)``. Only features that the labels tie to toxic texts enter the
model, so the thousands of neutral words of a long text add no noise to its score; of a word and
its beginnings the shortest that say as much.

The labels say toxic or not. Grade 0 is not toxic; toxic documents are graded by how many of
their words carry a chosen feature: 1 up to one, 2 up to three, 3 beyond.

Learns from at most ``sample`` labelled documents, the ones with the smallest hashes (the bound
is a parameter); scores every whole text in a map-only pass."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.base import arrow_limits, labelled_sample, per_batch, pick, position

SAMPLE = 16_384       # labelled documents learnt from, at most
FEATURES = 4_096      # features of the model, at most
PREFIXES = (3, 4, 5, 6)
GRADES = 3
_WORD = re.compile(r"[^\W_]+")
_KNOWN = 150_000      # words remembered by a worker


@dataclass(frozen=True)
class Model:
    """``index``: feature -> position in ``weights``; bounded by ``FEATURES``."""
    index: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, counts: dict[int, int]) -> np.ndarray:
        """P(grade >= 1), ..., P(grade >= GRADES)."""
        z = sum(self.weights[i] * (1 + np.log(n)) for i, n in counts.items())
        return 1 / (1 + np.exp(-(z - self.thresholds)))


def forms(word: str) -> list[str]:
    """A word as a feature (marked as whole) and its beginnings."""
    return [word + "$", *[word[:n] for n in PREFIXES if len(word) >= n]]


class Counter_:
    """Counts a text's model features; remembers which features a word has."""

    def __init__(self, index: dict[str, int]):
        self.index, self.known = index, {}

    def features(self, word: str) -> tuple[int, ...]:
        if len(self.known) >= _KNOWN:
            self.known.clear()
        got = self.known[word] = tuple(self.index[f] for f in forms(word) if f in self.index)
        return got

    def count(self, text: str) -> tuple[dict[int, int], int]:
        """Feature counts, and how many words had a feature."""
        known, counts, hits = self.known, {}, 0
        for w in _WORD.findall(text.lower()):
            got = known.get(w)
            if got is None:
                got = self.features(w)
            if got:
                hits += 1
                for i in got:
                    counts[i] = counts.get(i, 0) + 1
        return counts, hits


def _word_counts(batches):
    seen: tuple[Counter, Counter] = (Counter(), Counter())

    def out():
        words = list(set(seen[0]) | set(seen[1]))
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([seen[0][w] for w in words], pa.int64()), pa.array([seen[1][w] for w in words], pa.int64())], names=["word", "clean", "toxic"])

    for batch in batches:
        for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist(), strict=True):
            seen[y].update(set(_WORD.findall(text.lower())))
        if len(seen[0]) + len(seen[1]) > 250_000:
            yield from out()
            seen = (Counter(), Counter())
    yield from out()


def _chosen(sample: DataFrame, features: int) -> list[str]:
    """The features with the surest tie to toxic texts, by log-odds over its error."""
    arrow_limits(sample.sparkSession)
    words = sample.mapInArrow(_word_counts, "word string, clean bigint, toxic bigint").groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    each = F.array(F.concat("word", F.lit("$")), *[F.when(F.length("word") >= n, F.substring("word", 1, n)) for n in PREFIXES])
    counts = words.select(F.explode(each).alias("f"), "clean", "toxic").filter("f is not null").groupBy("f").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    docs = sample.agg(F.sum(1 - F.col("y")).alias("clean"), F.sum("y").alias("toxic")).first()
    if not docs["toxic"] or not docs["clean"]:
        return []
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(a / F.lit(docs["toxic"] + 1.0)) - F.log(b / F.lit(docs["clean"] + 1.0))
    best = (counts.filter("toxic >= 5").withColumn("odds", odds).withColumn("z", F.col("odds") / F.sqrt(1 / a + 1 / b))
            .filter((F.col("odds") > 3.0) & (F.col("z") > 2.5)).orderBy(F.desc("z"), "f").limit(features))
    odds_of = {r["f"]: r["odds"] for r in best.select("f", "odds").collect()}
    # a beginning that says as much as a longer one stands for it, so unseen endings count too
    return [f for f, o in odds_of.items() if not any(odds_of.get(f[:n], -99.0) >= o - 0.2 for n in PREFIXES if n < len(f))]


def _rows(sample: DataFrame, index: dict[str, int]) -> list:
    def run(batch: pa.RecordBatch) -> dict:
        counter = Counter_(index)
        out = [counter.count(t) for t in batch.column("text").to_pylist()]
        return {"y": batch.column("y").cast(pa.int32()), "hits": pa.array([h for _, h in out], pa.int32()),
                "at": pa.array([list(c) for c, _ in out], pa.list_(pa.int32())), "n": pa.array([list(c.values()) for c, _ in out], pa.list_(pa.int32()))}

    return per_batch(sample, run, "y int, hits int, at array<int>, n array<int>").collect()   # bounded by the sample


def _regress(rows: list, size: int, steps: int = 600, rate: float = 0.1, l2: float = 1e-6) -> tuple[np.ndarray, np.ndarray]:
    """Full-gradient Adam on the ordinal log-likelihood. Thresholds are a first
    value and positive steps, so they stay in order."""
    y = np.array([0 if not r["y"] else 1 if r["hits"] <= 1 else 2 if r["hits"] <= 3 else 3 for r in rows])
    at = np.concatenate([np.asarray(r["at"], np.int64) for r in rows] or [np.empty(0, np.int64)])
    x = 1 + np.log(np.concatenate([np.asarray(r["n"], float) for r in rows] or [np.empty(0)]))
    row = np.repeat(np.arange(len(rows)), [len(r["at"]) for r in rows])
    target = (y[:, None] >= np.arange(1, GRADES + 1)).astype(float)
    p = np.concatenate([np.zeros(size), [1.0], np.zeros(GRADES - 1)])
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        gaps = np.exp(p[size + 1:])
        theta = p[size] + np.concatenate([[0], np.cumsum(gaps)])
        z = np.bincount(row, p[at] * x, minlength=len(rows))
        error = 1 / (1 + np.exp(-np.clip(z[:, None] - theta, -30, 30))) - target
        per_row = error.sum(1) / len(rows)
        g_theta = -error.mean(0)
        g = np.concatenate([np.bincount(at, per_row[row] * x, minlength=size)[:size] + l2 * p[:size], [g_theta.sum()], [g_theta[k + 1:].sum() * gaps[k] for k in range(GRADES - 1)]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return p[:size], p[size] + np.concatenate([[0], np.cumsum(np.exp(p[size + 1:]))])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES) -> Model:
    """Train on labelled documents. Without toxic or without clean labels there is
    nothing to learn and the model rejects nothing."""
    rows = labelled_sample(docs, labels, "toxic", sample)
    chosen = _chosen(rows, features)
    index = {f: i for i, f in enumerate(chosen)}
    if not index:
        return Model({}, np.zeros(0), np.array([5.0, 6.0, 7.0]))
    return Model(index, *_regress(_rows(rows, index), len(index)))


def severity(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, p_toxic, severity, grade, toxic`` for every row: P(grade >= 1), the
    expected grade, the likeliest grade by the half marks, and the decision. A null or empty
    text has no features and gets the model's score for none. Repeated rows get
    the same scores; an empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)   # bounded by FEATURES

    def run(batch: pa.RecordBatch) -> dict:
        model = shared.value
        counter = _counter(model)
        p = np.array([model.at_least(counter.count(t or "")[0]) for t in batch.column(1).to_pylist()]).reshape(-1, GRADES)
        return {"doc_id": batch.column(0), "p_toxic": p[:, 0], "severity": p.sum(1), "grade": (p >= 0.5).sum(1).astype(np.int32), "toxic": p[:, 0] >= 0.5}

    docs = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return per_batch(docs, run, "doc_id bigint, p_toxic double, severity double, grade int, toxic boolean")


def without_toxic(docs: DataFrame, model: Model, column: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, all columns as they were."""
    arrow_limits(docs.sparkSession)
    at = position(docs, column)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    flat = docs.toDF(*[f"_in{i}" for i in range(len(docs.columns))])

    def run(batches):
        model = shared.value
        counter = _counter(model)
        for batch in batches:
            keep = [bool(model.at_least(counter.count(t or "")[0])[0] < 0.5) for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return flat.mapInArrow(run, flat.schema).toDF(*docs.columns)


_counters: dict[int, tuple[Model, Counter_]] = {}


def _counter(model: Model) -> Counter_:
    """One counter for each model in a worker, so known words last over batches."""
    got = _counters.get(id(model))
    if got is None or got[0] is not model:
        _counters.clear()
        got = _counters[id(model)] = (model, Counter_(model.index))
    return got[1]
