"""Quality classifier (operator 6): hashed word n-gram logistic regression trained with
follow-the-regularised-leader updates, scored as sparse dot products.

A text is a sequence of words, each with a shape (runs of capital and small letters, digits
and signs) and marks for a word that repeats the one before and for a pair of words met earlier in the
text. Features are hashed n-grams: single words, pairs of words, and one to three
shapes in a row. The value of a feature is its share of the text's n-grams of that kind, so the score of
a long text does not drift with its length.

Training reads at most ``sample`` labelled documents (smallest hashes of their ids), dealt over ``shards``
tasks; each runs FTRL-proximal on its share for some epochs, and the weights are averaged. The
model has ``2 ** BITS`` weights whatever the corpus, and is broadcast. Scoring is one map-only pass over whole
texts; labels, language, source and ids are not read."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.base import arrow_limits, labelled_sample, per_batch, pick
from marketlens.llm.shingles import mix

BITS = 18
SAMPLE = 16_384
SHARDS = 8
EPOCHS = 4
THRESHOLD = 0.3
FOLDS = 5            # documents with crc32(doc_id) % FOLDS == 0 are held out
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-4
_KNOWN = 200_000
_KIND = np.uint64(0x9E3779B97F4A7C15)
_SALT = np.arange(1, 6, dtype=np.uint64) * _KIND   # by kind: words, pairs, one to three shapes
_SCALE = (1.0, 1.0, 4.0, 4.0, 4.0)
_LOW = np.uint64(0xFFFFFFFF)
_RUNS = re.compile(r"(?P<A>[A-Z]+)|(?P<a>[^\W\d_]+)|(?P<d>\d+)|(?P<s>.)", re.DOTALL)


def shape(word: str) -> str:
    """``A`` for a run of capitals, ``a`` for other letters, ``0`` for digits; other signs
    once for each run of the same."""
    out = []
    for m in _RUNS.finditer(word):
        c = {"A": "A", "a": "a", "d": "0"}.get(m.lastgroup) or m[0]
        if not out or out[-1] != c:
            out.append(c)
    return "".join(out)


class _Words(dict):
    """Word -> hash of the lower-case word (high half) and of its shape (low half)."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _KNOWN:
            self.clear()
        got = (xxhash.xxh32_intdigest(word.lower()) << 32) | xxhash.xxh32_intdigest(shape(word))
        if len(word) <= 64:
            self[word] = got
        return got


_words = _Words()


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """``(index, value)`` of a text's n-grams; an index may come more than once."""
    words = (text or "").split()
    if not words:
        return np.empty(0, np.int64), np.empty(0)
    both = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    word, form = both >> np.uint64(32), both & _LOW
    pair = mix(word[:-1] * _KIND + word[1:])
    again = np.concatenate([[False], word[1:] == word[:-1]])
    _, first = np.unique(pair, return_index=True)
    seen = np.ones(len(pair), bool)
    seen[first] = False
    form = form * np.uint64(4) + again.astype(np.uint64) * np.uint64(2) + np.concatenate([[False], seen]).astype(np.uint64)
    kinds = [word, pair, form]
    for n in (2, 3):
        if len(form) >= n:
            h = form[:len(form) - n + 1]
            for i in range(1, n):
                h = mix(h * _KIND + form[i:len(form) - n + 1 + i])
            kinds.append(h)
    index = np.concatenate([mix(h + salt) >> np.uint64(64 - BITS) for h, salt in zip(kinds, _SALT)]).astype(np.int64)
    value = np.concatenate([np.full(len(h), scale / len(h)) for h, scale in zip(kinds, _SCALE) if len(h)])
    return index, value


def _merged(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    index, value = features(text)
    at, where = np.unique(index, return_inverse=True)
    return at, np.bincount(where, value, minlength=len(at)) if len(at) else np.empty(0)


def ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS) -> np.ndarray:
    """FTRL-proximal over the examples in turn; the last weight is the bias."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(at):
        zi = z[at]
        return np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(epochs):
        for at, value, y in examples:
            at, value = np.append(at, 1 << BITS), np.append(value, 1.0)
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(w @ value, -35, 35))) - y) * value
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(np.arange((1 << BITS) + 1))


def held_out(doc_id, folds: int, fold: int):
    """crc32 of the id as text falls in ``fold``. A null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, shards: int = SHARDS) -> np.ndarray:
    """Weights learnt from the labelled documents that are not held out. Without labels all are 0."""
    rows = labelled_sample(docs, labels, label, sample, learn=lambda i: ~held_out(i, FOLDS, 0))
    arrow_limits(docs.sparkSession)

    def train(batches):
        examples = [(*_merged(t), int(y)) for b in batches for t, y in zip(b.column("text").to_pylist(), b.column("y").to_pylist(), strict=True)]
        if examples:
            w = ftrl(examples)
            at = np.flatnonzero(w)
            share = len(examples)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(w[at], 1.0) * share)], names=["at", "w"])

    # each shard holds at most its part of the bounded sample
    parts = rows.repartition(shards, F.xxhash64(F.lit(3), "doc_id")).sortWithinPartitions(F.xxhash64(F.lit(4), "doc_id"))
    got = parts.mapInArrow(train, "at bigint, w double").groupBy("at").agg(F.sum("w").alias("w")).collect()   # at most 2 ** BITS + 2 rows
    weights = np.zeros((1 << BITS) + 1)
    total = sum(r["w"] for r in got if r["at"] < 0)
    for r in got:
        if r["at"] >= 0:
            weights[r["at"]] = r["w"] / total
    return weights


def scores(docs: DataFrame, weights: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row. A null, empty or blank text has
    no features and gets the bias alone. Repeated rows get the same scores; an empty table
    gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)   # 2 ** BITS doubles

    def run(batch: pa.RecordBatch) -> dict:
        w = shared.value
        z = np.array([w[index] @ value for index, value in map(features, batch.column(2).to_pylist())]) + w[-1]
        score = 1 / (1 + np.exp(-np.clip(z, -35, 35)))
        return {"doc_id": batch.column(0), "held_out": batch.column(1), "score": score, "predicted": (score >= threshold).astype(np.int32)}

    docs = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id"), FOLDS, 0).alias("held_out"), "text")
    return per_batch(docs, run, "doc_id bigint, held_out boolean, score double, predicted int")
