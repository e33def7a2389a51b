"""LM scoring (operator 8): Brown class-based n-grams.

``P(w_i | w_{i-1}) = P(c_i | c_{i-1}) P(w_i | c_i)``. Exchange clustering gives every word of the training texts
its class. The ``FREQUENT`` most frequent words, the core, are moved word after word to the class in which the
class bigrams have the highest likelihood, over some sweeps. Every other word then makes the same move against the core's
table: from the class of words not yet placed to the class that raises the likelihood most. So all known words are in Brown classes;
a word that training never saw belongs to a class of its own, as frequent behind every class as words met once are in the corpus (Good-Turing). Transitions and emissions are counted over every token of every
training text and smoothed by addition; a text's score is its log10 probability, from which ``perplexity`` follows.

1. Count words: each task sends its distinct words, which are summed by word. The ``KNOWN`` most frequent are numbered.
2. Encode each text once: numbers of the known words, and its other words beside them.
3. Count pairs over the core, words not yet placed and the text's end: at most ``(FREQUENT + 2) ** 2`` cells, on which the driver clusters.
4. Count (word, neighbouring class) by word and place the words in tasks. The known words' classes are broadcast; the
   other words stay in a table.
5. Every token of those other words becomes a row that meets its class in a join; neighbours among them meet in a window
   over the text. Transitions are summed from the rows and the encoded texts, and so are the scores.

Where a word is held does not change its class or any score. The vocabulary is never held in one place and grows with the corpus."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.base import arrow_limits, pick, saved
from marketlens.llm.shingles import words

FREQUENT = 1_024     # words of the core, which the driver clusters
CLASSES = 64         # Brown classes
KNOWN = 131_072      # most frequent words whose classes and probabilities are broadcast, at most
SWEEPS = 3
ADD_CLASS, ADD_WORD = 0.5, 0.5
FOLDS, HELD_OUT = 7, 2
_DISTINCT = 300_000  # distinct words a task holds before it sends them
_ROWS = 50_000       # rows a task holds before it sends them


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(pairs: np.ndarray, frequent: int, classes: int, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each row of the pair table: ``0 .. classes - 1`` for the first ``frequent`` rows, by
    exchange; every further row is a class of its own."""
    size = len(pairs)
    fixed = size - frequent
    of = np.concatenate([np.arange(frequent) % classes, classes + np.arange(fixed)])
    total = classes + fixed
    one = np.zeros((size, total))
    one[np.arange(size), of] = 1.0
    after, before = pairs @ one, (one.T @ pairs).T     # by word: classes that follow, that come before
    table = one.T @ after
    for _ in range(sweeps):
        moved = 0
        for w in range(frequent):
            a, twice = of[w], pairs[w, w]
            out, into = after[w].copy(), before[w].copy()
            out[a] -= twice
            into[a] -= twice
            if out.sum() + into.sum() + twice == 0:
                continue
            table[a] -= out
            table[:, a] -= into
            table[a, a] -= twice
            # sums of the classes with w's pairs to the other words, which do not depend on w's class
            left, right = table.sum(1) + into, table.sum(0) + out
            n_out, n_in = out.sum() + twice, into.sum() + twice
            rows, cols = table[:classes], table[:, :classes].T
            gain = (_xlogx(rows + out) - _xlogx(rows)).sum(1) + (_xlogx(cols + into) - _xlogx(cols)).sum(1)
            own = np.arange(classes)
            same = table[own, own]
            gain += _xlogx(same + out[own] + into[own] + twice) + _xlogx(same) - _xlogx(same + out[own]) - _xlogx(same + into[own])
            l, r = left[:classes], right[:classes]
            gain -= _xlogx(l + n_out) - _xlogx(l) + _xlogx(r + n_in) - _xlogx(r)
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = int(a)
            table[b] += out
            table[:, b] += into
            table[b, b] += twice
            if b != a:
                moved += 1
                of[w] = b
                after[:, a] -= pairs[:, w]
                after[:, b] += pairs[:, w]
                before[:, a] -= pairs[w]
                before[:, b] += pairs[w]
        if not moved:
            break
    return of


@dataclass(frozen=True)
class Vocabulary:
    known: dict[bytes, int]          # word -> number, by falling count; at most KNOWN
    n: np.ndarray                    # counts by number
    tokens: int                      # N
    distinct: int                    # V
    once: int                        # words met once
    documents: int


@dataclass(frozen=True)
class Model:
    words: Vocabulary
    word_class: np.ndarray           # class by number
    word_score: np.ndarray           # log10 P(word | class)
    word_base: np.ndarray            # log10 of the base unigram probability
    moves: np.ndarray                # log10 P(class | class before); the last two: unseen words, the text's end
    within: np.ndarray               # what emissions of a class are divided by
    end_base: float


def _word_counts(batches):
    seen: Counter = Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            seen.update(words(text))
            if len(seen) > _DISTINCT:
                yield out()
                seen = Counter()
    yield out()


def vocabulary(docs: DataFrame, known: int = KNOWN) -> Vocabulary:
    """Counts of the words of the texts (null: empty)."""
    texts = pick(docs, "text").select(F.coalesce("text", F.lit("")).alias("text"))
    arrow_limits(docs.sparkSession)
    counts = saved(texts.mapInArrow(_word_counts, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n")), "lm-counts")
    documents = texts.count()
    # words by an eighth of a power of two: few rows, which show how far down the known words may reach
    level = F.floor(F.log2("n") * 8)
    levels = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("tokens")).collect()
    least, some = None, 0
    for r in sorted(levels, key=lambda r: -r["level"]):
        if some + r["words"] > known:
            break
        some, least = some + r["words"], r["level"]
    top = counts.filter(level >= least).collect() if least is not None else []   # at most ``known`` rows
    top.sort(key=lambda r: (-r["n"], bytes(r["word"])))
    return Vocabulary({bytes(r["word"]): i for i, r in enumerate(top)}, np.array([r["n"] for r in top], float),
                      sum(r["tokens"] for r in levels) + documents, sum(r["words"] for r in levels) + (documents > 0),
                      sum(r["words"] for r in levels if r["level"] == 0), documents)


_TEXT = "uid bigint, doc_id bigint, held_out boolean, learn boolean, ids binary, others array<binary>"


def _encode(shared):
    def run(batches):
        known = shared.value.known.get
        uid = TaskContext.get().partitionId() << 36
        for batch in batches:
            ids, others = [], []
            for text in batch.column(3):
                text = text.as_py()
                found = words(text) if text else []
                row, rest = list(map(known, found)), {}
                if None in row:
                    row = [-1 - rest.setdefault(w, len(rest)) if i is None else i for i, w in zip(row, found, strict=True)]
                ids.append(np.array(row, np.int32).tobytes())
                others.append(list(rest))
            uids = np.arange(uid, uid + len(ids))
            uid += len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(uids), *batch.columns[:3], pa.array(ids, pa.binary()), pa.array(others, pa.list_(pa.binary()))],
                                             names=["uid", "doc_id", "held_out", "learn", "ids", "others"])

    return run


def encoded(docs: DataFrame, vocab: Vocabulary, learn=None) -> DataFrame:
    """One row a text: numbers of its words; ``-1 - i`` stands for ``others[i]``."""
    texts = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
                                                F.lit(True).alias("learn") if learn is None else learn(F.col("doc_id")).alias("learn"), "text")
    arrow_limits(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocab)   # at most KNOWN words
    return saved(texts.mapInArrow(_encode(shared), _TEXT), "lm-texts")


def _ids(column) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), np.int32) for x in column]


def _pairs(column, lookup: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Neighbours in the texts, the end of one being the start of the next, by ``lookup`` (known words, the end, others);
    the second array gives the numbers themselves."""
    end = np.array([len(lookup) - 2])
    row = np.concatenate([end] + [part for ids in _ids(column) for part in (ids, end)])
    row[row < 0] = len(lookup) - 1
    return lookup[row], row


def _cells(table: np.ndarray):
    at = np.flatnonzero(table)
    for i in range(0, len(at), 1 << 18):
        yield pa.RecordBatch.from_arrays([pa.array(at[i:i + (1 << 18)], pa.int64()), pa.array(table[at[i:i + (1 << 18)]], pa.int64())], names=["cell", "n"])


def _pair_counts(lookup: np.ndarray, size: int):
    """Cells ``before * size + after``; pairs with a negative entry of ``lookup`` are left out."""
    def run(batches):
        table = np.zeros(size * size, np.int64)
        for batch in batches:
            got, _ = _pairs(batch.column(0), lookup)
            a, b = got[:-1], got[1:]
            use = (a >= 0) & (b >= 0)
            table += np.bincount(a[use] * size + b[use], minlength=size * size)
        yield from _cells(table)

    return run


def _neighbour_counts(lookup: np.ndarray, core: int, total: int):
    """Cells ``(number - core) * 2 * total + class after``, or ``+ total + class before``, of the known words behind the core."""
    def run(batches):
        known = len(lookup) - 2
        table = np.zeros((known - core) * 2 * total, np.int32)
        for batch in batches:
            got, row = _pairs(batch.column(0), lookup)
            at = np.flatnonzero((row >= core) & (row < known))
            to = (row[at].astype(np.int64) - core) * (2 * total)
            np.add.at(table, to + got[at + 1], 1)
            np.add.at(table, to + total + got[at - 1], 1)
        yield from _cells(table)

    return run


def best_classes(table: np.ndarray, groups: int, of: np.ndarray, col: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Class to which each word moves from the class ``groups`` of words not yet placed. ``of``, ``col`` and ``n`` are the words'
    counts, sorted by word and column: classes after it, then (``+ len(table)``) classes before it."""
    total, size = len(table), int(of[-1]) + 1
    sides = np.zeros((2, size, total))
    side, c = col // total, col % total
    sides[side, of, c] = n
    out, into = sides[:, :, :groups]
    base = np.where((side == 0)[:, None], table[:groups, c].T, table[c, :groups])
    own = c == groups    # without the pairs that the word itself has there
    base[own] -= np.where((side[own] == 0)[:, None], into[of[own]], out[of[own]])
    gain = np.add.reduceat(_xlogx(base + n[:, None]) - _xlogx(base), np.flatnonzero(np.diff(of, prepend=-1)))
    same = np.diag(table)[:groups]
    gain += _xlogx(same + out + into) + _xlogx(same) - _xlogx(same + out) - _xlogx(same + into)
    n_out, n_in = sides.sum(2)[:, :, None]
    left, right = table.sum(1)[:groups], table.sum(0)[:groups]
    gain -= _xlogx(left + n_out) - _xlogx(left) + _xlogx(right + n_in) - _xlogx(right)
    return np.argmax(np.round(gain, 6), axis=1)


def _places(table: np.ndarray, groups: int):
    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            cells = batch.column(1)
            of, flat = np.asarray(pc.list_parent_indices(cells)), cells.flatten()
            col, n = np.asarray(flat.field(0)).astype(np.int64), np.asarray(flat.field(1)).astype(float)
            order = np.lexsort((col, of))
            of, col, n = of[order], col[order], n[order]
            count = np.bincount(of, n * (col < len(table)), len(batch)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count), pa.array(best_classes(table, groups, of, col, n), pa.int32())], names=["word", "n", "class"])

    return run


def _placed(cells: DataFrame, table: np.ndarray, groups: int, kind: str) -> DataFrame:
    """``word, n, class`` from rows ``word, col, n`` that are partitioned by word: a word has at most two cells for each class."""
    cells = cells.groupBy("word", "col").agg(F.sum("n").alias("n")).groupBy("word").agg(F.collect_list(F.struct("col", "n")).alias("cells"))
    return cells.mapInArrow(_places(table, groups), f"word {kind}, n bigint, class int")


_TOKEN = "word binary, uid bigint, learn boolean, pos int, before int, after int, col_before int, col_after int"


def _other_tokens(classes: np.ndarray, columns: np.ndarray):
    """Tokens of words without a number: the classes of their neighbours (-1: such a word too) and the columns that stand for them while
    words are placed."""
    names = [f.split()[0] for f in _TOKEN.split(", ")]

    def run(batches):
        end = np.array([len(classes) - 2])

        def out(parts: list) -> pa.RecordBatch:
            word, *rest = zip(*parts, strict=True)
            return pa.RecordBatch.from_arrays([pa.array([w for some in word for w in some], pa.binary()), *[pa.array(np.concatenate(x)) for x in rest]], names=names)

        for batch in batches:
            parts, held = [], 0
            for uid, learn, ids, others in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _ids(batch.column(2)), batch.column(3), strict=True):
                at = np.flatnonzero(ids < 0)
                if not len(at):
                    continue
                others = others.as_py()
                row = np.concatenate([end, np.where(ids < 0, len(classes) - 1, ids), end])
                near = [x[row[at + i]].astype(np.int32) for x in (classes, columns) for i in (0, 2)]
                parts.append(([others[-1 - i] for i in ids[at]], np.full(len(at), uid), np.full(len(at), learn), at.astype(np.int32), *near))
                held += len(at)
                if held > _ROWS:
                    yield out(parts)
                    parts, held = [], 0
            if parts:
                yield out(parts)

    return run


def _summed(cells: DataFrame, size: int) -> np.ndarray:
    """A table of ``size ** 2`` cells at most, on the driver."""
    out = np.zeros(size * size)
    for r in cells.groupBy("cell").agg(F.sum("n").alias("n")).toArrow().to_pylist():
        out[r["cell"]] = r["n"]
    return out.reshape(size, size)


def _met(tokens: DataFrame, rest: DataFrame, groups: int) -> DataFrame:
    """Tokens with the class and the count of their word, and the class before them; words that training never saw are in the class
    ``groups``. A text's tokens meet in one task, as the text itself does."""
    found = tokens.select("word", "uid", "learn", "pos", "before", "after").join(rest.select("word", "n", "class"), "word", "left")
    found = found.select("uid", "learn", "pos", "before", "after", F.coalesce("class", F.lit(groups)).alias("class"), F.coalesce("n", F.lit(0)).alias("n"))
    ahead = F.lag("class").over(Window.partitionBy("uid").orderBy("pos"))
    return saved(found.select("uid", "learn", F.when(F.col("before") < 0, ahead).otherwise(F.col("before")).alias("before"), "after", "class", "n"), "lm-met")


def _lookup(classes: np.ndarray, end: int, others: int) -> np.ndarray:
    return np.concatenate([classes, [end, others]]).astype(np.int64)


def _learned(texts: DataFrame, vocab: Vocabulary, frequent: int, classes: int) -> tuple[Model, DataFrame, DataFrame]:
    """The model, ``word, n, class`` of the words without a number, and their tokens in all texts."""
    learn = texts.filter("learn").select("ids")
    known = len(vocab.known)
    core = min(frequent, known)
    size = core + 2
    pairs = _summed(learn.mapInArrow(_pair_counts(_lookup(np.minimum(np.arange(known), core), core + 1, core), size), "cell bigint, n bigint"), size)
    groups = max(1, min(classes, core))
    of = exchange(pairs, core, groups)
    total = groups + 2
    one = np.zeros((size, total))
    one[np.arange(size), of] = 1.0
    table = one.T @ pairs @ one
    columns = np.full(known, groups)
    columns[:core] = of[:core]
    look = _lookup(columns, groups + 1, groups)
    word_class = columns.copy()
    if known > core:
        cells = learn.mapInArrow(_neighbour_counts(look, core, total), "cell bigint, n bigint")
        cells = cells.select(F.floor(F.col("cell") / (2 * total)).alias("word"), (F.col("cell") % (2 * total)).cast("int").alias("col"), "n").repartition("word")
        for r in _placed(cells, table, groups, "bigint").collect():   # at most KNOWN rows
            word_class[core + r["word"]] = r["class"]
    lasting = _lookup(word_class, groups + 1, -1)
    tokens = texts.filter("size(others) > 0").select("uid", "learn", "ids", "others").mapInArrow(_other_tokens(lasting, look), _TOKEN)
    # shuffled once by word: a word behind the KNOWN most frequent holds less than one in KNOWN of all tokens
    mine = tokens.filter("learn").select("word", "col_before", "col_after").repartition("word")
    cells = mine.select("word", F.explode(F.array(F.col("col_after"), F.col("col_before") + total)).alias("col"), F.lit(1).cast("bigint").alias("n"))
    rest = saved(_placed(cells, table, groups, "binary"), "lm-rest")
    c_tokens = np.bincount(word_class, vocab.n, total) if known else np.zeros(total)
    c_words = np.bincount(word_class, minlength=total).astype(float)
    for r in rest.groupBy("class").agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("words")).collect():
        c_tokens[r["class"]] += r["tokens"]
        c_words[r["class"]] += r["words"]
    within = c_tokens + ADD_WORD * c_words
    within[groups:] = ADD_WORD * (vocab.once + 1), 1.0    # an unseen word: one of as many as were met once
    base = vocab.tokens + vocab.distinct + 1
    model = Model(vocab, word_class, np.log10((vocab.n + ADD_WORD) / within[word_class]), np.log10((vocab.n + 1) / base), np.empty((total, total)), within,
                  float(np.log10((vocab.documents + 1) / base)))
    return model, rest, tokens


def _with_moves(model: Model, texts: DataFrame, met: DataFrame) -> Model:
    """The model with its transitions, counted over all pairs of the training texts."""
    total = len(model.within)
    lasting = _lookup(model.word_class, total - 1, -1)
    cells = texts.filter("learn").select("ids").mapInArrow(_pair_counts(lasting, total), "cell bigint, n bigint")
    mine = met.filter("learn")    # the step to a token, and from it to a word with a number
    steps = mine.select(F.col("before").alias("a"), F.col("class").alias("b")).unionAll(mine.filter("after >= 0").select("class", "after")).groupBy((F.col("a") * total + F.col("b")).cast("bigint").alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    table = _summed(cells.unionAll(steps), total)
    unseen = model.words.once / max(1, model.words.tokens)
    table[:, total - 2], table[total - 2] = table.sum(1) * unseen, table.sum(0) * unseen
    table[total - 2, total - 2] = model.words.once * unseen
    return replace(model, moves=np.log10((table + ADD_CLASS) / (table.sum(1, keepdims=True) + ADD_CLASS * total)))


_SCORE = "uid bigint, doc_id bigint, held_out boolean, n bigint, known bigint, base double, score double"


def _score_rows(shared):
    """What the known words and the ends give."""
    def run(batches):
        model = shared.value
        total = len(model.within)
        lasting = _lookup(model.word_class, total - 1, -1)
        end = np.array([total - 1])
        for batch in batches:
            rows = []
            for ids in _ids(batch.column(3)):
                have = ids[ids >= 0]
                place = np.concatenate([end, np.where(ids >= 0, lasting[np.maximum(ids, 0)], -1), end])
                a, b = place[:-1], place[1:]
                use = (a >= 0) & (b >= 0)
                rows.append((len(ids) + 1, len(have) + (model.words.documents > 0), float(model.word_base[have].sum() + model.end_base),
                             float(model.moves[a[use], b[use]].sum() + model.word_score[have].sum())))
            if rows:
                n, known, base, score = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(base), pa.array(score)],
                                                 names=[f.split()[0] for f in _SCORE.split(", ")])

    return run


def _scored(texts: DataFrame, met: DataFrame, model: Model) -> DataFrame:
    total = len(model.within)
    shared = texts.sparkSession.sparkContext.broadcast(model)   # at most KNOWN words
    whole = texts.select("uid", "doc_id", "held_out", "ids").mapInArrow(_score_rows(shared), _SCORE)
    base = float(model.words.tokens + model.words.distinct + 1)
    n, zero = F.col("n"), F.lit(0.0)
    moves, c = F.lit(model.moves.ravel()), F.col("class")
    sums = met.groupBy("uid").agg(
        F.sum((n > 0).cast("bigint")).alias("k"), F.sum(F.log10((n + 1) / F.lit(base))).alias("b"),
        F.sum(F.log10((n + ADD_WORD) / F.get(F.lit(model.within), c)) + F.get(moves, F.col("before") * total + c)
              + F.when(F.col("after") >= 0, F.get(moves, c * total + F.col("after"))).otherwise(zero)).alias("s"))
    out = whole.join(sums, "uid", "left").select(
        "doc_id", "held_out", F.col("n").alias("n_tokens"), (F.col("known") + F.coalesce("k", F.lit(0))).alias("n_known"), F.lit(model.words.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("b", zero)).alias("base_score"), (F.col("score") + F.coalesce("s", zero)).alias("score"))
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def fit(docs: DataFrame, frequent: int = FREQUENT, classes: int = CLASSES, known: int = KNOWN) -> tuple[Model, DataFrame]:
    """The model, and ``word binary, n, class`` of the words that it does not hold itself. Null texts are empty."""
    docs = pick(docs, "text").select(F.lit(None).cast("bigint").alias("doc_id"), "text")
    vocab = vocabulary(docs, known)
    texts = encoded(docs, vocab)
    model, rest, tokens = _learned(texts, vocab, frequent, classes)
    return _with_moves(model, texts, _met(tokens, rest, len(model.within) - 2)), rest


def scores(docs: DataFrame, model: Model, rest: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity`` for every row. A null text
    counts as empty: it has the end token alone. Rows that repeat are scored each on its own; an
    empty table gives no rows."""
    texts = encoded(docs, model.words)
    lasting = _lookup(model.word_class, len(model.within) - 1, -1)
    tokens = texts.filter("size(others) > 0").select("uid", "learn", "ids", "others").mapInArrow(_other_tokens(lasting, lasting), _TOKEN)
    return _scored(texts, _met(tokens, rest, len(model.within) - 2), model)


def held_out(doc_id):
    """crc32 of the id as text falls in the held-out fold. A null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(True))


def corpus_scores(docs: DataFrame) -> DataFrame:
    """Learns from the documents that are not held out and scores all, each encoded once; rows as of ``scores``."""
    docs = pick(docs, "doc_id", "text")
    vocab = vocabulary(docs.filter(~held_out(F.col("doc_id"))))
    texts = encoded(docs, vocab, lambda doc_id: ~held_out(doc_id))
    model, rest, tokens = _learned(texts, vocab, FREQUENT, CLASSES)
    met = _met(tokens, rest, len(model.within) - 2)
    return _scored(texts, met, _with_moves(model, texts, met))
