"""Mixing sources to target weights (operator 5): Pfair scheduling.

Each source's documents are cut into blocks of equal size. One block is sent per
slot. For a source of weight w, its i-th block (from 0) is released at slot
floor(i / w) and has its deadline at ceil((i + 1) / w); each slot goes to the
released block whose deadline is earliest. The weights of the sources add up to 1, so every
block runs inside its window and after any number of slots each source is less
than one block away from its target.

Weights are held as whole shares of a cycle of ``cycle`` slots. Every window
pattern repeats with the cycle, and so does the schedule: it is made once for
one cycle, and a block's slot follows by arithmetic. When a source runs out,
a new phase starts in which the others keep the ratio of their weights.

Every source is a class with a weight of its own: those that are not named share the weight of ``*``
equally. The driver holds a table bounded by ``OWN`` classes and the cycle; it never grows with the rows."""

from __future__ import annotations

import heapq
from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.base import pick, position, saved

OTHERS = "*"          # all sources that are not named; as a class: null, and those behind the OWN largest
OWN = 256             # sources not named that are a class each: the largest by characters
BLOCK_CHARS = 65_536
CYCLE = 1_000
BUCKET_DOCS = 5_000   # documents in one bucket of a source, on average
BUCKETS = 10          # 2^10 buckets are summed up at a time
COPIES = 1_000        # copies of one row that a step sets out at a time


def shares(weights: dict[str, float], cycle: int = CYCLE) -> dict[str, int]:
    """Whole slots of a cycle by largest remainder; at least one for each."""
    if not weights or any(not w > 0 for w in weights.values()) or len(weights) > cycle:
        raise ValueError("weights must be positive, and no more than the slots of a cycle")
    total = sum(weights.values())
    exact = {k: w / total * cycle for k, w in weights.items()}
    out = {k: max(1, int(x)) for k, x in exact.items()}
    order = sorted(exact, key=lambda k: (out[k] - exact[k], k))
    i = 0
    while sum(out.values()) != cycle:
        step = 1 if sum(out.values()) < cycle else -1
        k = order[i % len(order)] if step > 0 else max(out, key=lambda k: (out[k] - exact[k] if out[k] > 1 else -1e18, k))
        out[k] += step
        i += 1
    return out


def one_cycle(parts: dict[str, int]) -> list[tuple[str, int, int, int]]:
    """Earliest-deadline-first schedule of one cycle: for each slot ``(class,
    block in the cycle, release, deadline)``."""
    cycle = sum(parts.values())
    waiting = sorted((i * cycle // n, ceil((i + 1) * cycle / n) if (i + 1) * cycle % n else (i + 1) * cycle // n, k, i)
                     for k, n in parts.items() for i in range(n))
    ready: list[tuple[int, str, int, int]] = []
    out, at = [], 0
    for slot in range(cycle):
        while at < len(waiting) and waiting[at][0] <= slot:
            release, deadline, k, i = waiting[at]
            heapq.heappush(ready, (deadline, k, i, release))
            at += 1
        deadline, k, i, release = heapq.heappop(ready)
        out.append((k, i, release, deadline))
    return out


def phases(weights: dict[str, float], blocks: dict[str, int], cycle: int = CYCLE) -> tuple[list[tuple], list[tuple]]:
    """Phases ``(phase, class, first block, blocks, first slot, share, cycle)`` and cycle
    patterns ``(phase, class, block in the cycle, offset, release, deadline)``."""
    left = {k: n for k, n in blocks.items() if n > 0}
    done = dict.fromkeys(left, 0)
    spans, patterns, slot, phase = [], [], 0, 0
    while left:
        parts = shares({k: weights[k] for k in left}, cycle)
        order = one_cycle(parts)
        where: dict[str, list[int]] = {k: [] for k in parts}
        for offset, (k, i, release, deadline) in enumerate(order):
            where[k].append(offset)
            patterns.append((phase, k, i, offset, release, deadline))
        # the phase ends at the first slot whose source has no block left
        end = min(left[k] // n * cycle + where[k][left[k] % n] for k, n in parts.items())
        turns, rest = divmod(end, cycle)
        for k, n in parts.items():
            sent = turns * n + sum(o < rest for o in where[k])
            spans.append((phase, k, done[k], sent, slot, n, cycle))
            done[k] += sent
            left[k] -= sent
        left = {k: n for k, n in left.items() if n}
        slot += end
        phase += 1
    return spans, patterns


def own_weights(sources: DataFrame, weights: dict[str, float], own: int = OWN) -> dict[str, float]:
    """Weight of each class of a table of ``(source, total)``. Sources not named share the weight of ``*`` equally;
    the ``own`` largest are classes of their own, ``*`` stands for null and the rest with the sum of their weights."""
    named = [k for k in weights if k != OTHERS]
    # a null source is one more, in class *
    others = sources.filter(F.col("source").isNull() | ~F.col("source").isin(named))
    n = others.count()
    if not n:
        return {k: weights[k] for k in named}
    each = weights[OTHERS] / n
    top = [r["source"] for r in others.filter(F.col("source") != OTHERS).orderBy(F.desc("total"), "source").limit(own).collect()]
    rest = {OTHERS: (n - len(top)) * each} if n > len(top) else {}
    return {k: weights[k] for k in named} | dict.fromkeys(top, each) | rest


def _starts(sums: DataFrame) -> DataFrame:
    """``class, bucket, start``: characters of a class in the buckets before. Prefix sums of groups of buckets, then inside each group."""
    sums = sums.withColumn("high", F.shiftright("bucket", BUCKETS))
    before = Window.unboundedPreceding, -1
    tops = sums.groupBy("class", "high").agg(F.sum("total").alias("held"))
    tops = tops.select("class", "high", F.coalesce(F.sum("held").over(Window.partitionBy("class").orderBy("high").rowsBetween(*before)), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("total").over(Window.partitionBy("class", "high").orderBy("bucket").rowsBetween(*before)), F.lit(0))
    return sums.withColumn("inside", inside).join(tops, ["class", "high"]).select("class", "bucket", "total", (F.col("base") + F.col("inside")).alias("start"))


def schedule(docs: DataFrame, weights: dict[str, float], block_chars: int = BLOCK_CHARS, cycle: int = CYCLE,
             seed: int = 17, own: int = OWN) -> DataFrame:
    """One row per input row: ``doc_id, source, class, block, slot, release,
    deadline, place, h2`` (place: order inside the block; h2: hash of the text). Ordering by ``slot, place`` gives the mix.

    ``weights`` gives the share of characters of each named source; ``*`` (added with the mean weight if it is
    missing) is shared equally by all other sources, null among them, each of which is a class of its own
    (``own_weights``; the cycle has at least four slots for each class). Inside a source the order is a seeded hash of ``doc_id`` and
    text. An empty or null text counts one character, so each row is sent once; a text longer than a block takes
    the slots of all blocks it covers and stands at the first. Rows with the same or a null ``doc_id`` are rows of their own;
    equal rows are counted before they are shuffled, and set out again one after the other. No row is dropped or repeated. An empty
    table gives no rows; a source without rows is left out from the start."""
    if OTHERS not in weights:
        weights = weights | {OTHERS: sum(weights.values()) / len(weights)}
    rows = pick(docs, "doc_id", "source", "text").select(
        "doc_id", "source", F.greatest(F.coalesce(F.char_length("text"), F.lit(0)), F.lit(1)).cast("bigint").alias("size"), F.xxhash64("text").alias("h2"))
    rows = rows.groupBy("doc_id", "source", "size", "h2").agg(F.count("*").alias("copies")).withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "h2"))
    rows = saved(rows, "mix-rows", docs.count())
    per_source = saved(rows.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("total")), "mix-sources")
    weights = own_weights(per_source, weights, own)
    cycle = max(cycle, 4 * len(weights))
    n = max(1, rows.count() // BUCKET_DOCS)
    bucket = F.shiftrightunsigned("h", 33).cast("bigint") * n
    named = [k for k in weights if k != OTHERS]
    rows = rows.withColumn("class", F.when(F.col("source").isin(named), F.col("source")).otherwise(F.lit(OTHERS))).withColumn("bucket", F.shiftright(bucket, 31))
    starts = saved(_starts(rows.groupBy("class", "bucket").agg(F.sum(F.col("size") * F.col("copies")).alias("total"))), "mix-starts")
    # one row per class at most
    ends = {r["class"]: r["end"] for r in starts.groupBy("class").agg(F.max(F.col("start") + F.col("total")).alias("end")).collect()}
    blocks = {k: -(-v // block_chars) for k, v in ends.items()}
    spans, patterns = phases(weights, blocks, cycle)
    spark = docs.sparkSession
    spans = spark.createDataFrame(spans, "phase long, class string, first_block long, blocks long, first_slot long, share long, cycle long").filter("blocks > 0")
    patterns = spark.createDataFrame(patterns, "phase long, class string, turn long, offset long, release long, deadline long")
    before = Window.partitionBy("class", "bucket").orderBy("h", "doc_id", "h2", "size", "source").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("ahead", F.coalesce(F.sum(F.col("size") * F.col("copies")).over(before), F.lit(0)))
    # buckets are many, classes and cycle are bounded: only the latter are broadcast
    rows = rows.join(starts.select("class", "bucket", "start"), ["class", "bucket"])
    # copies are set out in steps, which are spread over the tasks
    rows = rows.withColumn("step", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / COPIES)))).repartition("h", "step")
    upto = F.least(F.lit(COPIES), F.col("copies") - F.col("step") * COPIES) - 1
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), upto)))
    at = F.col("start") + F.col("ahead") + (F.col("step") * COPIES + F.col("copy")) * F.col("size")
    rows = rows.select("doc_id", "source", "class", "h2", F.floor(at / block_chars).cast("bigint").alias("block"), (at % block_chars).alias("place"))
    rows = rows.join(F.broadcast(spans), "class").filter("block >= first_block and block < first_block + blocks")
    index = F.col("block") - F.col("first_block")
    rows = rows.withColumn("turn", index % F.col("share")).withColumn("base", F.col("first_slot") + F.floor(index / F.col("share")) * F.col("cycle"))
    rows = rows.join(F.broadcast(patterns), ["phase", "class", "turn"])
    return rows.select("doc_id", "source", "class", "block", (F.col("base") + F.col("offset")).cast("bigint").alias("slot"),
                       (F.col("base") + F.col("release")).cast("bigint").alias("release"), (F.col("base") + F.col("deadline")).cast("bigint").alias("deadline"),
                       F.col("place").cast("bigint").alias("place"), "h2")


def placed(docs: DataFrame, weights: dict[str, float], **options) -> DataFrame:
    """All rows and columns of ``docs``, then ``slot`` and ``place`` of the schedule (columns of these names in the
    input are replaced): sorted by them the rows are in the order of the mix. Rows with the same id and text go to the
    same place."""
    order = schedule(docs, weights, **options)
    flat = docs.toDF(*[f"_in{i}" for i in range(len(docs.columns))])
    kept = [i for i, c in enumerate(docs.columns) if c.lower() not in ("slot", "place")]
    key, text = (F.col(f"_in{position(docs, n)}") for n in ("doc_id", "text"))
    first = order.groupBy("doc_id", "h2").agg(F.min(F.struct("slot", "place")).alias("at"))
    first = first.select(F.col("doc_id").alias("_id"), F.col("h2").alias("_h2"), F.col("at.slot").alias("_slot"), F.col("at.place").alias("_place"))
    out = flat.join(first, key.eqNullSafe(F.col("_id")) & (F.xxhash64(text) == F.col("_h2")))
    return out.select(*[f"_in{i}" for i in kept], "_slot", "_place").toDF(*[docs.columns[i] for i in kept], "slot", "place")


def mixed(docs: DataFrame, weights: dict[str, float], **options) -> DataFrame:
    """All rows and columns of ``docs`` in the order of the mix: files follow one another by range of
    slots, and the rows of a file are in order. Files may be read in any order: ``placed`` tells the place."""
    flat = docs.toDF(*[f"_in{i}" for i in range(len(docs.columns))])
    named = flat.withColumnsRenamed({f"_in{position(docs, n)}": n for n in ("doc_id", "source", "text")})
    out = placed(named, weights, **options).repartitionByRange("slot", "place").sortWithinPartitions("slot", "place")
    return out.select(named.columns).toDF(*docs.columns)
