"""Merkle dataset manifest (operator 12): one digest for the table, and a proof for every row.

Each row is a leaf. The leaves of a source, by ``doc_id``, form a tree of runs of ``FAN`` nodes; the subroots of the sources,
by source, form the tree above them. Time-forward processing: a node is labelled (tree, level, place), children before
parents. Digests travel as messages to the label of the parent; the queue of messages is external (a written table), and a step takes
all messages of the smallest level, sorted by label by the shuffle, hashes them run by run and inserts the parents' messages. The sweep back
goes from the root to the leaves and hands every run the suffix of its proofs: the siblings left and right of the path at every
level above. Suffixes are delivered to runs, once for ``FAN`` leaves, and never to single leaves.

Places come from a range sort over (source, doc_id, leaf) and prefix sums of the rows of each partition, so
no source is gathered in a task, and the driver holds one number per tree: its greatest size.

Defined results: null values are ``-``; a null ``doc_id`` comes first in its source and is never tampered with; rows with
equal ids follow each other by leaf digest, and equal rows are leaves of their own. A table without rows gives no rows. Further
columns of the input, also clashing ones, are ignored."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.base import pick, saved

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STEP = "struct<l:string,r:string>"


def _field(c: Column) -> Column:
    text = c.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    """Digest of a row: ``-`` for null, else byte count, ``:`` and value, concatenated."""
    return F.sha2(F.concat(*[_field(v) for v in values]), 256)


def tampered(doc_id: Column) -> Column:
    """Rows whose text the check alters: 5 divides the crc32 of the decimal id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _leaves(docs: DataFrame) -> DataFrame:
    """``(tree, doc_id, leaf, altered)``; ``tree`` sorts as the source does, null first; ``altered`` is the digest after tampering."""
    d = pick(docs, *FIELDS)
    cols = [F.col(c) for c in FIELDS]
    low = [*cols[:-1], F.translate("text", UPPER, LOWER)]
    tree = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit(""))
    return d.select(tree.alias("tree"), "doc_id", leaf(*cols).alias("leaf"),
                    F.when(tampered(F.col("doc_id")), leaf(*low)).alias("altered"))


def numbered(df: DataFrame, tree: str, order: list[str], name: str) -> DataFrame:
    """Adds ``at`` (place in its tree, from 0) and ``n`` (rows of the tree). ``df`` is a written table, so that a
    partition computed again has the same rows; equal rows are spread by a number of their own."""
    rows = df.withColumn("_salt", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(tree, *order, "_salt").sortWithinPartitions(tree, *order, "_salt").drop("_salt")
    rows = saved(rows.withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()), name)
    # a partition is one range: the rows of a tree in it are consecutive
    parts = rows.groupBy(tree, "_part").agg(F.count(F.lit(1)).alias("_k"), F.min("_row").alias("_first"))
    before = Window.partitionBy(tree).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(tree, "_part", "_first", F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_before"),
                         F.sum("_k").over(Window.partitionBy(tree)).alias("n"))
    return rows.join(parts, [tree, "_part"]).withColumn("at", F.col("_before") + F.col("_row") - F.col("_first")).drop(
        "_part", "_row", "_first", "_before")


def _steps(kids: Column, many: Column) -> Column:
    """For each kid of a run, the digests left and right of it; a lone leaf has none, for it is hashed into nothing."""
    digest = F.transform(kids, lambda k: k["digest"])
    return F.when(many, F.transform(kids, lambda k, i: F.array(F.struct(
        F.array_join(F.slice(digest, F.lit(1), i), "").alias("l"),
        F.array_join(F.slice(digest, i + 2, F.lit(FAN)), "").alias("r"))))).otherwise(
        F.transform(kids, lambda k: F.array().cast(f"array<{STEP}>")))


def _take(queue: DataFrame, payload: list[str], level: int, name: str) -> DataFrame:
    """One level leaves the queue: its messages, by label, become runs ``(tree, at, n, kids, many, digest)``. ``n`` is
    the number of nodes of the tree at the level of the run."""
    kid = F.struct("at", "digest", *payload)
    runs = queue.groupBy("tree", F.expr(f"at div {FAN}").alias("up")).agg(F.array_sort(F.collect_list(kid)).alias("kids"), F.max("n").alias("n"))
    runs = runs.withColumn("many", F.col("n") > 1)
    hashed = F.sha2(F.array_join(F.transform("kids", lambda k: k["digest"]), ""), 256)
    digest = F.when(F.col("many"), hashed).otherwise(F.col("kids")[0]["digest"])
    return saved(runs.select("tree", F.col("up").alias("at"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"), "kids", "many",
                             digest.alias("digest")), f"{name}-{level}")


def forward(nodes: DataFrame, payload: list[str], name: str) -> list[DataFrame]:
    """Runs of every level above ``nodes`` (``tree, at, n, digest``), lowest first. Trees that have come to
    one node stay out of the higher levels."""
    size = nodes.agg(F.max("n")).first()[0]
    levels = [_take(nodes, payload, 0, name)]
    size = -(-size // FAN)
    while size > 1:
        levels.append(_take(levels[-1].filter("n > 1").select("tree", "at", "n", "digest"), [], len(levels), name))
        size = -(-size // FAN)
    return levels


def roots(levels: list[DataFrame]) -> DataFrame:
    """``(tree, digest)``: the last node of every tree."""
    return reduce(DataFrame.unionByName, [x.filter("n = 1").select("tree", "digest") for x in levels])


def backward(levels: list[DataFrame], tops: DataFrame, name: str) -> DataFrame:
    """The lowest runs with their ``suffix`` and what ``tops`` carries. ``tops`` has, for every tree's last node,
    ``(tree, suffix, ...)``; each level passes to the runs below what is beside and above them."""
    carry = [c for c in tops.columns if c != "tree"]
    held: DataFrame | None = None
    for i in range(len(levels) - 1, 0, -1):
        got = _with_suffix(levels[i], tops, held)
        below = got.select("tree", F.explode(_paths()).alias("x"), *carry)
        below = below.select("tree", F.col("x")["kid"]["at"].alias("at"), *[
            F.concat(F.col("x")["own"], F.col("suffix")).alias("suffix") if c == "suffix" else F.col(c) for c in carry])
        held = saved(below, f"{name}-{i}")
    return _with_suffix(levels[0], tops, held)


def _with_suffix(runs: DataFrame, tops: DataFrame, held: DataFrame | None) -> DataFrame:
    got = runs.filter("n = 1").join(tops, "tree")
    return got if held is None else got.unionByName(runs.filter("n > 1").join(held, ["tree", "at"]))


def _paths() -> Column:
    """Of a run: each kid and its own step."""
    return F.arrays_zip(F.col("kids").alias("kid"), _steps(F.col("kids"), F.col("many")).alias("own"))


def manifest(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, leaf, altered, subroot, root, steps)`` of every row; ``steps`` has, from the leaf up, the
    digests left and right of the path to the root, and ``altered`` the leaf after tampering (null where there is none)."""
    leaves = saved(_leaves(docs), "mk-leaves")
    if leaves.isEmpty():
        return leaves.selectExpr("doc_id", "tree as source", "leaf", "altered", "leaf as subroot", "leaf as root", f"cast(null as array<{STEP}>) as steps")
    nodes = numbered(leaves, "tree", ["doc_id", "leaf"], "mk-places").withColumnRenamed("leaf", "digest")
    levels = forward(nodes, ["doc_id", "altered"], "mk-up")
    subroots = saved(roots(levels).select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest"), "mk-subroots")
    above = forward(numbered(subroots, "tree", ["source"], "mk-sources"), ["source"], "mk-top")
    nothing = F.array().cast(f"array<{STEP}>")
    by_source = backward(above, roots(above).select("tree", nothing.alias("suffix"), F.col("digest").alias("root")), "mk-down-top")
    x = F.col("x")
    tops = by_source.select(F.explode(_paths()).alias("x"), "suffix", "root").select(
        x["kid"]["source"].alias("tree"), F.concat(x["own"], F.col("suffix")).alias("suffix"), x["kid"]["digest"].alias("subroot"), "root")
    runs = backward(levels, saved(tops, "mk-trees"), "mk-down")
    source = F.when(F.col("tree") != "", F.expr("substring(tree, 2)")).alias("source")
    rows = runs.select(source, F.explode(_paths()).alias("x"), "suffix", "subroot", "root")
    return rows.select(x["kid"]["doc_id"].alias("doc_id"), "source", x["kid"]["digest"].alias("leaf"), x["kid"]["altered"].alias("altered"),
                       "subroot", "root", F.concat(x["own"], F.col("suffix")).alias("steps"))


def verified(docs: DataFrame) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)``: each row's proof, digested, and the root
    that its leaf (after tampering, where there is any) and the siblings of the proof fold to."""
    proof = F.sha2(F.array_join(F.transform("steps", lambda s: F.concat(s["l"], s["r"])), ""), 256)
    folded = F.aggregate("steps", F.coalesce("altered", "leaf"), lambda at, s: F.sha2(F.concat(s["l"], at, s["r"]), 256))
    out = manifest(docs).select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
