"""Connected components as Spark joins: hook each node to its smallest
neighbour, shorten the pointers, contract the links, and repeat.

Each pass at least halves the nodes that still have links. Nothing is
collected; every step is written to the shared folder, so lost executors cost
one step. A hub with many links is met by a partial minimum before the
shuffle and by joins whose many-row side Spark may split."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.base import saved


def _pointers(links: DataFrame, rows: int) -> DataFrame:
    """``(node, root)``: each node with a smaller neighbour points to a local minimum. They are no more than the links (``rows``)."""
    up = saved(links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")), "cc-hook", rows)
    while True:
        above = up.select(F.col("node").alias("root"), F.col("root").alias("above"))
        joined = up.join(above, "root", "left")
        up = saved(joined.select("node", F.coalesce("above", "root").alias("root"),
                                 F.col("above").isNotNull().alias("moved")), "cc-jump", rows)
        if up.filter("moved").isEmpty():
            return up.select("node", "root")
        up = up.select("node", "root")


def components(links: DataFrame, a: str, b: str, rows: int | None = None) -> DataFrame:
    """``(node, component)`` for every node that has a link and is not its
    component's smallest node. Links are undirected, of one orderable type;
    nulls, self links and repeats are ignored. ``rows``: how many links there are, about, if that is known."""
    links = (links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
             .filter("a is not null and b is not null and a < b").distinct())
    links = saved(links, "cc-links", rows)
    rows = links.count()     # links become fewer with each pass, and nodes that point are no more than they were at first
    found: DataFrame | None = None
    while not links.isEmpty():
        # hook to the smallest neighbour: links go from smaller a to larger b
        up = _pointers(links, rows)
        as_a = up.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        as_b = up.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        moved = (links.join(as_a, "a", "left").join(as_b, "b", "left")
                 .select(F.coalesce("ra", "a").alias("x"), F.coalesce("rb", "b").alias("y")).filter("x <> y"))
        links = saved(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "cc-links", rows)
        if found is None:
            found = up
        else:
            step = up.select(F.col("node").alias("root"), F.col("root").alias("higher"))
            found = found.join(step, "root", "left").select("node", F.coalesce("higher", "root").alias("root")).unionByName(up)
        found = saved(found, "cc-found", rows)
    if found is None:
        return links.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return found.select("node", F.col("root").alias("component"))


def merge_labels(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Labels (smallest index reachable) after adding links ``i - j``."""
    while True:
        a, b = label[i], label[j]
        differ = a != b
        if not differ.any():
            return
        lo, hi = np.minimum(a, b)[differ], np.maximum(a, b)[differ]
        np.minimum.at(label, hi, lo)
        while (label != label[label]).any():
            label[:] = label[label]
