"""Query registry primitives shared by the ``q_*`` modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def dbl(c: str):
    return F.col(c).cast("double").alias(c)
