"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.session import ensure_checkpoint_dir, scratch_path
from marketlens.sources.store import freed_shuffles

# Rows in one Arrow batch handed to Python. Long texts make a batch large, so
# it is far below Spark's default of 10,000; the byte bound cuts it further.
BATCH_ROWS = 500
BATCH_BYTES = 4 << 20
FILE_ROWS = 50_000   # rows of a file of a table whose size is known, about


def position(df: DataFrame, name: str) -> int:
    """Index of the column called ``name``: the first with exactly that
    spelling, else the first that differs in letter case only."""
    exact = [i for i, c in enumerate(df.columns) if c == name]
    found = exact or [i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
    if not found:
        raise ValueError(f"the input has no column {name!r}; it has {df.columns}")
    return found[0]


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone. Works by position, so further columns whose
    names clash (also in letter case, or twice the same) do no harm."""
    flat = df.toDF(*[f"_in{i}" for i in range(len(df.columns))])
    return flat.select(*[F.col(f"_in{position(df, n)}").alias(n) for n in names])


_shipped: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Send the package's source to the executors once per application, so
    that tasks can import it wherever it lies on the driver."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.basename(top)
    path = os.path.join(tempfile.mkdtemp(prefix=f"{name}-"), f"{name}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(top):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join(name, os.path.relpath(full, top)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def arrow_limits(spark: SparkSession) -> None:
    """Before Python tasks: ship the package, and bound the Arrow batches by
    rows and bytes (session settings)."""
    _ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    try:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    except Exception:  # a setting that this Spark does not have
        pass


def per_batch(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[dict]], schema: str) -> DataFrame:
    """``mapInArrow`` for a function from one batch to a dict of columns."""
    arrow_limits(df.sparkSession)
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn(batch)
            arrays = [out[n] if isinstance(out[n], pa.Array) else pa.array(out[n]) for n in names]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return df.mapInArrow(run, schema)


_made: list[list[str]] = []


def saved(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write to the cluster's shared folder and read back: cuts the lineage, so
    a lost executor does not cause earlier steps to run again. ``rows``: how many there are, about. They are then written in
    as many files as their number needs, at least one a core, not in one a shuffle partition: on a local file system each
    file costs the executor several child processes. The write's shuffle files go when it ends."""
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(1, spark.sparkContext.defaultParallelism, -(-rows // FILE_ROWS)))
    path = scratch_path(spark, name)
    with freed_shuffles(spark):
        df.write.parquet(path)
    if _made:
        _made[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def emptied(spark: SparkSession, paths: list[str]) -> None:
    """Free what ``saved`` wrote: each folder is overwritten by a table without rows."""
    none = spark.createDataFrame([], "x int")
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda p: none.write.mode("overwrite").parquet(p), paths))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """Folders that ``saved`` writes within are freed at the end. Yields ``saved`` for what is to stay: a result
    that is not written by it must not be used afterwards."""
    _made.append([])

    def keep(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
        out = saved(df, name, rows)
        _made[-1].pop()
        return out

    try:
        yield keep
    finally:
        emptied(spark, _made.pop())


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, sample: int, learn=None) -> DataFrame:
    """``(doc_id, text, y)`` of at most ``sample`` labelled documents, by the smallest hashes of
    their ids. Labels other than 0 and 1, and null ids, are left out; a document labelled more than
    once takes its largest label. The chosen ids are broadcast: their number is bounded."""
    rows = pick(labels, "doc_id", label).toDF("doc_id", "y").filter("doc_id is not null and y in (0, 1)")
    if learn is not None:
        rows = rows.filter(learn(F.col("doc_id")))
    rows = rows.groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64(F.lit(5), "doc_id"), "doc_id").limit(sample)
    return pick(docs, "doc_id", "text").filter("text is not null").join(F.broadcast(rows), "doc_id").select("doc_id", "text", "y")


__all__ = ["arrow_limits", "ensure_checkpoint_dir", "labelled_sample", "per_batch", "pick", "position", "saved"]
