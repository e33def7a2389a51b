"""Partitioned Parquet tables and batches that rewrite some of their partitions.

A table is one Parquet folder, partitioned by the label column ``_part`` (a month, a day, a source and month, a hash of the key).
A batch reads the partitions it meets (a filter on ``_part`` prunes the scan), writes their new content to a staging folder, and
then overwrites just those partitions with ``partitionOverwriteMode=dynamic``. Which partitions a batch stages is listed in
the small table ``pending``; if a run dies while it overwrites, the next one begins by overwriting them again from the same staged
rows, which gives the same tables however often it is done. One batch runs at a time.

Columns that a table gained later have a version and a default (``schemas.ADDED``, M01): rows carry the version they
were written at, and rows from before a column get its default, also beside new rows in one scan."""

from __future__ import annotations

import threading
import time
import uuid
from concurrent.futures import Future, ThreadPoolExecutor
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from marketlens import schemas
from marketlens.operators.quality import conform_schema

PART = "_part"
VERSION = "_version"
SET = "_set"       # folder of a staged table: rows laid out first, or the others
CODEC = "zstd"     # a batch writes its tables twice: smaller files for some CPU
BUCKETS = 8
JOBS = 6     # tables that are written at the same time: Spark runs independent jobs side by side


FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writes = {"lock": threading.Lock(), "running": 0, "before": "false"}


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Shuffle files of a write go when it ends, not when the driver's garbage is collected: a batch of many steps holds the
    shuffles of the steps that run, and no more. Writes run side by side; the last one restores the session's setting."""
    with _writes["lock"]:
        if not _writes["running"]:
            _writes["before"] = spark.conf.get(FREE, "false")
            spark.conf.set(FREE, "true")
        _writes["running"] += 1
    try:
        yield
    finally:
        with _writes["lock"]:
            _writes["running"] -= 1
            if not _writes["running"]:
                spark.conf.set(FREE, _writes["before"])


def labels_of(df: DataFrame, column: str = PART) -> list[str]:
    """The distinct partition labels in a column: few, whatever the number of rows."""
    return sorted(r[0] for r in df.select(column).distinct().collect())


def with_defaults(df: DataFrame, added: list[tuple[int, str, object]]) -> DataFrame:
    """M01 on read: rows written before version ``v`` take the default of a column added in ``v``."""
    for version, name, default in added:
        old = F.coalesce(F.col(VERSION), F.lit(1)) < version
        df = df.withColumn(name, F.when(old, F.lit(default)).otherwise(F.col(name)))
    return df


class Store:
    """The tables under ``root``. ``buckets`` is the number of hash partitions of the tables that are partitioned by a
    key; it is fixed when the store is made and read from the store afterwards."""

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, StructType] | None = None, buckets: int = BUCKETS):
        self.spark, self.root, self.tables = spark, root.rstrip("/"), tables or schemas.TABLES
        made = self.load("layout", "buckets int").collect()   # one row
        if not made:
            spark.createDataFrame([(buckets,)], "buckets int").write.mode("overwrite").parquet(self.path("layout"))
        self.buckets = made[0]["buckets"] if made else buckets

    def path(self, *names: str) -> str:
        return "/".join([self.root, *names])

    def load(self, name: str, schema) -> DataFrame:
        """A folder of the store; one that is not there yet is made, without rows."""
        try:
            return self.spark.read.schema(schema).parquet(self.path(name))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
        none = self.spark.createDataFrame([], schema)
        (none.write.partitionBy(PART) if PART in none.columns else none.write).mode("ignore").parquet(self.path(name))
        return none

    def _stored(self, name: str) -> StructType:
        return StructType([*self.tables[name].fields]).add(VERSION, IntegerType()).add(PART, StringType())

    def bucket(self, *keys: str) -> Column:
        """Label of the hash partition of a key."""
        return F.concat(F.lit("b"), F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("string"))

    def parts(self, name: str) -> list[str]:
        """Labels of the partitions that hold files, from their paths (no rows are read)."""
        return _labels_in(self.load(name, self._stored(name)))

    def read(self, name: str, parts: list[str] | None = None, with_part: bool = False) -> DataFrame:
        """The table, or some of its partitions: the scan reads no others."""
        df = self.load(name, self._stored(name))
        if parts is not None:
            # without files of these partitions the planner is told so: no join with them shuffles its other side
            df = df.filter(F.col(PART).isin(list(parts)) if {*parts} & {*_labels_in(df)} else F.lit(False))
        df = with_defaults(df, schemas.ADDED.get(name, []))
        return df.select(*self.tables[name].fieldNames(), *([PART] if with_part else []))

    def shaped(self, name: str, rows: DataFrame) -> DataFrame:
        """Rows as they are stored: declared columns, version, label."""
        version = max([1, *[v for v, _, _ in schemas.ADDED.get(name, [])]])
        return conform_schema(rows.withColumn(VERSION, F.lit(version)), self._stored(name))

    def overwrite(self, name: str, stored: DataFrame, touched: list[str]) -> None:
        """Give the ``touched`` partitions the rows ``stored``; one without rows becomes empty."""
        (stored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", CODEC).partitionBy(PART).parquet(self.path(name)))
        none = self.spark.createDataFrame([], StructType([f for f in self._stored(name).fields if f.name != PART]))
        emptied = {*touched} - {*_labels_in(stored)}
        for label in sorted(emptied & {*self.parts(name)} if emptied else []):
            none.write.mode("overwrite").parquet(self.path(name, f"{PART}={label}"))

    def finish(self) -> None:
        """Overwrite what a staged batch lists; nothing if there is none."""
        pending = self.load("pending", "batch string, name string, label string").collect()   # partition labels of a batch
        if not pending:
            return
        batch = pending[0]["batch"]

        def put(name: str) -> None:
            staged = self.load(f"staging/{batch}/tables/{name}", self._stored(name)).drop(SET)
            self.overwrite(name, staged, [r["label"] for r in pending if r["name"] == name])

        with ThreadPoolExecutor(JOBS) as pool:
            list(pool.map(put, sorted({r["name"] for r in pending})))
        none = self.spark.createDataFrame([], "batch string, name string, label string")
        for folder in ("pending", f"staging/{batch}"):
            none.write.mode("overwrite").parquet(self.path(folder))

    def begin(self) -> Batch:
        return Batch(self)


def _labels_in(df: DataFrame) -> list[str]:
    return sorted({unquote(f.rsplit(f"/{PART}=", 1)[1].split("/")[0]) for f in df.inputFiles() if f"/{PART}=" in f})


class Batch:
    """The new content of some partitions of some tables, staged and then put in place."""

    def __init__(self, store: Store):
        store.finish()
        self.store, self.spark = store, store.spark
        self.id = f"{time.time_ns()}-{uuid.uuid4().hex[:6]}"
        self.touched: dict[str, list[str]] = {}
        self.counts: dict[str, int] = {}
        self.pool = ThreadPoolExecutor(JOBS)
        self.jobs: dict[str, Future] = {}
        self.branches: list[Future] = []

    def branch(self, fn) -> Future:
        """Run a part of the plan that others do not wait for beside them."""
        self.branches.append(self.pool.submit(fn))
        return self.branches[-1]

    def stage(self, name: str, df: DataFrame) -> DataFrame:
        """Write an intermediate once (a lineage cut that several later steps read)."""
        path = self.store.path("staging", self.id, name)
        with freed_shuffles(self.spark):
            df.write.option("compression", CODEC).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def lay(self, name: str, rows: DataFrame) -> DataFrame:
        """Stage new rows of a table (with their label) by label, as a part of what ``write`` stages for it, and give them back:
        steps that need the new rows alone read them from there, and ``write`` gets the other rows of the partitions."""
        path = f"staging/{self.id}/tables/{name}/{SET}=new"
        with freed_shuffles(self.spark):
            self._put(path, self.store.shaped(name, rows))
        return self.store.load(path, self.store._stored(name)).drop(VERSION)

    def _put(self, path: str, shaped: DataFrame) -> None:
        # rebalance: small partitions share a task, a large one is split over several
        shaped.hint("rebalance", PART).write.option("compression", CODEC).partitionBy(PART).parquet(self.store.path(path))

    def read(self, name: str, parts: list[str] | None = None, with_part: bool = False) -> DataFrame:
        return self.store.read(name, parts, with_part)

    def write(self, name: str, rows: DataFrame, touched: list[str]) -> None:
        """Begin to stage ``rows`` (with their label) as the whole content of the ``touched`` partitions, beside those laid before."""
        out = self.store.shaped(name, rows)
        self.touched[name] = sorted(touched)

        def put() -> None:
            with freed_shuffles(self.spark):
                self._put(f"staging/{self.id}/tables/{name}/{SET}=others", out)

        self.jobs[name] = self.pool.submit(put)

    def written(self, name: str) -> DataFrame:
        """The rows staged for a table, with their label."""
        self.jobs[name].result()
        return self.store.load(f"staging/{self.id}/tables/{name}", self.store._stored(name)).drop(VERSION, SET)

    def merge(self, name: str, rows: DataFrame, keys: list[str]) -> None:
        """Replace by key in the partitions that ``rows`` name; a key never changes its partition."""
        touched = labels_of(rows)
        kept = self.read(name, touched, with_part=True)
        some = F.lit(True)
        for k in keys:
            some = some & F.col(k).isNotNull()
        rest = kept.filter(some).join(rows.select(*keys).distinct(), keys, "left_anti").unionByName(kept.filter(~some))
        self.write(name, rest.unionByName(rows.select(*rest.columns)), touched)

    def publish(self) -> None:
        for job in [*self.branches]:
            job.result()
        for job in self.jobs.values():
            job.result()
        self.pool.shutdown()
        rows = [(self.id, n, p) for n, parts in self.touched.items() for p in parts]
        if rows:
            self.spark.createDataFrame(rows, "batch string, name string, label string").coalesce(1).write.mode("overwrite").parquet(self.store.path("pending"))
            self.store.finish()


def upsert_by_day(spark: SparkSession, root: str, new: DataFrame, keys: list[str], day: str, schema: StructType,
                  ordinal: str | None = None) -> None:
    """Upsert ``new`` by ``keys`` (of which ``day`` is one) into a table of its own at ``root``, partitioned by day; only
    the days that ``new`` holds are read and rewritten."""
    from marketlens.operators import upsert
    batch = Store(spark, root, {"rows": schema}).begin()
    rows = batch.stage("new", new.select(*schema.fieldNames(), *([ordinal] if ordinal else [])))
    if ordinal:
        rows = upsert.last_write_wins(rows, keys, ordinal)
    batch.merge("rows", rows.withColumn(PART, F.coalesce(F.col(day).cast("string"), F.lit("none"))), keys)
    batch.publish()


def read_by_day(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    return Store(spark, root, {"rows": schema}).read("rows")
