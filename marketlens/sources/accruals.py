"""Accrual reports as delimited text.

A report file starts with one preamble line (the report period), then the
header line, then data. Every required column must be present or the load
fails. Header labels are mapped to column names by an argument, so the
report language is configuration.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.session import scratch_path
from marketlens.sources.store import labels_of

# Column names the flattener (P24) expects.
REQUIRED = ["accrual_id", "accrual_date", "service_group", "accrual_type", "sku", "accepted_at",
            "total_amount"]
OPTIONAL = ["commission_percent"]
MAX_COLUMNS = 64   # cells of a line that are read; a header with more is refused


def _written(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """A small table in a folder of its own, with a size that the planner knows."""
    path = scratch_path(spark, name)
    df.coalesce(1).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_accruals(spark: SparkSession, path: str, labels: dict[str, str], sep: str = ";") -> DataFrame:
    """Read report files; ``labels`` maps header label -> column name.

    The preamble and the header are the first two lines of each file, found by
    position: the lines with the two smallest (block start, read position) of
    their file. Each file's lines are read by that file's own header, so
    layouts may differ from file to file; a required column that any file
    lacks, or a file without a header, fails the load. A data line may hold
    anything, also text like the preamble's.

    The header table has one row per report file. It is written once, so that its size is known when it is joined
    to the lines: while it is small the lines are not shuffled, and files may be split freely between tasks. A line
    is parsed with as many columns as its file's header has: the parser pays for every column
    that a line lacks. The different widths, at most ``MAX_COLUMNS``, are known to the driver."""
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(
        F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"),
        F.monotonically_increasing_id().alias("r"), "value")
    # the two first lines of a file, by a partial aggregate in each task
    at = F.struct("b", "r")
    begin = lines.filter("b = 0")
    first = _written(spark, "accrual-tops", begin.groupBy("f").agg(F.min(at).alias("top")))
    after = F.when(at > F.col("top"), at)
    heads = begin.join(first, "f").groupBy("f").agg(F.min(after).alias("head"), F.min_by("value", after).alias("header"))
    heads = heads.withColumn("names", F.transform(F.split("header", re.escape(sep), -1), lambda h: F.btrim(F.btrim(h), F.lit('"')))).drop("header")
    heads = _written(spark, "accrual-heads", heads)
    widths = labels_of(heads.select(F.size("names").alias("width")).filter(F.col("width").between(1, MAX_COLUMNS)), "width")
    known = F.create_map(*[F.lit(x) for k, v in labels.items() for x in (k, v)])
    heads = heads.withColumn("names", F.transform("names", lambda h: F.coalesce(known[h], h)))
    lacking = F.array_except(F.array(*[F.lit(c) for c in REQUIRED]), F.coalesce("names", F.array().cast("array<string>")))
    heads = heads.withColumn("names", F.when((F.size(lacking) == 0) & (F.size("names") <= MAX_COLUMNS), F.col("names")).otherwise(
        F.raise_error(F.concat(F.lit("accrual report "), F.col("f"), F.lit(" is too wide or misses columns: "), F.array_join(lacking, ", "))).cast("array<string>")))
    heads = heads.select("f", "head", F.size("names").alias("width"), *[F.array_position("names", F.lit(c)).cast("int").alias(f"_p_{c}") for c in REQUIRED + OPTIONAL])
    data = lines.join(heads, "f").filter((at > F.col("head")) | F.col("width").isNull())

    def cells(width: int):
        parsed = F.from_csv(F.col("value"), ", ".join(f"_c{i} string" for i in range(width)), {"sep": sep})
        # the parsed line as a lambda's argument: it is parsed once for all cells
        return F.transform(F.array(parsed), lambda r: F.array(*[r[f"_c{i}"] for i in range(width)]))[0]

    row = F.lit(None).cast("array<string>")
    for w in widths:
        row = F.when(F.col("width") == w, cells(w)).otherwise(row)
    parsed = data.filter(F.btrim("value") != F.lit("")).select(*[c for c in heads.columns if c.startswith("_p_")], row.alias("row"))

    def cell(name: str):
        return F.when(F.col(f"_p_{name}") > 0, F.get("row", F.col(f"_p_{name}") - 1))

    return parsed.select(*[cell(c).alias(c) for c in REQUIRED + OPTIONAL])


def land_accruals(rows: DataFrame, path: str, labels: dict[str, str], period: str, sep: str = ";",
                  rows_per_file: int = 500_000) -> str:
    """Write accrual rows as report files of about ``rows_per_file`` rows, each
    starting with the preamble and header lines."""
    inv = {v: k for k, v in labels.items()}
    cols = REQUIRED + [c for c in OPTIONAL if c in rows.columns]
    header = sep.join(inv.get(c, c) for c in cols)
    files = max(2, -(-rows.count() // rows_per_file))
    body = rows.select(F.pmod(F.xxhash64(*cols), F.lit(files)).cast("bigint").alias("f"), F.lit(2).alias("o"),
                       F.concat_ws(sep, *[F.coalesce(F.col(c), F.lit("")) for c in cols]).alias("value"))
    top = rows.sparkSession.range(files).select(F.col("id").alias("f"), F.inline(F.array(
        F.struct(F.lit(0).alias("o"), F.lit(f"Период: {period}").alias("value")),
        F.struct(F.lit(1).alias("o"), F.lit(header).alias("value")))))
    # one range of report numbers per task and file: its lines start with its preamble
    out = top.unionByName(body).repartition(files, "f").sortWithinPartitions("f", "o")
    out.select("f", "value").write.mode("errorifexists").partitionBy("f").text(path)
    return path
