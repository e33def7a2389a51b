"""Dimension reads (S08) and parameterised scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_catalog(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Product dimension ``sku, flavor, grams`` from CSV or Parquet."""
    if fmt == "csv":
        df = spark.read.option("header", True).schema("sku bigint, flavor string, grams int").csv(path)
    else:
        df = spark.read.format(fmt).load(path)
    return df.select(F.col("sku").cast("bigint"), F.col("flavor").cast("string"),
                     F.col("grams").cast("int"))


def param_scan(spark: SparkSession, sql_text: str, args: dict | None = None,
               views: dict[str, DataFrame] | None = None, one: bool = False) -> DataFrame:
    """A parameterised query over registered tables (``:name`` markers
    bound by Spark, never by string formatting). ``one`` = first row only."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    out = spark.sql(sql_text, args=args or {})
    return out.limit(1) if one else out
