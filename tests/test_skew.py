"""Hot keys: one key holding a third of all rows must give the same results
and must be collapsed map-side (partial aggregation before the shuffle)."""

import datetime as dt

from pyspark.sql import functions as F

from marketlens.operators import orders as oo
from marketlens.operators import resolve, upsert


def skewed_orders(spark, n=30000):
    # customer "hot" owns a third of the orders
    return spark.range(n).select(
        F.concat(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 997).cast("string")),
                 F.lit("-"), F.col("id").cast("string"), F.lit("-1")).alias("order_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 997).cast("string")).alias("customer_id"),
        F.timestamp_add("DAY", (F.col("id") % 400).cast("int"), F.lit(dt.datetime(2024, 1, 1))).cast("timestamp_ntz")
        .alias("order_date"))


def test_hot_prefix_resolution(spark):
    o = skewed_orders(spark)
    cands = spark.range(9000).select(F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.lit("nope")).alias("cand"))
    out = resolve.resolve_order_id(cands, o, "cand")
    got = {(r["cand"], r["order_id"]) for r in out.distinct().collect()}
    newest = o.filter(F.col("customer_id") == "hot").orderBy(F.col("order_date").desc(), F.col("order_id").desc()).first()
    assert got == {("hot", newest["order_id"]), ("nope", None)}
    lookup = resolve.order_lookup(o)
    plan = lookup._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan  # the hot prefix is reduced before the exchange


def test_hot_customer_first_flag(spark):
    o = skewed_orders(spark)
    flagged = oo.first_order_flag(o)
    hot = o.filter(F.col("customer_id") == "hot")
    first_day = hot.agg(F.min("order_date")).first()[0]
    ties = hot.filter(F.col("order_date") == F.lit(first_day)).count()   # ties are all first orders
    hot_first = flagged.filter((F.col("customer_id") == "hot") & F.col("is_first_order")).count()
    assert hot_first == ties
    assert flagged.count() == o.count()


def test_hot_key_last_write_wins(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
                                   F.col("id").alias("v"), F.col("id").alias("ord"))
    out = upsert.last_write_wins(df, "k", "ord")
    assert out.count() == 20001
    assert out.filter(F.col("k") == "hot").first()["v"] == 29997
