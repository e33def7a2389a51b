"""Ad attribution to orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.money import MONEY
from marketlens.operators import flatten, resolve
from marketlens.operators.upsert import update_from


def _in_range(attribution: DataFrame, date_from, date_to) -> DataFrame:
    d = F.col("stat_date")
    return attribution.filter(F.col("order_id").isNotNull()
                              & (d >= F.lit(str(date_from)).cast("date"))
                              & (d <= F.lit(str(date_to)).cast("date")))


def order_campaign_agg(attribution: DataFrame, date_from, date_to) -> DataFrame:
    """Per order: max(campaign_id), max(campaign_title) - independently, as
    the source does - and the attributed spend, for stat_date in [from, to]."""
    return _in_range(attribution, date_from, date_to).groupBy("order_id").agg(
        F.max("campaign_id").alias("_campaign_id"),
        F.max("campaign_title").alias("_campaign_title"),
        F.sum("spent").alias("_spend"),
    )


def order_campaign(orders: DataFrame, attribution: DataFrame, date_from, date_to,
                   agg: DataFrame | None = None) -> DataFrame:
    """A10: set campaign_id / campaign_title of attributed orders."""
    a = agg if agg is not None else order_campaign_agg(attribution, date_from, date_to)
    for c in ("campaign_id", "campaign_title"):
        if c not in orders.columns:
            orders = orders.withColumn(c, F.lit(None).cast("string"))
    return update_from(orders, a, "order_id", {"campaign_id": F.col("_campaign_id"),
                                               "campaign_title": F.col("_campaign_title")})


def order_ad_spend(orders: DataFrame, attribution: DataFrame, date_from, date_to,
                   agg: DataFrame | None = None) -> DataFrame:
    """ads_attributed = spend in [from, to] of attributed orders."""
    a = agg if agg is not None else order_campaign_agg(attribution, date_from, date_to)
    if "ads_attributed" not in orders.columns:
        orders = orders.withColumn("ads_attributed", F.lit(None).cast(MONEY))
    return update_from(orders, a, "order_id",
                       {"ads_attributed": F.coalesce(F.col("_spend"), F.lit(0)).cast(MONEY)})


def apply_attribution(orders: DataFrame, attribution: DataFrame, date_from, date_to) -> DataFrame:
    """A10 + A11 from one aggregation and one join."""
    a = order_campaign_agg(attribution, date_from, date_to)
    for c, t in (("campaign_id", "string"), ("campaign_title", "string"), ("ads_attributed", MONEY)):
        if c not in orders.columns:
            orders = orders.withColumn(c, F.lit(None).cast(t))
    return update_from(orders, a, "order_id", {
        "campaign_id": F.col("_campaign_id"), "campaign_title": F.col("_campaign_title"),
        "ads_attributed": F.coalesce(F.col("_spend"), F.lit(0)).cast(MONEY)})


def resolved_rows(fields: DataFrame, orders: DataFrame | None, lookup: DataFrame | None = None, keyed: bool = False) -> DataFrame:
    """Report rows with their orders, one of each ``row_key``. The key covers the candidate and all fields of a
    row, so equal keys are equal rows, and they meet where the join on the candidate has put them: there is no other shuffle.
    ``keyed``: with the join's key as ``_key``; rows with one ``row_key`` have one, and those of several loads meet by both without being moved."""
    content = F.xxhash64("campaign_id", "sku", "stat_date", "spent", "amount")
    found = resolve.resolve_order_id(fields, orders, "cand", exact=False, lookup=lookup, out_key="_key", spread=content)
    rows = flatten.attribution_rows(found).drop("_ordinal")
    if not keyed:
        return rows.distinct().drop("_key")
    # the row as one value: whatever columns and rows of it are used later, its plan stays the same and is run once
    one = rows.groupBy("_key", "row_key").agg(F.first(F.struct(*[c for c in rows.columns if c not in ("_key", "row_key")])).alias("_row"))
    return one.select(*[c if c in ("_key", "row_key") else F.col("_row")[c].alias(c) for c in rows.columns])


def attribution_match_rate(rows: DataFrame) -> DataFrame:
    """Rows matched to an order vs. not."""
    return rows.agg(F.count_if(F.col("order_id").isNotNull()).cast("bigint").alias("matched"),
                    F.count_if(F.col("order_id").isNull()).cast("bigint").alias("unmatched"))
