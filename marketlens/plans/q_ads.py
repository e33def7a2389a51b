"""Registered queries: ad attribution, daily statistics, campaigns, order
upserts and missing-order marking."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens.functions.money import MONEY
from marketlens.operators import attribution as ao
from marketlens.operators import flatten, resolve, upsert
from marketlens.operators import metrics as mx
from marketlens.operators import orders as oo
from marketlens.operators import quality as qo
from marketlens.plans.inputs import Inputs
from marketlens.plans.qbase import dbl, query

ATTR_COLS = ["campaign_id", "campaign_title", "order_id", "ext_order_id", "sku", "offer_id", "product_name",
             "stat_date", "price", "amount", "spent", "bid", "bid_percent", "qty"]
MONEY_ATTR = {"price", "amount", "spent", "bid", "bid_percent"}
DAILY_COLS = ["campaign_id", "campaign_title", "stat_date", "impressions", "clicks", "spend", "avg_bid",
              "orders_cnt", "orders_amount"]
MONEY_DAILY = {"spend", "avg_bid", "orders_amount"}
ATTR_FROM, ATTR_TO = "1996-01-01", "1998-12-31"


def attr_out(df):
    return df.select(*[dbl(c) if c in MONEY_ATTR else F.col(c) for c in ATTR_COLS])


def daily_out(df):
    return df.select(*[dbl(c) if c in MONEY_DAILY else F.col(c) for c in DAILY_COLS])


@query("flatten_attribution")
def q_p23(spark, d):
    return attr_out(Inputs(spark, d).attribution())


@query("resolve_prefix")
def q_j04(spark, d):
    inp = Inputs(spark, d)
    fields = flatten.attribution_fields(inp.attribution_raw())
    res = resolve.resolve_order_id(fields, inp.orders_landed(), "cand", exact=False)
    return res.select("cand", "order_id", "ext_order_id")


@query("attribution_match_rate")
def q_a12(spark, d):
    inp = Inputs(spark, d)
    fields = flatten.attribution_fields(inp.attribution_raw())
    res = resolve.resolve_order_id(fields, inp.orders_landed(), "cand", exact=False)
    return ao.attribution_match_rate(res)


@query("order_campaign")
def q_a10(spark, d):
    inp = Inputs(spark, d)
    o = ao.order_campaign(inp.orders(), inp.attribution(), ATTR_FROM, ATTR_TO)
    return o.select("order_id", "campaign_id", "campaign_title")


@query("order_ad_spend")
def q_a11(spark, d):
    inp = Inputs(spark, d)
    o = ao.order_ad_spend(inp.orders(), inp.attribution(), ATTR_FROM, ATTR_TO)
    return o.select("order_id", dbl("ads_attributed"))


@query("insert_ignore_attribution")
def q_u10(spark, d):
    """Old table holds the rows up to 1998; re-landing all rows adds only the
    new ones (content key)."""
    inp = Inputs(spark, d)
    # both loads are cut from one exchange (it is reused), and meet where the join on the candidate has put them
    all_rows = inp.attribution(keyed=True)
    old = all_rows.filter(F.col("stat_date") < F.lit("1999-01-01").cast("date"))
    return attr_out(upsert.insert_absent(old, all_rows, ["_key", "row_key"]))


@query("relink_attribution")
def q_u10_relink(spark, d):
    """Rows landed while only orders up to 1997 exist, then again when all do:
    each row is there once, with the order it resolves to now."""
    inp = Inputs(spark, d)
    fields = flatten.attribution_fields(inp.attribution_raw())
    few = inp.orders_landed().filter(F.col("order_date") < F.lit("1998-01-01").cast("timestamp_ntz"))
    first, again = (ao.resolved_rows(fields, o, keyed=True) for o in (few, inp.orders_landed()))
    return attr_out(upsert.upsert(first, again, ["_key", "row_key"], update_cols=["order_id", "ext_order_id"]))


@query("flatten_campaign_daily")
def q_p22(spark, d):
    return daily_out(Inputs(spark, d).daily())


@query("spend_by_day")
def q_a21(spark, d):
    return mx.spend_by_day(Inputs(spark, d).daily())


@query("upsert_campaign_daily")
def q_u09(spark, d):
    inp = Inputs(spark, d)
    daily = inp.daily()
    old = daily.filter(F.col("stat_date") < F.lit("2024-01-20").cast("date")).drop("_ordinal")
    new = daily.filter(F.col("stat_date") >= F.lit("2024-01-15").cast("date")) \
        .withColumn("spend", (F.col("spend") + 1).cast(MONEY)).withColumn("_ordinal", F.lit(0))
    return daily_out(upsert.replace_by_key(old, new.select(*old.columns, "_ordinal"),
                                           ["campaign_id", "stat_date"], ordinal="_ordinal"))


CAMPAIGN_COLS = ["campaign_id", "title", "state", "adv_object_type", "payment_type", "created_at", "updated_at"]


@query("flatten_campaigns")
def q_p21(spark, d):
    raw = Inputs(spark, d).campaigns_raw().withColumnRenamed("ordinal", "_ordinal").drop("nation")
    c = flatten.flatten_campaigns(raw)
    return c.select(*CAMPAIGN_COLS, F.col("_ordinal").alias("ordinal"))


@query("upsert_campaigns")
def q_u07(spark, d):
    """Campaign lists of two loads (suppliers of nations < 15, then >= 10):
    each load keeps its last version per id; created_at is insert-only."""
    raw = Inputs(spark, d).campaigns_raw().withColumnRenamed("ordinal", "_ordinal")
    load1 = upsert.last_write_wins(flatten.flatten_campaigns(_nation(raw, lo=None, hi=15)), "campaign_id", "_ordinal")
    load2 = flatten.flatten_campaigns(_nation(raw, lo=10, hi=None)) \
        .withColumn("title", F.concat(F.col("title"), F.lit(" v2"))) \
        .withColumn("created_at", F.lit("2030-01-01T00:00:00Z"))
    out = upsert.upsert(load1, load2, "campaign_id", insert_only_cols=["created_at"], ordinal="_ordinal")
    return out.select(*CAMPAIGN_COLS)


def _nation(raw, lo, hi):
    n = F.col("nation")
    c = F.lit(True)
    if lo is not None:
        c = c & (n >= lo)
    if hi is not None:
        c = c & (n < hi)
    return raw.filter(c).drop("nation")


# --- orders tables ----------------------------------------------------------------

HEADER_COLS = ["order_id", "customer_id", "order_date", "status", "revenue", "fees_total", "payout"]


@query("flatten_order_header")
def q_p17(spark, d):
    h = flatten.flatten_order_header(Inputs(spark, d).postings())
    return h.select("order_id", "customer_id", "order_date", "status", dbl("revenue"))


@query("posting_totals")
def q_a02(spark, d):
    h = flatten.flatten_order_header(Inputs(spark, d).postings())
    return h.select("order_id", dbl("fees_total"), dbl("payout"))


@query("flatten_order_items")
def q_p18(spark, d):
    it = flatten.flatten_order_items(Inputs(spark, d).postings())
    return it.select("order_id", "sku", "name", dbl("quantity"), dbl("price"), dbl("revenue"))


@query("upsert_orders")
def q_u01(spark, d):
    """Old orders table: orders up to 1999 (undated too) with derived columns;
    a posting reload from 1999 updates the six loaded columns only."""
    inp = Inputs(spark, d)
    orders = inp.orders()
    old = orders.filter(~F.coalesce(F.col("order_date") >= F.lit("2000-01-01").cast("timestamp_ntz"), F.lit(False)))
    new = flatten.flatten_order_header(inp.postings().filter(F.col("in_process_at") >= F.lit("1999-01-01")))
    out = upsert.upsert(old.select("order_id", "customer_id", "order_date", "status", "revenue", "campaign",
                                   "is_first_order", F.lit(None).cast(MONEY).alias("fees_total"),
                                   F.lit(None).cast(MONEY).alias("payout")),
                        new, "order_id", update_cols=HEADER_COLS[1:])
    return out.select("order_id", "customer_id", "order_date", "status", dbl("revenue"), "campaign",
                      "is_first_order", dbl("fees_total"), dbl("payout"))


@query("insert_absent_customers")
def q_u02(spark, d):
    inp = Inputs(spark, d)
    old = oo.customer_aggregates(inp.orders().filter(F.col("order_date") < F.lit("1998-01-01").cast("timestamp_ntz")))
    new = flatten.flatten_order_header(inp.postings()).select("customer_id")
    out = upsert.insert_absent(old, new, "customer_id")
    return out.select("customer_id", "first_order_date", "orders_count", dbl("total_revenue"))


@query("upsert_products")
def q_u03(spark, d):
    """Item names differ from order to order; the order with the highest key
    (numerically) lands last, whatever its id looks like as text."""
    inp = Inputs(spark, d)
    old = inp.products().withColumn("name", F.concat(F.lit("old "), F.col("name")))
    key = F.split("posting_number", "-")[1].cast("bigint")
    items = flatten.flatten_order_items(inp.postings().withColumn("_ordinal", key))
    items = items.withColumn("name", F.concat("name", F.lit(" / "), F.split("order_id", "-")[1]))
    new = flatten.products_from_items(items, inp.products())
    out = upsert.replace_by_key(old, new.select("sku", "name", "flavor", "grams", "_ordinal"), "sku",
                                ordinal="_ordinal")
    return out.select("sku", "name", "flavor", "grams")


@query("replace_items_by_order")
def q_u04(spark, d):
    """Postings from 1999 are reloaded with changed quantities; every item of
    a reloaded order is replaced (orders now without items lose theirs)."""
    inp = Inputs(spark, d)
    old = inp.order_items()
    posts = inp.postings().filter(F.col("in_process_at") >= F.lit("1999-01-01"))
    new = flatten.flatten_order_items(posts).withColumn("quantity", (F.col("quantity") + 1).cast(MONEY)) \
        .select("order_id", "sku", "quantity", "price", "revenue")
    scope = posts.select(F.col("posting_number").alias("order_id"))
    out = upsert.replace_scope(old, new, scope, "order_id")
    return out.select("order_id", "sku", dbl("quantity"), dbl("price"), dbl("revenue"))


@query("mark_missing")
def q_j07(spark, d):
    """Seen = orders whose posting came with products; window = 1998."""
    inp = Inputs(spark, d)
    seen = inp.items().select("order_id")
    out = oo.mark_missing(inp.orders(), seen, "1998-01-01", "1999-01-01", "2025-01-01 00:00:00")
    return out.select("order_id", "order_date", "missing", "missing_at")


@query("dq_foreign_keys_all")
def q_q02_all(spark, d):
    """Q02 over every declared reference, against tables from which some parents are missing."""
    inp = Inputs(spark, d)
    orders = inp.orders().filter(F.col("order_date") < F.lit("2000-01-01").cast("timestamp_ntz"))
    tables = {"customers": oo.customer_aggregates(orders.filter(F.col("order_date") < F.lit("1999-01-01").cast("timestamp_ntz"))),
              "orders": orders, "order_items": inp.order_items(), "order_fee_items": inp.posting_fees(),
              "products": inp.products().filter(F.col("grams") <= 25)}
    return qo.dq_foreign_keys(tables)


@query("dq_foreign_key")
def q_q02(spark, d):
    inp = Inputs(spark, d)
    customers = oo.customer_aggregates(inp.orders().filter(F.col("order_date") < F.lit("1999-01-01").cast("timestamp_ntz")))
    return qo.dq_foreign_key(inp.orders(), customers, "customer_id", "customer_id").select("order_id", "customer_id")


@query("dq_not_null")
def q_q03(spark, d):
    return qo.dq_not_null(Inputs(spark, d).attribution(), ["order_id", "ext_order_id", "sku", "campaign_title"])


@query("dq_date_bounds")
def q_q05(spark, d):
    return qo.dq_date_bounds(Inputs(spark, d).orders())


@query("lookback_window")
def q_f02(spark, d):
    o = qo.lookback_window(Inputs(spark, d).orders(), "order_date", "1998-08-02", 30)
    return o.select("order_id", "order_date")


@query("flatten_accruals")
def q_p24(spark, d):
    from marketlens.plans.q_fees import fee_out
    from marketlens.sources import testdata as td
    return fee_out(flatten.flatten_accruals(td.accrual_rows(spark, d)))


@query("update_from_aggregate")
def q_j06(spark, d):
    """UPDATE orders SET revenue = <revenue of MEDIUM products> FROM (...):
    orders with such items take the aggregate, all others keep their value."""
    inp = Inputs(spark, d)
    medium = inp.items().join(inp.products().filter(F.col("flavor") == "MEDIUM").select("sku"), "sku", "left_semi")
    agg = medium.groupBy("order_id").agg(F.sum(F.col("price") * F.col("quantity")).alias("medium_revenue"))
    out = upsert.update_from(inp.orders(), agg, "order_id", {"revenue": F.col("medium_revenue").cast(MONEY)})
    return out.select("order_id", dbl("revenue"))


@query("existence_limit")
def q_o02(spark, d):
    """Top-1 probe: the newest order (a NULL date sorts first, as in the source)."""
    o = Inputs(spark, d).orders_landed()
    return o.orderBy(F.col("order_date").desc_nulls_first(), F.col("order_id").desc()).limit(1) \
        .select("order_id", "order_date")
