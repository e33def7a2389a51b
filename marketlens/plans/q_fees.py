"""Registered queries: fee flattening, resolution and per-order finance."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens.functions.fees import not_double_counted
from marketlens.operators import fees as fo
from marketlens.operators import flatten, resolve, upsert
from marketlens.operators import quality as qo
from marketlens.plans.inputs import Inputs
from marketlens.plans.qbase import dbl, query

FULL_FROM, FULL_TO = "1995-01-01", "2002-01-01"
FEE_COLS = ["uid", "order_id", "ext_order_id", "fee_group", "fee_name", "amount", "percent", "product_id",
            "sku", "operation_type", "occurred_at", "source"]


def fee_out(df):
    return df.select(*[dbl(c) if c in ("amount", "percent") else F.col(c) for c in FEE_COLS])


@query("flatten_posting_fees")
def q_posting_fees(spark, d):
    return fee_out(Inputs(spark, d).posting_fees())


@query("flatten_finance_services")
def q_finance_services(spark, d):
    rows = flatten.finance_fee_rows(Inputs(spark, d).finance_resolved())
    return fee_out(rows)


@query("resolve_order_id")
def q_resolve(spark, d):
    return Inputs(spark, d).finance_resolved().select("cand", "order_id", "ext_order_id")


@query("resolve_exact")
def q_resolve_exact(spark, d):
    inp = Inputs(spark, d)
    cands = flatten.finance_service_rows(inp.finance_operations()).select("cand") \
        .filter(F.col("cand").isNotNull()).distinct()
    return resolve.resolve_exact(cands, inp.orders_landed(), "cand")


@query("latest_per_key")
def q_latest(spark, d):
    o = Inputs(spark, d).orders_landed().filter(F.col("customer_id").isNotNull())
    return resolve.latest_per_key(o, "customer_id", "order_id", "order_date", out="latest_order_id")


@query("last_write_wins")
def q_lww(spark, d):
    return fee_out(Inputs(spark, d).finance_fees())


@query("fee_union")
def q_fee_union(spark, d):
    return fee_out(Inputs(spark, d).fees())


@query("fee_dedup_filter")
def q_f04(spark, d):
    f = Inputs(spark, d).fees().filter(not_double_counted())
    return f.select("order_id", "fee_group", "source", dbl("amount"))


ORDER_FIN_COLS = ["fees_total", "sales_report", "payout", "delivery_fee", "acquiring_fee", "ads_fee",
                  "sale_commission", "discount", "other_fee", "profit"]


@query("sales_report")
def q_sales(spark, d):
    inp = Inputs(spark, d)
    return fo.sales_report(inp.orders(), inp.fees()).select("order_id", dbl("sales_report"))


@query("order_fees_total")
def q_fees_total(spark, d):
    inp = Inputs(spark, d)
    return fo.order_fees_total(inp.orders(), inp.fees()).select("order_id", dbl("fees_total"))


@query("order_payout")
def q_payout(spark, d):
    inp = Inputs(spark, d)
    o = fo.recalc_order_finance(inp.orders(), inp.fees(), breakdown=False)
    return o.select("order_id", dbl("sales_report"), dbl("fees_total"), dbl("payout"))


@query("fee_breakdown")
def q_breakdown(spark, d):
    inp = Inputs(spark, d)
    o = fo.fee_breakdown(inp.orders(), inp.fees())
    return o.select("order_id", dbl("revenue"), *[dbl(c) for c in ORDER_FIN_COLS if c not in ("sales_report", "payout")])


@query("unlinked_costs_filter")
def q_f05(spark, d):
    f = fo.unlinked_costs(Inputs(spark, d).fees(), FULL_FROM, FULL_TO)
    return f.select("uid", "fee_group", "fee_name", "occurred_at", dbl("amount"))


@query("period_costs")
def q_period_costs(spark, d):
    pc = fo.period_costs(Inputs(spark, d).fees(), FULL_FROM, FULL_TO)
    return pc.select("cost_date", "fee_group", "fee_name", dbl("amount"))


@query("replace_range_period_costs")
def q_u08(spark, d):
    fees = Inputs(spark, d).fees()
    old = fo.period_costs(fees, FULL_FROM, FULL_TO)
    corrected = fees.withColumn("amount", F.col("amount") * 2)
    new = fo.period_costs(corrected, "1998-01-01", "1999-01-01")
    out = fo.replace_range_period_costs(old, new, "1998-01-01", "1999-01-01")
    return out.select("cost_date", "fee_group", "fee_name", dbl("amount"))


@query("upsert_fees_by_uid")
def q_u06(spark, d):
    """Old table: finance rows up to 1999; a reload from mid-1999 brings
    corrected amounts (last arrival per uid wins)."""
    inp = Inputs(spark, d)
    # One plan for the finance rows; both loads are cut from it (shared exchanges are reused). Versions and replacements of a
    # row meet where the join on the candidate has put them. The uid covers the date, so the versions of a row are in one load.
    keys = ["_key", "uid"]
    rows = flatten.finance_fee_rows(inp.finance_resolved(out_key="_key")) \
        .withColumn("_ord", F.struct("_ordinal", "pos")).drop("_ordinal", "pos").withColumn("_last", F.col("_ord"))
    latest = upsert.last_write_wins(rows, keys, "_last")
    old = latest.filter(F.col("occurred_at") < F.lit("2000-01-01").cast("timestamp_ntz")).drop("_ord")
    new = latest.filter(F.col("occurred_at") >= F.lit("1999-07-01").cast("timestamp_ntz")) \
        .withColumn("amount", (F.col("amount") - F.lit(1)).cast("decimal(18,4)"))
    return fee_out(upsert.replace_by_key(old, new.select(*old.columns, "_ord"), keys, ordinal="_ord"))


@query("replace_source_accruals")
def q_u11(spark, d):
    inp = Inputs(spark, d)
    new = inp.accrual_fees().withColumn("amount", (F.col("amount") * 2).cast("decimal(18,4)"))
    return fee_out(upsert.replace_source(inp.fees(), new, "finance_report"))


@query("replace_fees_by_order_source")
def q_u05(spark, d):
    """Postings dated from 1999 are reloaded: their posting_financial rows are
    replaced (orders with no fee rows now still lose their old ones)."""
    inp = Inputs(spark, d)
    old = inp.fees()
    posts = inp.postings().filter(F.col("in_process_at") >= F.lit("1999-01-01"))
    new = flatten.flatten_posting_fees(posts).withColumn("amount", (F.col("amount") + 1).cast("decimal(18,4)"))
    scope = posts.select(F.col("posting_number").alias("order_id"))
    out = upsert.replace_scope(old, new, scope, "order_id", F.col("source") == F.lit("posting_financial"))
    return fee_out(out)


@query("dq_primary_key")
def q_q01(spark, d):
    rows = flatten.finance_fee_rows(Inputs(spark, d).finance_resolved())
    return qo.dq_primary_key(rows, ["uid"])


@query("dq_primary_keys_all")
def q_q01_all(spark, d):
    """Q01 for every declared key: values held by more than one row, per table."""
    inp = Inputs(spark, d)
    fees = flatten.finance_fee_rows(inp.finance_resolved())
    campaigns = flatten.flatten_campaigns(inp.campaigns_raw().drop("nation").withColumnRenamed("ordinal", "_ordinal"))
    return qo.dq_primary_keys({
        "customers": inp.customers(), "orders": inp.orders(), "products": inp.products(), "order_fee_items": fees,
        "campaigns": campaigns, "campaign_daily": inp.daily(), "period_costs": fo.period_costs(inp.fees(), FULL_FROM, FULL_TO)})


@query("dq_counts_by_source")
def q_q04(spark, d):
    return qo.dq_counts_by_source(Inputs(spark, d).fees())


@query("conform_schema")
def q_m01(spark, d):
    from marketlens import schemas
    pf = Inputs(spark, d).posting_fees().select("order_id", "fee_group", "fee_name", "amount")
    c = qo.conform_schema(pf, schemas.FEE_ITEMS, defaults={"source": "posting_financial"})
    return fee_out(c)


@query("drop_keyless_rows")
def q_f03(spark, d):
    svc = flatten.finance_service_rows(Inputs(spark, d).finance_operations())
    kept, _obs = qo.drop_keyless_rows(svc, ["cand"])
    return kept.select("cand", "fee_name", dbl("amount"))


@query("backfill_window_counts")
def q_a23(spark, d):
    f = Inputs(spark, d).fees().filter(F.col("source") == F.lit("finance_api"))
    return qo.backfill_window_counts(f, "occurred_at", FULL_FROM, FULL_TO, 10)
