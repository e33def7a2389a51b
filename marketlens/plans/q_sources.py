"""Registered queries for the sources.

Documents are derived from the test tables, landed as response pages under
the shared checkpoint folder (a fresh path per run), and read back through
the real readers, so the nested JSON / report text paths are exercised.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens import vocab
from marketlens.operators import flatten, resolve
from marketlens.plans.inputs import Inputs
from marketlens.plans.q_ads import attr_out, daily_out, CAMPAIGN_COLS
from marketlens.plans.q_fees import fee_out
from marketlens.plans.qbase import dbl, query
from marketlens.session import scratch_path
from marketlens.sources import accruals, json_docs, tables
from marketlens.sources import testdata as td


def _posting_seq():
    return F.split(F.col("posting_number"), "-").getItem(1).cast("bigint")


def land_postings(spark, docs, name):
    """Pages of 100 postings; even pages use {"result": [...]}, odd pages
    {"result": {"postings": [...]}}."""
    path = scratch_path(spark, name)
    env = lambda arr, page: F.when(page % 2 == 0, F.to_json(F.struct(arr.alias("result")))) \
        .otherwise(F.to_json(F.struct(F.struct(arr.alias("postings")).alias("result"))))
    json_docs.land_pages(docs.withColumn("_seq", _posting_seq()), path, env, "_seq", as_text=True)
    return path


@query("src_postings")
def q_s01(spark, d):
    inp = Inputs(spark, d)
    path = land_postings(spark, inp.postings(), "postings")
    p = json_docs.read_postings(spark, path)
    h = flatten.flatten_order_header(p)
    return h.select("order_id", "customer_id", "order_date", "status", dbl("revenue"), dbl("fees_total"),
                    dbl("payout"))


@query("src_postings_by_scheme")
def q_s02(spark, d):
    inp = Inputs(spark, d)
    posts = inp.postings()
    fbo = land_postings(spark, posts.filter(F.col("status") == "F"), "postings-fbo")
    fbs = land_postings(spark, posts.filter(~(F.col("status") == "F")), "postings-fbs")
    p = json_docs.read_postings_by_scheme(spark, {"fbo": fbo, "fbs": fbs})
    return p.select(F.col("posting_number").alias("order_id"), "scheme", "status",
                    F.size(F.coalesce(F.col("products"), F.array())).alias("n_products"))


@query("src_finance_ops")
def q_s03(spark, d):
    inp = Inputs(spark, d)
    ops = inp.finance_operations().drop("_ordinal")
    path = scratch_path(spark, "finance-ops")
    seq = F.col("operation_id")
    json_docs.land_pages(ops.withColumn("_seq", F.split(seq, "-").getItem(0).cast("bigint") * 8
                                        + F.split(seq, "-").getItem(1).cast("bigint")), path,
                         lambda arr, page: F.struct(F.struct(arr.alias("operations")).alias("result")), "_seq", 200)
    read = json_docs.read_finance_ops(spark, path)
    svc = flatten.finance_service_rows(read)
    res = resolve.resolve_order_id(svc, inp.orders_landed(), "cand")
    return fee_out(flatten.finance_fee_rows(res))


@query("src_campaigns")
def q_s04(spark, d):
    raw = Inputs(spark, d).campaigns_raw().drop("nation")
    path = scratch_path(spark, "campaigns")
    json_docs.land_pages(raw.withColumnRenamed("ordinal", "_seq"), path,
                         lambda arr, page: F.struct(arr.alias("list")), "_seq", 50)
    c = flatten.flatten_campaigns(json_docs.read_campaigns(spark, path))
    return c.select(*CAMPAIGN_COLS)


@query("src_campaign_daily")
def q_s05(spark, d):
    rows = td.daily_rows(spark, d)
    path = scratch_path(spark, "daily")
    seq = F.dayofyear(F.to_date("date")) * 100 + F.substring("id", 2, 3).cast("int")
    json_docs.land_pages(rows.withColumn("_seq", seq), path, lambda arr, page: F.struct(arr.alias("rows")),
                         "_seq", 100)
    return daily_out(flatten.flatten_campaign_daily(json_docs.read_campaign_daily(spark, path)))


@query("src_attribution_rows")
def q_s06(spark, d):
    """Pages alternate between rows under 'rows' and rows under 'list' with an
    empty 'rows' array."""
    inp = Inputs(spark, d)
    raw = inp.attribution_raw().drop("_ordinal")
    path = scratch_path(spark, "attribution")
    seq = F.monotonically_increasing_id()
    env = lambda arr, page: F.when(page % 2 == 0, F.to_json(F.struct(arr.alias("rows")))).otherwise(
        F.to_json(F.struct(F.array().alias("rows"), arr.alias("list"))))
    json_docs.land_pages(raw.withColumn("_seq", seq), path, env, "_seq", 500, as_text=True)
    fields = flatten.attribution_fields(json_docs.read_attribution(spark, path))
    res = resolve.resolve_order_id(fields, inp.orders_landed(), "cand", exact=False)
    return attr_out(flatten.attribution_rows(res))


@query("src_accruals")
def q_s07(spark, d):
    rows = td.accrual_rows(spark, d)
    path = scratch_path(spark, "accruals")
    accruals.land_accruals(rows, path, vocab.ACCRUAL_LABELS, "01.01.1995 - 31.12.2001")
    rep = accruals.read_accruals(spark, path, vocab.ACCRUAL_LABELS)
    return fee_out(flatten.flatten_accruals(rep))


@query("dim_catalog")
def q_s08(spark, d):
    cat = td.catalog(spark, d)
    path = scratch_path(spark, "catalog")
    cat.write.option("header", True).csv(path)
    return tables.read_catalog(spark, path, "csv")


@query("param_scan")
def q_s09(spark, d):
    o = Inputs(spark, d).orders()
    return tables.param_scan(
        spark, "SELECT order_id, customer_id, CAST(revenue AS DOUBLE) AS revenue FROM orders_v "
               "WHERE campaign = :campaign AND revenue > :min_revenue",
        args={"campaign": "2-HIGH", "min_revenue": 100000}, views={"orders_v": o})
