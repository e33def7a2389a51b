"""Registered queries for the scalar functions.

Each builds text inputs from a test table (one row per base row; variants are
chosen per row by key residue) and applies the function column-wise.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens import functions as fn
from marketlens.sources import testdata as td
from marketlens.plans.qbase import query

NBSP = "\u00a0"


def money_texts(spark, d, junk: bool, nbsp: bool, blank: bool):
    """'1 234,56'-style texts from events.value, one per event."""
    e = td.table(spark, d, "events").select("event_id", "value")
    base = F.concat(F.lit("1"), F.lit(" "), F.replace(td.s(td.m("value")), F.lit("."), F.lit(",")))
    txt = base
    if nbsp:
        txt = F.when(F.col("event_id") % 2 == 0, F.replace(base, F.lit(" "), F.lit(NBSP))).otherwise(txt)
    if blank:
        txt = F.when(F.col("event_id") % 11 == 0, F.lit("")).otherwise(txt)
    if junk:
        txt = F.when(F.col("event_id") % 13 == 0, F.lit("n/a")).otherwise(txt)
    return e.select("event_id", txt.alias("text"))


@query("money_lenient")
def q_p01(spark, d):
    t = money_texts(spark, d, junk=True, nbsp=True, blank=True)
    return t.select("event_id", "text", fn.money_lenient("text").cast("double").alias("amount"))


@query("money_strict")
def q_p02(spark, d):
    t = money_texts(spark, d, junk=False, nbsp=False, blank=False)
    return t.select("event_id", "text", fn.money_strict("text").cast("double").alias("amount"))


@query("money_localized")
def q_p03(spark, d):
    t = money_texts(spark, d, junk=False, nbsp=True, blank=True)
    return t.select("event_id", "text", fn.money_localized("text").cast("double").alias("amount"))


@query("money_report")
def q_p04(spark, d):
    t = money_texts(spark, d, junk=False, nbsp=False, blank=False)
    t = t.withColumn("text", F.when(F.col("event_id") % 13 == 0, F.lit("NaN"))
                     .when(F.col("event_id") % 17 == 0, F.lit(None)).otherwise(F.col("text")))
    return t.select("event_id", "text", fn.money_report("text").cast("double").alias("amount"))


def posting_texts(spark, d):
    o = td.table(spark, d, "orders")
    oid = td.order_id_expr()
    k = F.col("o_orderkey") % 5
    txt = (F.when(k == 0, oid).when(k == 1, F.replace(oid, F.lit("-"), F.lit("_")))
           .when(k == 2, F.lit(" ")).when(k == 3, F.concat(F.lit("  "), oid, F.lit(" "))))
    return o.select("o_orderkey", txt.alias("text"))


@query("customer_from_posting")
def q_p05(spark, d):
    t = posting_texts(spark, d)
    return t.select("o_orderkey", "text", fn.customer_from_posting("text").alias("customer_id"))


@query("customer_from_posting_simple")
def q_p06(spark, d):
    t = posting_texts(spark, d)
    return t.select("o_orderkey", "text", fn.customer_from_posting_simple("text").alias("customer_id"))


def date_texts(spark, d, lenient: bool):
    o = td.table(spark, d, "orders")
    dt = F.col("o_orderdate")
    k = F.col("o_orderkey") % (5 if lenient else 4)
    txt = (F.when(k == 0, F.date_format(dt, "yyyy-MM-dd")).when(k == 1, F.date_format(dt, "dd.MM.yyyy"))
           .when(k == 2, F.date_format(dt, "d.M.yyyy")).when(k == 3, F.date_format(dt, "dd/MM/yyyy"))
           .otherwise(F.date_format(dt, "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    txt = F.when(F.col("o_orderkey") % 50 == 0, F.lit("")).otherwise(txt)
    if lenient:
        txt = F.when(F.col("o_orderkey") % 7 == 0, F.lit("n/a")).otherwise(txt)
    return o.select("o_orderkey", txt.alias("text"))


@query("date_any")
def q_p07(spark, d):
    t = date_texts(spark, d, lenient=False)
    return t.select("o_orderkey", "text", fn.date_any("text").alias("parsed"))


@query("date_any_lenient")
def q_p08(spark, d):
    t = date_texts(spark, d, lenient=True)
    return t.select("o_orderkey", "text", fn.date_any_lenient("text").alias("parsed"))


def name_texts(spark, d):
    it = td.items(spark, d)
    name = td._pick(F.col("l_suppkey") % 6, td.SERVICE_NAMES)
    ln = F.col("l_linenumber") % 5
    txt = (F.when(ln == 1, F.upper(name)).when(ln == 2, F.concat(F.lit("LastMile"), td.s("sku")))
           .when(ln == 3, F.lit(None).cast("string")).when(ln == 4, F.lit("")).otherwise(name))
    return it.select("o_orderkey", "l_linenumber", txt.alias("name"))


@query("fee_name_normalize")
def q_p09(spark, d):
    t = name_texts(spark, d)
    return t.select("o_orderkey", "l_linenumber", "name", fn.fee_name_normalize("name").alias("fee_name"))


@query("fee_group_classify")
def q_p10(spark, d):
    t = name_texts(spark, d)
    return t.select("o_orderkey", "l_linenumber", "name", fn.fee_group_classify("name").alias("fee_group"))


@query("fee_uid")
def q_p11(spark, d):
    it = td.items(spark, d)
    ln = F.col("l_linenumber")
    null = F.lit(None).cast("string")
    uid = fn.fee_uid(F.lit("finance_api"), F.when(ln % 2 == 0, F.col("order_id")), F.when(ln % 2 == 1, F.col("order_id")),
                     F.when(ln % 3 != 0, F.lit("OperationAgentDeliveredToCustomer")), null,
                     F.concat(F.lit("svc"), td.s("l_suppkey")), F.date_format("l_shipdate", "yyyy-MM-dd"),
                     F.when(ln % 4 != 0, F.col("sku")).otherwise(F.lit(0)))
    return it.select("o_orderkey", "l_linenumber", "sku", uid.alias("uid"))


def accrual_id_texts(spark, d):
    it = td.items(spark, d)
    ln = F.col("l_linenumber") % 4
    txt = (F.when(ln == 0, F.col("order_id")).when(ln == 1, F.concat(F.lit(" "), F.col("order_id"), F.lit(" ")))
           .when(ln == 2, td.s("o_orderkey")).otherwise(F.concat(F.col("order_id"), F.lit("-x"))))
    return it.select("o_orderkey", "l_linenumber", txt.alias("text"))


@query("posting_id_normalize")
def q_p12(spark, d):
    t = accrual_id_texts(spark, d)
    return t.select("o_orderkey", "l_linenumber", "text", fn.posting_id_normalize("text").alias("order_id"))


@query("int_lenient")
def q_p13(spark, d):
    li = td.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    q = td.s(F.col("l_quantity").cast("bigint"))
    k = F.col("l_linenumber") % 4
    txt = (F.when(k == 0, q).when(k == 1, F.concat(F.lit(" "), q, F.lit(" ")))
           .when(k == 2, td.s(td.m("l_quantity"))).otherwise(F.lit("abc")))
    return li.select("l_orderkey", "l_linenumber", txt.alias("text"), fn.int_lenient(txt).alias("qty"))


@query("first_present")
def q_p14(spark, d):
    a = td.attribution_rows(spark, d)
    return a.select("campaignId", "campaign_id", "id",
                    fn.first_present("campaignId", "campaign_id", "id", default="0").alias("campaign"))


@query("line_revenue")
def q_p15(spark, d):
    it = td.items(spark, d)
    qty = F.when(F.col("l_linenumber") % 6 != 0, F.col("quantity"))
    return it.select("order_id", "sku", "l_linenumber",
                     fn.line_revenue(F.col("price"), qty).cast("double").alias("revenue"))


@query("iso_window_bounds")
def q_p16(spark, d):
    li = td.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return li.select("l_orderkey", "l_linenumber", fn.iso_z(F.col("l_shipdate")).alias("iso"))
