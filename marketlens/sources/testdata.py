"""Adapters from the driver's test tables to this domain's inputs.

The test data is a TPC-H-like star schema. These functions derive, with
plain column expressions and joins, the landed inputs the seller pipeline
works on: order rows, order items, products, finance operations, ad
attribution rows, daily ad statistics and campaigns. Every derivation keeps
all rows of its base table (roles are assigned per row, nothing is sampled),
so the work grows with the tables. ``oracle/fixtures.py`` states the same
derivations in DuckDB SQL.

Conventions: ``s(x)`` = text, ``m(x)`` = ``decimal(18,2)``, applied before
any arithmetic so both engines compute on the same decimals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens import vocab

M2 = "decimal(18,2)"

# --- FIXED VALUES (fixture vocabulary): service names of finance operations,
# picked per row by l_suppkey % 6, in this order.
SERVICE_NAMES = [
    "MarketplaceServiceItemDirectFlowLogistic",
    "MarketplaceServiceItemRedistributionLastMileCourier",
    "MarketplaceRedistributionOfAcquiringOperation",
    "Вознаграждение за продажу",
    "Оплата за клик",
    "Хранение",
]
# Accrual report service groups, picked per row by l_returnflag.
ACCRUAL_GROUPS = {"R": vocab.FEE_GROUP_SALES, "A": vocab.FEE_GROUP_COMMISSION, "N": vocab.FEE_GROUP_DELIVERY}
UNRESOLVABLE_PREFIX = "999999999-"


def s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def m(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(M2)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(key: Column, values: list[str]) -> Column:
    out = None
    for i, v in enumerate(values):
        cond = key == F.lit(i)
        out = F.when(cond, F.lit(v)) if out is None else out.when(cond, F.lit(v))
    return out


def order_id_expr(custkey="o_custkey", orderkey="o_orderkey") -> Column:
    return F.concat(s(custkey), F.lit("-"), s(orderkey), F.lit("-1"))


def line_ordinal() -> Column:
    """Arrival order of lineitem-derived rows. (l_orderkey, l_linenumber) is
    not unique in the test data, so the remaining columns complete a total
    order; rows equal in all of them are identical."""
    return F.struct("o_orderkey", "l_linenumber", "sku", "l_suppkey", "quantity", "price", "disc",
                    "tax", "l_shipdate")


def lines(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    """lineitem joined to its order (one row per lineitem). With ``whole`` a line passes the shuffle as one value, all columns
    together: readers that need different ones share the shuffle."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    if not whole:
        return li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    packed = li.select("l_orderkey", F.array(F.struct(*[c for c in li.columns if c != "l_orderkey"])).alias("_line"))
    return packed.join(o, packed.l_orderkey == o.o_orderkey, "inner").select(*packed.columns[:1], *o.columns, F.inline("_line"))


def items(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    """order_items: order_id, sku, quantity, price (+ disc, tax, keys used by other fixtures)."""
    return lines(spark, sf_dir, whole).select(
        order_id_expr().alias("order_id"),
        F.col("l_partkey").alias("sku"),
        m("l_quantity").alias("quantity"),
        m("l_extendedprice").alias("price"),
        m("l_discount").alias("disc"),
        m("l_tax").alias("tax"),
        "l_suppkey", "l_linenumber", "l_shipdate", "l_returnflag", "o_orderkey", "o_custkey",
    )


def orders_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed order rows. NULL dates / customers are injected on fixed key residues
    so NULL handling is exercised (no row is dropped)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        order_id_expr().alias("order_id"),
        F.when(F.col("o_orderkey") % 101 != 0, s("o_custkey")).alias("customer_id"),
        F.when(F.col("o_orderkey") % 97 != 0, F.col("o_orderdate")).alias("order_date"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("campaign"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("sku"), F.col("p_name").alias("name"),
                    F.col("p_type").alias("flavor"), F.col("p_size").alias("grams"))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Static product dimension sku -> flavor, grams."""
    return products(spark, sf_dir).select("sku", "flavor", "grams")


# --- nested documents ----------------------------------------------------------

def _iso(c) -> Column:
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 posting documents (one row per order, nested products and financial data).

    Lines are grouped per order key (partial collect before the shuffle), then
    orders are left-joined on the same key, which reuses that partitioning: one
    shuffle of each table. An order holds a handful of lines; orders without
    lines get NULL arrays. The shuffle carries numbers; the texts of the document
    are made from them after it.
    """
    o = orders_landed(spark, sf_dir).withColumn("_okey", F.split("order_id", "-").getItem(1).cast("bigint"))
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", m("l_quantity").alias("q"), m("l_extendedprice").alias("p"),
        m("l_discount").alias("dsc"), m("l_tax").alias("tx"))
    per_order = li.groupBy("l_orderkey").agg(F.collect_list(F.struct("l_partkey", "q", "p", "dsc", "tx")).alias("lines"))
    g = o.join(per_order, o["_okey"] == per_order["l_orderkey"], "left")
    return g.select(
        F.col("order_id").alias("posting_number"),
        _iso("order_date").alias("in_process_at"),
        F.col("status"),
        F.transform("lines", lambda x: F.struct(
            s(x["l_partkey"]).alias("sku"), F.concat(F.lit("Товар "), s(x["l_partkey"])).alias("name"),
            s(x["q"]).alias("quantity"), s(x["p"]).alias("price"))).alias("products"),
        F.struct(F.transform("lines", lambda x: F.struct(
            s(x["l_partkey"]).alias("product_id"), s(-(x["p"] * x["dsc"])).alias("commission_amount"),
            s(x["dsc"]).alias("commission_percent"), s(x["p"] - x["p"] * x["dsc"]).alias("payout"),
            s(x["p"] * x["tx"]).alias("total_discount_value"),
            s(x["tx"]).alias("total_discount_percent"))).alias("products")
        ).alias("financial_data"),
    )


def finance_operations(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    """A2 finance operations, one per lineitem.

    Order candidate by line number: %5=0 customer only (several prefix matches);
    else %4=0 full id (exact), 1 customer-number (prefix), 2 none (period cost),
    3 an id no order has. Services are empty when l_partkey % 3 = 0.
    """
    it = items(spark, sf_dir, whole)
    ln = F.col("l_linenumber")
    cand = (F.when(ln % 5 == 0, s("o_custkey"))
            .when(ln % 4 == 0, F.col("order_id"))
            .when(ln % 4 == 1, F.concat(s("o_custkey"), F.lit("-"), s("o_orderkey")))
            .when(ln % 4 == 2, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit(UNRESOLVABLE_PREFIX), s("o_orderkey"))))
    name = _pick(F.col("l_suppkey") % 6, SERVICE_NAMES)
    amount = s(-(F.col("price") * F.col("tax")))
    service = F.struct(name.alias("name"), F.lit(None).cast("string").alias("type"),
                       amount.alias("price"), F.lit(None).cast("string").alias("amount"),
                       s("sku").alias("sku"))
    services = F.when(F.col("sku") % 3 == 0, F.array().cast("array<struct<name:string,type:string,price:string,amount:string,sku:string>>")) \
        .otherwise(F.array(service))
    return it.select(
        F.concat(s("o_orderkey"), F.lit("-"), s("l_linenumber")).alias("operation_id"),
        _iso("l_shipdate").alias("operation_date"),
        F.lit(None).cast("string").alias("date"),
        F.concat(F.lit("OperationType"), s(F.col("l_suppkey") % 6)).alias("operation_type"),
        name.alias("operation_type_name"),
        amount.alias("amount"),
        F.struct(cand.alias("posting_number")).alias("posting"),
        F.lit(None).cast("string").alias("posting_number"),
        F.lit(None).cast("string").alias("order_id"),
        services.alias("services"),
        line_ordinal().alias("_ordinal"),
    )


def accrual_rows(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    """A6 accrual report rows (flat text columns), one per lineitem.

    Accrual id is the full posting number for line numbers divisible by 3,
    else a bare number (not a posting -> NULL order)."""
    it = items(spark, sf_dir, whole)
    ln = F.col("l_linenumber")
    grp = F.when(F.col("l_returnflag") == "R", F.lit(ACCRUAL_GROUPS["R"])) \
        .when(F.col("l_returnflag") == "A", F.lit(ACCRUAL_GROUPS["A"])) \
        .otherwise(F.lit(ACCRUAL_GROUPS["N"]))
    return it.select(
        F.when(ln % 3 == 0, F.col("order_id")).otherwise(s("o_orderkey")).alias("accrual_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("accrual_date"),
        grp.alias("service_group"),
        F.concat(F.lit("Начисление "), s("l_returnflag")).alias("accrual_type"),
        s("sku").alias("sku"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("accepted_at"),
        F.replace(s(F.col("price") * (F.lit(1) - F.col("disc"))), F.lit("."), F.lit(",")).alias("total_amount"),
        s(F.col("disc") * F.lit(100)).alias("commission_percent"),
    )


def localized_money(c: Column, nbsp: Column, scale: int = 2) -> Column:
    """'1 234,56'-style text for a decimal (exact at ``scale`` digits); the
    thousands space is a no-break space where ``nbsp`` is true."""
    txt = F.format_number(c, scale)  # 1,234.56
    ru = F.replace(F.replace(F.replace(txt, F.lit(","), F.lit("~")), F.lit("."), F.lit(",")), F.lit("~"), F.lit(" "))
    return F.when(nbsp, F.replace(ru, F.lit(" "), F.lit("\u00a0"))).otherwise(ru)


def attribution_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 attribution rows, one per lineitem (fields as text, alternative keys).

    Candidate: customer-number (prefix of one order); customer only when
    line number % 5 = 0 (several matches, newest wins); an unknown customer
    when % 7 = 0. Dates rotate through three layouts."""
    it = items(spark, sf_dir)
    ln = F.col("l_linenumber")
    cand = (F.when(ln % 7 == 0, F.concat(F.lit(UNRESOLVABLE_PREFIX), s("o_orderkey")))
            .when(ln % 5 == 0, s("o_custkey"))
            .otherwise(F.concat(s("o_custkey"), F.lit("-"), s("o_orderkey"))))
    d = F.col("l_shipdate")
    date_txt = (F.when(ln % 3 == 0, F.date_format(d, "yyyy-MM-dd"))
                .when(ln % 3 == 1, F.date_format(d, "dd.MM.yyyy"))
                .otherwise(F.date_format(d, "d/M/yyyy")))
    camp = F.concat(F.lit("c"), s(F.col("l_suppkey") % 10))
    spent = F.col("price") * F.col("tax")
    null = F.lit(None).cast("string")
    return it.select(
        F.when(ln % 2 == 0, camp).alias("campaignId"), F.when(ln % 2 == 1, camp).alias("campaign_id"),
        null.alias("id"),
        F.concat(F.lit("Campaign "), s(F.col("l_suppkey") % 10)).alias("campaignTitle"),
        null.alias("campaign_title"), null.alias("title"), null.alias("ordersSource"),
        date_txt.alias("date"),
        F.when(ln % 2 == 0, cand).alias("orderNumber"), null.alias("orderNumberId"),
        F.when(ln % 2 == 1, cand).alias("order_id"), null.alias("orderId"),
        s("sku").alias("sku"), null.alias("skuId"),
        F.concat(F.lit("offer-"), s("sku")).alias("offerId"), null.alias("offer_id"),
        F.concat(F.lit("Товар "), s("sku")).alias("name"), null.alias("productName"),
        localized_money(spent, ln % 2 == 0, 4).alias("moneySpent"), null.alias("bidValue"),
        null.alias("spent"), null.alias("expense"), null.alias("cost"),
        localized_money(F.col("price"), F.lit(False)).alias("price"),
        localized_money(F.col("price") * F.col("quantity"), F.lit(False), 4).alias("amount"),
        localized_money(F.col("tax"), F.lit(False)).alias("bid"),
        localized_money(F.col("disc") * F.lit(100), F.lit(False)).alias("bidPercent"),
        s(F.col("quantity").cast("bigint")).alias("quantity"),
        null.alias("qty"),
        line_ordinal().alias("_ordinal"),
    )


def daily_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 daily ad statistics: per (campaign, day) counts of views, clicks and
    purchases, spend = sum of click values, as localized money text."""
    e = table(spark, sf_dir, "events")
    et = F.col("event_type")
    g = e.groupBy(F.concat(F.lit("c"), s(F.col("user_id") % 10)).alias("id"),
                  F.to_date("ts").alias("d")).agg(
        F.count(F.when(et == "view", 1)).alias("views"),
        F.count(F.when(et == "click", 1)).alias("clicks"),
        F.count(F.when(et == "purchase", 1)).alias("orders"),
        F.coalesce(F.sum(F.when(et == "click", m("value"))), F.lit(0).cast(M2)).alias("spend"),
        F.coalesce(F.sum(F.when(et == "purchase", m("value"))), F.lit(0).cast(M2)).alias("orders_money"),
        F.coalesce(F.max(F.when(et == "click", m("value"))), F.lit(0).cast(M2)).alias("max_bid"),
    )
    return g.select(
        "id", F.concat(F.lit("Campaign "), F.col("id")).alias("title"),
        F.date_format("d", "yyyy-MM-dd").alias("date"),
        s("views").alias("views"), s("clicks").alias("clicks"),
        localized_money(F.col("spend"), F.lit(False)).alias("moneySpent"),
        localized_money(F.col("max_bid"), F.lit(False)).alias("avgBid"),
        s("orders").alias("orders"),
        localized_money(F.col("orders_money"), F.lit(False)).alias("ordersMoney"),
    )


def campaign_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 campaigns, one per supplier (ids repeat every 10 suppliers, so a
    campaign list has several versions of a campaign)."""
    sp = table(spark, sf_dir, "supplier")
    return sp.select(
        F.concat(F.lit("c"), s(F.col("s_suppkey") % 10)).alias("id"),
        F.col("s_name").alias("title"),
        F.when(F.col("s_acctbal") > 0, F.lit("CAMPAIGN_STATE_RUNNING")).otherwise(F.lit("CAMPAIGN_STATE_STOPPED")).alias("state"),
        F.lit("SKU").alias("advObjectType"),
        F.when(F.col("s_nationkey") % 2 == 0, F.lit("CPC")).otherwise(F.lit("CPO")).alias("PaymentType"),
        F.concat(F.lit("2024-01-"), F.lpad(s(F.col("s_suppkey") % 28 + 1), 2, "0"), F.lit("T00:00:00Z")).alias("createdAt"),
        F.concat(F.lit("2024-02-"), F.lpad(s(F.col("s_suppkey") % 28 + 1), 2, "0"), F.lit("T00:00:00Z")).alias("updatedAt"),
        F.col("s_suppkey").alias("ordinal"),
        F.col("s_nationkey").alias("nation"),
    )
