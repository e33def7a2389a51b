"""Nested documents -> typed rows.

All flattening is ``explode``/``inline`` plus column expressions on the
declared schemas: one narrow pass per document set, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens import vocab
from marketlens.functions.dates import date_any, text_to_ntz, tried
from marketlens.functions.fees import fee_group_classify, fee_name_normalize
from marketlens.functions.ids import (customer_from_posting, fee_uid, first_present, int_lenient,
                                      posting_id_normalize, strip)
from marketlens.functions.money import (MONEY, line_revenue, money_lenient, money_localized,
                                        money_report, money_strict)
from marketlens.operators.orders import posting_revenue, posting_totals



def null_s() -> Column:
    return F.lit(None).cast("string")


def _has_key(c: str) -> Column:
    """``if not posting.get(c)``: NULL and '' are both missing."""
    return F.col(c).isNotNull() & (F.col(c) != F.lit(""))


def flatten_order_header(postings: DataFrame) -> DataFrame:
    """One order row per posting (F03: postings without a number are skipped).

    revenue = A01 in-row; fees_total / payout = A02 posting totals."""
    p = postings.filter(_has_key("posting_number"))
    payout, fees = posting_totals("financial_data.products")
    return p.select(
        F.col("posting_number").alias("order_id"),
        customer_from_posting(F.col("posting_number")).alias("customer_id"),
        text_to_ntz(F.col("in_process_at")).alias("order_date"),
        F.col("status"),
        posting_revenue("products").alias("revenue"),
        fees.alias("fees_total"),
        payout.alias("payout"),
        *[c for c in p.columns if c == "_ordinal"],
    )


def flatten_order_items(postings: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One item row per posting product: order_id, sku, name, quantity,
    price, revenue (= P15 price x quantity); the arrival order (posting,
    then position) if the postings have one; and the posting's columns ``keep``."""
    p = postings.filter(_has_key("posting_number"))
    arrived = "_ordinal" in p.columns
    x = p.select(F.col("posting_number").alias("order_id"), *(["_ordinal"] if arrived else []), *keep,
                 F.posexplode("products").alias("pos", "it"))
    price = money_lenient(F.col("it.price"))
    qty = money_lenient(F.col("it.quantity"))
    return x.select(
        "order_id",
        int_lenient(F.col("it.sku")).alias("sku"),
        F.col("it.name").alias("name"),
        qty.alias("quantity"),
        price.alias("price"),
        line_revenue(price, qty).cast(MONEY).alias("revenue"),
        *([F.struct("_ordinal", "pos").alias("_ordinal")] if arrived else []), *keep,
    )


def products_from_items(items: DataFrame, catalog: DataFrame) -> DataFrame:
    """P18 side output: (sku, name) enriched from the catalog (J02); a miss
    gives NULL flavor/grams. One row per item in arrival order: U03 keeps the
    last one per sku."""
    cat = catalog.select("sku", "flavor", "grams")
    return items.select("sku", "name", *[c for c in items.columns if c == "_ordinal"]) \
        .join(cat, "sku", "left")


def flatten_posting_fees(postings: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """0-2 fee rows per financial product of a posting, with the posting's columns ``keep``.

    commission row if commission_amount != 0 (amount as is); discount row if
    total_discount_value != 0 (amount = -discount). Source 'posting_financial'."""
    p = postings.filter(_has_key("posting_number"))
    x = p.select(F.col("posting_number").alias("order_id"), *keep,
                 F.explode("financial_data.products").alias("fp"))
    fp = F.col("fp")
    com = money_lenient(fp["commission_amount"])
    disc = money_lenient(fp["total_discount_value"])

    def pct(c: Column) -> Column:
        return F.when(c.isNotNull(), money_lenient(c))

    rows = F.filter(F.array(
        F.struct(F.lit(vocab.FEE_GROUP_COMMISSION).alias("fee_group"),
                 F.lit(vocab.POSTING_COMMISSION_NAME).alias("fee_name"),
                 com.alias("amount"), pct(fp["commission_percent"]).alias("percent")),
        F.struct(F.lit(vocab.FEE_GROUP_DISCOUNT).alias("fee_group"),
                 F.lit(vocab.POSTING_DISCOUNT_NAME).alias("fee_name"),
                 (-disc).cast(MONEY).alias("amount"), pct(fp["total_discount_percent"]).alias("percent")),
    ), lambda r: r["amount"] != F.lit(0))
    y = x.select("order_id", *keep, fp["product_id"].alias("product_id"), F.inline(rows))
    return y.select(
        null_s().alias("uid"), "order_id", null_s().alias("ext_order_id"), "fee_group", "fee_name",
        "amount", "percent", "product_id", F.lit(None).cast("bigint").alias("sku"),
        null_s().alias("operation_type"), F.lit(None).cast("timestamp_ntz").alias("occurred_at"),
        F.lit(vocab.SOURCE_POSTING).alias("source"), *keep,
    )


def finance_service_rows(ops: DataFrame) -> DataFrame:
    """P20 (before resolution): one row per service of an operation; an
    operation without services gives one row from the operation itself.

    Service amount is ``price``, else ``amount``; names classify (raw) and
    normalize; the candidate order id is the first present of
    posting.posting_number, posting_number, order_id."""
    op_type = F.when(F.col("operation_type") != F.lit(""), F.col("operation_type"))
    base = ops.select(
        strip(first_present(F.col("posting.posting_number"), F.col("posting_number"),
                            F.col("order_id"))).alias("cand"),
        first_present(F.col("operation_date"), F.col("date")).alias("op_date"),
        op_type.alias("operation_type"),
        first_present(F.col("operation_type_name"), op_type, default=vocab.FEE_NAME_UNKNOWN).alias("op_name"),
        F.col("amount").alias("op_amount"),
        F.col("services"),
        *[c for c in ops.columns if c == "_ordinal"],
    )
    keep = [c for c in base.columns if c not in ("services",)]
    # posexplode_outer yields one row per service, or one row with a NULL
    # position when an operation has no services: that row is the operation's.
    x = base.select(*keep, F.posexplode_outer("services").alias("pos", "svc"))
    is_op = F.col("pos").isNull()
    svc = F.col("svc")
    name = F.when(is_op, F.col("op_name")).otherwise(
        first_present(svc["name"], svc["type"], default=vocab.FEE_NAME_UNKNOWN))
    amount = F.when(is_op, F.col("op_amount")).otherwise(F.coalesce(svc["price"], svc["amount"]))
    sku = F.when(~is_op, svc["sku"])
    y = x.select(*keep, name.alias("name"), amount.alias("amount"), sku.alias("sku"),
                 F.coalesce(F.col("pos"), F.lit(0)).alias("pos"))
    return y.select(
        F.when(F.col("cand") != F.lit(""), F.col("cand")).alias("cand"),
        "op_date", "operation_type",
        fee_group_classify(F.col("name")).alias("fee_group"),
        fee_name_normalize(F.col("name")).alias("fee_name"),
        money_strict(F.col("amount")).alias("amount"),
        int_lenient(F.col("sku")).alias("sku"),
        *[c for c in base.columns if c == "_ordinal"], "pos",
    )


def finance_fee_rows(resolved: DataFrame) -> DataFrame:
    """P20 (after J05): fee table rows with the uid."""
    return resolved.select(
        fee_uid(F.lit(vocab.SOURCE_FINANCE_API), F.col("order_id"), F.col("ext_order_id"),
                F.col("operation_type"), F.col("fee_group"), F.col("fee_name"), F.col("op_date"),
                F.col("sku")).alias("uid"),
        "order_id", "ext_order_id", "fee_group", "fee_name", "amount",
        F.lit(None).cast(MONEY).alias("percent"), null_s().alias("product_id"), "sku",
        "operation_type", text_to_ntz(F.col("op_date")).alias("occurred_at"),
        F.lit(vocab.SOURCE_FINANCE_API).alias("source"),
        *[c for c in resolved.columns if c in ("_ordinal", "pos", "_key")],
    )


def flatten_campaigns(campaigns: DataFrame) -> DataFrame:
    """Campaign rows (id required) and the raw document as JSON text: the
    whole landed one (``_raw``) where the reader kept it, else the columns."""
    c = campaigns.filter(F.col("id").isNotNull())
    doc_cols = [x for x in c.columns if x not in ("_ordinal", "_raw")]
    raw = F.col("_raw") if "_raw" in c.columns else F.to_json(F.struct(*doc_cols))
    return c.select(
        F.col("id").alias("campaign_id"), "title", "state",
        F.col("advObjectType").alias("adv_object_type"), F.col("PaymentType").alias("payment_type"),
        F.col("createdAt").alias("created_at"), F.col("updatedAt").alias("updated_at"),
        raw.alias("raw"),
        *[x for x in c.columns if x == "_ordinal"],
    )


def _int_or_zero(c: Column) -> Column:
    """``int(x or 0)``: NULL/'' -> 0, else a strict integer."""
    s = c.cast("string")
    return F.when(s.isNull() | (s == F.lit("")), F.lit(0).cast("bigint")).otherwise(
        F.coalesce((F.btrim(s)).try_cast("bigint"),
                   F.raise_error(F.concat(F.lit("invalid integer: "), s)).cast("bigint")))


def flatten_campaign_daily(rows: DataFrame) -> DataFrame:
    """Daily rows; blank campaign ids are skipped."""
    cid = strip(F.coalesce(F.col("id"), F.lit("")))
    d = F.col("date")
    stat_date = F.coalesce(F.try_to_date(d, "yyyy-MM-dd"),
                           F.raise_error(F.concat(F.lit("bad date: "), F.coalesce(d, F.lit("NULL")))).cast("date"))
    daily_money = lambda c: money_localized(F.col(c), strip_nbsp=False)
    return rows.filter(cid != F.lit("")).select(
        cid.alias("campaign_id"),
        strip(F.coalesce(F.col("title"), F.lit(""))).alias("campaign_title"),
        stat_date.alias("stat_date"),
        _int_or_zero(F.col("views")).alias("impressions"),
        _int_or_zero(F.col("clicks")).alias("clicks"),
        daily_money("moneySpent").alias("spend"),
        daily_money("avgBid").alias("avg_bid"),
        _int_or_zero(F.col("orders")).alias("orders_cnt"),
        daily_money("ordersMoney").alias("orders_amount"),
        *[c for c in rows.columns if c == "_ordinal"],
    )


def attribution_fields(rows: DataFrame) -> DataFrame:
    """P23 (before resolution): normalise one report row (P03/P07/P13/P14);
    rows without a date are dropped."""
    col = F.col
    camp = strip(first_present(col("campaignId"), col("campaign_id"), col("id"),
                               default=vocab.UNKNOWN_CAMPAIGN_ID))
    out = rows.select(
        F.when(camp != F.lit(""), camp).otherwise(F.lit(vocab.UNKNOWN_CAMPAIGN_ID)).alias("campaign_id"),
        first_present(col("campaignTitle"), col("campaign_title"), col("title"), col("ordersSource")).alias("campaign_title"),
        date_any(col("date")).alias("stat_date"),
        first_present(col("orderNumber"), col("orderNumberId"), col("order_id"), col("orderId")).alias("cand"),
        int_lenient(first_present(col("sku"), col("skuId"))).alias("sku"),
        first_present(col("offerId"), col("offer_id")).alias("offer_id"),
        first_present(col("name"), col("productName")).alias("product_name"),
        money_localized(col("price")).alias("price"),
        money_localized(col("amount")).alias("amount"),
        money_localized(first_present(col("moneySpent"), col("bidValue"), col("spent"), col("expense"),
                                      col("cost"))).alias("spent"),
        money_localized(col("bid")).alias("bid"),
        money_localized(col("bidPercent")).alias("bid_percent"),
        int_lenient(first_present(col("quantity"), col("qty"))).alias("qty"),
        *[c for c in rows.columns if c == "_ordinal"],
    )
    return out.filter(F.col("stat_date").isNotNull())


ATTRIBUTION_PAYLOAD = ["campaign_id", "campaign_title", "order_id", "ext_order_id", "sku", "offer_id",
                       "product_name", "stat_date", "price", "amount", "spent", "bid", "bid_percent", "qty"]


def attribution_rows(resolved: DataFrame) -> DataFrame:
    """P23 (after J04): attribution table rows with a content-hash key over the
    report's own fields. The candidate id counts, not the order it resolves to:
    a row landed again after a newer order took its prefix is the same row."""
    own = ["cand" if c == "order_id" else c for c in ATTRIBUTION_PAYLOAD if c != "ext_order_id"]
    # never NULL, and the planner is told so: else a join on it first makes every row's key below the shuffle, to see whether it is NULL
    key = F.coalesce(F.sha2(F.to_json(F.struct(*[F.col(c) for c in own])), 256), F.lit(""))
    return resolved.select(key.alias("row_key"), *ATTRIBUTION_PAYLOAD,
                           F.lit(vocab.SOURCE_PERFORMANCE).alias("source"),
                           *[c for c in resolved.columns if c in ("_ordinal", "_key")])


# --- FIXED VALUES: date layouts of the report's "accepted" column
ACCEPTED_LAYOUTS = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "dd.MM.yyyy HH:mm:ss", "dd.MM.yyyy"]


def _accepted_at(c: Column) -> Column:
    """Timestamp of a report row; blank (or a blank cell's 'nan', 'NaT') is NULL, any
    other text that is no date raises."""
    text = strip(c)
    blank = text.isNull() | F.lower(text).isin("", "nan", "nat")
    parsed = F.coalesce(*[tried(text, x, lambda t, f: F.try_to_timestamp(t, F.lit(f))) for x in ACCEPTED_LAYOUTS])
    bad = F.raise_error(F.concat(F.lit("bad date in accrual report: "), F.coalesce(text, F.lit("NULL")))).cast("timestamp")
    return F.when(~blank, F.coalesce(parsed, bad)).cast("timestamp_ntz")


def flatten_accruals(report: DataFrame) -> DataFrame:
    """Accrual report rows -> fee rows of source 'finance_report'.

    order_id only when the accrual id is a full posting number (P12); fee_name
    and operation_type are the accrual type; amount via P04."""
    grp = strip(F.col("service_group"))
    typ = strip(F.col("accrual_type"))
    pct = F.col("commission_percent") if "commission_percent" in report.columns else F.lit(None).cast("string")
    return report.select(
        null_s().alias("uid"),
        posting_id_normalize(F.col("accrual_id")).alias("order_id"),
        null_s().alias("ext_order_id"),
        grp.alias("fee_group"), typ.alias("fee_name"),
        money_report(F.col("total_amount")).alias("amount"),
        F.when(pct.isNotNull() & (F.lower(F.btrim(pct)) != F.lit("nan")), money_report(pct)).alias("percent"),
        null_s().alias("product_id"),
        int_lenient(F.col("sku")).alias("sku"),
        typ.alias("operation_type"),
        _accepted_at(F.col("accepted_at")).alias("occurred_at"),
        F.lit(vocab.SOURCE_FINANCE_REPORT).alias("source"),
    )
