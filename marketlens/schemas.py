"""Declared schemas: landed JSON documents (ids and money as STRING, parsed
later by the P-functions) and the target tables."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BooleanType, DateType, DecimalType, IntegerType,
                               LongType, StringType, StructField, StructType,
                               TimestampNTZType)

from marketlens import vocab

S = StringType()
MONEY = DecimalType(18, 4)


def _struct(*names_types) -> StructType:
    return StructType([StructField(n, t, True) for n, t in names_types])


def _strings(*names) -> StructType:
    return _struct(*[(n, S) for n in names])


# --- FIXED VALUES: field names of the landed documents (A1-A5)
# --- A1 posting --------------------------------------------------------------
POSTING_PRODUCT = _strings("sku", "name", "quantity", "price")
POSTING_FIN_PRODUCT = _strings("product_id", "commission_amount", "commission_percent", "payout",
                               "total_discount_value", "total_discount_percent")
POSTING = _struct(
    ("posting_number", S), ("in_process_at", S), ("status", S),
    ("products", ArrayType(POSTING_PRODUCT)),
    ("financial_data", _struct(("products", ArrayType(POSTING_FIN_PRODUCT)))),
)

# --- A2 finance operation ----------------------------------------------------
FINANCE_SERVICE = _strings("name", "type", "price", "amount", "sku")
FINANCE_OPERATION = _struct(
    ("operation_id", S), ("operation_date", S), ("date", S), ("operation_type", S),
    ("operation_type_name", S), ("amount", S), ("posting", _strings("posting_number")),
    ("posting_number", S), ("order_id", S), ("services", ArrayType(FINANCE_SERVICE)),
)
FINANCE_PAGE = _struct(("result", _struct(("operations", ArrayType(FINANCE_OPERATION)))))

# --- A3 campaign -------------------------------------------------------------
CAMPAIGN = _strings("id", "title", "state", "advObjectType", "PaymentType", "createdAt", "updatedAt")
CAMPAIGN_PAGE = _struct(("list", ArrayType(CAMPAIGN)))

# --- A4 campaign daily -------------------------------------------------------
DAILY_ROW = _strings("id", "title", "date", "views", "clicks", "moneySpent", "avgBid", "orders",
                     "ordersMoney")
DAILY_PAGE = _struct(("rows", ArrayType(DAILY_ROW)))

# --- A5 attribution row ------------------------------------------------------
ATTRIBUTION_ROW = _strings(
    "campaignId", "campaign_id", "id", "campaignTitle", "campaign_title", "title", "ordersSource",
    "date", "orderNumber", "orderNumberId", "order_id", "orderId", "sku", "skuId", "offerId",
    "offer_id", "name", "productName", "moneySpent", "bidValue", "spent", "expense", "cost",
    "price", "amount", "bid", "bidPercent", "quantity", "qty")
ATTRIBUTION_PAGE = _struct(("rows", ArrayType(ATTRIBUTION_ROW)), ("list", ArrayType(ATTRIBUTION_ROW)))

# --- target tables -----------------------------------------------------------
ORDERS = _struct(
    ("order_id", S), ("customer_id", S), ("order_date", TimestampNTZType()), ("status", S),
    ("revenue", MONEY), ("fees_total", MONEY), ("payout", MONEY), ("sales_report", MONEY),
    ("delivery_fee", MONEY), ("acquiring_fee", MONEY), ("ads_fee", MONEY),
    ("sale_commission", MONEY), ("discount", MONEY), ("other_fee", MONEY), ("profit", MONEY),
    ("campaign", S), ("campaign_id", S), ("campaign_title", S), ("ads_attributed", MONEY),
    ("is_first_order", BooleanType()), ("missing", BooleanType()), ("missing_at", TimestampNTZType()),
)
CUSTOMERS = _struct(("customer_id", S), ("first_order_date", DateType()), ("last_order_date", DateType()),
                    ("orders_count", LongType()), ("total_revenue", DecimalType(28, 4)))
PRODUCTS = _struct(("sku", LongType()), ("name", S), ("flavor", S), ("grams", IntegerType()))
ORDER_ITEMS = _struct(("order_id", S), ("sku", LongType()), ("quantity", MONEY), ("price", MONEY),
                      ("revenue", MONEY))
FEE_ITEMS = _struct(
    ("uid", S), ("order_id", S), ("ext_order_id", S), ("fee_group", S), ("fee_name", S),
    ("amount", MONEY), ("percent", MONEY), ("product_id", S), ("sku", LongType()),
    ("operation_type", S), ("occurred_at", TimestampNTZType()), ("source", S),
)
CAMPAIGNS = _struct(("campaign_id", S), ("title", S), ("state", S), ("adv_object_type", S),
                    ("payment_type", S), ("created_at", S), ("updated_at", S), ("raw", S))
CAMPAIGN_DAILY = _struct(("campaign_id", S), ("campaign_title", S), ("stat_date", DateType()),
                         ("impressions", LongType()), ("clicks", LongType()), ("spend", MONEY),
                         ("avg_bid", MONEY), ("orders_cnt", LongType()), ("orders_amount", MONEY))
ATTRIBUTION = _struct(
    ("row_key", S), ("campaign_id", S), ("campaign_title", S), ("order_id", S), ("ext_order_id", S),
    ("sku", LongType()), ("offer_id", S), ("product_name", S), ("stat_date", DateType()),
    ("price", MONEY), ("amount", MONEY), ("spent", MONEY), ("bid", MONEY), ("bid_percent", MONEY),
    ("qty", LongType()), ("source", S),
)
PERIOD_COSTS = _struct(("cost_date", DateType()), ("fee_group", S), ("fee_name", S),
                       ("amount", DecimalType(28, 4)))


# Partial aggregates that the batch plans keep, by key and part, so that a batch reads its own keys and parts only.
#: Of the orders of a month whose id begins with ``key`` (or is ``key``: exact), the newest.
ORDER_KEYS = _struct(("key", S), ("exact", BooleanType()), ("month", S), ("order_id", S), ("order_date", TimestampNTZType()))
#: A customer's orders of a month.
CUSTOMER_MONTHS = _struct(("customer_id", S), ("month", S), ("first_at", TimestampNTZType()), ("last_at", TimestampNTZType()),
                          ("orders_count", LongType()), ("total_revenue", DecimalType(28, 4)))
#: Sums over an order's fee rows in one partition of ``order_fee_items``.
ORDER_FEE_PARTS = _struct(("order_id", S), ("fee_part", S), ("_sales", DecimalType(28, 4)), ("_n_sales", LongType()), ("_fees", DecimalType(28, 4)),
                          ("_n_fees", LongType()), *[(f"_{c}", DecimalType(28, 4)) for c, _ in vocab.FEE_BUCKETS], ("_other_fee", DecimalType(28, 4)))

TABLES: dict[str, StructType] = {
    "orders": ORDERS, "customers": CUSTOMERS, "products": PRODUCTS, "order_items": ORDER_ITEMS, "order_fee_items": FEE_ITEMS,
    "campaigns": CAMPAIGNS, "campaign_daily": CAMPAIGN_DAILY, "order_attribution": ATTRIBUTION, "period_costs": PERIOD_COSTS,
    "order_keys": ORDER_KEYS, "customer_months": CUSTOMER_MONTHS, "order_fee_parts": ORDER_FEE_PARTS,
}

#: Columns that a table gained after its first version, with the version and the value of rows written before.
ADDED: dict[str, list[tuple[int, str, object]]] = {"orders": [(2, "missing", False)]}

# Declared keys, used by upserts and by the key-uniqueness check (Q01).
TABLE_KEYS: dict[str, list[str]] = {
    "customers": ["customer_id"],
    "orders": ["order_id"],
    "products": ["sku"],
    "order_fee_items": ["uid"],
    "campaigns": ["campaign_id"],
    "campaign_daily": ["campaign_id", "stat_date"],
    "period_costs": ["cost_date", "fee_group", "fee_name"],
}

# Declared references (Q02): child, column, parent, column.
REFERENCES: list[tuple[str, str, str, str]] = [
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "sku", "products", "sku"),
    ("order_fee_items", "order_id", "orders", "order_id"),
]
