"""Order-level derivations: revenue (A01), posting totals (A02), customer
aggregates (A03), first-order flags (A04) and missing-order marking (J07)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.money import MONEY, line_revenue, money_lenient, zero
from marketlens.operators.upsert import update_from


def posting_revenue(products="products") -> Column:
    """A01 (in-row): sum of price x quantity over a posting's products; 0 if none."""
    arr = F.coalesce(F.col(products) if isinstance(products, str) else products,
                     F.array().cast("array<struct<sku:string,name:string,quantity:string,price:string>>"))
    acc_t = "decimal(38,4)"
    return F.aggregate(arr, zero().cast(acc_t),
                       lambda acc, x: (acc + money_lenient(x["price"]) * money_lenient(x["quantity"])).cast(acc_t)
                       ).cast(MONEY)


def posting_totals(fin_products="financial_data.products") -> tuple[Column, Column]:
    """(payout total, commission total) over a posting's financial
    products; discounts are not part of the fee total."""
    arr = F.coalesce(F.col(fin_products), F.array().cast(
        "array<struct<product_id:string,commission_amount:string,commission_percent:string,"
        "payout:string,total_discount_value:string,total_discount_percent:string>>"))
    z = zero().cast("decimal(28,4)")
    payout = F.aggregate(arr, z, lambda acc, x: (acc + money_lenient(x["payout"])).cast("decimal(28,4)")).cast(MONEY)
    fees = F.aggregate(arr, z, lambda acc, x: (acc + money_lenient(x["commission_amount"])).cast("decimal(28,4)")).cast(MONEY)
    return payout, fees


def order_revenue(orders: DataFrame, items: DataFrame, price: str = "price",
                  quantity: str = "quantity") -> DataFrame:
    """A01 (set form): revenue = sum of item price x quantity; no items -> 0.

    Items are pre-aggregated per order (partial aggregation before the shuffle),
    then left-joined, so orders without items keep a 0 revenue."""
    sums = items.groupBy("order_id").agg(F.sum(line_revenue(price, quantity)).alias("_rev"))
    base = orders.drop("revenue") if "revenue" in orders.columns else orders
    j = base.join(sums, "order_id", "left")
    return j.withColumn("revenue", F.coalesce(F.col("_rev"), F.lit(0)).cast(MONEY)).drop("_rev")


def customer_aggregates(orders: DataFrame) -> DataFrame:
    """Per customer first/last order date, order count and revenue.
    All statuses count; rows without a customer are excluded."""
    return orders.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.min("order_date").cast("date").alias("first_order_date"),
        F.max("order_date").cast("date").alias("last_order_date"),
        F.count(F.lit(1)).alias("orders_count"),
        F.sum("revenue").cast("decimal(28,4)").alias("total_revenue"),
    )


def customer_months(orders: DataFrame, part: Column, customers: DataFrame | None = None) -> DataFrame:
    """Partial result of A03 and A04 for each ``part`` of the orders; with ``customers`` of these only."""
    own = orders.filter(F.col("customer_id").isNotNull()).withColumn("month", part)
    if customers is not None:
        own = own.join(customers.select("customer_id").distinct(), "customer_id", "left_semi")
    return own.groupBy("customer_id", "month").agg(
        F.min("order_date").alias("first_at"), F.max("order_date").alias("last_at"), F.count(F.lit(1)).alias("orders_count"),
        F.sum("revenue").cast("decimal(28,4)").alias("total_revenue"))


def merged_customers(parts: DataFrame) -> DataFrame:
    """A03 from its partial results, and each customer's first order time (A04) as ``first_at``. A part that an order
    left is a row fewer or a row anew, so an extreme that goes needs no rescan."""
    return parts.groupBy("customer_id").agg(
        F.min("first_at").alias("first_at"), F.max("last_at").cast("date").alias("last_order_date"),
        F.sum("orders_count").alias("orders_count"), F.sum("total_revenue").cast("decimal(28,4)").alias("total_revenue"),
    ).withColumn("first_order_date", F.col("first_at").cast("date"))


def flag_first_orders(orders: DataFrame, firsts: DataFrame) -> DataFrame:
    """A04 with the first order times ``(customer_id, first_at)`` given; orders of other customers, and of those without a
    dated order, keep their flag."""
    firsts = firsts.filter("customer_id is not null and first_at is not null").select("customer_id", F.col("first_at").alias("_first_date"))
    return update_from(orders, firsts, "customer_id", {"is_first_order": F.col("order_date") == F.col("_first_date")})


def first_order_flag(orders: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    """``is_first_order = (order_date = min(order_date) of the customer)``.

    Ties are all TRUE; a NULL date gives NULL; rows without a customer, or of
    a customer with no dated order, keep their old flag. The minimum is a
    partial aggregate joined back (not a window), so a customer holding a
    large share of all orders is not gathered into one task. With ``customers``
    (a ``customer_id`` column) only their orders are flagged.
    """
    if "is_first_order" not in orders.columns:
        orders = orders.withColumn("is_first_order", F.lit(None).cast("boolean"))
    own = orders if customers is None else orders.join(customers.select("customer_id"), "customer_id", "left_semi")
    firsts = own.filter(F.col("customer_id").isNotNull() & F.col("order_date").isNotNull()) \
        .groupBy("customer_id").agg(F.min("order_date").alias("_first_date"))
    return update_from(orders, firsts, "customer_id",
                       {"is_first_order": F.col("order_date") == F.col("_first_date")})


def mark_missing(orders: DataFrame, seen_ids: DataFrame, date_from, date_to, now, unseen: bool = True) -> DataFrame:
    """Seen ids -> missing = false, missing_at = NULL; unseen ids dated in
    ``[date_from, date_to)`` -> missing = true, missing_at = ``now``; other
    rows untouched. An empty ``seen_ids`` marks the whole window missing. With ``unseen=False`` seen ids are
    cleared and no others marked.
    """
    for c, t in (("missing", "boolean"), ("missing_at", "timestamp_ntz")):
        if c not in orders.columns:
            orders = orders.withColumn(c, F.lit(None).cast(t))
    seen = seen_ids.select(F.col(seen_ids.columns[0]).alias("order_id")).distinct() \
        .withColumn("_seen", F.lit(True))
    j = orders.join(seen, "order_id", "left")
    is_seen = F.col("_seen").isNotNull()
    d = F.col("order_date")
    in_window = (d >= _lit_ts(date_from)) & (d < _lit_ts(date_to)) if unseen else F.lit(False)
    missing = F.when(is_seen, F.lit(False)).when(in_window, F.lit(True)).otherwise(F.col("missing"))
    at = (F.when(is_seen, F.lit(None).cast("timestamp_ntz"))
          .when(in_window, _lit_ts(now)).otherwise(F.col("missing_at")))
    return j.select(*[missing.alias(c) if c == "missing" else at.alias(c) if c == "missing_at"
                      else F.col(c) for c in orders.columns])


def _lit_ts(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, _dt.datetime):
        return F.lit(v).cast("timestamp_ntz")
    return F.lit(str(v)).cast("timestamp_ntz")
