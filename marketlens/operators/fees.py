"""Per-order finance from fee rows (A05-A08) and unlinked period costs.

The reference recomputes sales, fee total, payout and the fee breakdown
with four statements; here all per-order sums come from ONE ``groupBy
(order_id)`` (partial aggregation before the shuffle), then one join back
to the orders table. Unmatched orders keep their old values (UPDATE ... FROM
semantics); the F04 predicate keeps SQL three-valued logic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens import vocab
from marketlens.functions.fees import not_double_counted
from marketlens.functions.money import MONEY
from marketlens.operators.upsert import update_from

BUCKET_GROUPS = [g for _, g in vocab.FEE_BUCKETS]
SUM_T = "decimal(28,4)"


def fee_union(*fee_frames: DataFrame) -> DataFrame:
    """Fee rows of all sources in one table (missing columns NULL)."""
    out = fee_frames[0]
    for f in fee_frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def order_fee_sums(fees: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Everything A05-A08 need, per order (or per ``by``), in one aggregation."""
    g = F.col("fee_group")
    amt = F.col("amount")
    counted = not_double_counted()  # NULL -> the row is not counted (WHERE semantics)
    is_sales = g == F.lit(vocab.FEE_GROUP_SALES)
    aggs = [
        F.sum(F.when(is_sales, amt)).alias("_sales"),
        F.count(F.when(is_sales, F.lit(1))).alias("_n_sales"),
        F.sum(F.when(counted, amt)).alias("_fees"),
        F.count(F.when(counted, F.lit(1))).alias("_n_fees"),
    ]
    for col_name, group in vocab.FEE_BUCKETS:
        aggs.append(F.sum(F.when(counted & (g == F.lit(group)), amt).when(counted, F.lit(0)))
                    .alias(f"_{col_name}"))
    aggs.append(F.sum(F.when(counted & ~g.isin(*BUCKET_GROUPS), amt).when(counted, F.lit(0)))
                .alias("_other_fee"))
    return fees.filter(F.col("order_id").isNotNull()).groupBy(*(by or ["order_id"])).agg(*aggs)


def order_fee_parts(fees: DataFrame, part: Column) -> DataFrame:
    """Partial result of ``order_fee_sums`` for each ``part`` of the fee rows."""
    return order_fee_sums(fees.withColumn("fee_part", part), ["order_id", "fee_part"])


def merged_fee_sums(parts: DataFrame) -> DataFrame:
    """``order_fee_sums`` from its partial results."""
    cols = [c for c in parts.columns if c.startswith("_") and c != "_part"]
    return parts.groupBy("order_id").agg(*[F.sum(c).alias(c) if c.startswith("_n_") else F.sum(c).cast(SUM_T).alias(c) for c in cols])


def _z(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0)).cast(MONEY)


def _ensure(orders: DataFrame, cols) -> DataFrame:
    for c in cols:
        if c not in orders.columns:
            orders = orders.withColumn(c, F.lit(None).cast(MONEY))
    return orders


def sales_report(orders: DataFrame, fees: DataFrame, sums: DataFrame | None = None) -> DataFrame:
    """sales_report = sum of 'sales' group amounts, for orders that have any."""
    sums = sums if sums is not None else order_fee_sums(fees)
    orders = _ensure(orders, ["sales_report"])
    return update_from(orders, sums.filter(F.col("_n_sales") > 0), "order_id",
                       {"sales_report": _z("_sales")})


def order_fees_total(orders: DataFrame, fees: DataFrame, sums: DataFrame | None = None) -> DataFrame:
    """fees_total = sum of counted amounts (after F04), for orders with any."""
    sums = sums if sums is not None else order_fee_sums(fees)
    orders = _ensure(orders, ["fees_total"])
    return update_from(orders, sums.filter(F.col("_n_fees") > 0), "order_id",
                       {"fees_total": _z("_fees")})


def order_payout(orders: DataFrame) -> DataFrame:
    """payout = coalesce(revenue, 0) + coalesce(fees_total, 0), every order."""
    orders = _ensure(orders, ["payout", "fees_total"])
    return orders.withColumn("payout", (F.coalesce(F.col("revenue"), F.lit(0))
                                        + F.coalesce(F.col("fees_total"), F.lit(0))).cast(MONEY))


def fee_breakdown(orders: DataFrame, fees: DataFrame, sums: DataFrame | None = None) -> DataFrame:
    """Bucketed fees, total and profit, for orders with counted fee rows.

    A NULL group counts in the total but in no bucket; groups outside the
    five named buckets (including 'sales') land in other_fee."""
    sums = sums if sums is not None else order_fee_sums(fees)
    cols = ["fees_total", "profit", "other_fee"] + [c for c, _ in vocab.FEE_BUCKETS]
    orders = _ensure(orders, cols)
    sets = {"fees_total": _z("_fees"), "other_fee": _z("_other_fee"),
            "profit": (F.coalesce(F.col("revenue"), F.lit(0)) + F.coalesce(F.col("_fees"), F.lit(0))).cast(MONEY)}
    for c, _ in vocab.FEE_BUCKETS:
        sets[c] = _z(f"_{c}")
    return update_from(orders, sums.filter(F.col("_n_fees") > 0), "order_id", sets)


def recalc_order_finance(orders: DataFrame, fees: DataFrame | None, breakdown: bool = True, sums: DataFrame | None = None) -> DataFrame:
    """A05 -> A06 -> A07 (-> A08) over one shared aggregation (of ``fees``, or ``sums`` as given) and one join."""
    sums = (order_fee_sums(fees) if sums is None else sums).withColumn("_matched_any", F.lit(True))
    cols = ["sales_report", "fees_total", "payout", "profit", "other_fee"] + [c for c, _ in vocab.FEE_BUCKETS]
    orders = _ensure(orders, cols)
    j = orders.join(sums, "order_id", "left")
    has_sales = F.coalesce(F.col("_n_sales"), F.lit(0)) > 0
    has_fees = F.coalesce(F.col("_n_fees"), F.lit(0)) > 0
    fees_total = F.when(has_fees, _z("_fees")).otherwise(F.col("fees_total"))
    sets = {
        "sales_report": F.when(has_sales, _z("_sales")).otherwise(F.col("sales_report")),
        "fees_total": fees_total,
        "payout": (F.coalesce(F.col("revenue"), F.lit(0)) + F.coalesce(fees_total, F.lit(0))).cast(MONEY),
    }
    if breakdown:
        sets["other_fee"] = F.when(has_fees, _z("_other_fee")).otherwise(F.col("other_fee"))
        sets["profit"] = F.when(has_fees, (F.coalesce(F.col("revenue"), F.lit(0))
                                           + F.coalesce(F.col("_fees"), F.lit(0))).cast(MONEY)
                                ).otherwise(F.col("profit"))
        for c, _ in vocab.FEE_BUCKETS:
            sets[c] = F.when(has_fees, _z(f"_{c}")).otherwise(F.col(c))
    return j.select(*[sets[c].alias(c) if c in sets else F.col(c) for c in orders.columns])


def unlinked_costs(fees: DataFrame, date_from, date_to) -> DataFrame:
    """finance-api rows with no order, dated in ``[date_from, date_to)``."""
    ts = F.col("occurred_at")
    return fees.filter((F.col("source") == F.lit(vocab.SOURCE_FINANCE_API))
                       & F.col("order_id").isNull() & ts.isNotNull()
                       & (ts >= F.lit(str(date_from)).cast("timestamp_ntz"))
                       & (ts < F.lit(str(date_to)).cast("timestamp_ntz")))


def period_costs(fees: DataFrame, date_from, date_to) -> DataFrame:
    """Unlinked costs summed by day x group x name."""
    return unlinked_costs(fees, date_from, date_to).groupBy(
        F.to_date("occurred_at").alias("cost_date"), "fee_group", "fee_name"
    ).agg(F.sum("amount").cast(SUM_T).alias("amount"))


def replace_range_period_costs(old: DataFrame, new: DataFrame, date_from, date_to) -> DataFrame:
    """Delete old rows dated in ``[date_from, date_to)`` or undated, then
    insert the recomputed aggregates."""
    d = F.col("cost_date")
    in_range = (d >= F.lit(str(date_from)).cast("date")) & (d < F.lit(str(date_to)).cast("date"))
    kept = old.filter(~F.coalesce(in_range | d.isNull(), F.lit(False)))
    return kept.unionByName(new.select(*old.columns))
