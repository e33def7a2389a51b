"""Dashboard metrics.

The reference runs one SQL statement per metric and guards product-filter
fan-out with DISTINCT. Here a product filter is a ``left_semi`` join (no
fan-out to undo), and the five summary metrics come from ONE pass:
filtered orders -> per-customer partial sums -> one global row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUM_T = "decimal(38,4)"


@dataclass(frozen=True)
class OrderFilter:
    """F01 parameters. ``date_to`` is inclusive; ``first_order_only`` True keeps
    first orders, False repeat orders (a NULL flag passes neither)."""
    date_from: str | None = None
    date_to: str | None = None
    campaign: str | None = None
    first_order_only: bool | None = None
    flavor: str | None = None
    grams: int | None = None

    @property
    def needs_product_join(self) -> bool:
        return self.flavor is not None or self.grams is not None


def order_conditions(flt: OrderFilter) -> Column | None:
    conds = []
    d = F.col("order_date")
    if flt.date_from is not None:
        conds.append(d >= F.lit(flt.date_from).cast("timestamp_ntz"))
    if flt.date_to is not None:
        conds.append(d <= F.lit(flt.date_to).cast("timestamp_ntz"))
    if flt.campaign is not None:
        conds.append(F.col("campaign") == F.lit(flt.campaign))
    if flt.first_order_only is True:
        conds.append(F.col("is_first_order") == F.lit(True))
    elif flt.first_order_only is False:
        conds.append(F.col("is_first_order") == F.lit(False))
    out = None
    for c in conds:
        out = c if out is None else (out & c)
    return out


def product_conditions(flt: OrderFilter) -> Column | None:
    out = None
    if flt.flavor is not None:
        out = F.col("flavor") == F.lit(flt.flavor)
    if flt.grams is not None:
        c = F.col("grams") == F.lit(flt.grams)
        out = c if out is None else (out & c)
    return out


def orders_by_product(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Orders x items x products inner join (one row per matching item)."""
    it = items.select("order_id", "sku")
    pr = products.select("sku", "flavor", "grams")
    return orders.join(it, "order_id", "inner").join(pr, "sku", "inner")


def catalog_enrich(items: DataFrame, catalog: DataFrame) -> DataFrame:
    """Left lookup sku -> flavor, grams; a miss gives NULLs. The catalog is
    a dimension: AQE broadcasts it when its runtime size is under the
    broadcast threshold, and shuffles otherwise."""
    cat = catalog.select("sku", "flavor", "grams")
    return items.join(cat, "sku", "left")


def filter_orders(orders: DataFrame, flt: OrderFilter, items: DataFrame | None = None,
                  products: DataFrame | None = None) -> DataFrame:
    """F01 (+ J01 as a semi join): the distinct orders passing the filter.

    An order passes a product filter if at least one of its items' products
    matches all product conditions; the semi join returns each order once."""
    out = orders
    cond = order_conditions(flt)
    if cond is not None:
        out = out.filter(cond)
    if flt.needs_product_join:
        if items is None or products is None:
            raise ValueError("a flavor/grams filter needs items and products")
        matching = items.select("order_id", "sku").join(
            products.filter(product_conditions(flt)).select("sku"), "sku", "left_semi")
        # distinct first: an order with many matching items is one row on the
        # semi join's build side (AQE can split a skewed probe side, not this one)
        out = out.join(matching.select("order_id").distinct(), "order_id", "left_semi")
    return out


def distinct_orders(joined: DataFrame, cols=("order_id", "customer_id", "revenue")) -> DataFrame:
    """DISTINCT over the join fan-out."""
    return joined.select(*cols).dropDuplicates()


def _per_customer(filtered: DataFrame) -> DataFrame:
    return filtered.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.count("revenue").alias("n_rev"),
        F.sum("revenue").cast(SUM_T).alias("cust_revenue"),
    )


def summary(filtered: DataFrame) -> DataFrame:
    """A20 (= A13..A17 in one row) over the filtered distinct orders.

    total_orders: count of orders; total_customers: distinct non-NULL
    customers; total_revenue: sum (NULL -> 0); avg_order_value: mean revenue
    (NULL -> 0); avg_revenue_per_customer: mean over customer groups (the
    NULL customer is one group) of their revenue sum (NULL -> 0).
    """
    pc = _per_customer(filtered)
    tot = F.sum("cust_revenue")
    return pc.agg(
        F.coalesce(F.sum("n_orders"), F.lit(0)).cast("bigint").alias("total_orders"),
        F.count("customer_id").cast("bigint").alias("total_customers"),
        F.coalesce(tot.cast("double"), F.lit(0.0)).alias("total_revenue"),
        F.coalesce(tot.cast("double") / F.sum("n_rev"), F.lit(0.0)).alias("avg_order_value"),
        F.coalesce(tot.cast("double") / F.count("cust_revenue"), F.lit(0.0)).alias("avg_revenue_per_customer"),
    )


def total_orders(filtered: DataFrame) -> DataFrame:
    """A13."""
    return filtered.agg(F.count_distinct("order_id").cast("bigint").alias("total_orders"))


def total_customers(filtered: DataFrame) -> DataFrame:
    """Two-level (group, then count) distinct count."""
    return filtered.select("customer_id").filter(F.col("customer_id").isNotNull()) \
        .distinct().agg(F.count(F.lit(1)).cast("bigint").alias("total_customers"))


def total_revenue(filtered: DataFrame) -> DataFrame:
    """A15."""
    return filtered.agg(F.coalesce(F.sum("revenue").cast("double"), F.lit(0.0)).alias("total_revenue"))


def avg_order_value(filtered: DataFrame) -> DataFrame:
    """A16."""
    return filtered.agg(F.coalesce(F.sum("revenue").cast("double") / F.count("revenue"),
                                   F.lit(0.0)).alias("avg_order_value"))


def avg_revenue_per_customer(filtered: DataFrame) -> DataFrame:
    """Mean over customers of their revenue sum."""
    pc = _per_customer(filtered)
    return pc.agg(F.coalesce(F.sum("cust_revenue").cast("double") / F.count("cust_revenue"),
                             F.lit(0.0)).alias("avg_revenue_per_customer"))


def retention_distribution(filtered: DataFrame) -> DataFrame:
    """Number of customers by their number of orders, ascending."""
    pc = filtered.groupBy("customer_id").agg(F.count(F.lit(1)).alias("orders_count"))
    return pc.groupBy("orders_count").agg(F.count(F.lit(1)).alias("customers_count")) \
        .orderBy("orders_count")


def cohort_by_month(customers: DataFrame) -> DataFrame:
    """Cohorts by month of first order: customers, revenue, mean revenue."""
    c = customers.filter(F.col("first_order_date").isNotNull())
    return c.groupBy(F.trunc("first_order_date", "month").alias("cohort_month")).agg(
        F.count(F.lit(1)).cast("bigint").alias("customers_count"),
        F.sum("total_revenue").cast("double").alias("cohort_revenue"),
        (F.sum("total_revenue").cast("double") / F.count("total_revenue")).alias("avg_revenue_per_customer"),
    ).orderBy("cohort_month")


def spend_by_day(daily: DataFrame) -> DataFrame:
    """Ad spend per day, newest first."""
    return daily.groupBy("stat_date").agg(F.sum("spend").cast("double").alias("spend")) \
        .orderBy(F.col("stat_date").desc())


def weekly_trend(orders: DataFrame, date_col: str = "order_date", value: str = "revenue") -> DataFrame:
    """Weekly orders and value (weeks start Monday); trailing weeks whose
    value is 0 are dropped. The cut-off is a scalar subquery, not a join."""
    w = orders.filter(F.col(date_col).isNotNull()).groupBy(
        F.date_trunc("week", F.col(date_col)).cast("date").alias("week")).agg(
        F.count(F.lit(1)).cast("bigint").alias("orders"),
        F.coalesce(F.sum(value), F.lit(0)).cast("double").alias("value"))
    last = w.filter(F.col("value") != 0).select(F.max("week")).scalar()
    return w.filter(F.col("week") <= last).orderBy("week")


def sorted_report(df: DataFrame, *cols, descending: bool = False) -> DataFrame:
    """An ordered output."""
    return df.orderBy(*[F.col(c).desc() if descending else F.col(c).asc() for c in cols])
