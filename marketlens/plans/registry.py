"""Registered queries: one per operator of the inventory.

Each entry takes ``(spark, sf_dir)``, builds the domain inputs from the test
tables with ``Inputs`` and returns the operator's output as a DataFrame
(money as DOUBLE, counts as BIGINT, so results compare across engines).
``oracle/queries.py`` holds the matching SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens.operators import metrics as mx
from marketlens.plans.inputs import Inputs

from marketlens.plans.qbase import QUERIES, dbl, query  # noqa: F401

# Parameters of the filtered metric variants (the filters are the feature).
FILTERED = mx.OrderFilter(date_from="1996-01-01", date_to="1999-12-31", first_order_only=False,
                          flavor="MEDIUM")
CAMPAIGN_FILTER = mx.OrderFilter(campaign="1-URGENT", first_order_only=True, grams=25)


# --- metrics -------------------------------------------------------------------

@query("summary")
def q_summary(spark, d):
    inp = Inputs(spark, d)
    return mx.summary(inp.orders())


@query("summary_filtered")
def q_summary_filtered(spark, d):
    inp = Inputs(spark, d)
    f = mx.filter_orders(inp.orders(), FILTERED, inp.items(), inp.products())
    return mx.summary(f)


@query("orders_filter")
def q_orders_filter(spark, d):
    inp = Inputs(spark, d)
    f = mx.filter_orders(inp.orders(), CAMPAIGN_FILTER, inp.items(), inp.products())
    return f.select("order_id", "customer_id", dbl("revenue"))


@query("total_orders")
def q_total_orders_all(spark, d):
    return mx.total_orders(Inputs(spark, d).orders())


@query("total_orders_filtered")
def q_total_orders(spark, d):
    inp = Inputs(spark, d)
    return mx.total_orders(mx.filter_orders(inp.orders(), FILTERED, inp.items(), inp.products()))


@query("total_customers")
def q_total_customers_all(spark, d):
    return mx.total_customers(Inputs(spark, d).orders())


@query("total_customers_filtered")
def q_total_customers(spark, d):
    inp = Inputs(spark, d)
    return mx.total_customers(mx.filter_orders(inp.orders(), FILTERED, inp.items(), inp.products()))


@query("total_revenue")
def q_total_revenue_all(spark, d):
    return mx.total_revenue(Inputs(spark, d).orders())


@query("total_revenue_filtered")
def q_total_revenue(spark, d):
    inp = Inputs(spark, d)
    return mx.total_revenue(mx.filter_orders(inp.orders(), FILTERED, inp.items(), inp.products()))


@query("avg_order_value")
def q_avg_order_value_all(spark, d):
    return mx.avg_order_value(Inputs(spark, d).orders())


@query("avg_order_value_filtered")
def q_avg_order_value(spark, d):
    inp = Inputs(spark, d)
    return mx.avg_order_value(mx.filter_orders(inp.orders(), FILTERED, inp.items(), inp.products()))


@query("avg_revenue_per_customer")
def q_avg_revenue_per_customer_all(spark, d):
    return mx.avg_revenue_per_customer(Inputs(spark, d).orders())


@query("avg_revenue_per_customer_filtered")
def q_avg_revenue_per_customer(spark, d):
    inp = Inputs(spark, d)
    return mx.avg_revenue_per_customer(mx.filter_orders(inp.orders(), FILTERED, inp.items(), inp.products()))


@query("retention_distribution")
def q_retention(spark, d):
    inp = Inputs(spark, d)
    return mx.retention_distribution(inp.orders())


@query("retention_distribution_filtered")
def q_retention_filtered(spark, d):
    inp = Inputs(spark, d)
    flt = mx.OrderFilter(date_from=FILTERED.date_from, date_to=FILTERED.date_to, flavor=FILTERED.flavor)
    return mx.retention_distribution(mx.filter_orders(inp.orders(), flt, inp.items(), inp.products()))


@query("cohort_by_month")
def q_cohort(spark, d):
    return mx.cohort_by_month(Inputs(spark, d).customers())


@query("orders_by_product")
def q_orders_by_product(spark, d):
    inp = Inputs(spark, d)
    j = mx.orders_by_product(inp.orders(), inp.items(), inp.products())
    return j.select("order_id", "sku", "flavor", "grams", dbl("revenue"))


@query("orders_by_product_filtered")
def q_orders_by_product_filtered(spark, d):
    return q_orders_by_product(spark, d).filter(F.col("flavor") == "MEDIUM")


@query("distinct_orders")
def q_distinct_orders(spark, d):
    inp = Inputs(spark, d)
    j = mx.orders_by_product(inp.orders(), inp.items(), inp.products())
    return mx.distinct_orders(j).select("order_id", "customer_id", dbl("revenue"))


@query("distinct_orders_filtered")
def q_distinct_orders_filtered(spark, d):
    inp = Inputs(spark, d)
    j = mx.orders_by_product(inp.orders(), inp.items(), inp.products()).filter(F.col("grams") <= 10)
    return mx.distinct_orders(j).select("order_id", "customer_id", dbl("revenue"))


@query("catalog_enrich")
def q_catalog_enrich(spark, d):
    inp = Inputs(spark, d)
    it = inp.order_items()
    return mx.catalog_enrich(it, inp.products()).select("order_id", "sku", "flavor", "grams", dbl("revenue"))


@query("weekly_trend")
def q_weekly(spark, d):
    return mx.weekly_trend(Inputs(spark, d).orders())


@query("sorted_report")
def q_sorted(spark, d):
    return mx.sorted_report(Inputs(spark, d).customers().select(
        "customer_id", "orders_count", dbl("total_revenue")), "orders_count", "customer_id")


# --- order derivations ----------------------------------------------------------

@query("order_revenue")
def q_order_revenue(spark, d):
    return Inputs(spark, d).orders().select("order_id", dbl("revenue"))


@query("customer_aggregates")
def q_customer_aggregates(spark, d):
    c = Inputs(spark, d).customers()
    return c.select("customer_id", "first_order_date", "last_order_date", "orders_count",
                    dbl("total_revenue"))


@query("first_order_flag")
def q_first_order_flag(spark, d):
    return Inputs(spark, d).orders().select("order_id", "customer_id", "order_date", "is_first_order")


# Queries of the other domains register themselves on import.
from marketlens.plans import q_ads, q_batch, q_fees, q_functions, q_sources, q_streams  # noqa: E402,F401
