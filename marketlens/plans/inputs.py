"""Domain tables built from the test tables with this package's operators.

``Inputs(spark, sf_dir)`` gives the orders table, items, products, fee rows,
attribution rows and daily statistics that the registered queries run on.
Each method returns a fresh DataFrame (plans, not materialized data).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions.money import MONEY
from marketlens.operators import fees as fees_ops
from marketlens.operators import attribution, flatten, resolve, upsert
from marketlens.operators import orders as ops_orders
from marketlens.sources import testdata as td


@dataclass
class Inputs:
    spark: SparkSession
    sf_dir: str

    def items(self) -> DataFrame:
        return td.items(self.spark, self.sf_dir)

    def order_items(self) -> DataFrame:
        """order_items table: order_id, sku, quantity, price, revenue."""
        it = self.items()
        return it.select("order_id", "sku", F.col("quantity").cast(MONEY).alias("quantity"),
                         F.col("price").cast(MONEY).alias("price"),
                         (F.col("price") * F.col("quantity")).cast(MONEY).alias("revenue"))

    def orders_landed(self) -> DataFrame:
        return td.orders_landed(self.spark, self.sf_dir)

    def orders(self) -> DataFrame:
        """orders table: landed rows + revenue (A01) + first-order flag."""
        o = ops_orders.order_revenue(self.orders_landed(), self.items())
        return ops_orders.first_order_flag(o)

    def products(self) -> DataFrame:
        return td.products(self.spark, self.sf_dir)

    def customers(self) -> DataFrame:
        return ops_orders.customer_aggregates(self.orders())

    # --- fees ------------------------------------------------------------------

    def postings(self) -> DataFrame:
        return td.postings(self.spark, self.sf_dir)

    def finance_operations(self, whole: bool = False) -> DataFrame:
        return td.finance_operations(self.spark, self.sf_dir, whole)

    def finance_resolved(self, out_key: str | None = None, whole: bool = False) -> DataFrame:
        """P20 service rows resolved to orders (J05) against the landed orders."""
        svc = flatten.finance_service_rows(self.finance_operations(whole))
        # of the parts of a uid those that are never blank, so that equal uids have equal keys
        content = F.xxhash64("op_date", "operation_type", "fee_name")
        return resolve.resolve_order_id(svc, self.orders_landed(), "cand", out_key=out_key, spread=content if out_key else None)

    def finance_fees(self, whole: bool = False) -> DataFrame:
        """finance_api fee rows, upserted by uid (U06: last arrival wins). The uid covers the candidate (as the order or the
        external id), so versions of a row meet where the join on the candidate has put them, and no second shuffle moves them."""
        rows = flatten.finance_fee_rows(self.finance_resolved(out_key="_key", whole=whole))
        rows = rows.withColumn("_ord", F.struct("_ordinal", "pos")).drop("_ordinal", "pos")
        return upsert.last_write_wins(rows, ["_key", "uid"], "_ord").drop("_key")

    def posting_fees(self) -> DataFrame:
        return flatten.flatten_posting_fees(self.postings())

    def accrual_fees(self) -> DataFrame:
        return flatten.flatten_accruals(td.accrual_rows(self.spark, self.sf_dir, whole=True))

    def fees(self) -> DataFrame:
        """order_fee_items: the three sources (U00), with NULL group / source
        injected on sku residues so three-valued logic is exercised. Finance and accrual rows come from one shuffle of the lines."""
        u = fees_ops.fee_union(self.posting_fees(), self.finance_fees(whole=True), self.accrual_fees())
        sku = F.col("sku")
        return u.withColumn("fee_group", F.when(F.coalesce(sku % 89, F.lit(1)) != 0, F.col("fee_group"))) \
                .withColumn("source", F.when(F.coalesce(sku % 83, F.lit(1)) != 0, F.col("source")))

    # --- ads -----------------------------------------------------------------------

    def attribution_raw(self) -> DataFrame:
        return td.attribution_rows(self.spark, self.sf_dir)

    def attribution(self, keyed: bool = False) -> DataFrame:
        """order_attribution: P23 rows resolved by prefix (J04), insert-ignore by
        content key (U10) into an empty table."""
        return attribution.resolved_rows(flatten.attribution_fields(self.attribution_raw()), self.orders_landed(), keyed=keyed)

    def daily(self) -> DataFrame:
        return flatten.flatten_campaign_daily(td.daily_rows(self.spark, self.sf_dir))

    def campaigns_raw(self) -> DataFrame:
        return td.campaign_rows(self.spark, self.sf_dir)
