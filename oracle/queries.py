"""DuckDB oracle SQL for the registered queries.

Stated from the operator definitions in plain SQL; the money of an order, for
one, is a sum by (order, bucket) that is then laid out in columns, written once
(``order_money``) and used by every query that needs it.
"""

from __future__ import annotations

from oracle.fixtures import ACQUIRING, ADS, COMMISSION, DELIVERY, DISCOUNT, SALES, normalize_sql, with_fixtures

SQL: dict[str, str] = {}

D = "DOUBLE"


def sql(name: str, body: str, *fixtures: str) -> None:
    SQL[name] = with_fixtures(body, *fixtures)


# Filter of the *_filtered metric variants (see marketlens.plans.registry.FILTERED).
FILTERED_WHERE = """o.order_date >= TIMESTAMP '1996-01-01' AND o.order_date <= TIMESTAMP '1999-12-31'
  AND o.is_first_order = FALSE AND p.flavor = 'MEDIUM'"""
FILTERED_CTE = f"""filtered AS (
  SELECT DISTINCT o.order_id, o.customer_id, o.revenue
  FROM fx_orders o JOIN fx_items oi ON oi.order_id = o.order_id JOIN fx_products p ON p.sku = oi.sku
  WHERE {FILTERED_WHERE})"""
FILTERED_FX = ("fx_orders", "fx_items", "fx_products")

SUMMARY_SELECT = f"""
SELECT CAST(COUNT(DISTINCT order_id) AS BIGINT) AS total_orders,
       CAST(COUNT(DISTINCT customer_id) AS BIGINT) AS total_customers,
       COALESCE(CAST(SUM(revenue) AS {D}), 0.0) AS total_revenue,
       COALESCE(CAST(SUM(revenue) AS {D}) / COUNT(revenue), 0.0) AS avg_order_value,
       (SELECT COALESCE(CAST(SUM(t) AS {D}) / COUNT(t), 0.0)
          FROM (SELECT SUM(revenue) AS t FROM filtered GROUP BY customer_id)) AS avg_revenue_per_customer
FROM filtered"""

sql("summary", "WITH filtered AS (SELECT order_id, customer_id, revenue FROM fx_orders)" + SUMMARY_SELECT,
    "fx_orders")
sql("summary_filtered", f"WITH {FILTERED_CTE}" + SUMMARY_SELECT, *FILTERED_FX)

sql("orders_filter", f"""
SELECT DISTINCT o.order_id, o.customer_id, CAST(o.revenue AS {D}) AS revenue
FROM fx_orders o JOIN fx_items oi ON oi.order_id = o.order_id JOIN fx_products p ON p.sku = oi.sku
WHERE o.campaign = '1-URGENT' AND o.is_first_order = TRUE AND p.grams = 25""", *FILTERED_FX)

#: The single metrics as expressions over (order_id, customer_id, revenue).
METRICS = {
    "total_orders": "CAST(COUNT(DISTINCT order_id) AS BIGINT)",
    "total_customers": "CAST(COUNT(DISTINCT customer_id) AS BIGINT)",
    "total_revenue": f"COALESCE(CAST(SUM(revenue) AS {D}), 0.0)",
    "avg_order_value": f"COALESCE(CAST(SUM(revenue) AS {D}) / COUNT(revenue), 0.0)",
    # orders without a customer are one customer more
    "avg_revenue_per_customer": f"COALESCE(CAST(SUM(revenue) AS {D}) / COUNT(DISTINCT COALESCE(customer_id, '')), 0.0)",
}
for _name, _expr in METRICS.items():
    sql(_name, f"SELECT {_expr} AS {_name} FROM fx_orders", "fx_orders")
    sql(f"{_name}_filtered", f"WITH {FILTERED_CTE} SELECT {_expr} AS {_name} FROM filtered", *FILTERED_FX)

# Customers by how many orders each has; orders without a customer count as one customer.
RETENTION = """
numbered AS (SELECT COALESCE(customer_id, '') AS who, COUNT(*) OVER (PARTITION BY customer_id) AS orders_count FROM filtered)
SELECT orders_count, COUNT(DISTINCT who) AS customers_count FROM numbered GROUP BY ALL ORDER BY ALL"""
sql("retention_distribution", "WITH filtered AS (SELECT DISTINCT order_id, customer_id FROM fx_orders o)," + RETENTION,
    "fx_orders")
sql("retention_distribution_filtered", f"""WITH filtered AS (
  SELECT DISTINCT o.order_id, o.customer_id
  FROM fx_orders o JOIN fx_items oi ON oi.order_id = o.order_id JOIN fx_products p ON p.sku = oi.sku
  WHERE o.order_date >= TIMESTAMP '1996-01-01' AND o.order_date <= TIMESTAMP '1999-12-31' AND p.flavor = 'MEDIUM'),"""
    + RETENTION, *FILTERED_FX)

sql("cohort_by_month", f"""
SELECT CAST(make_date(year(first_order_date), month(first_order_date), 1) AS DATE) AS cohort_month, CAST(COUNT(*) AS BIGINT) AS customers_count,
       CAST(SUM(total_revenue) AS {D}) AS cohort_revenue, CAST(SUM(total_revenue) AS {D}) / COUNT(total_revenue) AS avg_revenue_per_customer
FROM fx_customers WHERE first_order_date IS NOT NULL GROUP BY ALL""", "fx_customers")

PRODUCT_JOIN = "fx_orders o JOIN fx_items oi ON oi.order_id = o.order_id JOIN fx_products p ON p.sku = oi.sku"
for _name, _where in (("orders_by_product", ""), ("orders_by_product_filtered", "WHERE p.flavor = 'MEDIUM'")):
    sql(_name, f"SELECT o.order_id, oi.sku, p.flavor, p.grams, CAST(o.revenue AS {D}) AS revenue FROM {PRODUCT_JOIN} {_where}", *FILTERED_FX)
for _name, _where in (("distinct_orders", ""), ("distinct_orders_filtered", "WHERE p.grams <= 10")):
    sql(_name, f"SELECT DISTINCT o.order_id, o.customer_id, CAST(o.revenue AS {D}) AS revenue FROM {PRODUCT_JOIN} {_where}", *FILTERED_FX)

sql("catalog_enrich", f"""
SELECT i.order_id, i.sku, p.flavor, p.grams, CAST(CAST(i.price * i.quantity AS DECIMAL(18,4)) AS {D}) AS revenue
FROM fx_items i LEFT JOIN fx_products p ON p.sku = i.sku""", "fx_items", "fx_products")

sql("weekly_trend", f"""
WITH w AS (
  SELECT CAST(DATE_TRUNC('week', order_date) AS DATE) AS week, CAST(COUNT(*) AS BIGINT) AS orders,
         CAST(COALESCE(SUM(revenue), 0) AS {D}) AS value
  FROM fx_orders WHERE order_date IS NOT NULL GROUP BY 1)
SELECT * FROM w WHERE week <= (SELECT MAX(week) FROM w WHERE value <> 0) ORDER BY week""", "fx_orders")

sql("sorted_report", f"""
SELECT customer_id, orders_count, CAST(total_revenue AS {D}) AS total_revenue
FROM fx_customers ORDER BY orders_count, customer_id""", "fx_customers")

sql("order_revenue", f"SELECT order_id, CAST(revenue AS {D}) AS revenue FROM fx_orders", "fx_orders")

sql("customer_aggregates", f"""
SELECT customer_id, first_order_date, last_order_date, CAST(orders_count AS BIGINT) AS orders_count,
       CAST(total_revenue AS {D}) AS total_revenue FROM fx_customers""", "fx_customers")

sql("first_order_flag", "SELECT order_id, customer_id, order_date, is_first_order FROM fx_orders", "fx_orders")


# --- fees ------------------------------------------------------------------------
FEE_SEL = f"""uid, order_id, ext_order_id, fee_group, fee_name, CAST(amount AS {D}) AS amount,
  CAST(percent AS {D}) AS percent, product_id, sku, operation_type, occurred_at, source"""

sql("flatten_posting_fees", f"SELECT {FEE_SEL} FROM fx_posting_fees", "fx_posting_fees")
sql("flatten_finance_services", f"SELECT {FEE_SEL} FROM fx_fin_rows", "fx_fin_rows")
sql("resolve_order_id", "SELECT cand, order_id, ext_order_id FROM fx_fin_resolved", "fx_fin_resolved")
sql("resolve_exact", """
SELECT c.cand, e.cand IS NOT NULL AS "exists" FROM fx_fin_cands c LEFT JOIN fx_fin_exact e ON e.cand = c.cand""",
    "fx_fin_cands", "fx_fin_exact")
sql("latest_per_key", """
SELECT customer_id, order_id AS latest_order_id FROM (
  SELECT customer_id, order_id, ROW_NUMBER() OVER (PARTITION BY customer_id
         ORDER BY order_date DESC NULLS FIRST, order_id DESC) AS rn
  FROM fx_orders_landed WHERE customer_id IS NOT NULL) t WHERE rn = 1""", "fx_orders_landed")
sql("last_write_wins", f"SELECT {FEE_SEL} FROM fx_fin_fees", "fx_fin_fees")
sql("fee_union", f"SELECT {FEE_SEL} FROM fx_fees", "fx_fees")
sql("fee_dedup_filter", f"""
SELECT order_id, fee_group, source, CAST(amount AS {D}) AS amount FROM fx_fees
WHERE NOT (source = 'finance_api' AND fee_group = 'Вознаграждение Ozon')""", "fx_fees")

F04 = f"NOT (source = 'finance_api' AND fee_group = '{COMMISSION}')"
BUCKETS = {DELIVERY: "delivery_fee", ACQUIRING: "acquiring_fee", ADS: "ads_fee", COMMISSION: "sale_commission", DISCOUNT: "discount"}
MONEY_COLS = [*BUCKETS.values(), "other_fee"]


def order_money(fees: str) -> str:
    """One row per order with counted fee rows: ``fees`` and a column for each bucket. Rows are
    labelled with their bucket and summed by (order, bucket); then each order's sums are laid out.
    A row without a group is in ``fees`` but in no bucket."""
    label = " ".join(f"WHEN '{g}' THEN '{c}'" for g, c in BUCKETS.items())
    wide = ", ".join(f"COALESCE(SUM(part) FILTER (bucket = '{c}'), 0) AS {c}" for c in MONEY_COLS)
    return f"""SELECT order_id, SUM(part) AS fees, {wide} FROM (
    SELECT order_id, IF(fee_group IS NULL, 'none', CASE fee_group {label} ELSE 'other_fee' END) AS bucket, SUM(amount) AS part
    FROM {fees} WHERE order_id IS NOT NULL AND {F04} GROUP BY ALL) GROUP BY order_id"""


def order_sales(fees: str) -> str:
    """One row per order with sales rows."""
    return f"SELECT order_id, SUM(amount) AS sales FROM {fees} WHERE fee_group = '{SALES}' AND order_id IS NOT NULL GROUP BY order_id"


# Orders without such rows keep NULL (their old value): the outer join leaves it.
sql("sales_report", f"""SELECT order_id, CAST(sales AS {D}) AS sales_report
FROM fx_orders LEFT JOIN ({order_sales('fx_fees')}) USING (order_id)""", "fx_orders", "fx_fees")
sql("order_fees_total", f"""SELECT order_id, CAST(fees AS {D}) AS fees_total
FROM fx_orders LEFT JOIN ({order_money('fx_fees')}) USING (order_id)""", "fx_orders", "fx_fees")
sql("order_payout", f"""
SELECT order_id, CAST(sales AS {D}) AS sales_report, CAST(fees AS {D}) AS fees_total, CAST(revenue + COALESCE(fees, 0) AS {D}) AS payout
FROM fx_orders LEFT JOIN ({order_sales('fx_fees')}) USING (order_id) LEFT JOIN ({order_money('fx_fees')}) USING (order_id)""",
    "fx_orders", "fx_fees")
sql("fee_breakdown", f"""
SELECT order_id, CAST(revenue AS {D}) AS revenue, CAST(fees AS {D}) AS fees_total, CAST(revenue + fees AS {D}) AS profit,
       {', '.join(f'CAST({c} AS {D}) AS {c}' for c in MONEY_COLS)}
FROM fx_orders LEFT JOIN ({order_money('fx_fees')}) USING (order_id)""", "fx_orders", "fx_fees")

UNLINKED = """source = 'finance_api' AND order_id IS NULL AND occurred_at IS NOT NULL
  AND occurred_at >= TIMESTAMP '{lo}' AND occurred_at < TIMESTAMP '{hi}'"""
sql("unlinked_costs_filter", f"""
SELECT uid, fee_group, fee_name, occurred_at, CAST(amount AS {D}) AS amount FROM fx_fees
WHERE {UNLINKED.format(lo='1995-01-01', hi='2002-01-01')}""", "fx_fees")
sql("period_costs", f"""
SELECT CAST(occurred_at AS DATE) AS cost_date, fee_group, fee_name, CAST(SUM(amount) AS {D}) AS amount
FROM fx_fees WHERE {UNLINKED.format(lo='1995-01-01', hi='2002-01-01')} GROUP BY 1, 2, 3""", "fx_fees")
sql("replace_range_period_costs", f"""
WITH old AS (
  SELECT CAST(occurred_at AS DATE) AS cost_date, fee_group, fee_name, SUM(amount) AS amount
  FROM fx_fees WHERE {UNLINKED.format(lo='1995-01-01', hi='2002-01-01')} GROUP BY 1, 2, 3),
new AS (
  SELECT CAST(occurred_at AS DATE) AS cost_date, fee_group, fee_name, SUM(amount * 2) AS amount
  FROM fx_fees WHERE {UNLINKED.format(lo='1998-01-01', hi='1999-01-01')} GROUP BY 1, 2, 3)
SELECT cost_date, fee_group, fee_name, CAST(amount AS {D}) AS amount FROM old
WHERE NOT ((cost_date >= DATE '1998-01-01' AND cost_date < DATE '1999-01-01') OR cost_date IS NULL)
UNION ALL
SELECT cost_date, fee_group, fee_name, CAST(amount AS {D}) FROM new""", "fx_fees")

sql("upsert_fees_by_uid", f"""
WITH old AS (SELECT * FROM fx_fin_fees WHERE occurred_at < TIMESTAMP '2000-01-01'),
new AS (
  SELECT uid, order_id, ext_order_id, fee_group, fee_name, amount - 1 AS amount, percent, product_id, sku,
         operation_type, occurred_at, source FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY uid ORDER BY o_orderkey DESC, l_linenumber DESC, line_sku DESC,
           l_suppkey DESC, quantity DESC, price DESC, disc DESC, tax DESC, l_shipdate DESC) AS rn
    FROM fx_fin_rows WHERE occurred_at >= TIMESTAMP '1999-07-01') t WHERE rn = 1)
SELECT {FEE_SEL} FROM old ANTI JOIN new USING (uid)
UNION ALL SELECT {FEE_SEL} FROM new""", "fx_fin_fees", "fx_fin_rows")

sql("replace_source_accruals", f"""
SELECT {FEE_SEL} FROM fx_fees WHERE NOT COALESCE(source = 'finance_report', FALSE)
UNION ALL
SELECT uid, order_id, ext_order_id, fee_group, fee_name, CAST(amount * 2 AS {D}), CAST(percent AS {D}), product_id,
       sku, operation_type, occurred_at, source FROM fx_accrual_fees""", "fx_fees", "fx_accrual_fees")

sql("replace_fees_by_order_source", f"""
WITH scope AS (SELECT order_id FROM fx_orders_landed WHERE order_date >= TIMESTAMP '1999-01-01')
SELECT {FEE_SEL} FROM fx_fees f
WHERE NOT (COALESCE(f.source = 'posting_financial', FALSE) AND f.order_id IN (SELECT order_id FROM scope))
UNION ALL
SELECT uid, order_id, ext_order_id, fee_group, fee_name, CAST(amount + 1 AS {D}), CAST(percent AS {D}), product_id,
       sku, operation_type, occurred_at, source
FROM fx_posting_fees WHERE order_id IN (SELECT order_id FROM scope)""",
    "fx_fees", "fx_posting_fees", "fx_orders_landed")

sql("dq_primary_key", "SELECT uid, CAST(COUNT(*) AS BIGINT) AS n FROM fx_fin_rows WHERE uid IS NOT NULL GROUP BY uid HAVING COUNT(*) > 1",
    "fx_fin_rows")
sql("dq_primary_keys_all", f"""
WITH k AS (
  SELECT 'customers' AS table_name, customer_id AS key FROM fx_customers
  UNION ALL SELECT 'orders', order_id FROM fx_orders
  UNION ALL SELECT 'products', CAST(sku AS VARCHAR) FROM fx_products
  UNION ALL SELECT 'order_fee_items', uid FROM fx_fin_rows
  UNION ALL SELECT 'campaigns', 'c' || CAST(s_suppkey % 10 AS VARCHAR) FROM supplier
  UNION ALL SELECT 'campaign_daily', campaign_id || '|' || CAST(stat_date AS VARCHAR) FROM fx_daily)
SELECT table_name, key, CAST(COUNT(*) AS BIGINT) AS n FROM k WHERE key IS NOT NULL GROUP BY ALL HAVING COUNT(*) > 1""",
    "fx_customers", "fx_orders", "fx_products", "fx_fin_rows", "fx_daily")
sql("dq_foreign_keys_all", """
WITH o AS (SELECT * FROM fx_orders WHERE order_date < TIMESTAMP '2000-01-01'),
p AS (SELECT sku FROM fx_products WHERE grams <= 25),
lost AS (
  SELECT 'orders' AS child, 'customer_id' AS "column", customer_id AS value FROM o
    ANTI JOIN (SELECT customer_id FROM o WHERE order_date < TIMESTAMP '1999-01-01') USING (customer_id) WHERE customer_id IS NOT NULL
  UNION ALL SELECT 'order_items', 'order_id', order_id FROM fx_items ANTI JOIN o USING (order_id)
  UNION ALL SELECT 'order_items', 'sku', CAST(sku AS VARCHAR) FROM fx_items ANTI JOIN p USING (sku)
  UNION ALL SELECT 'order_fee_items', 'order_id', order_id FROM fx_posting_fees ANTI JOIN o USING (order_id))
SELECT child, "column", value, CAST(COUNT(*) AS BIGINT) AS n FROM lost GROUP BY ALL""",
    "fx_orders", "fx_products", "fx_items", "fx_posting_fees")
sql("dq_counts_by_source", "SELECT source, CAST(COUNT(*) AS BIGINT) AS n FROM fx_fees GROUP BY source", "fx_fees")
sql("conform_schema", f"""
SELECT CAST(NULL AS VARCHAR) AS uid, order_id, CAST(NULL AS VARCHAR) AS ext_order_id, fee_group, fee_name,
       CAST(amount AS {D}) AS amount, CAST(NULL AS {D}) AS percent, CAST(NULL AS VARCHAR) AS product_id,
       CAST(NULL AS BIGINT) AS sku, CAST(NULL AS VARCHAR) AS operation_type, CAST(NULL AS TIMESTAMP) AS occurred_at,
       'posting_financial' AS source FROM fx_posting_fees""", "fx_posting_fees")
sql("drop_keyless_rows", f"""
SELECT cand, {normalize_sql('name')} AS fee_name,
       CAST(amount AS {D}) AS amount FROM fx_fin_raw WHERE cand IS NOT NULL AND cand <> ''""", "fx_fin_raw")
sql("backfill_window_counts", """
WITH x AS (SELECT CAST(FLOOR(datediff('day', DATE '1995-01-01', CAST(occurred_at AS DATE)) / 10) AS BIGINT) AS window_no
           FROM fx_fees WHERE source = 'finance_api' AND CAST(occurred_at AS DATE) >= DATE '1995-01-01'
             AND CAST(occurred_at AS DATE) < DATE '2002-01-01')
SELECT window_no, CAST(DATE '1995-01-01' + CAST(window_no * 10 AS INTEGER) AS DATE) AS window_start,
       CAST(DATE '1995-01-01' + CAST((window_no + 1) * 10 AS INTEGER) AS DATE) AS window_end,
       CAST(COUNT(*) AS BIGINT) AS n FROM x GROUP BY window_no""", "fx_fees")


# --- ads ----------------------------------------------------------------------------
ATTR_SEL = f"""campaign_id, campaign_title, order_id, ext_order_id, sku, offer_id, product_name, stat_date,
  CAST(price AS {D}) AS price, CAST(amount AS {D}) AS amount, CAST(spent AS {D}) AS spent,
  CAST(bid AS {D}) AS bid, CAST(bid_percent AS {D}) AS bid_percent, qty"""
DAILY_SEL = f"""campaign_id, campaign_title, stat_date, impressions, clicks, CAST(spend AS {D}) AS spend,
  CAST(avg_bid AS {D}) AS avg_bid, orders_cnt, CAST(orders_amount AS {D}) AS orders_amount"""

sql("flatten_attribution", f"SELECT {ATTR_SEL} FROM fx_attribution", "fx_attribution")
sql("insert_ignore_attribution", f"SELECT {ATTR_SEL} FROM fx_attribution", "fx_attribution")
sql("resolve_prefix", """
SELECT r.cand, p.order_id, r.cand AS ext_order_id FROM fx_attr_raw r LEFT JOIN fx_attr_prefix p ON p.cand = r.cand""",
    "fx_attr_raw", "fx_attr_prefix")
sql("attribution_match_rate", """
SELECT CAST(COUNT(p.order_id) AS BIGINT) AS matched, CAST(COUNT(*) - COUNT(p.order_id) AS BIGINT) AS unmatched
FROM fx_attr_raw r LEFT JOIN fx_attr_prefix p ON p.cand = r.cand""", "fx_attr_raw", "fx_attr_prefix")


def order_ads(orders: str, lo: str, hi: str) -> str:
    """Each order with its largest campaign id and title and its spend from rows dated in ``[lo, hi]``;
    NULL for orders without such rows."""
    return f"""SELECT o.order_id, MAX(a.campaign_id) AS campaign_id, MAX(a.campaign_title) AS campaign_title,
       CAST(IF(COUNT(a.order_id) > 0, COALESCE(SUM(a.spent), 0), NULL) AS {D}) AS ads_attributed
FROM {orders} o LEFT JOIN fx_attribution a ON a.order_id = o.order_id AND a.stat_date BETWEEN DATE '{lo}' AND DATE '{hi}'
GROUP BY o.order_id"""


ATTR_WINDOW = ("1996-01-01", "1998-12-31")
sql("order_campaign", f"SELECT order_id, campaign_id, campaign_title FROM ({order_ads('fx_orders', *ATTR_WINDOW)})", "fx_orders", "fx_attribution")
sql("order_ad_spend", f"SELECT order_id, ads_attributed FROM ({order_ads('fx_orders', *ATTR_WINDOW)})", "fx_orders", "fx_attribution")
sql("relink_attribution", f"SELECT {ATTR_SEL} FROM fx_attribution", "fx_attribution")

sql("flatten_campaign_daily", f"SELECT {DAILY_SEL} FROM fx_daily", "fx_daily")
sql("spend_by_day", f"SELECT stat_date, CAST(SUM(spend) AS {D}) AS spend FROM fx_daily GROUP BY 1 ORDER BY 1 DESC",
    "fx_daily")
sql("upsert_campaign_daily", f"""
WITH old AS (SELECT * FROM fx_daily WHERE stat_date < DATE '2024-01-20'),
new AS (SELECT campaign_id, campaign_title, stat_date, impressions, clicks, spend + 1 AS spend, avg_bid, orders_cnt,
               orders_amount FROM fx_daily WHERE stat_date >= DATE '2024-01-15')
SELECT {DAILY_SEL} FROM old o WHERE NOT EXISTS (
  SELECT 1 FROM new n WHERE n.campaign_id = o.campaign_id AND n.stat_date = o.stat_date)
UNION ALL SELECT {DAILY_SEL} FROM new""", "fx_daily")

CAMPAIGN_SRC = """SELECT 'c' || CAST(s_suppkey % 10 AS VARCHAR) AS campaign_id, s_name AS title,
  CASE WHEN s_acctbal > 0 THEN 'CAMPAIGN_STATE_RUNNING' ELSE 'CAMPAIGN_STATE_STOPPED' END AS state,
  'SKU' AS adv_object_type, CASE WHEN s_nationkey % 2 = 0 THEN 'CPC' ELSE 'CPO' END AS payment_type,
  '2024-01-' || lpad(CAST(s_suppkey % 28 + 1 AS VARCHAR), 2, '0') || 'T00:00:00Z' AS created_at,
  '2024-02-' || lpad(CAST(s_suppkey % 28 + 1 AS VARCHAR), 2, '0') || 'T00:00:00Z' AS updated_at,
  s_suppkey AS ordinal, s_nationkey FROM supplier"""
sql("flatten_campaigns", f"""SELECT campaign_id, title, state, adv_object_type, payment_type, created_at, updated_at,
  ordinal FROM ({CAMPAIGN_SRC}) c""")
sql("upsert_campaigns", f"""
WITH src AS ({CAMPAIGN_SRC}),
l1 AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY campaign_id ORDER BY ordinal DESC) rn
                      FROM src WHERE s_nationkey < 15) t WHERE rn = 1),
l2 AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY campaign_id ORDER BY ordinal DESC) rn
                      FROM src WHERE s_nationkey >= 10) t WHERE rn = 1)
SELECT COALESCE(n.campaign_id, o.campaign_id) AS campaign_id,
       CASE WHEN n.campaign_id IS NOT NULL THEN n.title || ' v2' ELSE o.title END AS title,
       CASE WHEN n.campaign_id IS NOT NULL THEN n.state ELSE o.state END AS state,
       CASE WHEN n.campaign_id IS NOT NULL THEN n.adv_object_type ELSE o.adv_object_type END AS adv_object_type,
       CASE WHEN n.campaign_id IS NOT NULL THEN n.payment_type ELSE o.payment_type END AS payment_type,
       CASE WHEN o.campaign_id IS NOT NULL THEN o.created_at ELSE '2030-01-01T00:00:00Z' END AS created_at,
       CASE WHEN n.campaign_id IS NOT NULL THEN n.updated_at ELSE o.updated_at END AS updated_at
FROM l1 o FULL OUTER JOIN l2 n ON n.campaign_id = o.campaign_id""")

# --- orders tables ---------------------------------------------------------------------
fx_header = """header AS (
  SELECT o.order_id, CAST(o.o_custkey AS VARCHAR) AS customer_id, o.order_date, o.status,
         COALESCE(SUM(i.price * i.quantity), 0) AS revenue, COALESCE(SUM(-(i.price * i.disc)), 0) AS fees_total,
         COALESCE(SUM(i.price - i.price * i.disc), 0) AS payout
  FROM fx_orders_landed o LEFT JOIN fx_items i ON i.order_id = o.order_id
  GROUP BY o.order_id, o.o_custkey, o.order_date, o.status)"""
sql("flatten_order_header", f"""WITH {fx_header}
SELECT order_id, customer_id, order_date, status, CAST(revenue AS {D}) AS revenue FROM header""",
    "fx_orders_landed", "fx_items")
sql("posting_totals", f"""WITH {fx_header}
SELECT order_id, CAST(fees_total AS {D}) AS fees_total, CAST(payout AS {D}) AS payout FROM header""",
    "fx_orders_landed", "fx_items")
sql("flatten_order_items", f"""
SELECT order_id, sku, 'Товар ' || CAST(sku AS VARCHAR) AS name, CAST(quantity AS {D}) AS quantity,
       CAST(price AS {D}) AS price, CAST(price * quantity AS {D}) AS revenue FROM fx_items""", "fx_items")
sql("upsert_orders", f"""WITH {fx_header},
old AS (SELECT * FROM fx_orders WHERE NOT COALESCE(order_date >= TIMESTAMP '2000-01-01', FALSE)),
new AS (SELECT * FROM header WHERE order_date >= TIMESTAMP '1999-01-01')
SELECT COALESCE(n.order_id, o.order_id) AS order_id,
       CASE WHEN n.order_id IS NOT NULL THEN n.customer_id ELSE o.customer_id END AS customer_id,
       CASE WHEN n.order_id IS NOT NULL THEN n.order_date ELSE o.order_date END AS order_date,
       CASE WHEN n.order_id IS NOT NULL THEN n.status ELSE o.status END AS status,
       CAST(CASE WHEN n.order_id IS NOT NULL THEN n.revenue ELSE o.revenue END AS {D}) AS revenue,
       o.campaign, o.is_first_order,
       CAST(n.fees_total AS {D}) AS fees_total, CAST(n.payout AS {D}) AS payout
FROM old o FULL OUTER JOIN new n ON n.order_id = o.order_id""", "fx_orders_landed", "fx_items", "fx_orders")
sql("insert_absent_customers", f"""
WITH old AS (
  SELECT customer_id, CAST(MIN(order_date) AS DATE) AS first_order_date, COUNT(*) AS orders_count,
         SUM(revenue) AS total_revenue
  FROM fx_orders WHERE order_date < TIMESTAMP '1998-01-01' AND customer_id IS NOT NULL GROUP BY customer_id)
SELECT customer_id, first_order_date, CAST(orders_count AS BIGINT) AS orders_count,
       CAST(total_revenue AS {D}) AS total_revenue FROM old
UNION ALL
SELECT DISTINCT CAST(o_custkey AS VARCHAR), CAST(NULL AS DATE), CAST(NULL AS BIGINT), CAST(NULL AS {D})
FROM fx_orders_landed WHERE CAST(o_custkey AS VARCHAR) NOT IN (SELECT customer_id FROM old)""",
    "fx_orders", "fx_orders_landed")
sql("upsert_products", """
SELECT sku, 'old ' || name AS name, flavor, grams FROM fx_products WHERE sku NOT IN (SELECT sku FROM fx_items)
UNION ALL
SELECT i.sku, 'Товар ' || CAST(i.sku AS VARCHAR) || ' / ' || CAST(MAX(i.o_orderkey) AS VARCHAR), ANY_VALUE(p.flavor), ANY_VALUE(p.grams)
FROM fx_items i LEFT JOIN fx_products p ON p.sku = i.sku GROUP BY i.sku""", "fx_products", "fx_items")
sql("replace_items_by_order", f"""
WITH scope AS (SELECT order_id FROM fx_orders_landed WHERE order_date >= TIMESTAMP '1999-01-01')
SELECT order_id, sku, CAST(quantity AS {D}) AS quantity, CAST(price AS {D}) AS price,
       CAST(CAST(price * quantity AS DECIMAL(18,4)) AS {D}) AS revenue
FROM fx_items WHERE order_id NOT IN (SELECT order_id FROM scope)
UNION ALL
SELECT order_id, sku, CAST(quantity + 1 AS {D}), CAST(price AS {D}), CAST(price * quantity AS {D})
FROM fx_items WHERE order_id IN (SELECT order_id FROM scope)""", "fx_items", "fx_orders_landed")
sql("mark_missing", """
WITH seen AS (SELECT DISTINCT order_id FROM fx_items)
SELECT o.order_id, o.order_date,
       CASE WHEN s.order_id IS NOT NULL THEN FALSE
            WHEN o.order_date >= TIMESTAMP '1998-01-01' AND o.order_date < TIMESTAMP '1999-01-01' THEN TRUE END AS missing,
       CASE WHEN s.order_id IS NULL AND o.order_date >= TIMESTAMP '1998-01-01' AND o.order_date < TIMESTAMP '1999-01-01'
            THEN TIMESTAMP '2025-01-01 00:00:00' END AS missing_at
FROM fx_orders o LEFT JOIN seen s ON s.order_id = o.order_id""", "fx_orders", "fx_items")
sql("dq_foreign_key", """
SELECT order_id, customer_id FROM fx_orders WHERE customer_id IS NOT NULL AND customer_id NOT IN (
  SELECT customer_id FROM fx_orders WHERE order_date < TIMESTAMP '1999-01-01' AND customer_id IS NOT NULL)""",
    "fx_orders")
sql("dq_not_null", """
SELECT 'order_id' AS column_name, CAST(COUNT(*) - COUNT(order_id) AS BIGINT) AS null_count FROM fx_attribution
UNION ALL SELECT 'ext_order_id', CAST(COUNT(*) - COUNT(ext_order_id) AS BIGINT) FROM fx_attribution
UNION ALL SELECT 'sku', CAST(COUNT(*) - COUNT(sku) AS BIGINT) FROM fx_attribution
UNION ALL SELECT 'campaign_title', CAST(COUNT(*) - COUNT(campaign_title) AS BIGINT) FROM fx_attribution""",
    "fx_attribution")
sql("dq_date_bounds", "SELECT MIN(order_date) AS min_date, MAX(order_date) AS max_date FROM fx_orders", "fx_orders")
sql("lookback_window", """
SELECT order_id, order_date FROM fx_orders
WHERE order_date >= TIMESTAMP '1998-07-03' AND order_date < TIMESTAMP '1998-08-03'""", "fx_orders")


# --- scalar functions ------------------------------------------------------------------
NB = "chr(160)"
MONEY_BASE = "'1' || ' ' || replace(CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), '.', ',')"


def _money_text(junk: bool, nbsp: bool, blank: bool) -> str:
    t = MONEY_BASE
    if nbsp:
        t = f"CASE WHEN event_id % 2 = 0 THEN replace({MONEY_BASE}, ' ', {NB}) ELSE {t} END"
    if blank:
        t = f"CASE WHEN event_id % 11 = 0 THEN '' ELSE {t} END"
    if junk:
        t = f"CASE WHEN event_id % 13 = 0 THEN 'n/a' ELSE {t} END"
    return t


def _parse(text: str) -> str:
    return f"TRY_CAST(replace(replace({text}, ' ', ''), ',', '.') AS DECIMAL(18,4))"


sql("money_lenient", f"""
WITH t AS (SELECT event_id, {_money_text(True, True, True)} AS text FROM events)
SELECT event_id, text, CAST(COALESCE({_parse('text')}, 0) AS {D}) AS amount FROM t""")
sql("money_strict", f"""
WITH t AS (SELECT event_id, {_money_text(False, False, False)} AS text FROM events)
SELECT event_id, text, CAST(CAST(replace(replace(text, ' ', ''), ',', '.') AS DECIMAL(18,4)) AS {D}) AS amount FROM t""")
sql("money_localized", f"""
WITH t AS (SELECT event_id, {_money_text(False, True, True)} AS text FROM events)
SELECT event_id, text, CAST(CASE WHEN replace(replace(trim(text), ' ', ''), {NB}, '') = '' THEN 0
  ELSE CAST(replace(replace(replace(trim(text), ' ', ''), {NB}, ''), ',', '.') AS DECIMAL(18,4)) END AS {D}) AS amount
FROM t""")
sql("money_report", f"""
WITH t AS (SELECT event_id, CASE WHEN event_id % 13 = 0 THEN 'NaN' WHEN event_id % 17 = 0 THEN NULL
                                 ELSE {_money_text(False, False, False)} END AS text FROM events)
SELECT event_id, text, CAST(CASE WHEN text IS NULL OR lower(trim(text)) = 'nan' THEN 0
  ELSE CAST(replace(replace(text, ' ', ''), ',', '.') AS DECIMAL(18,4)) END AS {D}) AS amount FROM t""")

OID = "CAST(o_custkey AS VARCHAR) || '-' || CAST(o_orderkey AS VARCHAR) || '-1'"
POSTING_TEXT = f"""CASE o_orderkey % 5 WHEN 0 THEN {OID} WHEN 1 THEN replace({OID}, '-', '_') WHEN 2 THEN ' '
  WHEN 3 THEN '  ' || {OID} || ' ' END"""
sql("customer_from_posting", f"""
WITH t AS (SELECT o_orderkey, {POSTING_TEXT} AS text FROM orders), s AS (SELECT *, trim(text) AS st FROM t)
SELECT o_orderkey, text, CASE WHEN st IS NULL OR st = '' THEN 'unknown'
  WHEN contains(st, '-') THEN split_part(st, '-', 1) WHEN contains(st, '_') THEN split_part(st, '_', 1)
  ELSE st END AS customer_id FROM s""")
sql("customer_from_posting_simple", f"""
WITH t AS (SELECT o_orderkey, {POSTING_TEXT} AS text FROM orders)
SELECT o_orderkey, text, CASE WHEN text IS NULL OR text = '' THEN '' ELSE split_part(text, '-', 1) END AS customer_id
FROM t""")


def _date_text(lenient: bool) -> str:
    n = 5 if lenient else 4
    t = (f"CASE o_orderkey % {n} WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%d.%m.%Y') "
         f"WHEN 2 THEN CAST(day(o_orderdate) AS VARCHAR) || '.' || CAST(month(o_orderdate) AS VARCHAR) || '.' || CAST(year(o_orderdate) AS VARCHAR) "
         f"WHEN 3 THEN strftime(o_orderdate, '%d/%m/%Y') ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END")
    t = f"CASE WHEN o_orderkey % 50 = 0 THEN '' ELSE {t} END"
    if lenient:
        t = f"CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' ELSE {t} END"
    return t


sql("date_any", f"""
WITH t AS (SELECT o_orderkey, {_date_text(False)} AS text FROM orders)
SELECT o_orderkey, text, CASE WHEN text IS NULL OR text = '' THEN NULL ELSE CAST(COALESCE(
  try_strptime(trim(text), '%Y-%m-%d'), try_strptime(trim(text), '%d.%m.%Y'), try_strptime(trim(text), '%d/%m/%Y')) AS DATE) END AS parsed
FROM t""")
sql("date_any_lenient", f"""
WITH t AS (SELECT o_orderkey, {_date_text(True)} AS text FROM orders)
SELECT o_orderkey, text, CASE WHEN text IS NULL OR text = '' THEN NULL ELSE CAST(COALESCE(
  try_strptime(trim(text), '%Y-%m-%d'), try_strptime(trim(text), '%d.%m.%Y'),
  try_strptime(trim(text), '%Y-%m-%dT%H:%M:%SZ'), try_strptime(trim(text), '%Y-%m-%dT%H:%M:%S')) AS DATE) END AS parsed
FROM t""")

from oracle.fixtures import SERVICE_NAME_SQL, classify_sql  # noqa: E402

NAME_TEXT = f"""CASE l_linenumber % 5 WHEN 1 THEN upper({SERVICE_NAME_SQL}) WHEN 2 THEN 'LastMile' || CAST(sku AS VARCHAR)
  WHEN 3 THEN NULL WHEN 4 THEN '' ELSE {SERVICE_NAME_SQL} END"""
sql("fee_name_normalize", f"""
WITH t AS (SELECT o_orderkey, l_linenumber, {NAME_TEXT} AS name FROM fx_items)
SELECT o_orderkey, l_linenumber, name, {normalize_sql('name')} AS fee_name FROM t""", "fx_items")
sql("fee_group_classify", f"""
WITH t AS (SELECT o_orderkey, l_linenumber, {NAME_TEXT} AS name FROM fx_items)
SELECT o_orderkey, l_linenumber, name, {classify_sql('name')} AS fee_group FROM t""", "fx_items")
sql("fee_uid", """
SELECT o_orderkey, l_linenumber, sku, md5(
  'finance_api' || '|' || CASE WHEN l_linenumber % 2 = 0 THEN order_id ELSE '' END || '|'
  || CASE WHEN l_linenumber % 2 = 1 THEN order_id ELSE '' END || '|'
  || CASE WHEN l_linenumber % 3 <> 0 THEN 'OperationAgentDeliveredToCustomer' ELSE '' END || '|' || '' || '|'
  || 'svc' || CAST(l_suppkey AS VARCHAR) || '|' || strftime(l_shipdate, '%Y-%m-%d') || '|'
  || CASE WHEN l_linenumber % 4 <> 0 AND sku <> 0 THEN CAST(sku AS VARCHAR) ELSE '' END) AS uid
FROM fx_items""", "fx_items")
sql("posting_id_normalize", """
WITH t AS (SELECT o_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN order_id WHEN 1 THEN ' ' || order_id || ' '
  WHEN 2 THEN CAST(o_orderkey AS VARCHAR) ELSE order_id || '-x' END AS text FROM fx_items)
SELECT o_orderkey, l_linenumber, text,
  CASE WHEN regexp_full_match(trim(text), '[0-9]+-[0-9]+-[0-9]+') THEN trim(text) END AS order_id FROM t""", "fx_items")
sql("int_lenient", """
WITH t AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4
  WHEN 0 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) WHEN 1 THEN ' ' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ' '
  WHEN 2 THEN CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) ELSE 'abc' END AS text FROM lineitem)
SELECT l_orderkey, l_linenumber, text,
  CASE WHEN regexp_full_match(trim(text), '[+-]?[0-9]+') THEN CAST(trim(text) AS BIGINT) END AS qty FROM t""")
sql("first_present", """
WITH t AS (SELECT CASE WHEN l_linenumber % 2 = 0 THEN 'c' || CAST(l_suppkey % 10 AS VARCHAR) END AS "campaignId",
                  CASE WHEN l_linenumber % 2 = 1 THEN 'c' || CAST(l_suppkey % 10 AS VARCHAR) END AS campaign_id,
                  CAST(NULL AS VARCHAR) AS id FROM fx_items)
SELECT "campaignId", campaign_id, id, COALESCE(NULLIF("campaignId", ''), NULLIF(campaign_id, ''), NULLIF(id, ''), '0') AS campaign
FROM t""", "fx_items")
sql("line_revenue", f"""
SELECT order_id, sku, l_linenumber,
  CAST(price * COALESCE(CASE WHEN l_linenumber % 6 <> 0 THEN quantity END, 0) AS {D}) AS revenue FROM fx_items""",
    "fx_items")
sql("iso_window_bounds", "SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS iso FROM lineitem")


# --- sources -----------------------------------------------------------------------------
sql("src_postings", f"""WITH {fx_header}
SELECT order_id, customer_id, order_date, status, CAST(revenue AS {D}) AS revenue, CAST(fees_total AS {D}) AS fees_total,
       CAST(payout AS {D}) AS payout FROM header""", "fx_orders_landed", "fx_items")
sql("src_postings_by_scheme", """
SELECT o.order_id, CASE WHEN o.status = 'F' THEN 'fbo' ELSE 'fbs' END AS scheme, o.status,
       CAST(COUNT(i.order_id) AS INTEGER) AS n_products
FROM fx_orders_landed o LEFT JOIN fx_items i ON i.order_id = o.order_id GROUP BY o.order_id, o.status""",
    "fx_orders_landed", "fx_items")
sql("src_finance_ops", f"SELECT {FEE_SEL} FROM fx_fin_rows", "fx_fin_rows")
sql("src_campaigns", f"""SELECT campaign_id, title, state, adv_object_type, payment_type, created_at, updated_at
FROM ({CAMPAIGN_SRC}) c""")
sql("src_campaign_daily", f"SELECT {DAILY_SEL} FROM fx_daily", "fx_daily")
sql("src_attribution_rows", f"""
SELECT r.campaign_id, r.campaign_title, p.order_id, r.cand AS ext_order_id, r.sku, r.offer_id, r.product_name,
       r.stat_date, CAST(r.price AS {D}) AS price, CAST(r.amount AS {D}) AS amount, CAST(r.spent AS {D}) AS spent,
       CAST(r.bid AS {D}) AS bid, CAST(r.bid_percent AS {D}) AS bid_percent, r.qty
FROM fx_attr_raw r LEFT JOIN fx_attr_prefix p ON p.cand = r.cand""", "fx_attr_raw", "fx_attr_prefix")
sql("src_accruals", f"SELECT {FEE_SEL} FROM fx_accrual_fees", "fx_accrual_fees")
sql("dim_catalog", "SELECT sku, flavor, grams FROM fx_products", "fx_products")
sql("param_scan", f"""SELECT order_id, customer_id, CAST(revenue AS {D}) AS revenue FROM fx_orders
WHERE campaign = '2-HIGH' AND revenue > 100000""", "fx_orders")


# --- batch plans ------------------------------------------------------------------------
K01 = f"""{fx_header},
posting_money AS ({order_money('fx_posting_fees')}),
k01 AS (
  SELECT h.* EXCLUDE (fees_total), COALESCE(m.fees, h.fees_total) AS fees_total, m.sale_commission, m.discount, m.other_fee, h.revenue + m.fees AS profit,
         h.order_date = MIN(h.order_date) OVER (PARTITION BY h.customer_id) AS is_first_order
  FROM header h LEFT JOIN posting_money m ON m.order_id = h.order_id)"""
K01_FX = ("fx_orders_landed", "fx_items", "fx_posting_fees")
sql("batch_orders", f"""WITH {K01}
SELECT order_id, customer_id, order_date, status, CAST(revenue AS {D}) AS revenue, CAST(fees_total AS {D}) AS fees_total,
       CAST(revenue + fees_total AS {D}) AS payout, CAST(sale_commission AS {D}) AS sale_commission,
       CAST(discount AS {D}) AS discount, CAST(other_fee AS {D}) AS other_fee, CAST(profit AS {D}) AS profit,
       is_first_order, FALSE AS missing, CAST(NULL AS TIMESTAMP) AS missing_at FROM k01""", *K01_FX)
sql("batch_order_items", f"""SELECT order_id, sku, CAST(quantity AS {D}) AS quantity, CAST(price AS {D}) AS price,
  CAST(CAST(price * quantity AS DECIMAL(18,4)) AS {D}) AS revenue FROM fx_items""", "fx_items")


def k01_with(extra_fees: str) -> str:
    """Orders after K01 and a further fee source: an order with counted fee rows takes the sums over both."""
    only_new = {"delivery_fee", "acquiring_fee", "ads_fee"}   # K01 leaves these NULL
    buckets = ", ".join(f"CAST({f'm.{c}' if c in only_new else f'COALESCE(m.{c}, k.{c})'} AS {D}) AS {c}" for c in MONEY_COLS)
    return f"""{K01},
both_fees AS (SELECT order_id, fee_group, amount, source FROM fx_posting_fees UNION ALL SELECT order_id, fee_group, amount, source FROM {extra_fees}),
money AS ({order_money('both_fees')}), sales AS ({order_sales('both_fees')}),
k02 AS (SELECT k.order_id, CAST(s.sales AS {D}) AS sales_report, CAST(COALESCE(m.fees, k.fees_total) AS {D}) AS fees_total,
       CAST(k.revenue + COALESCE(m.fees, k.fees_total) AS {D}) AS payout, CAST(COALESCE(k.revenue + m.fees, k.profit) AS {D}) AS profit, {buckets}
  FROM k01 k LEFT JOIN money m ON m.order_id = k.order_id LEFT JOIN sales s ON s.order_id = k.order_id)"""


# orders without counted rows keep NULL in the three buckets; those with some have sums, also 0
sql("batch_finance", f"WITH {k01_with('fx_fin_fees')} SELECT * FROM k02", *K01_FX, "fx_fin_fees")
sql("batch_accruals", f"WITH {k01_with('fx_accrual_fees')} SELECT * FROM k02", *K01_FX, "fx_accrual_fees")
sql("batch_attribution", order_ads("fx_orders_landed", *ATTR_WINDOW), "fx_orders_landed", "fx_attribution")
sql("batch_all", f"""WITH {k01_with('fx_fin_fees')}, ads AS ({order_ads('fx_orders_landed', '1995-01-01', '2001-12-31')})
SELECT * FROM k02 JOIN ads USING (order_id)""", *K01_FX, "fx_fin_fees", "fx_attribution")


# --- streaming (batch-equal) ------------------------------------------------------------
sql("stream_upsert", f"SELECT {DAILY_SEL} FROM fx_daily", "fx_daily")
sql("stream_dedup", "SELECT event_id, ts, user_id, event_type, value FROM events")
sql("stream_campaign_daily", f"""
SELECT 'c' || CAST(user_id % 10 AS VARCHAR) AS campaign_id, CAST(ts AS DATE) AS stat_date,
       CAST(COUNT(*) AS BIGINT) AS events,
       CAST(COUNT(CASE WHEN event_type = 'click' THEN 1 END) AS BIGINT) AS clicks,
       CAST(COUNT(CASE WHEN event_type = 'purchase' THEN 1 END) AS BIGINT) AS orders_cnt,
       CAST(COALESCE(SUM(CASE WHEN event_type = 'click' THEN CAST(value AS DECIMAL(18,2)) END), 0) AS {D}) AS spend
FROM events GROUP BY 1, 2""")

sql("stream_corrected_daily", f"""
WITH last AS (SELECT event_id, user_id, event_type, CASE WHEN event_id % 7 = 0 THEN ts + INTERVAL 1 DAY ELSE ts END AS ts,
                     CASE WHEN event_id % 7 = 0 THEN value + 10 ELSE value END AS value FROM events)
SELECT 'c' || CAST(user_id % 10 AS VARCHAR) AS campaign_id, CAST(ts AS DATE) AS stat_date,
       CAST(COUNT(*) AS BIGINT) AS events,
       CAST(COUNT(CASE WHEN event_type = 'click' THEN 1 END) AS BIGINT) AS clicks,
       CAST(COUNT(CASE WHEN event_type = 'purchase' THEN 1 END) AS BIGINT) AS orders_cnt,
       CAST(COALESCE(SUM(CASE WHEN event_type = 'click' THEN CAST(value AS DECIMAL(18,2)) END), 0) AS {D}) AS spend
FROM last GROUP BY 1, 2""")
SQL["stream_tables"] = SQL["batch_all"]

sql("flatten_accruals", f"SELECT {FEE_SEL} FROM fx_accrual_fees", "fx_accrual_fees")
sql("update_from_aggregate", f"""
WITH agg AS (SELECT i.order_id, SUM(i.price * i.quantity) AS medium_revenue
             FROM fx_items i JOIN fx_products p ON p.sku = i.sku WHERE p.flavor = 'MEDIUM' GROUP BY i.order_id)
SELECT o.order_id, CAST(CASE WHEN a.order_id IS NOT NULL THEN a.medium_revenue ELSE o.revenue END AS {D}) AS revenue
FROM fx_orders o LEFT JOIN agg a ON a.order_id = o.order_id""", "fx_orders", "fx_items", "fx_products")
sql("existence_limit", """
SELECT order_id, order_date FROM fx_orders_landed ORDER BY order_date DESC NULLS FIRST, order_id DESC LIMIT 1""",
    "fx_orders_landed")
