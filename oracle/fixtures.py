"""The fixture derivations of ``marketlens.sources.testdata`` in DuckDB SQL.

Each entry is (dependencies, SELECT). ``with_fixtures`` prepends the needed
CTEs, in dependency order, to an oracle query.
"""

from __future__ import annotations

import re

V = "VARCHAR"
M2 = "DECIMAL(18,2)"

FIXTURES: dict[str, tuple[list[str], str]] = {}


def fx(name: str, deps: list[str], sql: str) -> None:
    FIXTURES[name] = (deps, sql)


fx("fx_items", [], f"""
SELECT CAST(o.o_custkey AS {V}) || '-' || CAST(o.o_orderkey AS {V}) || '-1' AS order_id,
       l.l_partkey AS sku, CAST(l.l_quantity AS {M2}) AS quantity,
       CAST(l.l_extendedprice AS {M2}) AS price, CAST(l.l_discount AS {M2}) AS disc,
       CAST(l.l_tax AS {M2}) AS tax, l.l_suppkey, l.l_linenumber, l.l_shipdate, l.l_returnflag,
       o.o_orderkey, o.o_custkey
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")

fx("fx_orders_landed", [], f"""
SELECT CAST(o_custkey AS {V}) || '-' || CAST(o_orderkey AS {V}) || '-1' AS order_id,
       CASE WHEN o_orderkey % 101 <> 0 THEN CAST(o_custkey AS {V}) END AS customer_id,
       CASE WHEN o_orderkey % 97 <> 0 THEN o_orderdate END AS order_date,
       o_orderstatus AS status, o_orderpriority AS campaign, o_orderkey, o_custkey
FROM orders""")

fx("fx_order_rev", ["fx_items"], """
SELECT order_id, SUM(price * quantity) AS rev FROM fx_items GROUP BY order_id""")

fx("fx_first_dates", ["fx_orders_landed"], """
SELECT customer_id, MIN(order_date) AS first_date FROM fx_orders_landed
WHERE customer_id IS NOT NULL AND order_date IS NOT NULL GROUP BY customer_id""")

# The orders table: landed rows + revenue (A01) + first-order flag.
fx("fx_orders", ["fx_orders_landed", "fx_order_rev", "fx_first_dates"], """
SELECT o.order_id, o.customer_id, o.order_date, o.status, o.campaign, o.o_orderkey, o.o_custkey,
       COALESCE(r.rev, 0) AS revenue,
       CASE WHEN f.customer_id IS NOT NULL THEN o.order_date = f.first_date END AS is_first_order
FROM fx_orders_landed o
LEFT JOIN fx_order_rev r ON r.order_id = o.order_id
LEFT JOIN fx_first_dates f ON f.customer_id = o.customer_id""")

fx("fx_products", [], """
SELECT p_partkey AS sku, p_name AS name, p_type AS flavor, p_size AS grams FROM part""")

# Customers table (A03) over the orders table.
fx("fx_customers", ["fx_orders"], """
SELECT customer_id, CAST(MIN(order_date) AS DATE) AS first_order_date,
       CAST(MAX(order_date) AS DATE) AS last_order_date, COUNT(*) AS orders_count,
       SUM(revenue) AS total_revenue
FROM fx_orders WHERE customer_id IS NOT NULL GROUP BY customer_id""")


def with_fixtures(select_sql: str, *names: str) -> str:
    """Prefix ``select_sql`` with the CTEs for ``names`` and their dependencies.

    ``select_sql`` may itself start with ``WITH``; its CTEs are appended."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in FIXTURES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    # materialized: several statements read the same derived table
    ctes = [f"{n} AS MATERIALIZED ({FIXTURES[n][1].strip()})" for n in order]
    body = select_sql.strip()
    m = re.match(r"(?is)^WITH\s+", body)
    if not ctes:
        return body
    if m:
        return "WITH " + ",\n".join(ctes) + ",\n" + body[m.end():]
    return "WITH " + ",\n".join(ctes) + "\n" + body


# --- fees ------------------------------------------------------------------------
# --- FIXED VALUES: fee-group labels as the reports spell them
COMMISSION = "Вознаграждение Ozon"
DELIVERY = "Услуги доставки"
ACQUIRING = "Услуги агентов"
ADS = "Продвижение и реклама"
OTHER = "Прочее"
DISCOUNT = "Скидки"
SALES = "Продажи"


def classify_sql(x: str) -> str:
    """Fee-group keyword rules (first match wins) as a CASE."""
    s = f"lower(COALESCE({x}, ''))"

    def any_of(*ks):
        return " OR ".join(f"contains({s}, '{k}')" for k in ks)
    return (f"CASE WHEN {any_of('вознаграж', 'комисс', 'commission')} THEN '{COMMISSION}' "
            f"WHEN {any_of('logistic', 'логист', 'достав', 'last mile', 'courier')} THEN '{DELIVERY}' "
            f"WHEN {any_of('эквайр', 'acquiring')} THEN '{ACQUIRING}' "
            f"WHEN {any_of('клик', 'cpc', 'cpo', 'реклам', 'продвиж')} THEN '{ADS}' "
            f"ELSE '{OTHER}' END")


def normalize_sql(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL OR {x} = '' THEN 'UNKNOWN' "
            f"WHEN {x} = 'MarketplaceServiceItemDirectFlowLogistic' THEN 'Логистика (доставка)' "
            f"WHEN {x} = 'MarketplaceServiceItemRedistributionLastMileCourier' THEN 'Последняя миля (курьер)' "
            f"WHEN {x} = 'MarketplaceRedistributionOfAcquiringOperation' THEN 'Эквайринг' "
            f"ELSE {x} END")


SERVICE_NAME_SQL = """CASE l_suppkey % 6 WHEN 0 THEN 'MarketplaceServiceItemDirectFlowLogistic'
  WHEN 1 THEN 'MarketplaceServiceItemRedistributionLastMileCourier'
  WHEN 2 THEN 'MarketplaceRedistributionOfAcquiringOperation'
  WHEN 3 THEN 'Вознаграждение за продажу' WHEN 4 THEN 'Оплата за клик' ELSE 'Хранение' END"""

ORDINAL_SQL = "o_orderkey DESC, l_linenumber DESC, sku DESC, l_suppkey DESC, quantity DESC, price DESC, disc DESC, tax DESC, l_shipdate DESC"

# One finance row per lineitem (P20): candidate, name, amount, sku, date text.
fx("fx_fin_raw", ["fx_items"], f"""
SELECT CASE WHEN l_linenumber % 5 = 0 THEN CAST(o_custkey AS {V})
            WHEN l_linenumber % 4 = 0 THEN order_id
            WHEN l_linenumber % 4 = 1 THEN CAST(o_custkey AS {V}) || '-' || CAST(o_orderkey AS {V})
            WHEN l_linenumber % 4 = 2 THEN NULL
            ELSE '999999999-' || CAST(o_orderkey AS {V}) END AS cand,
       {SERVICE_NAME_SQL} AS name,
       -(price * tax) AS amount,
       CASE WHEN sku % 3 = 0 THEN NULL ELSE sku END AS fee_sku,
       strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS op_date,
       l_shipdate AS occurred_at,
       'OperationType' || CAST(l_suppkey % 6 AS {V}) AS operation_type,
       o_orderkey, l_linenumber, sku, l_suppkey, quantity, price, disc, tax, l_shipdate
FROM fx_items""")

# Every text that an order id starts with up to one of its hyphens.
fx("fx_prefixes", ["fx_orders_landed"], """
SELECT array_to_string(parts[1:i], '-') AS prefix, order_id, order_date
FROM (SELECT order_id, order_date, string_split(order_id, '-') AS parts FROM fx_orders_landed) o,
     UNNEST(range(1, len(parts))) AS t(i)""")

# Resolution cascade.
fx("fx_fin_cands", ["fx_fin_raw"], "SELECT DISTINCT cand FROM fx_fin_raw WHERE cand IS NOT NULL")
fx("fx_fin_exact", ["fx_fin_cands", "fx_orders_landed"], """
SELECT c.cand FROM fx_fin_cands c WHERE EXISTS (SELECT 1 FROM fx_orders_landed o WHERE o.order_id = c.cand)""")
fx("fx_fin_prefix", ["fx_fin_cands", "fx_prefixes"], """
SELECT c.cand, o.order_id FROM fx_fin_cands c JOIN fx_prefixes o ON o.prefix = c.cand
QUALIFY ROW_NUMBER() OVER (PARTITION BY c.cand ORDER BY o.order_date DESC NULLS FIRST, o.order_id DESC) = 1""")
fx("fx_fin_resolved", ["fx_fin_raw", "fx_fin_exact", "fx_fin_prefix"], """
SELECT r.*, CASE WHEN e.cand IS NOT NULL THEN r.cand ELSE p.order_id END AS order_id,
       CASE WHEN r.cand IS NOT NULL AND e.cand IS NULL THEN r.cand END AS ext_order_id
FROM fx_fin_raw r LEFT JOIN fx_fin_exact e ON e.cand = r.cand LEFT JOIN fx_fin_prefix p ON p.cand = r.cand""")

fx("fx_fin_rows", ["fx_fin_resolved"], f"""
SELECT md5(concat_ws('|', 'finance_api', COALESCE(order_id, ''), COALESCE(ext_order_id, ''),
           COALESCE(operation_type, ''), {classify_sql('name')}, {normalize_sql('name')}, op_date,
           CASE WHEN fee_sku IS NULL OR fee_sku = 0 THEN '' ELSE CAST(fee_sku AS {V}) END)) AS uid,
       order_id, ext_order_id, {classify_sql('name')} AS fee_group, {normalize_sql('name')} AS fee_name,
       amount, CAST(NULL AS DECIMAL(18,4)) AS percent, CAST(NULL AS {V}) AS product_id, fee_sku AS sku,
       operation_type, occurred_at, 'finance_api' AS source,
       o_orderkey, l_linenumber, sku AS line_sku, l_suppkey, quantity, price, disc, tax, l_shipdate
FROM fx_fin_resolved""")

# U06 into an empty table: last arrival per uid.
fx("fx_fin_fees", ["fx_fin_rows"], f"""
SELECT uid, order_id, ext_order_id, fee_group, fee_name, amount, percent, product_id, sku,
       operation_type, occurred_at, source FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY uid ORDER BY {ORDINAL_SQL.replace('sku DESC', 'line_sku DESC')}) AS rn
  FROM fx_fin_rows) t WHERE rn = 1""")

# Posting fee rows (P19): commission if != 0, discount (negated) if != 0.
fx("fx_posting_fees", ["fx_items"], f"""
SELECT CAST(NULL AS {V}) AS uid, order_id, CAST(NULL AS {V}) AS ext_order_id, '{COMMISSION}' AS fee_group,
       'Вознаграждение за продажу' AS fee_name, -(price * disc) AS amount, disc AS percent,
       CAST(sku AS {V}) AS product_id, CAST(NULL AS BIGINT) AS sku, CAST(NULL AS {V}) AS operation_type,
       CAST(NULL AS TIMESTAMP) AS occurred_at, 'posting_financial' AS source
FROM fx_items WHERE -(price * disc) <> 0
UNION ALL
SELECT NULL, order_id, NULL, '{DISCOUNT}', 'Скидка', -(price * tax), tax, CAST(sku AS {V}), NULL, NULL, NULL,
       'posting_financial'
FROM fx_items WHERE price * tax <> 0""")

# Accrual report rows.
fx("fx_accrual_fees", ["fx_items"], f"""
SELECT CAST(NULL AS {V}) AS uid, CASE WHEN l_linenumber % 3 = 0 THEN order_id END AS order_id,
       CAST(NULL AS {V}) AS ext_order_id,
       CASE l_returnflag WHEN 'R' THEN '{SALES}' WHEN 'A' THEN '{COMMISSION}' ELSE '{DELIVERY}' END AS fee_group,
       'Начисление ' || l_returnflag AS fee_name, price * (1 - disc) AS amount, disc * 100 AS percent,
       CAST(NULL AS {V}) AS product_id, sku, 'Начисление ' || l_returnflag AS operation_type,
       l_shipdate AS occurred_at, 'finance_report' AS source
FROM fx_items""")

fx("fx_fees", ["fx_posting_fees", "fx_fin_fees", "fx_accrual_fees"], """
SELECT uid, order_id, ext_order_id,
       CASE WHEN COALESCE(sku % 89, 1) <> 0 THEN fee_group END AS fee_group,
       fee_name, amount, percent, product_id, sku, operation_type, occurred_at,
       CASE WHEN COALESCE(sku % 83, 1) <> 0 THEN source END AS source
FROM (SELECT * FROM fx_posting_fees UNION ALL SELECT * FROM fx_fin_fees UNION ALL SELECT * FROM fx_accrual_fees) u""")

# --- ads ---------------------------------------------------------------------------
fx("fx_attr_raw", ["fx_items"], f"""
SELECT 'c' || CAST(l_suppkey % 10 AS {V}) AS campaign_id, 'Campaign ' || CAST(l_suppkey % 10 AS {V}) AS campaign_title,
       CAST(l_shipdate AS DATE) AS stat_date,
       CASE WHEN l_linenumber % 7 = 0 THEN '999999999-' || CAST(o_orderkey AS {V})
            WHEN l_linenumber % 5 = 0 THEN CAST(o_custkey AS {V})
            ELSE CAST(o_custkey AS {V}) || '-' || CAST(o_orderkey AS {V}) END AS cand,
       sku, 'offer-' || CAST(sku AS {V}) AS offer_id, 'Товар ' || CAST(sku AS {V}) AS product_name,
       price, price * quantity AS amount, price * tax AS spent, tax AS bid, disc * 100 AS bid_percent,
       CAST(quantity AS BIGINT) AS qty
FROM fx_items""")
fx("fx_attr_cands", ["fx_attr_raw"], "SELECT DISTINCT cand FROM fx_attr_raw")
fx("fx_attr_prefix", ["fx_attr_cands", "fx_prefixes"], """
SELECT c.cand, o.order_id FROM fx_attr_cands c JOIN fx_prefixes o ON o.prefix = c.cand
QUALIFY ROW_NUMBER() OVER (PARTITION BY c.cand ORDER BY o.order_date DESC NULLS FIRST, o.order_id DESC) = 1""")
fx("fx_attribution", ["fx_attr_raw", "fx_attr_prefix"], """
SELECT DISTINCT r.campaign_id, r.campaign_title, p.order_id, r.cand AS ext_order_id, r.sku, r.offer_id,
       r.product_name, r.stat_date, r.price, r.amount, r.spent, r.bid, r.bid_percent, r.qty
FROM fx_attr_raw r LEFT JOIN fx_attr_prefix p ON p.cand = r.cand""")

fx("fx_daily", [], f"""
SELECT 'c' || CAST(user_id % 10 AS {V}) AS campaign_id,
       'Campaign c' || CAST(user_id % 10 AS {V}) AS campaign_title,
       CAST(ts AS DATE) AS stat_date,
       CAST(COUNT(CASE WHEN event_type = 'view' THEN 1 END) AS BIGINT) AS impressions,
       CAST(COUNT(CASE WHEN event_type = 'click' THEN 1 END) AS BIGINT) AS clicks,
       COALESCE(SUM(CASE WHEN event_type = 'click' THEN CAST(value AS {M2}) END), 0) AS spend,
       COALESCE(MAX(CASE WHEN event_type = 'click' THEN CAST(value AS {M2}) END), 0) AS avg_bid,
       CAST(COUNT(CASE WHEN event_type = 'purchase' THEN 1 END) AS BIGINT) AS orders_cnt,
       COALESCE(SUM(CASE WHEN event_type = 'purchase' THEN CAST(value AS {M2}) END), 0) AS orders_amount
FROM events GROUP BY 1, 2, 3""")
