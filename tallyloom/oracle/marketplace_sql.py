"""Statements for the marketplace metrics."""

from __future__ import annotations

from .. import catalog
from .sql import count_if, half_up, ratio, share, with_ctes

CITIES = "['São Paulo', 'sao bernardo', 'SÃO JOSÉ', 'Rio de Janeiro', 'Curitiba', 'Sa' || chr(771) || 'o Vicente']"
TABLES = f"""m_orders AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
    CASE o_orderkey % 20 WHEN 0 THEN 'canceled' WHEN 1 THEN 'unavailable' WHEN 2 THEN 'shipped'
      WHEN 3 THEN 'invoiced' WHEN 4 THEN 'processing' WHEN 5 THEN 'created' WHEN 6 THEN 'approved'
      ELSE 'delivered' END AS order_status,
    o_orderdate + to_minutes((o_orderkey * 37) % 1440) AS purchased,
    CASE WHEN o_orderkey % 20 > 6 AND o_orderkey % 97 <> 8 THEN o_orderdate
      + to_minutes((o_orderkey * 37) % 1440) + to_days(CAST(3 + o_orderkey % 17 AS INT))
      + to_seconds((o_orderkey * 7919) % 86400) END AS arrived,
    o_orderdate + to_days(CAST(8 + o_orderkey % 13 AS INT)) AS due,
    CAST(o_totalprice AS DECIMAL(12,2)) AS paid
  FROM orders
), m_items AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS price, CAST(l_quantity * 1.25 AS DECIMAL(12,2)) AS freight
  FROM lineitem
), m_reviews AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(1 + (o_orderkey * 7 + i * 3) % 5 AS INT) AS score
  FROM orders, LATERAL (SELECT unnest(range(1, CAST(o_orderkey % 3 AS INT) + 1)) AS i)
), m_customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, 'u' || c_custkey AS customer_unique_id,
    lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
    {CITIES}[CAST(c_custkey % 6 AS INT) + 1] AS customer_city, 'S' || c_nationkey AS customer_state
  FROM customer
), m_sellers AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, 'S' || s_nationkey AS seller_state FROM supplier
), m_products AS (
  SELECT CASE WHEN p_partkey % 50 <> 0 THEN lower(p_type) END AS category FROM part
), m_translation AS (
  SELECT DISTINCT lower(p_type) AS category, CASE WHEN lower(p_type) <> 'large' THEN lower(p_type) END AS english
  FROM part WHERE lower(p_type) <> 'promo'
), chosen AS (
  SELECT order_id, customer_state FROM m_orders JOIN m_customers USING (customer_id)
  WHERE order_status = 'delivered' AND purchased >= TIMESTAMP '{catalog.FANOUT_SINCE}'
    AND strip_accents(lower(customer_city)) LIKE '%' || strip_accents(lower('{catalog.CITY}')) || '%'
), naive AS (
  SELECT customer_state, COUNT(DISTINCT c.order_id) AS orders, CAST(SUM(price) AS DOUBLE) AS revenue,
    {half_up(ratio("SUM(score)", "COUNT(score)"), 4)} AS avg_score
  FROM chosen c LEFT JOIN m_items i ON c.order_id = i.order_id LEFT JOIN m_reviews r ON c.order_id = r.order_id
  GROUP BY 1
), safe AS (
  SELECT customer_state, COUNT(*) AS orders, CAST(SUM(COALESCE(rev, 0)) AS DOUBLE) AS revenue,
    {half_up(ratio("SUM(CAST(sc AS DECIMAL(20,12)))", "COUNT(sc)"))} AS avg_score
  FROM chosen c LEFT JOIN (SELECT order_id, SUM(price) AS rev FROM m_items GROUP BY 1) i USING (order_id)
    LEFT JOIN (SELECT order_id, {ratio("SUM(score)", "COUNT(score)")} AS sc FROM m_reviews GROUP BY 1) r USING (order_id)
  GROUP BY 1
)"""


def market(body: str, *more: str) -> str:
    return with_ctes(TABLES, *more) + body


def _sellers() -> str:
    canceled, delivered = count_if("order_status = 'canceled'"), "order_status = 'delivered'"
    judgeable = f"{delivered} AND arrived IS NOT NULL AND due IS NOT NULL"
    return market(
        "SELECT * FROM (SELECT *, rank() OVER (PARTITION BY seller_state ORDER BY gmv DESC) AS state_rank FROM metrics) "
        "ORDER BY gmv DESC, seller_id LIMIT 20",
        f"""scores AS (SELECT order_id, {ratio("SUM(score)", "COUNT(score)")} AS sc FROM m_reviews GROUP BY 1),
        sold AS (SELECT seller_id, order_id, SUM(price + freight) AS value FROM m_items GROUP BY 1, 2),
        metrics AS (
          SELECT s.seller_id, any_value(m.seller_state) AS seller_state,
            CAST(SUM(CASE WHEN {delivered} THEN value ELSE 0 END) AS DOUBLE) AS gmv, COUNT(*) AS order_count,
            COUNT(DISTINCT customer_id) AS unique_customers,
            {half_up(ratio("SUM(CAST(sc AS DECIMAL(20,12)))", "COUNT(sc)"))} AS avg_review_score,
            {half_up(share(count_if(f"{judgeable} AND arrived > due"), count_if(judgeable)))} AS late_delivery_rate,
            {half_up(share(canceled, "COUNT(*)"))} AS cancel_rate
          FROM sold s JOIN m_orders o USING (order_id) JOIN m_sellers m ON s.seller_id = m.seller_id
            LEFT JOIN scores USING (order_id)
          WHERE purchased >= TIMESTAMP '{catalog.SELLER_YEAR}-01-01'
            AND purchased < TIMESTAMP '{catalog.SELLER_YEAR + 1}-01-01'
          GROUP BY s.seller_id)""",
    )


def _days(name: str, values: str, orders: str = "m_orders", reviews: str = "m_reviews") -> str:
    return f"""{name} AS (
      SELECT CAST(purchased AS DATE) AS day, COUNT(*) AS orders, SUM(COALESCE(v, 0)) AS gmv,
        {count_if("order_status = 'canceled'")} AS canceled, SUM(COALESCE(r, 0)) AS reviews
      FROM {orders} LEFT JOIN ({values}) USING (order_id)
        LEFT JOIN (SELECT order_id, COUNT(*) AS r FROM {reviews} GROUP BY 1) USING (order_id) GROUP BY 1)"""


def _reconcile() -> str:
    diffs = ", ".join(
        f"CAST(COALESCE(a.{m}, 0) - COALESCE(c.{m}, 0) AS DOUBLE) AS {m}_diff"
        for m in ("orders", "gmv", "canceled", "reviews")
    )
    rate = "COALESCE({}, 0::DOUBLE)"
    ra = rate.format(half_up(share("a.canceled", "a.orders")))
    rc = rate.format(half_up(share("c.canceled", "c.orders")))
    return market(
        f"""SELECT *, orders_diff = 0 AND gmv_diff = 0 AND canceled_diff = 0 AND reviews_diff = 0 AS matches
        FROM (SELECT CAST(COALESCE(a.day, c.day) AS VARCHAR) AS day, {diffs}, {ra} - {rc} AS cancel_rate_diff
        FROM source a FULL JOIN served c ON a.day = c.day)""",
        _days("source", "SELECT order_id, paid AS v FROM m_orders"),
        """served_orders AS (
          SELECT * REPLACE (CASE WHEN CAST(order_id AS BIGINT) % 41 = 0 THEN 'canceled' ELSE order_status END AS order_status)
          FROM m_orders WHERE CAST(order_id AS BIGINT) % 37 <> 0 AND day(purchased) <> 13
        ), served_reviews AS (SELECT * FROM m_reviews WHERE CAST(order_id AS BIGINT) % 29 <> 0)""",
        _days("served", "SELECT order_id, SUM(price) AS v FROM m_items GROUP BY 1", "served_orders", "served_reviews"),
    )


def _source_counts() -> str:
    return market(
        """SELECT 'orders' AS "table", COUNT(*) AS rows, COUNT(due) AS last_column_present, min(order_id) AS first_key FROM m_orders
        UNION ALL SELECT 'order_items', COUNT(*), COUNT(freight), min(order_id) FROM m_items
        UNION ALL SELECT 'order_reviews', COUNT(*), COUNT(*), min(order_id || '-1') FROM m_reviews
        UNION ALL SELECT 'products', COUNT(*), COUNT(p_size), min(CAST(p_partkey AS VARCHAR)) FROM part
        UNION ALL SELECT 'customers', COUNT(*), COUNT(customer_state), min(customer_id) FROM m_customers
        UNION ALL SELECT 'sellers', COUNT(*), COUNT(seller_state), min(seller_id) FROM m_sellers
        UNION ALL SELECT 'order_payments', COUNT(*), COUNT(paid), min(order_id) FROM m_orders
        UNION ALL SELECT 'geolocation', COUNT(*), COUNT(customer_state), min(customer_zip_code_prefix) FROM m_customers
        UNION ALL SELECT 'product_category_name_translation', COUNT(*), COUNT(english), min(category) FROM m_translation"""
    )


def statements() -> dict[str, str]:
    canceled = count_if("order_status = 'canceled'")
    took = "epoch(arrived - purchased)"
    return {
        "translation_gap": market(
            """SELECT COALESCE(p.category, 'NULL') AS missing_category, COUNT(*) AS product_count
            FROM m_products p LEFT JOIN m_translation t ON p.category = t.category
            WHERE p.category IS NULL OR t.english IS NULL GROUP BY 1"""
        ),
        "monthly_metrics": market(
            f"""SELECT strftime(purchased, '%Y-%m') AS month, COUNT(*) AS total_orders,
            {count_if("order_status = 'delivered'")} AS delivered_orders, {canceled} AS canceled_orders,
            {half_up(share(canceled, "COUNT(*)"))} AS cancel_rate,
            CAST(SUM(CASE WHEN order_status = 'delivered' THEN COALESCE(value, 0) ELSE 0 END) AS DOUBLE) AS delivered_gmv,
            {half_up(ratio(f"SUM(CASE WHEN order_status = 'delivered' THEN CAST({took} AS BIGINT) END)",
                           "COUNT(CASE WHEN order_status = 'delivered' THEN arrived END)") + " / 86400::DOUBLE")}
              AS avg_delivery_days
            FROM m_orders LEFT JOIN (SELECT order_id, SUM(price + freight) AS value FROM m_items GROUP BY 1)
              USING (order_id) GROUP BY 1"""
        ),
        "top_sellers": _sellers(),
        "fanout_naive": market("SELECT * FROM naive"),
        "fanout_safe": market("SELECT * FROM safe"),
        "fanout_inflation": market(
            f"""SELECT customer_state, COALESCE(n.revenue, 0::DOUBLE) AS naive_revenue, s.revenue AS safe_revenue,
            {half_up("COALESCE(n.revenue, 0::DOUBLE) - s.revenue")} AS inflation
            FROM naive n JOIN safe s USING (customer_state)"""
        ),
        "city_search": market(
            f"SELECT * FROM m_customers WHERE strip_accents(lower(customer_city)) LIKE '%' || strip_accents(lower('{catalog.CITY}')) || '%'"
        ),
        "reconcile": _reconcile(),
        "reconcile_stream": _reconcile(),
        "orders_csv": market(
            """SELECT order_id, customer_id, order_status, purchased AS order_purchase_timestamp,
            CASE WHEN k % 20 <> 5 THEN purchased + INTERVAL 60 MINUTE END AS order_approved_at,
            CASE WHEN k % 20 > 6 OR k % 20 = 2 THEN purchased + INTERVAL 2 DAY END AS order_delivered_carrier_date,
            arrived AS order_delivered_customer_date, due AS order_estimated_delivery_date
            FROM (SELECT *, CAST(order_id AS BIGINT) AS k FROM m_orders)"""
        ),
        "order_items_csv": """SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
            CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
            l_shipdate AS shipping_limit_date, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS price,
            CAST(CAST(l_quantity * 1.25 AS DECIMAL(12,2)) AS DOUBLE) AS freight_value FROM lineitem""",
        "order_reviews_csv": """SELECT o_orderkey || '-' || i AS review_id, CAST(o_orderkey AS VARCHAR) AS order_id,
            CAST(1 + (o_orderkey * 7 + i * 3) % 5 AS INT) AS review_score,
            CASE WHEN o_orderkey % 4 = 0 THEN 'nota "' || i || '"' END AS review_comment_title,
            CASE WHEN o_orderkey % 5 <> 0 THEN 'pedido ' || o_orderkey || chr(10) || ', fim' END AS review_comment_message,
            o_orderdate + INTERVAL 20 DAY AS review_creation_date,
            o_orderdate + to_days(CAST(20 + i AS INT)) AS review_answer_timestamp
            FROM orders, LATERAL (SELECT unnest(range(1, CAST(o_orderkey % 3 AS INT) + 1)) AS i)""",
        "order_source": _source_counts(),
    }
