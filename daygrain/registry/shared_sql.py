"""The shop's tables and the star schema in SQL, for the comparison texts."""

from __future__ import annotations

from daygrain.registry.base import define, local_day, to_utc
from daygrain.sources.shop import LINE_ORDER

define(
    "s_dates",
    """
SELECT l_orderkey,
       min(CASE WHEN l_returnflag = 'A' THEN l_shipdate END) AS approved,
       min(CASE WHEN l_linestatus = 'O' THEN l_shipdate END) AS carrier,
       max(CASE WHEN l_linestatus = 'F' THEN l_shipdate END) AS last_delivery
FROM lineitem GROUP BY 1""",
)
define(
    "s_orders",
    """
SELECT o_orderkey::VARCHAR AS order_id, 'c' || o_orderkey AS customer_id,
       'u' || o_custkey AS customer_unique_id,
       CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
                          WHEN 'P' THEN 'canceled' END AS order_status,
       o_orderdate AS order_purchase_timestamp, approved AS order_approved_at,
       carrier AS order_delivered_carrier_date,
       CASE WHEN o_orderstatus = 'F' THEN last_delivery END AS order_delivered_customer_date,
       o_orderdate + INTERVAL 365 DAY AS order_estimated_delivery_date
FROM orders LEFT JOIN s_dates ON l_orderkey = o_orderkey""",
)
_LINE = """
SELECT l_orderkey::VARCHAR AS order_id, l_linenumber AS order_item_id,
       l_partkey::VARCHAR AS product_id, l_suppkey::VARCHAR AS seller_id,
       l_shipdate AS shipping_limit_date, l_extendedprice::DECIMAL(12,2) AS price,
       round(l_extendedprice::DECIMAL(12,2) * l_tax::DECIMAL(12,2), 2)::DECIMAL(12,2)
           AS freight_value
FROM """
define("s_lines", _LINE + "lineitem")
define(
    "s_items",
    f"""{_LINE}(SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY {', '.join(LINE_ORDER)}) AS rn FROM lineitem) WHERE rn = 1""",
)
define(
    "s_payments",
    """
SELECT l_orderkey::VARCHAR AS order_id, l_linenumber AS payment_sequential,
       CASE l_returnflag WHEN 'A' THEN 'boleto' WHEN 'N' THEN 'credit_card'
                         WHEN 'R' THEN 'not_defined' END AS payment_type,
       l_quantity::INT - 1 AS payment_installments,
       round(l_extendedprice::DECIMAL(12,2) * (1 - l_discount::DECIMAL(12,2)), 2)::DECIMAL(12,2)
           AS payment_value
FROM lineitem""",
)
define(
    "s_reviews",
    """
SELECT l_partkey || '-' || l_linenumber AS review_id, l_orderkey::VARCHAR AS order_id,
       5 - floor(l_discount::DECIMAL(12,2) * 50)::INT AS review_score,
       nullif(l_returnflag, 'N') AS review_comment_title,
       nullif(l_linestatus, 'O') AS review_comment_message,
       l_shipdate AS review_creation_date,
       l_shipdate + to_days(l_linenumber) AS review_answer_timestamp
FROM lineitem""",
)
define(
    "s_snapshots",
    """
SELECT 'c' || o_orderkey AS customer_id, 'u' || o_custkey AS customer_unique_id,
       c_nationkey::VARCHAR AS zip, c_mktsegment AS city, o_orderpriority AS state,
       o_orderdate::DATE AS effective_date
FROM orders JOIN customer ON c_custkey = o_custkey""",
)
define(
    "s_products",
    """
SELECT p_partkey::VARCHAR AS product_id,
       CASE WHEN p_brand <> 'Brand#7' THEN p_type END AS product_category_name,
       length(p_name)::INT AS name_length, length(p_brand)::INT AS description_length,
       CASE WHEN p_size > 2 THEN p_size END AS photos_qty,
       CASE WHEN p_size < 50 THEN p_size * 10 END AS weight_g,
       trunc(p_retailprice)::INT AS length_cm, p_size AS height_cm, p_size + 1 AS width_cm
FROM part""",
)
define(
    "s_translation",
    """
SELECT DISTINCT p_type AS product_category_name, lower(p_type) AS english
FROM part WHERE p_type <> 'PROMO'""",
)
define(
    "s_sellers",
    """
SELECT s_suppkey::VARCHAR AS seller_id, s_nationkey::VARCHAR AS zip, n_name AS city,
       r_name AS state
FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""",
)
define(
    "s_points",
    """
SELECT lpad(c_nationkey::VARCHAR, 5, '0') AS zip, c_acctbal::DECIMAL(12,2) AS lat,
       c_custkey::DECIMAL(12,2) AS lng FROM customer
UNION ALL
SELECT lpad(s_nationkey::VARCHAR, 5, '0'), s_acctbal::DECIMAL(12,2), s_suppkey::DECIMAL(12,2)
FROM supplier""",
)
define(
    "s_events",
    """
SELECT CASE WHEN k <> 0 THEN event_id::VARCHAR END AS event_id,
       user_id || '-' || strftime(ts, '%Y%m%d') AS session_id,
       'u' || user_id AS customer_unique_id, floor(value)::BIGINT::VARCHAR AS product_id,
       CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart'
            WHEN 'signup' THEN 'checkout_start' ELSE event_type END AS event_type,
       CASE WHEN k = 1 THEN 'not-a-timestamp' WHEN k = 2 THEN '1970-01-01T00:00:00'
            ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS event_ts_raw,
       ['desktop', 'mobile', 'tablet'][(user_id % 3)::INT + 1] AS device,
       strftime(ts::DATE + days_late, '%Y-%m-%d') AS ingest_dt
FROM (SELECT *, unnest(CASE WHEN k IN (3, 4) THEN [late, late] WHEN k = 5 THEN [late, late + 1]
                            ELSE [late] END) AS days_late
      FROM (SELECT *, regexp_extract(props, '(\\d+)', 1)::INT AS k,
                   CASE WHEN hour(ts) >= 23 THEN 1 ELSE 0 END AS late FROM events))""",
)
define(
    "s_prepared",
    f"""
SELECT *, {to_utc("try_cast(event_ts_raw AS TIMESTAMP)")} AS event_ts FROM s_events""",
)
_TAGGED = """
SELECT *, concat_ws(',',
    CASE WHEN event_id IS NULL THEN 'null:event_id' END,
    CASE WHEN session_id IS NULL THEN 'null:session_id' END,
    CASE WHEN customer_unique_id IS NULL THEN 'null:customer_unique_id' END,
    CASE WHEN event_ts IS NULL THEN 'null:event_ts' END,
    CASE WHEN event_type NOT IN ('page_view', 'add_to_cart', 'checkout_start', 'purchase')
         THEN 'bad_value:event_type' END,
    CASE WHEN event_ts_raw IS NOT NULL AND event_ts IS NULL THEN 'bad_timestamp:event_ts' END,
    CASE WHEN event_ts < TIMESTAMP '2023-01-01' OR event_ts > TIMESTAMP '2025-01-01'
         THEN 'out_of_range:event_ts' END,
    CASE WHEN event_id IS NOT NULL AND copy > 1 THEN 'duplicate:event_id' END) AS dq_reason
FROM (SELECT *, row_number() OVER (PARTITION BY {within}event_id ORDER BY event_ts) AS copy
      FROM s_prepared)"""
define("s_tagged_events", _TAGGED.format(within="ingest_dt, "))
# All arrivals shipped as one day's drop.
define("s_drop_events", _TAGGED.format(within=""))
define(
    "s_clean_events",
    "SELECT * FROM s_tagged_events WHERE dq_reason = ''",
)
define(
    "s_first_events",
    """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ingest_dt, event_ts)
               AS arrival FROM s_clean_events) WHERE arrival = 1""",
)
SESSION_SQL = f"""
SELECT session_id, max(customer_unique_id) AS customer_unique_id,
       {local_day("min(event_ts)")} AS session_date, max(device) AS device,
       min(event_ts) AS session_start, max(event_ts) AS session_end, count(*)::INT AS n_events,
       max(CASE event_type WHEN 'page_view' THEN 1 WHEN 'add_to_cart' THEN 2
               WHEN 'checkout_start' THEN 3 WHEN 'purchase' THEN 4 END) AS rank,
       max(ingest_dt) AS last_arrival
FROM {{source}} GROUP BY session_id"""
define("s_ranked", SESSION_SQL.format(source="s_first_events"))
FLAGS_SQL = """
SELECT *, ['page_view', 'add_to_cart', 'checkout_start', 'purchase'][rank] AS furthest_stage,
       rank >= 1 AS viewed, rank >= 2 AS carted, rank >= 3 AS checkout_started,
       rank >= 4 AS purchased FROM """
define("s_sessions", FLAGS_SQL + "s_ranked")
define(
    "s_orders_utc",
    f"""
SELECT order_id, customer_id, customer_unique_id, order_status,
       {to_utc("order_purchase_timestamp")} AS purchase_ts,
       {to_utc("order_approved_at")} AS approved_ts,
       {to_utc("order_delivered_carrier_date")} AS carrier_ts,
       {to_utc("order_delivered_customer_date")} AS delivered_ts,
       {to_utc("order_estimated_delivery_date")} AS estimated_ts
FROM s_orders""",
)
define(
    "s_tagged_orders",
    """
SELECT *, concat_ws(',',
    CASE WHEN order_id IS NULL THEN 'null:order_id' END,
    CASE WHEN customer_id IS NULL THEN 'null:customer_id' END,
    CASE WHEN order_status IS NULL THEN 'null:order_status' END,
    CASE WHEN purchase_ts IS NULL THEN 'null:order_purchase_timestamp' END,
    CASE WHEN order_status = 'delivered' AND delivered_ts IS NULL
         THEN 'missing_when:order_delivered_customer_date:order_status=delivered' END,
    CASE WHEN row_number() OVER (PARTITION BY order_id ORDER BY purchase_ts) > 1
         THEN 'duplicate:order_id' END) AS dq_reason,
  concat_ws(',',
    CASE WHEN carrier_ts < approved_ts
         THEN 'date_order:order_delivered_carrier_date<order_approved_at' END,
    CASE WHEN delivered_ts < carrier_ts
         THEN 'date_order:order_delivered_customer_date<order_delivered_carrier_date' END)
    AS dq_warn
FROM s_orders_utc""",
)
define("s_clean_orders", "SELECT * FROM s_tagged_orders WHERE dq_reason = ''")
define(
    "s_feed",
    """
SELECT customer_unique_id, lpad(zip, 5, '0') AS zip, city, state, effective_date
FROM (SELECT s.*, row_number() OVER (PARTITION BY s.customer_unique_id, s.effective_date
             ORDER BY o.purchase_ts DESC, s.customer_id) AS rn
      FROM s_snapshots s JOIN s_clean_orders o USING (customer_id))
WHERE rn = 1""",
)
define(
    "s_dim_customer",
    """
SELECT customer_unique_id, zip, city, state, effective_date AS valid_from,
       lead(effective_date) OVER (PARTITION BY customer_unique_id ORDER BY effective_date)
           AS valid_to
FROM (SELECT *, lag((zip, city, state)) OVER w AS before, row_number() OVER w AS rn
      FROM s_feed WINDOW w AS (PARTITION BY customer_unique_id ORDER BY effective_date))
WHERE rn = 1 OR before IS DISTINCT FROM (zip, city, state)""",
)
define(
    "s_dim_product",
    """
SELECT product_id, p.product_category_name AS category_pt,
       coalesce(t.english, p.product_category_name, 'unknown') AS category_en,
       name_length, description_length, photos_qty, weight_g, length_cm, height_cm, width_cm
FROM s_products p LEFT JOIN s_translation t USING (product_category_name)""",
)
define(
    "s_gold_orders",
    f"""
SELECT o.order_id, o.customer_unique_id, {local_day("o.purchase_ts")} AS order_date,
       o.order_status, o.purchase_ts, o.approved_ts, o.carrier_ts AS delivered_carrier_ts,
       o.delivered_ts AS delivered_customer_ts, o.estimated_ts AS estimated_delivery_ts,
       CASE WHEN o.delivered_ts IS NOT NULL THEN o.delivered_ts > o.estimated_ts END
           AS delivered_late,
       coalesce(i.n, 0)::INT AS n_items, coalesce(i.price, 0)::DECIMAL(12,2) AS items_value,
       coalesce(i.freight, 0)::DECIMAL(12,2) AS freight_value,
       coalesce(p.paid, 0)::DECIMAL(12,2) AS payment_value
FROM s_clean_orders o
LEFT JOIN (SELECT order_id, count(*) AS n, sum(price) AS price, sum(freight_value) AS freight
           FROM s_items GROUP BY 1) i USING (order_id)
LEFT JOIN (SELECT order_id, sum(payment_value) AS paid FROM s_payments GROUP BY 1) p
     USING (order_id)""",
)
define(
    "s_gold_items",
    f"""
SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, o.customer_unique_id,
       {local_day("o.purchase_ts")} AS order_date, i.price, i.freight_value
FROM s_items i JOIN s_clean_orders o USING (order_id)""",
)
_VERSION = """
SELECT f.*, c.state AS customer_state, c.valid_from AS version_from
FROM {facts} f LEFT JOIN s_dim_customer c
  ON c.customer_unique_id = f.customer_unique_id AND f.order_date >= c.valid_from
 AND (c.valid_to IS NULL OR f.order_date < c.valid_to)"""
define("s_fact_orders", _VERSION.format(facts="s_gold_orders"))
define("s_fact_items", _VERSION.format(facts="s_gold_items"))
