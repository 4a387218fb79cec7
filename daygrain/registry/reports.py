"""Business reports and the benchmark queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.plans import distinct, kpi
from daygrain.plans.sessions import event_days
from daygrain.registry.base import pct, query
from daygrain.registry.star import Star

BENCH_DAY = "2024-01-15"


@query(
    "kpi1_funnel",
    f"""
SELECT *, {pct("carted", "viewed", 1)} AS view_to_cart_pct,
       {pct("checkout_started", "carted", 1)} AS cart_to_checkout_pct,
       {pct("purchased", "checkout_started", 1)} AS checkout_to_purchase_pct,
       {pct("purchased", "sessions", 2)} AS session_conversion_pct
FROM (SELECT strftime(session_date, '%Y-%m-%d') AS session_date, count(*) AS sessions,
             sum(viewed::INT)::BIGINT AS viewed, sum(carted::INT)::BIGINT AS carted,
             sum(checkout_started::INT)::BIGINT AS checkout_started,
             sum(purchased::INT)::BIGINT AS purchased FROM s_sessions GROUP BY 1)""",
)
def funnel(star: Star):
    return kpi.funnel(star.sessions)


@query(
    "kpi2_revenue",
    """
WITH per_order AS (
  SELECT order_id, product_id, customer_state, sum(price) AS worth, sum(freight_value) AS freight
  FROM s_fact_items WHERE version_from IS NOT NULL AND order_id IN
    (SELECT order_id FROM s_fact_orders WHERE order_status NOT IN ('canceled', 'unavailable'))
  GROUP BY ALL),
per_category AS (
  SELECT order_id, customer_state, sum(worth) AS worth, sum(freight) AS freight,
         (SELECT category_en FROM s_dim_product d WHERE d.product_id = per_order.product_id)
             AS category
  FROM per_order WHERE product_id IN (SELECT product_id FROM s_dim_product) GROUP BY ALL)
SELECT category, customer_state, count(*) AS orders, sum(worth)::DOUBLE AS revenue,
       sum(freight)::DOUBLE AS freight
FROM per_category GROUP BY ALL""",
)
def revenue(star: Star):
    return kpi.revenue_by_category_and_state(
        star.fact_items, star.gold_orders, star.dim_product, star.dim_customer
    )


@query(
    "kpi3_on_time",
    f"""
SELECT *, {pct("on_time", "delivered_orders", 1)} AS on_time_pct
FROM (SELECT strftime(order_date, '%Y-%m-%d') AS order_date, count(*) AS delivered_orders,
             sum((NOT delivered_late)::INT)::BIGINT AS on_time
      FROM s_gold_orders
      WHERE order_status = 'delivered' AND delivered_customer_ts IS NOT NULL GROUP BY 1)""",
)
def on_time(star: Star):
    return kpi.on_time(star.gold_orders)


@query(
    "kpi4_sellers",
    f"""
WITH sold AS (
  SELECT order_id, seller_id, sum(price) AS worth FROM s_gold_items GROUP BY ALL),
judged AS (
  SELECT seller_id, worth, delivered_late AS late FROM sold JOIN s_gold_orders USING (order_id)
  WHERE order_status NOT IN ('canceled', 'unavailable')),
ranked AS (
  SELECT seller_id, orders, revenue::DOUBLE AS revenue, {pct("n_late", "n_judged", 1)} AS late_pct,
         row_number() OVER (ORDER BY revenue DESC, seller_id) AS top,
         row_number() OVER (ORDER BY revenue, seller_id) AS bottom
  FROM (SELECT seller_id, count(*) AS orders, sum(worth) AS revenue, count(late) AS n_judged,
               count(*) FILTER (WHERE late) AS n_late FROM judged GROUP BY seller_id)
  WHERE orders >= 5)
SELECT bucket, seller_id, orders, revenue, late_pct
FROM ranked UNPIVOT (place FOR bucket IN (top, bottom)) WHERE place <= 10""",
)
def sellers(star: Star):
    return kpi.sellers(star.gold_items, star.gold_orders)


@query(
    "b1_events_by_type",
    f"""
SELECT event_type, count(*) AS n FROM s_clean_events WHERE ingest_dt = '{BENCH_DAY}' GROUP BY 1""",
)
def one_day(star: Star):
    return kpi.events_by_type(star.clean_events, BENCH_DAY)


@query(
    "b1_raw",
    f"SELECT event_type, count(*) AS n FROM s_events WHERE ingest_dt = '{BENCH_DAY}' GROUP BY 1",
)
def one_day_raw(star: Star):
    return kpi.events_by_type(star.raw_events, BENCH_DAY)


@query(
    "b2_sessions_by_type",
    "SELECT event_type, count(DISTINCT session_id) AS s FROM s_clean_events GROUP BY 1",
)
def stage_sessions(star: Star):
    return kpi.sessions_by_type(star.clean_events)


@query(
    "b2_by_bitmaps",
    """
SELECT 'all' AS days, event_type, count(DISTINCT session_id) AS s FROM s_clean_events GROUP BY 2
UNION ALL
SELECT 'late', event_type, count(DISTINCT session_id) FROM s_clean_events
WHERE ingest_dt > '2024-01-20' GROUP BY 2""",
)
def stage_sessions_by_bitmaps(star: Star):
    """The same counts from the days' bitmaps, over all days and over the later ones."""
    spark, at = star.spark, star.session_bitmaps_at
    late = [d for d in event_days(spark, star.clean_events_at) if d > "2024-01-20"]
    found = [("all", None), *([("late", late)] if late else [])]
    return reduce(DataFrame.unionByName, [
        distinct.count_distinct(spark, at, ["event_type"], days).select(
            F.lit(name).alias("days"), "event_type", F.col("n").alias("s")
        )
        for name, days in found
    ])


@query(
    "b2_raw", "SELECT event_type, count(DISTINCT session_id) AS s FROM s_events GROUP BY 1"
)
def stage_sessions_raw(star: Star):
    return kpi.sessions_by_type(star.raw_events)


@query(
    "b3_mobile_per_day",
    """
SELECT ingest_dt AS dt, count(*) AS n FROM s_clean_events WHERE device = 'mobile' GROUP BY 1""",
)
def mobile(star: Star):
    return kpi.device_events_per_day(star.clean_events)


@query(
    "b3_raw",
    "SELECT ingest_dt AS dt, count(*) AS n FROM s_events WHERE device = 'mobile' GROUP BY 1",
)
def mobile_raw(star: Star):
    return kpi.device_events_per_day(star.raw_events)


def _revenue_sql(orders: str, items: str) -> str:
    return f"""
SELECT o.order_status, count(DISTINCT o.order_id) AS orders, sum(i.price)::DOUBLE AS revenue
FROM {orders} o JOIN {items} i USING (order_id) GROUP BY 1"""


@query("b4_revenue_by_status", _revenue_sql("s_clean_orders", "s_items"))
def status_revenue(star: Star):
    return kpi.revenue_by_status(star.clean_orders, star.clean_items)


@query("b4_raw", _revenue_sql("s_orders", "s_lines"))
def status_revenue_raw(star: Star):
    return kpi.revenue_by_status(star.raw_orders, star.raw_items)
