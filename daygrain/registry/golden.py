"""Gold builders: sessions, feed, facts, dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from daygrain.plans import gold
from daygrain.plans.gold import build_sessions
from daygrain.plans.sessions import event_days, touched_events
from daygrain.registry.base import query, when
from daygrain.registry.shared_sql import FLAGS_SQL
from daygrain.registry.star import Star

_SESSION_COLUMNS = f"""
SELECT session_id, customer_unique_id, strftime(session_date, '%Y-%m-%d') AS session_date, device,
       {when("session_start")} AS session_start, {when("session_end")} AS session_end, n_events,
       furthest_stage, viewed, carted, checkout_started, purchased FROM """


@query(
    "g5_dedupe_events",
    f"""
SELECT event_id, session_id, ingest_dt, {when("event_ts")} AS event_ts FROM s_first_events""",
)
def first_arrivals(star: Star):
    return gold.dedupe_events(star.clean_events).select(
        "event_id", "session_id", "ingest_dt", "event_ts"
    )


@query("g6_sessions", _SESSION_COLUMNS + "s_sessions")
def sessions(star: Star):
    """Every session from the whole event history."""
    return star.build_sessions()


@query(
    "g6_sessions_of_day",
    _SESSION_COLUMNS
    + f"""({FLAGS_SQL} s_ranked)
WHERE last_arrival = (SELECT max(ingest_dt) FROM s_clean_events)""",
)
def sessions_of_day(star: Star):
    """Sessions the last arrival day touched, each with all its history."""
    last = star.events.agg(F.max("ingest_dt")).first()[0]
    return star.build_sessions(last)


@query(
    "g6_sessions_by_index",
    _SESSION_COLUMNS
    + f"""({FLAGS_SQL} s_ranked)
WHERE last_arrival = (SELECT max(ingest_dt) FROM s_clean_events)""",
)
def sessions_by_index(star: Star):
    """The same sessions, read from the days that the index of the event zone names."""
    days = event_days(star.spark, star.clean_events_at)
    found = touched_events(star.spark, star.clean_events_at, star.event_index_at, max(days))
    return build_sessions(found, max(days))


@query(
    "g7_customer_feed",
    """
SELECT customer_unique_id, zip, city, state,
       strftime(effective_date, '%Y-%m-%d') AS effective_date FROM s_feed""",
)
def feed(star: Star):
    return star.build_feed()


@query(
    "g8_fact_orders",
    f"""
SELECT order_id, customer_unique_id, strftime(order_date, '%Y-%m-%d') AS order_date, order_status,
       {when("purchase_ts")} AS purchase_ts, {when("approved_ts")} AS approved_ts,
       {when("delivered_carrier_ts")} AS delivered_carrier_ts,
       {when("delivered_customer_ts")} AS delivered_customer_ts,
       {when("estimated_delivery_ts")} AS estimated_delivery_ts, delivered_late, n_items,
       items_value::DOUBLE AS items_value, freight_value::DOUBLE AS freight_value,
       payment_value::DOUBLE AS payment_value FROM s_gold_orders""",
)
def fact_orders(star: Star):
    return star.build_fact_orders()


@query(
    "g9_fact_items",
    """
SELECT order_id, order_item_id, product_id, seller_id, customer_unique_id,
       strftime(order_date, '%Y-%m-%d') AS order_date, price::DOUBLE AS price,
       freight_value::DOUBLE AS freight_value FROM s_gold_items""",
)
def fact_items(star: Star):
    return star.build_fact_items()


@query(
    "g9_items_without_order",
    """
SELECT order_id, order_item_id, product_id FROM s_items
WHERE order_id NOT IN (SELECT order_id FROM s_clean_orders)""",
)
def lost_items(star: Star):
    """Items the fact leaves out because quality rules rejected their order."""
    return gold.items_without_order(star.clean_orders, star.clean_items).select(
        "order_id", "order_item_id", "product_id"
    )


@query("g10_dim_product", "SELECT * FROM s_dim_product")
def dim_product(star: Star):
    return star.build_dim_product()


@query(
    "g11_dim_seller",
    "SELECT seller_id, lpad(zip, 5, '0') AS zip, city, state FROM s_sellers",
)
def dim_seller(star: Star):
    return star.build_dim_seller()


@query(
    "g13_dim_date",
    """
SELECT strftime(d, '%Y%m%d')::INT AS date_key, strftime(d, '%Y-%m-%d') AS full_date,
       year(d)::INT AS year, quarter(d)::INT AS quarter, month(d)::INT AS month,
       monthname(d) AS month_name, day(d)::INT AS day, isodow(d)::INT AS day_of_week,
       dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend,
       d::DATE = DATE '2017-11-24' AS is_black_friday
FROM (SELECT unnest(generate_series(first, last, INTERVAL 1 DAY)) AS d
      FROM (SELECT least((SELECT min(o_orderdate)::DATE FROM orders),
                         (SELECT min(ts)::DATE FROM events)) AS first,
                   greatest((SELECT max(o_orderdate)::DATE FROM orders),
                            (SELECT max(ts)::DATE FROM events)) AS last))""",
)
def dim_date(star: Star):
    """The calendar over all days on which something was ordered or browsed."""
    return star.build_dim_date()


@query(
    "d1_dim_geo",
    """
SELECT zip, count(*) AS points, sum(lat::DECIMAL(18,6))::DOUBLE / count(*) AS lat,
       sum(lng::DECIMAL(18,6))::DOUBLE / count(*) AS lng FROM s_points GROUP BY 1""",
)
def centroids(star: Star):
    return gold.dim_geo(star.geolocation)


@query(
    "d2_latest_review",
    f"""
SELECT order_id, review_id, {when("review_answer_timestamp")} AS review_answer_timestamp
FROM (SELECT *, row_number() OVER (PARTITION BY order_id
             ORDER BY review_answer_timestamp DESC, review_id) AS rn FROM s_reviews)
WHERE rn = 1""",
)
def last_review(star: Star):
    return gold.latest_reviews(star.order_reviews).select(
        "order_id", "review_id", "review_answer_timestamp"
    )


@query(
    "d3_seed_categories",
    """
SELECT coalesce(t.english, CASE p.product_category_name WHEN 'PROMO' THEN 'promotion' END,
                p.product_category_name, 'unknown') AS category_en, count(*) AS products
FROM s_products p LEFT JOIN s_translation t USING (product_category_name) GROUP BY 1""",
)
def seeded_categories(star: Star):
    """Products per category when a seed mapping fills in what the translation table lacks."""
    seed = star.spark.createDataFrame([("PROMO", "promotion")], star.translation.schema)
    known = star.translation.unionByName(seed)
    return (
        gold.build_dim_product(star.products, known)
        .groupBy("category_en")
        .agg(F.count("*").alias("products"))
    )
