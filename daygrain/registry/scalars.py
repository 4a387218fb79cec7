"""Single functions and primitives over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from daygrain.functions.time import date_key, iso_weekday, local_date, parse_ts, utc
from daygrain.functions.values import distinct_from, lookup, zip_code
from daygrain.operators.copies import keep_first
from daygrain.plans import kpi, profile
from daygrain.plans.gold import STAGES
from daygrain.plans.reconcile import only_in
from daygrain.registry.base import local_day, pct, query, to_utc, when
from daygrain.registry.star import Star


@query(
    "x1_parse_ts",
    f"""
SELECT event_id, ingest_dt, event_ts_raw,
       {when("try_cast(event_ts_raw AS TIMESTAMP)")} AS event_ts FROM s_events""",
)
def parse(star: Star):
    return parse_ts(star.events, "event_ts").select(
        "event_id", "ingest_dt", "event_ts_raw", "event_ts"
    )


@query(
    "x2_to_utc",
    f"SELECT o_orderkey, {when(to_utc('o_orderdate'))} AS purchase_utc FROM orders",
)
def into_utc(star: Star):
    return star.table("orders").select(
        "o_orderkey", utc(F.col("o_orderdate").cast("timestamp")).alias("purchase_utc")
    )


@query(
    "x3_local_date",
    f"""
SELECT event_id, {when("ts")} AS utc_ts, strftime({local_day("ts")}, '%Y-%m-%d') AS local_day
FROM events""",
)
def business_day(star: Star):
    """The event log read as UTC: late evenings belong to the day before."""
    ts = F.col("ts").cast("timestamp")
    return star.table("events").select(
        "event_id", ts.alias("utc_ts"), local_date(ts).alias("local_day")
    )


@query(
    "x6_date_parts",
    """
SELECT o_orderkey, year(o_orderdate)::INT AS year, quarter(o_orderdate)::INT AS quarter,
       month(o_orderdate)::INT AS month, day(o_orderdate)::INT AS day,
       isodow(o_orderdate)::INT AS weekday, dayname(o_orderdate) AS day_name,
       monthname(o_orderdate) AS month_name, strftime(o_orderdate, '%Y%m%d')::INT AS date_key
FROM orders""",
)
def date_parts(star: Star):
    day = F.col("o_orderdate").cast("date")
    return star.table("orders").select(
        "o_orderkey",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.day(day).alias("day"),
        iso_weekday(day).alias("weekday"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
        date_key(day).alias("date_key"),
    )


@query(
    "x9_lpad",
    "SELECT c_custkey, lpad(c_nationkey::VARCHAR, 5, '0') AS zip FROM customer",
)
def padded(star: Star):
    return star.table("customer").select("c_custkey", zip_code("c_nationkey").alias("zip"))


@query(
    "x12_map_lookup",
    """
SELECT event_type, CASE event_type WHEN 'page_view' THEN 1 WHEN 'add_to_cart' THEN 2
       WHEN 'checkout_start' THEN 3 WHEN 'purchase' THEN 4 END AS stage_rank,
       count(*) AS events FROM s_events GROUP BY 1, 2""",
)
def mapped(star: Star):
    """Stage rank by event type; a type that is no stage has none."""
    return (
        star.events.withColumn("stage_rank", lookup(STAGES, "event_type"))
        .groupBy("event_type", "stage_rank")
        .agg(F.count("*").alias("events"))
    )


@query(
    "x14_distinct_from",
    """
SELECT order_id, (order_approved_at, order_delivered_carrier_date) IS DISTINCT FROM
       (order_delivered_customer_date, order_approved_at) AS differs FROM s_orders""",
)
def differing(star: Star):
    left = [F.col("order_approved_at"), F.col("order_delivered_carrier_date")]
    right = [F.col("order_delivered_customer_date"), F.col("order_approved_at")]
    return star.orders.select("order_id", distinct_from(left, right).alias("differs"))


@query(
    "a3_distinct_filter",
    """
SELECT l_suppkey, count(DISTINCT l_orderkey) AS orders,
       count(DISTINCT l_orderkey) FILTER (WHERE l_returnflag = 'R') AS returned,
       count(DISTINCT l_orderkey) FILTER (WHERE l_linestatus = 'O') AS open
FROM lineitem GROUP BY 1""",
)
def filtered_distinct(star: Star):
    """Three distinct counts in two plain aggregations: flags per (supplier, order) first."""
    per_order = star.table("lineitem").groupBy("l_suppkey", "l_orderkey").agg(
        F.max(F.col("l_returnflag") == "R").alias("returned"),
        F.max(F.col("l_linestatus") == "O").alias("open"),
    )
    return per_order.groupBy("l_suppkey").agg(
        F.count("*").alias("orders"),
        F.count_if("returned").alias("returned"),
        F.count_if("open").alias("open"),
    )


@query(
    "f8_not_in",
    """
SELECT o_orderkey, o_orderstatus FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
)
def not_in(star: Star):
    returned = star.table("lineitem").where(F.col("l_returnflag") == "R")
    return (
        star.table("orders")
        .join(
            returned.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti"
        )
        .select("o_orderkey", "o_orderstatus")
    )


@query(
    "u2_difference",
    """
WITH a AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'A'),
     r AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'R')
SELECT k AS l_orderkey, 'a' AS side FROM a WHERE k NOT IN (SELECT k FROM r)
UNION ALL
SELECT k, 'b' FROM r WHERE k NOT IN (SELECT k FROM a)""",
)
def difference(star: Star):
    """Orders with accepted but no returned lines, and the other way round."""
    lines = star.table("lineitem")
    flag = F.col("l_returnflag")
    return only_in(lines.where(flag == "A"), lines.where(flag == "R"), "l_orderkey")


@query(
    "u3_dedupe",
    """
SELECT o_custkey, max(o_orderkey) AS o_orderkey, count(*) AS orders FROM orders GROUP BY 1""",
)
def one_per_key(star: Star):
    """Each customer's last order by key, with their number of orders."""
    orders = star.table("orders")
    last = keep_first(orders, "o_custkey", [F.col("o_orderkey").desc()])
    return last.select("o_custkey", "o_orderkey").join(
        orders.groupBy("o_custkey").agg(F.count("*").alias("orders")), "o_custkey"
    )


@query(
    "w4_share",
    f"""
SELECT event_type, count(*) AS events,
       {pct("count(*)", "(SELECT count(*) FROM events)", 2)} AS pct FROM events GROUP BY 1""",
)
def share(star: Star):
    return profile.shares(star.table("events"), "event_type", "events")


@query(
    "w5_rolling",
    """
SELECT strftime(day, '%Y-%m-%d') AS window_start, strftime(day + 6, '%Y-%m-%d') AS window_end,
       (sum(n) OVER (ORDER BY day ROWS BETWEEN CURRENT ROW AND 6 FOLLOWING))::BIGINT
           AS orders_in_window
FROM (SELECT l_shipdate::DATE AS day, count(*) AS n FROM lineitem GROUP BY 1)
ORDER BY orders_in_window DESC, window_start LIMIT 20""",
)
def rolling(star: Star):
    """The twenty weeks with the most shipped lines."""
    return profile.best_windows(star.table("lineitem"), "l_shipdate", days=7, k=20)


@query(
    "w5_calendar",
    """
SELECT o_orderpriority, strftime(day, '%Y-%m-%d') AS window_start,
       strftime(day + 29, '%Y-%m-%d') AS window_end,
       (sum(n) OVER (PARTITION BY o_orderpriority ORDER BY day
                     RANGE BETWEEN CURRENT ROW AND INTERVAL 29 DAYS FOLLOWING))::BIGINT
           AS orders_in_window
FROM (SELECT o_orderpriority, o_orderdate::DATE AS day, count(*) AS n FROM orders
      WHERE o_totalprice > 300000 GROUP BY 1, 2)""",
)
def rolling_calendar(star: Star):
    """Large orders of thirty calendar days per priority; most days have none."""
    day = F.col("o_orderdate").cast("date")
    daily = (
        star.table("orders").where("o_totalprice > 300000")
        .groupBy("o_orderpriority", day.alias("day")).agg(F.count("*").alias("orders"))
    )
    return profile.calendar_windows(daily, 30, "orders", keys=["o_orderpriority"])


@query(
    "l3_top_bottom",
    """
WITH c AS (SELECT o_custkey, sum(o_totalprice::DECIMAL(18,2)) AS spent FROM orders GROUP BY 1)
SELECT * FROM (SELECT 'top' AS bucket, o_custkey, spent::DOUBLE AS spent FROM c
               ORDER BY c.spent DESC, o_custkey LIMIT 10)
UNION ALL
SELECT * FROM (SELECT 'bottom' AS bucket, o_custkey, spent::DOUBLE AS spent FROM c
               ORDER BY c.spent, o_custkey LIMIT 10)""",
)
def extremes(star: Star):
    spent = star.table("orders").groupBy("o_custkey").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("spent")
    )
    return kpi.top_and_bottom(spent, "spent", "o_custkey")
