"""Reconciliation of source, quarantine, warehouse and copies of it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.plans import reconcile
from daygrain.plans.gold import build_sessions
from daygrain.plans.warehouse import merge_table
from daygrain.registry.base import define, pct, query, when
from daygrain.registry.merging import EVENTS_STORED_UPTO
from daygrain.registry.star import Star

FIRST, LAST = "1995-01-01", "2001-12-31"
# Rejected orders are asked for in a part of that window only.
REJECTED_FIRST, REJECTED_LAST = "1996-03-01", "1998-10-15"

define(
    "s_window",
    f"""
SELECT * FROM s_orders
WHERE order_purchase_timestamp::DATE BETWEEN DATE '{FIRST}' AND DATE '{LAST}'""",
)


def _source_sql(kept: str) -> str:
    its = f"FROM s_items WHERE order_id IN (SELECT order_id FROM {kept})"
    return f"""
SELECT 'orders' AS "check", count(*)::DECIMAL(38,2) AS value FROM {kept}
UNION ALL SELECT 'order items', count(*) {its}
UNION ALL SELECT 'items value', sum(price) {its}
UNION ALL SELECT 'freight value', sum(freight_value) {its}
UNION ALL SELECT 'payments', sum(payment_value) FROM s_payments
          WHERE order_id IN (SELECT order_id FROM {kept})
UNION ALL SELECT 'people who ordered', count(DISTINCT customer_unique_id) FROM {kept}
UNION ALL SELECT 'sessions', count(DISTINCT session_id) FROM s_clean_events
UNION ALL SELECT 'products', count(*) FROM s_products
UNION ALL SELECT 'sellers', count(*) FROM s_sellers"""


define("s_accepted", "SELECT * FROM s_window WHERE order_id IN (SELECT order_id FROM s_clean_orders)")
define("s_source_totals", _source_sql("s_window"))
define("s_kept_totals", _source_sql("s_accepted"))
define(
    "s_warehouse_totals",
    """
SELECT 'orders' AS "check", count(*)::DECIMAL(38,2) AS value FROM s_gold_orders
UNION ALL SELECT 'order items', count(*) FROM s_gold_items
UNION ALL SELECT 'items value', sum(items_value) FROM s_gold_orders
UNION ALL SELECT 'freight value', sum(freight_value) FROM s_gold_orders
UNION ALL SELECT 'payments', sum(payment_value) FROM s_gold_orders
UNION ALL SELECT 'people who ordered', count(DISTINCT customer_unique_id) FROM s_dim_customer
UNION ALL SELECT 'sessions', count(*) FROM s_sessions
UNION ALL SELECT 'products', count(*) FROM s_dim_product
UNION ALL SELECT 'sellers', count(*) FROM s_sellers""",
)


@query(
    "r1_three_way",
    """
SELECT "check", s.value::DOUBLE AS source, (s.value - k.value)::DOUBLE AS rejected,
       w.value::DOUBLE AS warehouse,
       CASE WHEN abs(k.value - w.value) < 0.005 THEN 'PASS' ELSE 'FAIL' END AS result
FROM s_source_totals s JOIN s_kept_totals k USING ("check") JOIN s_warehouse_totals w USING ("check")""",
)
def three_way(star: Star):
    window = reconcile.in_window(star.order_heads, FIRST, LAST)
    tables = star.warehouse
    direct, loaded = reconcile.direct_metrics(
        star.clean_events, star.products, star.sellers, tables
    )
    totals = reconcile.source_metrics(
        reconcile.with_verdict(window, star.quarantined_orders),
        star.order_items,
        star.order_payments,
        star.customer_snapshots,
    )
    return reconcile.three_way(
        totals.unionByName(direct), reconcile.warehouse_metrics(tables).unionByName(loaded)
    )


@query(
    "r2_rejected",
    f"""
SELECT order_id, order_status, dq_reason FROM s_tagged_orders
WHERE dq_reason <> '' AND order_id IN (
  SELECT order_id FROM s_orders WHERE order_purchase_timestamp >= DATE '{REJECTED_FIRST}'
  AND order_purchase_timestamp < DATE '{REJECTED_LAST}' + 1)""",
)
def rejected(star: Star):
    return reconcile.rejected_orders(
        star.quarantined_orders,
        reconcile.in_window(star.order_heads, REJECTED_FIRST, REJECTED_LAST),
    )


@query(
    "r3_derived",
    f"""
SELECT count(*) AS sessions, count(*) FILTER (WHERE purchased) AS purchased_sessions,
       (SELECT count(*) FROM s_gold_orders) AS orders,
       (SELECT count(*) FROM (SELECT 1 FROM s_dim_customer GROUP BY customer_unique_id
                              HAVING count(*) > 1)) AS people_with_history,
       {pct("count(*) FILTER (WHERE purchased)", "count(*)", 2)} AS conversion_pct
FROM s_sessions""",
)
def derived(star: Star):
    return reconcile.derived_facts(star.warehouse)


def stale_sessions(star: Star):
    """What a replay of an older day leaves: newer versions of its sessions are overwritten."""
    early = star.clean_events.where(F.col("ingest_dt") <= EVENTS_STORED_UPTO)
    return merge_table("fact_sessions", star.sessions, build_sessions(early))


define(
    "s_stale_sessions",
    """
SELECT s.session_id, coalesce(t.session_date, s.session_date) AS session_date,
       coalesce(t.n_events, s.n_events) AS n_events,
       coalesce(t.session_end, s.session_end) AS session_end,
       coalesce(t.furthest_stage, s.furthest_stage) AS furthest_stage,
       coalesce(t.purchased, s.purchased) AS purchased
FROM s_sessions s LEFT JOIN s_early_sessions t USING (session_id)""",
)


@query(
    "r4_two_copies",
    """
WITH o AS (SELECT count(*) AS n, count(*) FILTER (WHERE delivered_late) AS late,
                  sum(items_value) AS i, sum(freight_value) AS f, sum(payment_value) AS p
           FROM s_gold_orders),
it AS (SELECT count(*) AS n, sum(price) AS price FROM s_gold_items),
c AS (SELECT count(*) AS n, count(*) FILTER (WHERE valid_to IS NULL) AS cur FROM s_dim_customer),
m AS (
SELECT 'dim_date rows' AS "check", (SELECT count(*) FROM s_days)::DOUBLE AS v
UNION ALL SELECT 'dim_customer rows', n FROM c
UNION ALL SELECT 'dim_customer current rows', cur FROM c
UNION ALL SELECT 'dim_product rows', (SELECT count(*) FROM s_products)
UNION ALL SELECT 'dim_seller rows', (SELECT count(*) FROM s_sellers)
UNION ALL SELECT 'fact_orders rows', n FROM o
UNION ALL SELECT 'fact_order_items rows', n FROM it
UNION ALL SELECT 'fact_sessions rows', (SELECT count(*) FROM s_sessions)
UNION ALL SELECT 'sessions purchased', (SELECT count(*) FROM s_sessions WHERE purchased)
UNION ALL SELECT 'orders delivered_late', late FROM o
UNION ALL SELECT 'sum items_value', i::DOUBLE FROM o
UNION ALL SELECT 'sum freight_value', f::DOUBLE FROM o
UNION ALL SELECT 'sum payment_value', p::DOUBLE FROM o
UNION ALL SELECT 'sum item price', price::DOUBLE FROM it),
b AS (SELECT "check", CASE WHEN "check" = 'sessions purchased'
             THEN (SELECT count(*) FROM s_stale_sessions WHERE purchased) ELSE v END AS w FROM m)
SELECT "check", v AS copy_a, w::DOUBLE AS copy_b, v = w AS same FROM m JOIN b USING ("check")""",
)
def two_copies(star: Star):
    """The warehouse against a copy in which an older day of sessions was replayed last."""
    tables = star.warehouse
    copy = {**tables, "fact_sessions": stale_sessions(star)}
    return reconcile.two_copies(reconcile.copy_metrics(tables), reconcile.copy_metrics(copy))


def _side(suffix: str) -> str:
    t = suffix
    return f"""strftime({t}.session_date, '%Y-%m-%d') AS session_date_{t},
       {t}.n_events AS n_events_{t}, {when(f"{t}.session_end")} AS session_end_{t},
       {t}.furthest_stage AS furthest_stage_{t}, {t}.purchased AS purchased_{t}"""


define(
    "s_session_diff",
    f"""
SELECT session_id, CASE WHEN a.purchased THEN 'a' ELSE 'b' END AS side, {_side("a")}, {_side("b")}
FROM s_sessions a JOIN s_stale_sessions b USING (session_id)
WHERE a.purchased IS DISTINCT FROM b.purchased""",
)


@query("r5_session_diff", "SELECT * FROM s_session_diff")
def session_diff(star: Star):
    """Every session only one copy calls purchased, both rows side by side."""
    return reconcile.session_diff(star.sessions, stale_sessions(star))


@query(
    "r5_session_diff_days",
    """
SELECT coalesce(session_date_a, session_date_b) AS session_date, count(*) AS sessions
FROM s_session_diff GROUP BY 1""",
)
def session_diff_days(star: Star):
    return reconcile.session_diff_by_day(
        reconcile.session_diff(star.sessions, stale_sessions(star))
    )


_SHOWN = ("session_date", "n_events", "session_end", "furthest_stage", "purchased")
_CHANGED = ", ".join(f"CASE WHEN a.{c} IS DISTINCT FROM b.{c} THEN '{c}' END" for c in _SHOWN)


@query(
    "r5_row_difference",
    f"""
SELECT 'fact_orders' AS "table", order_id AS key,
       CASE WHEN order_id LIKE '%123' THEN 'only_a' ELSE 'changed' END AS kind,
       CASE WHEN order_id LIKE '%77' THEN 'payment_value' END AS columns
FROM s_gold_orders WHERE order_id LIKE '%123' OR order_id LIKE '%77' AND payment_value IS NOT NULL
UNION ALL
SELECT 'fact_order_items', order_id || '/' || order_item_id, 'only_b', NULL
FROM s_gold_items WHERE order_id LIKE '%55'
UNION ALL
SELECT 'fact_sessions', session_id, 'changed', columns
FROM (SELECT session_id, concat_ws(',', {_CHANGED}) AS columns
      FROM s_sessions a JOIN s_stale_sessions b USING (session_id))
WHERE columns <> ''""",
)
def row_difference(star: Star):
    """Two copies of three tables: cells changed, rows that only one side has, sessions replayed."""
    ends = lambda text: F.col("order_id").endswith(text)
    orders, items = star.gold_orders, star.gold_items
    more = F.when(ends("77"), F.col("payment_value") + 1).otherwise(F.col("payment_value"))
    kind = dict(orders.dtypes)["payment_value"]
    shown = ["session_id", *_SHOWN]
    copies = {
        "fact_orders": (orders, orders.withColumn("payment_value", more.cast(kind)).where(~ends("123")), ["order_id"]),
        "fact_order_items": (items.where(~ends("55")), items, ["order_id", "order_item_id"]),
        "fact_sessions": (star.sessions.select(shown), stale_sessions(star).select(shown), ["session_id"]),
    }
    found = [
        reconcile.row_difference(a, b, keys).select(
            F.lit(table).alias("table"), F.concat_ws("/", *keys).alias("key"), "kind",
            F.array_join("columns", ",").alias("columns"),
        )
        for table, (a, b, keys) in copies.items()
    ]
    return reduce(DataFrame.unionByName, found)


@query(
    "r6_event_funnel",
    f"""
SELECT event_type, count(*) AS events,
       {pct("count(*)", "(SELECT count(*) FROM s_clean_events WHERE event_type = 'page_view')", 1)}
       AS pct_of_first
FROM s_clean_events GROUP BY 1""",
)
def event_funnel(star: Star):
    return reconcile.event_funnel(star.clean_events, "page_view")


@query(
    "r7_converting_orders",
    f"""
SELECT o.order_id, o.customer_unique_id, {when("o.order_purchase_timestamp")} AS purchase_ts,
       i.product_id
FROM s_window o LEFT JOIN s_items i ON i.order_id = o.order_id AND i.order_item_id = 1""",
)
def converting(star: Star):
    orders = star.order_heads.select("order_id", "customer_id", "order_purchase_timestamp")
    return reconcile.converting_orders(
        orders, star.customer_snapshots, star.order_items, FIRST, LAST
    )
