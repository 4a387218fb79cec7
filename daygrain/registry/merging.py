"""Merges, customer history and the version valid on a date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.operators.copies import copies_per_key
from daygrain.operators.merge import upsert
from daygrain.operators.versions import SURROGATE, apply_feed, as_of, history
from daygrain.plans.gold import build_sessions
from daygrain.plans.warehouse import merge_table
from daygrain.registry.base import define, query, when
from daygrain.registry.shared_sql import FLAGS_SQL, SESSION_SQL
from daygrain.registry.star import Star

# The stored state of the merge queries ends here, and the staged one starts a year earlier.
STORED_UPTO, STAGED_FROM = "1999-01-01", "1998-01-01"
FIRST_LINES_UPTO = "1995-07-01"
EVENTS_STORED_UPTO = "2024-01-20"


def _line_facts(star: Star, condition) -> DataFrame:
    """What a set of order lines tells about the products in it."""
    lines = star.table("lineitem").where(condition).groupBy("l_partkey").agg(
        F.max("l_quantity").cast("int").alias("weight_g"),
        F.min("l_discount").cast("decimal(12,2)").alias("discount"),
    )
    names = star.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    return lines.join(names, "l_partkey").select(
        F.col("l_partkey").alias("product_id"), F.col("p_type").alias("category"),
        "weight_g", "discount",
    )


def _product_sql(take: str) -> str:
    return f"""
WITH f AS (SELECT l_partkey AS product_id, p_type AS category, l_shipdate,
                  l_quantity::INT AS weight_g, l_discount::DECIMAL(12,2) AS discount
           FROM lineitem JOIN part ON p_partkey = l_partkey),
t AS (SELECT product_id, category, max(weight_g) AS weight_g, min(discount) AS discount
      FROM f WHERE l_shipdate < TIMESTAMP '{FIRST_LINES_UPTO}' GROUP BY 1, 2),
s AS (SELECT product_id, category, max(weight_g) AS weight_g, min(discount) AS discount
      FROM f WHERE l_shipdate >= TIMESTAMP '{FIRST_LINES_UPTO}' GROUP BY 1, 2)
SELECT product_id, coalesce(s.category, t.category) AS category,
       coalesce(s.weight_g, t.weight_g) AS weight_g,
       coalesce(s.discount, t.discount)::DOUBLE AS discount,
       CASE WHEN t.product_id IS NULL THEN 'insert'
            WHEN s.product_id IS NOT NULL AND ({take}) THEN 'update' ELSE 'keep' END AS action
FROM t FULL JOIN s USING (product_id)"""


def _upsert_products(star: Star, when_changed: bool) -> DataFrame:
    ship = F.col("l_shipdate")
    cut = F.lit(FIRST_LINES_UPTO).cast("date")
    return upsert(
        _line_facts(star, ship < cut),
        _line_facts(star, ship >= cut),
        ["product_id"],
        when_changed=when_changed,
        action="action",
    )


@query(
    "m1_upsert_product",
    _product_sql(
        "(t.category, t.weight_g, t.discount) IS DISTINCT FROM (s.category, s.weight_g, s.discount)"
    ),
)
def upsert_changed(star: Star):
    """Products as the first lines show them, merged with what all later lines show."""
    return _upsert_products(star, True)


@query("m2_upsert_always", _product_sql("true"))
def upsert_always(star: Star):
    return _upsert_products(star, False)


_VERSIONS = """
SELECT customer_unique_id, zip, city, state, strftime(valid_from, '%Y-%m-%d') AS valid_from,
       strftime(valid_to, '%Y-%m-%d') AS valid_to, valid_to IS NULL AS is_current
FROM s_dim_customer"""


@query("m3_scd2_replay", _VERSIONS)
def replayed(star: Star):
    """History up to the last three days of the feed, then these days applied one by one."""
    feed = star.feed
    day = F.col("effective_date")
    last = [r[0] for r in feed.select(day).distinct().orderBy(day.desc()).limit(3).collect()]
    dim = history(feed.where(day < min(last)))
    for dt in sorted(last):
        dim = apply_feed(dim, feed.where(day == dt))
    return dim.drop(SURROGATE)


@query("m3b_scd2_history", _VERSIONS)
def whole_history(star: Star):
    return history(star.feed).drop(SURROGATE)


@query(
    "m4_surrogate_keys",
    "SELECT count(*) AS versions, count(*) AS keys, 0 AS shared_keys FROM s_dim_customer",
)
def surrogates(star: Star):
    """Versions, distinct surrogate keys, and keys that more than one version has."""
    shared = copies_per_key(star.dim_customer, SURROGATE).agg(F.count("*").alias("n"))
    return star.dim_customer.agg(
        F.count("*").alias("versions"), F.count_distinct(SURROGATE).alias("keys")
    ).withColumn("shared_keys", shared.scalar())


@query(
    "j5_point_in_time",
    """
SELECT order_id, customer_unique_id, strftime(order_date, '%Y-%m-%d') AS order_date,
       customer_state, strftime(version_from, '%Y-%m-%d') AS version_from FROM s_fact_orders""",
)
def point_in_time(star: Star):
    orders = star.gold_orders.select("order_id", "customer_unique_id", "order_date")
    versions = star.dim_customer.withColumns(
        {"customer_state": F.col("state"), "version_from": F.col("valid_from")}
    )
    return as_of(orders, versions, "order_date", ["customer_state", "version_from"])


define(
    "s_stored_orders",
    f"""
SELECT order_id, customer_unique_id, order_date, version_from, 'created' AS order_status,
       payment_value FROM s_fact_orders WHERE order_date < DATE '{STORED_UPTO}'""",
)


@query(
    "m5_fact_orders_merge",
    f"""
WITH s AS (SELECT * FROM s_fact_orders WHERE order_date >= DATE '{STAGED_FROM}')
SELECT order_id, coalesce(t.customer_unique_id, s.customer_unique_id) AS customer_unique_id,
       strftime(coalesce(t.order_date, s.order_date), '%Y-%m-%d') AS order_date,
       strftime(coalesce(s.version_from, t.version_from), '%Y-%m-%d') AS version_from,
       coalesce(s.order_status, t.order_status) AS order_status,
       coalesce(s.payment_value, t.payment_value)::DOUBLE AS payment_value,
       CASE WHEN t.order_id IS NULL THEN 'insert' WHEN s.order_id IS NULL THEN 'keep'
            ELSE 'update' END AS action
FROM s_stored_orders t FULL JOIN s USING (order_id)""",
)
def merge_orders(star: Star):
    """Orders stored as just created, merged with a year of them and all newer ones as they
    are now, each staged order with the customer version of its day."""
    stored = star.fact_orders.where(
        F.col("order_date") < F.lit(STORED_UPTO).cast("date")
    ).withColumn("order_status", F.lit("created"))
    staged = star.gold_orders.where(F.col("order_date") >= F.lit(STAGED_FROM).cast("date"))
    staged = as_of(staged, star.dim_customer, "order_date")
    merged = merge_table("fact_orders", stored, staged, action="action")
    return star.with_version(merged).select(
        "order_id", "customer_unique_id", "order_date", "version_from", "order_status",
        "payment_value", "action",
    )


@query(
    "m6_items_merge",
    f"""
WITH t AS (SELECT * REPLACE (CASE WHEN price > 50000 THEN price ELSE 0 END AS price)
           FROM s_fact_items WHERE order_date < DATE '{STORED_UPTO}'),
s AS (SELECT * FROM s_fact_items WHERE order_date >= DATE '{STAGED_FROM}')
SELECT order_id, order_item_id, coalesce(s.product_id, t.product_id) AS product_id,
       coalesce(s.price, t.price)::DOUBLE AS price,
       strftime(coalesce(t.order_date, s.order_date), '%Y-%m-%d') AS order_date,
       CASE WHEN t.order_id IS NULL THEN 'insert'
            WHEN s.order_id IS NOT NULL AND t.price <> s.price THEN 'update'
            ELSE 'keep' END AS action
FROM t FULL JOIN s USING (order_id, order_item_id)""",
)
def merge_items(star: Star):
    """Items stored without the price of cheap ones, merged with a year of them and all newer
    ones on the composite key."""
    day, price = F.col("order_date"), F.col("price")
    stored = star.fact_items.where(day < F.lit(STORED_UPTO).cast("date")).withColumn(
        "price", F.when(price > 50000, price).otherwise(0).cast("decimal(10,2)")
    )
    staged = star.gold_items.where(day >= F.lit(STAGED_FROM).cast("date"))
    staged = as_of(staged, star.dim_customer, "order_date")
    merged = merge_table("fact_order_items", stored, staged, action="action")
    return merged.select(
        "order_id", "order_item_id", "product_id", "price", "order_date", "action"
    )


define(
    "s_early_events",
    f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ingest_dt, event_ts)
               AS arrival FROM s_clean_events WHERE ingest_dt <= '{EVENTS_STORED_UPTO}')
WHERE arrival = 1""",
)
define("s_early_ranked", SESSION_SQL.format(source="s_early_events"))
define("s_early_sessions", FLAGS_SQL + "s_early_ranked")


@query(
    "m7_sessions_merge",
    f"""
SELECT s.session_id, s.n_events, {when("s.session_end")} AS session_end, s.furthest_stage,
       s.purchased,
       CASE WHEN t.session_id IS NULL THEN 'insert'
            WHEN (t.n_events, t.session_start, t.session_end, t.furthest_stage)
                 IS DISTINCT FROM (s.n_events, s.session_start, s.session_end, s.furthest_stage)
            THEN 'update' ELSE 'keep' END AS action
FROM s_sessions s LEFT JOIN s_early_sessions t USING (session_id)""",
)
def merge_sessions(star: Star):
    """Sessions as known on an earlier day, replaced by what the whole history makes of them."""
    early = star.clean_events.where(F.col("ingest_dt") <= EVENTS_STORED_UPTO)
    merged = merge_table("fact_sessions", build_sessions(early), star.sessions, action="action")
    return merged.select(
        "session_id", "n_events", "session_end", "furthest_stage", "purchased", "action"
    )


@query(
    "m8_version_guard",
    f"""
SELECT session_id, n_events, {when("session_end")} AS session_end, furthest_stage, purchased
FROM s_sessions""",
)
def guarded(star: Star):
    """The older state merged over the newer one: the guard keeps sessions with more events."""
    early = star.clean_events.where(F.col("ingest_dt") <= EVENTS_STORED_UPTO)
    merged = merge_table(
        "fact_sessions", star.sessions, build_sessions(early), version_guard=True
    )
    return merged.select(
        "session_id", "n_events", "session_end", "furthest_stage", "purchased"
    )
