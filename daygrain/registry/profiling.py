"""Profiling of the source tables, in the sources' own wall clock."""

from __future__ import annotations

from pyspark.sql import functions as F

from daygrain.plans import profile
from daygrain.registry.base import pct, query, when
from daygrain.registry.star import Star

_PURCHASE = "order_purchase_timestamp"
_DELIVERED, _ESTIMATED = "order_delivered_customer_date", "order_estimated_delivery_date"
_CARRIER, _APPROVED = "order_delivered_carrier_date", "order_approved_at"


@query(
    "p1_row_counts",
    """
SELECT 'orders' AS "table", count(*) AS rows FROM s_orders
UNION ALL SELECT 'items', count(*) FROM s_lines
UNION ALL SELECT 'customers', count(*) FROM s_snapshots
UNION ALL SELECT 'products', count(*) FROM s_products
UNION ALL SELECT 'sellers', count(*) FROM s_sellers
UNION ALL SELECT 'payments', count(*) FROM s_payments
UNION ALL SELECT 'reviews', count(*) FROM s_reviews
UNION ALL SELECT 'geolocation', count(*) FROM s_points
UNION ALL SELECT 'translation', count(*) FROM s_translation""",
)
def row_counts(star: Star):
    return profile.row_counts(
        {
            "orders": star.order_heads,
            "items": star.all_lines,
            "customers": star.customer_snapshots,
            "products": star.products,
            "sellers": star.sellers,
            "payments": star.order_payments,
            "reviews": star.order_reviews,
            "geolocation": star.geolocation,
            "translation": star.translation,
        }
    )


@query(
    "p2_key_unique",
    "SELECT count(*) AS rows, count(DISTINCT o_orderkey) AS distinct_ids FROM orders",
)
def key_unique(star: Star):
    return profile.distinct_counts(star.order_heads, distinct_ids="order_id")


@query(
    "p3_ids_and_people",
    """
SELECT count(*) AS rows, count(DISTINCT customer_id) AS distinct_customer_id,
       count(DISTINCT customer_unique_id) AS distinct_real_people FROM s_snapshots""",
)
def ids_and_people(star: Star):
    return profile.distinct_counts(
        star.customer_snapshots,
        distinct_customer_id="customer_id",
        distinct_real_people="customer_unique_id",
    )


@query(
    "p4_people_with_many_ids",
    """
SELECT count(*) AS people_ordering_again
FROM (SELECT 1 FROM s_snapshots GROUP BY customer_unique_id HAVING count(*) > 1)""",
)
def many_ids(star: Star):
    return profile.repeated_keys(
        star.customer_snapshots, "customer_unique_id", "people_ordering_again"
    )


@query(
    "p5_items_per_order",
    f"""
SELECT count(DISTINCT order_id) AS orders, count(*) AS items,
       max(order_item_id) AS max_items_in_one_order,
       {pct("count(*)", "count(DISTINCT order_id)", 2, times=1)} AS avg_items_per_order
FROM s_lines""",
)
def items_per_order(star: Star):
    per_order = profile.rows_per_group(
        star.all_lines, "order_id", "order_item_id", ("orders", "items", "max_items_in_one_order")
    )
    return profile.average(per_order, "items", "orders", "avg_items_per_order")


@query(
    "p6_payments_per_order",
    """
SELECT count(DISTINCT order_id) AS orders, count(*) AS payments,
       max(payment_sequential) AS max_payments_in_one_order FROM s_payments""",
)
def payments_per_order(star: Star):
    return profile.rows_per_group(
        star.order_payments,
        "order_id",
        "payment_sequential",
        ("orders", "payments", "max_payments_in_one_order"),
    )


@query(
    "p7_review_keys",
    """
SELECT count(*) AS rows, count(DISTINCT review_id) AS distinct_review_ids,
       count(DISTINCT order_id) AS distinct_orders FROM s_reviews""",
)
def review_keys(star: Star):
    return profile.distinct_counts(
        star.order_reviews, distinct_review_ids="review_id", distinct_orders="order_id"
    )


@query(
    "p8_orders_with_many_reviews",
    """
SELECT count(*) AS orders_with_multiple_reviews
FROM (SELECT 1 FROM s_reviews GROUP BY order_id HAVING count(*) > 1)""",
)
def many_reviews(star: Star):
    return profile.repeated_keys(star.order_reviews, "order_id", "orders_with_multiple_reviews")


@query("p9_zips", "SELECT count(*) AS rows, count(DISTINCT zip) AS distinct_zips FROM s_points")
def zips(star: Star):
    return profile.distinct_counts(star.geolocation, distinct_zips="zip")


@query(
    "p10_date_range",
    f"""
SELECT {when("min(o_orderdate)")} AS first_order, {when("max(o_orderdate)")} AS last_order
FROM orders""",
)
def date_range(star: Star):
    return profile.date_range(star.order_heads, _PURCHASE)


@query(
    "p11_orders_per_month",
    "SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS orders FROM orders GROUP BY 1",
)
def per_month(star: Star):
    return profile.per_month(star.order_heads, _PURCHASE)


@query(
    "p12_busiest_days",
    """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS orders
FROM orders GROUP BY 1 ORDER BY orders DESC, day LIMIT 20""",
)
def busiest(star: Star):
    return profile.busiest_days(star.order_heads, _PURCHASE)


@query(
    "p13_daily_volume",
    """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS orders FROM orders
WHERE o_orderdate >= '1997-11-10' AND o_orderdate < '1997-12-10' GROUP BY 1""",
)
def volume(star: Star):
    return profile.daily_volume(star.order_heads, _PURCHASE, "1997-11-10", "1997-12-09")


@query(
    "p14_best_window",
    """
SELECT strftime(day, '%Y-%m-%d') AS window_start, strftime(day + 10, '%Y-%m-%d') AS window_end,
       (sum(n) OVER (ORDER BY day ROWS BETWEEN CURRENT ROW AND 10 FOLLOWING))::BIGINT
           AS orders_in_window
FROM (SELECT o_orderdate::DATE AS day, count(*) AS n FROM orders GROUP BY 1)
ORDER BY orders_in_window DESC, window_start LIMIT 5""",
)
def best_window(star: Star):
    return profile.best_windows(star.order_heads, _PURCHASE)


@query(
    "p15_status_share",
    f"""
SELECT order_status, count(*) AS orders,
       {pct("count(*)", "(SELECT count(*) FROM orders)", 2)} AS pct FROM s_orders GROUP BY 1""",
)
def status_share(star: Star):
    return profile.shares(star.order_heads, "order_status")


def _null_pct(column: str, name: str) -> str:
    return f"{pct(f'count(*) FILTER (WHERE {column} IS NULL)', 'count(*)', 2)} AS {name}"


@query(
    "p16_order_nulls",
    f"""
SELECT count(*) AS n, {_null_pct(_APPROVED, "approved_null_pct")},
       {_null_pct(_CARRIER, "carrier_null_pct")}, {_null_pct(_DELIVERED, "delivered_null_pct")},
       {_null_pct(_ESTIMATED, "estimated_null_pct")} FROM s_orders""",
)
def order_nulls(star: Star):
    return profile.null_rates(
        star.orders,
        approved_null_pct=_APPROVED,
        carrier_null_pct=_CARRIER,
        delivered_null_pct=_DELIVERED,
        estimated_null_pct=_ESTIMATED,
    )


@query(
    "p17_undelivered_by_status",
    f"""
SELECT order_status, count(*) AS orders,
       count(*) FILTER (WHERE {_DELIVERED} IS NULL) AS null_delivered FROM s_orders GROUP BY 1""",
)
def undelivered(star: Star):
    return profile.nulls_by(star.orders, "order_status", _DELIVERED, "null_delivered")


@query(
    "p18_delivered_without_date",
    f"""
SELECT count(*) AS delivered_undated FROM s_orders
WHERE order_status = 'delivered' AND {_DELIVERED} IS NULL""",
)
def without_date(star: Star):
    condition = (F.col("order_status") == "delivered") & F.col(_DELIVERED).isNull()
    return profile.count_where(star.orders, condition, "delivered_undated")


@query(
    "p19_review_nulls",
    f"""
SELECT count(*) AS n, {_null_pct("review_comment_title", "title_null_pct")},
       {_null_pct("review_comment_message", "message_null_pct")},
       {_null_pct("review_score", "score_null_pct")} FROM s_reviews""",
)
def review_nulls(star: Star):
    return profile.null_rates(
        star.order_reviews,
        title_null_pct="review_comment_title",
        message_null_pct="review_comment_message",
        score_null_pct="review_score",
    )


@query(
    "p20_product_nulls",
    f"""
SELECT count(*) AS n, {_null_pct("product_category_name", "category_null_pct")},
       {_null_pct("weight_g", "weight_null_pct")}, {_null_pct("photos_qty", "photos_null_pct")}
FROM s_products""",
)
def product_nulls(star: Star):
    return profile.null_rates(
        star.products,
        category_null_pct="product_category_name",
        weight_null_pct="product_weight_g",
        photos_null_pct="product_photos_qty",
    )


@query(
    "p21_duplicate_keys",
    """
SELECT 'orders' AS tbl, count(*) - count(DISTINCT order_id) AS dup_keys FROM s_orders
UNION ALL SELECT 'order_items', count(*) - count(DISTINCT (order_id, order_item_id)) FROM s_lines
UNION ALL SELECT 'payments', count(*) - count(DISTINCT (order_id, payment_sequential))
          FROM s_payments
UNION ALL SELECT 'products', count(*) - count(DISTINCT product_id) FROM s_products
UNION ALL SELECT 'sellers', count(*) - count(DISTINCT seller_id) FROM s_sellers
UNION ALL SELECT 'events', count(*) - count(DISTINCT event_id) FROM s_events
UNION ALL SELECT 'reviews (review_id)', count(*) - count(DISTINCT review_id) FROM s_reviews""",
)
def duplicates(star: Star):
    return profile.duplicate_keys(
        {
            "orders": (star.order_heads, ["order_id"]),
            "order_items": (star.all_lines, ["order_id", "order_item_id"]),
            "payments": (star.order_payments, ["order_id", "payment_sequential"]),
            "products": (star.products, ["product_id"]),
            "sellers": (star.sellers, ["seller_id"]),
            "events": (star.events, ["event_id"]),
            "reviews (review_id)": (star.order_reviews, ["review_id"]),
        }
    )


def _reversed(name: str, later: str, earlier: str, out: str) -> None:
    @query(name, f"SELECT count(*) AS {out} FROM s_orders WHERE {later} < {earlier}")
    def impossible_dates(star: Star):
        return profile.later_before_earlier(star.orders, later, earlier, out)


_reversed("p22_delivered_before_purchase", _DELIVERED, _PURCHASE, "delivered_before_purchase")
_reversed("p23_approved_before_purchase", _APPROVED, _PURCHASE, "approved_before_purchase")
_reversed("p24_carrier_before_approval", _CARRIER, _APPROVED, "carrier_before_approval")
_reversed("p25_customer_before_carrier", _DELIVERED, _CARRIER, "customer_before_carrier")


@query(
    "p26_late_rate",
    f"""
SELECT count(*) AS delivered_orders,
       count(*) FILTER (WHERE {_DELIVERED} > {_ESTIMATED}) AS late,
       {pct(f"count(*) FILTER (WHERE {_DELIVERED} > {_ESTIMATED})", "count(*)", 2)} AS late_pct
FROM s_orders WHERE order_status = 'delivered'""",
)
def late_rate(star: Star):
    return profile.late_rate(star.orders, _DELIVERED, _ESTIMATED, "order_status")


@query(
    "p27_odd_payments",
    """
SELECT count(*) FILTER (WHERE payment_value = 0) AS zero_value,
       count(*) FILTER (WHERE payment_value < 0) AS negative_value,
       count(*) FILTER (WHERE payment_installments = 0) AS zero_installments FROM s_payments""",
)
def odd_payments(star: Star):
    return profile.odd_payments(star.order_payments)


@query(
    "p28_payment_types", "SELECT payment_type, count(*) AS n FROM s_payments GROUP BY 1"
)
def payment_types(star: Star):
    return profile.value_counts(star.order_payments, "payment_type")


@query(
    "p29_price_bounds",
    """
SELECT count(*) FILTER (WHERE price <= 0) AS bad_price,
       count(*) FILTER (WHERE freight_value < 0) AS negative_freight,
       min(price)::DOUBLE AS min_price, max(price)::DOUBLE AS max_price FROM s_lines""",
)
def price_bounds(star: Star):
    return profile.price_bounds(star.all_lines)


@query("p30_review_scores", "SELECT review_score, count(*) AS n FROM s_reviews GROUP BY 1")
def review_scores(star: Star):
    return profile.value_counts(star.order_reviews, "review_score", by_value=True)


@query(
    "p31_untranslated",
    """
SELECT product_category_name, count(*) AS products FROM s_products
WHERE product_category_name NOT IN (SELECT product_category_name FROM s_translation) GROUP BY 1""",
)
def untranslated(star: Star):
    return profile.untranslated(star.products, star.translation)


@query(
    "p32_items_without_order",
    """
SELECT count(*) AS orphan_items FROM s_lines WHERE order_id NOT IN (SELECT order_id FROM s_orders)""",
)
def orphan_items(star: Star):
    return profile.unmatched(star.all_lines, star.order_heads, "order_id", "orphan_items")


@query(
    "p33_orders_without_items",
    """
SELECT count(*) AS orders_without_items FROM s_orders
WHERE order_id NOT IN (SELECT order_id FROM s_lines)""",
)
def empty_orders(star: Star):
    return profile.unmatched(star.order_heads, star.all_lines, "order_id", "orders_without_items")


@query(
    "p34_orders_without_payment",
    """
SELECT count(*) AS orders_without_payment FROM s_orders
WHERE order_id NOT IN (SELECT order_id FROM s_payments)""",
)
def unpaid_orders(star: Star):
    return profile.unmatched(
        star.order_heads, star.order_payments, "order_id", "orders_without_payment"
    )


@query(
    "p35_payment_mismatch",
    """
SELECT count(*) AS orders_compared, count(*) FILTER (WHERE abs(owed - paid) > 0.01) AS mismatched
FROM (SELECT order_id, sum(price + freight_value) AS owed FROM s_lines GROUP BY 1)
JOIN (SELECT order_id, sum(payment_value) AS paid FROM s_payments GROUP BY 1) USING (order_id)""",
)
def mismatch(star: Star):
    return profile.payment_mismatch(star.all_lines, star.order_payments)


@query(
    "p36_moved_people",
    """
SELECT count(*) AS people_with_changing_address
FROM (SELECT 1 FROM s_snapshots GROUP BY customer_unique_id
      HAVING count(DISTINCT (zip, city, state)) > 1)""",
)
def moved(star: Star):
    return profile.moved_people(star.customer_snapshots)


@query(
    "p37_customer_states",
    """
SELECT state, count(*) AS customers FROM s_snapshots GROUP BY 1
ORDER BY customers DESC, state LIMIT 10""",
)
def customer_states(star: Star):
    return profile.top_values(star.customer_snapshots, "state", "customers")


@query(
    "p38_seller_states",
    """
SELECT state AS seller_state, count(*) AS sellers FROM s_sellers GROUP BY 1
ORDER BY sellers DESC, seller_state LIMIT 10""",
)
def seller_states(star: Star):
    return profile.top_values(star.sellers, "seller_state", "sellers")


@query(
    "p39_table_profile",
    f"""
SELECT count(*) AS rows, count(*) FILTER (WHERE {_APPROVED} IS NULL) AS null_{_APPROVED},
       count(*) FILTER (WHERE {_DELIVERED} IS NULL) AS null_{_DELIVERED},
       count(*) FILTER (WHERE {_CARRIER} < {_APPROVED}) AS {_CARRIER}_before_{_APPROVED},
       count(*) FILTER (WHERE {_DELIVERED} < {_PURCHASE}) AS {_DELIVERED}_before_{_PURCHASE}
FROM s_orders""",
)
def one_scan(star: Star):
    """Missing values and reversed dates of the orders in a single scan."""
    return profile.table_profile(
        star.orders, [_APPROVED, _DELIVERED], [(_APPROVED, _CARRIER), (_PURCHASE, _DELIVERED)]
    )
