"""Each invariant check on the built star schema, and on one with violations planted in it."""

from __future__ import annotations

from collections import ChainMap

from pyspark.sql import functions as F

from daygrain.operators.versions import as_of
from daygrain.plans.checks import CHECKS
from daygrain.registry.base import define, query
from daygrain.registry.star import Star

define(
    "s_dim",
    """
SELECT *, customer_unique_id || valid_from::VARCHAR AS customer_sk, valid_to IS NULL AS is_current
FROM s_dim_customer""",
)
define(
    "s_fo",
    "SELECT *, customer_unique_id || version_from::VARCHAR AS customer_sk FROM s_fact_orders",
)
define(
    "s_days",
    """
SELECT unnest(generate_series(least((SELECT min(o_orderdate)::DATE FROM orders),
                                    (SELECT min(ts)::DATE FROM events)),
                              greatest((SELECT max(o_orderdate)::DATE FROM orders),
                                       (SELECT max(ts)::DATE FROM events)),
                              INTERVAL 1 DAY))::DATE AS full_date""",
)

_BUILT = {
    "orders": "s_fo",
    "items": "s_gold_items",
    "sessions": "s_sessions",
    "dim": "s_dim",
    "products": "s_dim_product",
    "sellers": "s_sellers",
    "days": "s_days",
}


def _check_sql(template: str, **planted: str) -> str:
    """The check on the built tables and on those with some of them replaced."""
    built = template.format(**_BUILT)
    faulty = template.format(**{**_BUILT, **{k: f"({v})" for k, v in planted.items()}})
    return f"""
SELECT *, 'built' AS dataset FROM ({built})
UNION ALL
SELECT *, 'planted' AS dataset FROM ({faulty})"""


def _both(star: Star, check: str, **planted):
    built = CHECKS[check](star.warehouse).withColumn("dataset", F.lit("built"))
    faulty = CHECKS[check](ChainMap(planted, star.warehouse))
    return built.unionByName(faulty.withColumn("dataset", F.lit("planted")))


def _day(text: str):
    return F.lit(text).cast("date")


@query(
    "v1_duplicate_orders",
    _check_sql(
        """SELECT 'duplicate orders' AS check_name, count(*) AS violations FROM
           (SELECT row_number() OVER (PARTITION BY order_id) AS nth FROM {orders})
           WHERE nth = 2""",
        orders="SELECT order_id FROM s_lines",
    ),
)
def orders(star: Star):
    """Planted: the order ids at the grain of their lines."""
    return _both(star, "v1", fact_orders=star.all_lines)


@query(
    "v2_duplicate_items",
    _check_sql(
        """SELECT 'duplicate order items' AS check_name, count(*) AS violations FROM
           (SELECT row_number() OVER (PARTITION BY order_id, order_item_id) AS nth FROM {items})
           WHERE nth = 2""",
        items="SELECT * FROM s_lines",
    ),
)
def items(star: Star):
    """Planted: the lines with the copies the source has."""
    return _both(star, "v2", fact_order_items=star.all_lines)


@query(
    "v3_duplicate_sessions",
    _check_sql(
        """SELECT 'duplicate sessions' AS check_name, count(*) AS violations FROM
           (SELECT row_number() OVER (PARTITION BY session_id) AS nth FROM {sessions})
           WHERE nth = 2""",
        sessions="SELECT session_id FROM s_clean_events",
    ),
)
def sessions(star: Star):
    """Planted: session ids at the grain of their events."""
    return _both(star, "v3", fact_sessions=star.clean_events)


@query(
    "v4_overlap",
    _check_sql(
        """SELECT 'overlapping validity ranges' AS check_name,
                  coalesce(sum(len([x for x in begun if x > day])), 0)::BIGINT AS violations
           FROM (SELECT valid_from AS day, list(coalesce(valid_to, DATE '9999-12-31')) OVER
                        (PARTITION BY customer_unique_id ORDER BY valid_from, customer_sk
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS begun
                 FROM {dim})""",
        dim="SELECT * REPLACE (valid_to + 400 AS valid_to) FROM s_dim",
    ),
)
def overlap(star: Star):
    """Planted: every closed version ends 400 days too late."""
    longer = star.dim_customer.withColumn("valid_to", F.date_add("valid_to", 400))
    return _both(star, "v4", dim_customer=longer)


@query(
    "v5_one_current_row",
    _check_sql(
        """SELECT 'customer without exactly one current row' AS check_name,
                  count(*) AS violations
           FROM (SELECT customer_unique_id, sum(is_current::INT) AS now FROM {dim} GROUP BY 1)
           WHERE now IS DISTINCT FROM 1""",
        dim="SELECT * REPLACE (valid_from >= DATE '2001-01-01' AS is_current) FROM s_dim",
    ),
)
def current(star: Star):
    """Planted: all versions of the last year count as current."""
    recent = F.col("valid_from") >= _day("2001-01-01")
    return _both(star, "v5", dim_customer=star.dim_customer.withColumn("is_current", recent))


@query(
    "v6_totals",
    _check_sql(
        """SELECT 'order total <> sum of its items' AS check_name, count(*) AS violations FROM
           (SELECT order_id, bool_or(head) AND NOT bool_and(head) AS paired,
                   sum(n) AS n, sum(worth) AS worth, sum(freight) AS freight
            FROM (SELECT order_id, TRUE AS head, n_items AS n, items_value AS worth,
                         freight_value AS freight FROM {orders}
                  UNION ALL SELECT order_id, FALSE, -1, -price, -freight_value FROM {items})
            GROUP BY order_id)
           WHERE paired AND (n <> 0 OR worth <> 0 OR freight <> 0)""",
        items="SELECT * FROM s_lines",
    ),
)
def totals(star: Star):
    """Planted: items with copies, so they add up to more than the orders say."""
    exact = {c: F.col(c).cast("decimal(10,2)") for c in ("price", "freight_value")}
    return _both(star, "v6", fact_order_items=star.all_lines.withColumns(exact))


@query(
    "v7_no_version",
    _check_sql(
        """SELECT 'fact rows with no customer version' AS check_name,
                  count(*) - count(customer_sk) AS violations FROM {orders}""",
        orders="""SELECT * REPLACE (CASE WHEN version_from >= DATE '1996-01-01'
                  THEN customer_sk END AS customer_sk) FROM s_fo""",
    ),
)
def unresolved(star: Star):
    """Planted: orders looked up in a dimension that lacks the versions of the first year."""
    late = star.dim_customer.where(F.col("valid_from") >= _day("1996-01-01"))
    return _both(star, "v7", fact_orders=as_of(star.gold_orders, late, "order_date"))


@query(
    "v8_wrong_version",
    _check_sql(
        """SELECT 'fact points at wrong customer version' AS check_name, count(*) AS violations
           FROM {orders} f WHERE EXISTS (
             SELECT 1 FROM {dim} v WHERE v.customer_sk = f.customer_sk
             AND (f.order_date < v.valid_from
                  OR coalesce(f.order_date >= v.valid_to, FALSE)))""",
        dim="SELECT * REPLACE (valid_from + 10 AS valid_from) FROM s_dim",
    ),
)
def misplaced(star: Star):
    """Planted: versions that start ten days later than when the facts were resolved."""
    moved = star.dim_customer.withColumn("valid_from", F.date_add("valid_from", 10))
    return _both(star, "v8", dim_customer=moved)


@query(
    "v9_items_without_order",
    _check_sql(
        """SELECT 'order items without an order' AS check_name, count(*) AS violations
           FROM {items} f WHERE NOT EXISTS
             (SELECT 1 FROM {orders} head WHERE head.order_id = f.order_id)""",
        orders="SELECT * FROM s_fo WHERE order_date >= DATE '1996-01-01'",
    ),
)
def orphans(star: Star):
    """Planted: the orders of the first year are missing."""
    late = star.fact_orders.where(F.col("order_date") >= _day("1996-01-01"))
    return _both(star, "v9", fact_orders=late)


@query(
    "v10_items_without_dimension",
    _check_sql(
        """SELECT 'order items missing product or seller' AS check_name, count(*) AS violations
           FROM {items} f WHERE NOT (
             EXISTS (SELECT 1 FROM {products} x WHERE x.product_id = f.product_id)
             AND EXISTS (SELECT 1 FROM {sellers} x WHERE x.seller_id = f.seller_id))""",
        products="SELECT * FROM s_dim_product WHERE category_pt IS NOT NULL",
    ),
)
def unknown_product(star: Star):
    """Planted: products without a category are missing from the dimension."""
    known = star.dim_product.where(F.col("category_pt").isNotNull())
    return _both(star, "v10", dim_product=known)


_CONSTRAINTS = """
SELECT 'valid_to after valid_from' AS check_name, count(*) AS violations FROM {dim}
WHERE valid_to <= valid_from
UNION ALL SELECT 'current rows have no end', count(*) FROM {dim}
WHERE is_current <> (valid_to IS NULL)
UNION ALL SELECT 'one version per start', count(*) FROM
    (SELECT 1 FROM {dim} GROUP BY customer_unique_id, valid_from HAVING count(*) > 1)
UNION ALL SELECT 'unique customer_sk', count(*) FROM
    (SELECT 1 FROM {dim} GROUP BY customer_sk HAVING count(*) > 1)
UNION ALL SELECT 'one current row per customer', count(*) FROM
    (SELECT 1 FROM {dim} WHERE is_current GROUP BY customer_unique_id HAVING count(*) > 1)
UNION ALL SELECT 'required customer columns', count(*) FROM {dim}
WHERE customer_unique_id IS NULL OR valid_from IS NULL OR is_current IS NULL
UNION ALL SELECT 'order_date in the calendar', count(*) FROM {orders}
WHERE order_date NOT IN (SELECT full_date FROM {days})
UNION ALL SELECT 'item order_date in the calendar', count(*) FROM {items}
WHERE order_date NOT IN (SELECT full_date FROM {days})
UNION ALL SELECT 'session_date in the calendar', count(*) FROM {sessions}
WHERE session_date NOT IN (SELECT full_date FROM {days})
UNION ALL SELECT 'required session columns', count(*) FROM {sessions}
WHERE furthest_stage IS NULL OR purchased IS NULL
UNION ALL SELECT 'customer_sk in the dimension', count(*) FROM {orders}
WHERE customer_sk NOT IN (SELECT customer_sk FROM {dim})"""


@query(
    "v11_constraints",
    _check_sql(
        _CONSTRAINTS,
        dim="""SELECT * REPLACE (CASE WHEN state = '5-LOW' THEN valid_from ELSE valid_to END
               AS valid_to) FROM s_dim WHERE city <> 'BUILDING'""",
        days="SELECT * FROM s_days WHERE full_date >= DATE '1996-01-01' AND full_date < DATE '2024-01-20'",
    ),
)
def constraints(star: Star):
    """Planted: empty ranges, a market segment without customers, a calendar that is too short."""
    emptied = F.when(F.col("state") == "5-LOW", F.col("valid_from")).otherwise(F.col("valid_to"))
    dim = star.dim_customer.where(F.col("city") != "BUILDING").withColumn("valid_to", emptied)
    day = F.col("full_date")
    days = star.dim_date.where((day >= _day("1996-01-01")) & (day < _day("2024-01-20")))
    return _both(star, "v11", dim_customer=dim, dim_date=days)
