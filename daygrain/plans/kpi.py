"""Business reports on the star schema, and the four scan/join benchmark queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.functions.values import money, percent, yes
from daygrain.operators.versions import SURROGATE

# Orders that never became revenue, and the sellers' report sizes.
NO_REVENUE = ("canceled", "unavailable")
MIN_ORDERS = 5
REPORT_ROWS = 10



def funnel(sessions: DataFrame) -> DataFrame:
    """Sessions per day that reached each stage, stage-to-stage and overall rates in percent."""
    stages = ("viewed", "carted", "checkout_started", "purchased")
    daily = sessions.groupBy("session_date").agg(
        F.count("*").alias("sessions"), *[F.sum(yes(F.col(s))).alias(s) for s in stages]
    )
    viewed, carted, checkout, purchased = (F.col(s) for s in stages)
    return daily.withColumns(
        {
            "view_to_cart_pct": percent(carted, viewed, 1),
            "cart_to_checkout_pct": percent(checkout, carted, 1),
            "checkout_to_purchase_pct": percent(purchased, checkout, 1),
            "session_conversion_pct": percent(purchased, F.col("sessions"), 2),
        }
    ).orderBy("session_date")


def revenue_by_category_and_state(
    items: DataFrame, orders: DataFrame, products: DataFrame, customers: DataFrame
) -> DataFrame:
    """Item revenue by product category and the customer's state when the order was placed.

    Items are first summed per order, product and customer version, so joins carry one row for
    each of these. That does not reduce a hot product: the join on it is left to Spark's skew join.
    The state is looked up once per order and version and comes back to the order, so that the rows
    that travel to their product carry a short state, and the long version key only travels for an order.
    """
    earning = orders.where(~F.col("order_status").isin(*NO_REVENUE)).select("order_id")
    per_order = (
        items.groupBy("order_id", "product_id", SURROGATE)
        .agg(F.sum("price").alias("revenue"), F.sum("freight_value").alias("freight"))
        .join(earning, "order_id", "left_semi")
    )
    versions = items.select("order_id", SURROGATE).distinct().join(earning, "order_id", "left_semi")
    states = versions.join(
        customers.select(SURROGATE, F.col("state").alias("customer_state")), SURROGATE
    ).withColumnsRenamed({"order_id": "_order", SURROGATE: "_version"})
    # Equal versions as a plain condition: as a key they would bring both sides to other tasks.
    same = (F.col("order_id") == F.col("_order")) & F.array_contains(
        F.array("_version"), F.col(SURROGATE)
    )
    category = F.coalesce("category_en", F.lit("unknown")).alias("category")
    placed = (
        per_order.join(states, same)
        .select("order_id", "product_id", "customer_state", "revenue", "freight")
        .join(products.select("product_id", category), "product_id")
    )
    # Orders are counted by a second aggregation instead of a distinct count: the first one
    # leaves a row per order, and sums of sums stay exact on decimals.
    return (
        placed.groupBy("category", "customer_state", "order_id")
        .agg(F.sum("revenue").alias("revenue"), F.sum("freight").alias("freight"))
        .groupBy("category", "customer_state")
        .agg(
            F.count("*").alias("orders"),
            F.sum("revenue").cast("decimal(38,2)").alias("revenue"),
            F.sum("freight").cast("decimal(38,2)").alias("freight"),
        )
        .orderBy(F.col("revenue").desc_nulls_last(), "category", "customer_state")
    )


def on_time(orders: DataFrame) -> DataFrame:
    """Delivered orders per order day, and how many came no later than estimated."""
    return (
        orders.where(
            (F.col("order_status") == "delivered") & F.col("delivered_customer_ts").isNotNull()
        )
        .groupBy("order_date")
        .agg(
            F.count("*").alias("delivered_orders"),
            F.sum(yes(~F.col("delivered_late"))).alias("on_time"),
        )
        .withColumn("on_time_pct", percent(F.col("on_time"), F.col("delivered_orders"), 1))
        .orderBy("order_date")
    )


def seller_totals(items: DataFrame, orders: DataFrame, min_orders: int = MIN_ORDERS) -> DataFrame:
    """Orders, revenue and late rate of every seller with enough orders.

    Lateness belongs to the order, so items are summed per (seller, order) and the three
    distinct counts become plain ones.
    """
    per_order = items.groupBy("seller_id", "order_id").agg(F.sum("price").alias("revenue"))
    earning = orders.where(~F.col("order_status").isin(*NO_REVENUE)).select(
        "order_id", "delivered_late"
    )
    late = F.col("delivered_late")
    return (
        per_order.join(earning, "order_id")
        .groupBy("seller_id")
        .agg(
            F.count("*").alias("orders"),
            F.sum("revenue").cast("decimal(38,2)").alias("revenue"),
            F.sum(yes(late)).alias("late"),
            F.count(late).alias("judged"),
        )
        .where(F.col("orders") >= min_orders)
        .select(
            "seller_id",
            "orders",
            "revenue",
            percent(F.col("late"), F.col("judged"), 1).alias("late_pct"),
        )
    )


def top_and_bottom(df: DataFrame, by: str, tie: str, k: int = REPORT_ROWS) -> DataFrame:
    """The k highest and the k lowest rows, labelled; a row may be in both."""
    top = df.orderBy(F.col(by).desc_nulls_last(), tie).limit(k)
    bottom = df.orderBy(F.col(by).asc_nulls_last(), tie).limit(k)
    return top.select(F.lit("top").alias("bucket"), "*").unionByName(
        bottom.select(F.lit("bottom").alias("bucket"), "*")
    )


def sellers(items: DataFrame, orders: DataFrame) -> DataFrame:
    return top_and_bottom(seller_totals(items, orders), "revenue", "seller_id")


def events_by_type(events: DataFrame, day: str, day_col: str = "ingest_dt") -> DataFrame:
    """Events of one day by type."""
    return (
        events.where(F.col(day_col) == day)
        .groupBy("event_type")
        .agg(F.count("*").alias("n"))
        .orderBy("event_type")
    )


def sessions_by_type(events: DataFrame) -> DataFrame:
    """Distinct sessions that have an event of each type, over the whole window."""
    return (
        events.groupBy("event_type")
        .agg(F.count_distinct("session_id").alias("s"))
        .orderBy("event_type")
    )


def device_events_per_day(
    events: DataFrame, device: str = "mobile", day_col: str = "ingest_dt"
) -> DataFrame:
    return (
        events.where(F.col("device") == device)
        .groupBy(F.col(day_col).alias("dt"))
        .agg(F.count("*").alias("n"))
        .orderBy("dt")
    )


def revenue_by_status(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with items and their revenue by order status. Text columns are cast here.

    All steps up to one row per order and status share the items' partitioning by order.
    """
    per_order = items.groupBy("order_id").agg(
        F.sum(money(F.col("price").cast("double"), 18)).alias("revenue")
    )
    return (
        orders.select("order_id", "order_status")
        .join(per_order, "order_id")
        .groupBy("order_id", "order_status")
        .agg(F.sum("revenue").alias("revenue"))
        .groupBy("order_status")
        .agg(
            F.count("order_id").alias("orders"),
            F.sum("revenue").cast("decimal(38,2)").alias("revenue"),
        )
        .orderBy("order_status")
    )
