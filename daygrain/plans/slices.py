"""Cutting source tables into day folders, the way the shop ships them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.functions.time import in_days
from daygrain.sinks.partitions import write_day_text
from daygrain.sources import schemas

STATIC = ("products", "sellers", "product_category_name_translation")


def slice_tables(
    source: Mapping[str, DataFrame], first: str, last: str
) -> dict[str, DataFrame]:
    """Source rows of the window with the day `dt` they are shipped on.

    Orders, their items and payments go by purchase day; reviews by creation day, if their
    order is in the window; snapshots are the people who ordered that day; static tables go
    with the first day.
    """
    day = F.date_format("order_purchase_timestamp", "yyyy-MM-dd")
    orders = source["orders"].where(in_days("order_purchase_timestamp", first, last))
    orders = orders.withColumn("dt", day)
    order_day = orders.select("order_id", "dt")
    reviews = (
        source["order_reviews"]
        .where(in_days("review_creation_date", first, last))
        .join(order_day, "order_id", "left_semi")
        .withColumn("dt", F.date_format("review_creation_date", "yyyy-MM-dd"))
    )
    people = source["customer_snapshots"].drop("effective_date")
    snapshots = people.join(orders.select("customer_id", "dt"), "customer_id").withColumn(
        "effective_date", F.col("dt")
    )
    cut = {
        "orders": orders,
        "order_items": source["order_items"].join(order_day, "order_id"),
        "order_payments": source["order_payments"].join(order_day, "order_id"),
        "order_reviews": reviews,
        "customer_snapshots": snapshots,
        **{t: source[t].withColumn("dt", F.lit(first)) for t in STATIC},
    }
    # Files bind cells by position, so the columns are put in declared order.
    return {
        name: df.select(*schemas.RAW[name].fieldNames(), "dt") for name, df in cut.items()
    }


def ship(cut: Mapping[str, DataFrame], base: str) -> None:
    """Write each sliced table as gzip files under `<base>/<table>/dt=.../`."""
    for name, df in cut.items():
        # A day's rows go to as few files as their size needs.
        write_day_text(
            df.hint("rebalance", "dt"), base, name, "json" if name == schemas.EVENTS else "csv"
        )
