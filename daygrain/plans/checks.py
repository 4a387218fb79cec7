"""Invariants of the star schema. Each check is a one-row frame (check_name, violations)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daygrain.functions.values import yes
from daygrain.operators.copies import copies_per_key
from daygrain.operators.versions import PERSON, SURROGATE

Tables = Mapping[str, DataFrame]

# The orders whose people `dim_customer` has, where that table is not given whole.
VERSIONED = "fact_orders with their people"


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias("violations")).select(
        F.lit(name).alias("check_name"), "violations"
    )


def _total(df: DataFrame, amount: Column, name: str) -> DataFrame:
    return df.agg(F.coalesce(F.sum(amount), F.lit(0)).cast("bigint").alias("violations")).select(
        F.lit(name).alias("check_name"), "violations"
    )


def _conditions(df: DataFrame, broken: Mapping[str, Column]) -> DataFrame:
    """One check per condition, all counted in a single scan."""
    counts = df.agg(*[F.count_if(c).alias(f"n{i}") for i, c in enumerate(broken.values())])
    rows = [
        F.struct(F.lit(name).alias("check_name"), F.col(f"n{i}").alias("violations"))
        for i, name in enumerate(broken)
    ]
    return counts.select(F.inline(F.array(*rows)))


def _orders_by_version(t: Tables) -> DataFrame:
    """Orders counted per version and day, with the version's range as `_range` if it exists.

    The checks on versions and days all start here, so a plan with several of them counts the
    orders once, and an order of a person with many does not travel on its own.
    """
    orders = t.get(VERSIONED, t["fact_orders"])
    counted = orders.groupBy(SURROGATE, "order_date").agg(F.count("*").alias("n"))
    ranges = t["dim_customer"].select(
        SURROGATE, F.struct("valid_from", "valid_to").alias("_range")
    )
    return counted.join(ranges, SURROGATE, "left")


def _covers(day: str) -> Column:
    start, end = F.col("_range.valid_from"), F.col("_range.valid_to")
    return (F.col(day) >= start) & (end.isNull() | (F.col(day) < end))


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return _count(copies_per_key(df, keys), name)


def duplicate_orders(t: Tables) -> DataFrame:
    return duplicate_keys(t["fact_orders"], ["order_id"], "duplicate orders")


def duplicate_items(t: Tables) -> DataFrame:
    return duplicate_keys(
        t["fact_order_items"], ["order_id", "order_item_id"], "duplicate order items"
    )


def duplicate_sessions(t: Tables) -> DataFrame:
    return duplicate_keys(t["fact_sessions"], ["session_id"], "duplicate sessions")


def overlapping_ranges(t: Tables) -> DataFrame:
    """Pairs of versions of a person whose ranges share a day.

    Counted without forming the pairs: a version overlaps those that started before it, less
    those that had ended by then, and those that start the same day. Starts and ends are
    counted per day first, so a person's group is no longer than the calendar. Versions whose
    own range is empty are the business of `table_constraints`.
    """
    ranges = t["dim_customer"].where(
        F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from"))
    )
    edges = (
        ranges.select(
            PERSON,
            F.inline(
                F.array(
                    F.struct(
                        F.col("valid_from").alias("day"),
                        F.lit(1).alias("starts"),
                        F.lit(0).alias("ends"),
                    ),
                    F.struct(
                        F.col("valid_to").alias("day"),
                        F.lit(0).alias("starts"),
                        F.lit(1).alias("ends"),
                    ),
                )
            ),
        )
        .where(F.col("day").isNotNull())
        .groupBy(PERSON, "day")
        .agg(F.sum("starts").alias("starts"), F.sum("ends").alias("ends"))
    )
    earlier = Window.partitionBy(PERSON).orderBy("day")
    begun = F.sum("starts").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    ended = F.sum("ends").over(earlier.rowsBetween(Window.unboundedPreceding, 0))
    still_open = F.coalesce(begun, F.lit(0)) - ended
    starts = F.col("starts")
    pairs = starts * F.col("open") + F.call_function("div", starts * (starts - 1), F.lit(2))
    return _total(edges.withColumn("open", still_open), pairs, "overlapping validity ranges")


def current_rows(t: Tables) -> DataFrame:
    per_person = t["dim_customer"].groupBy(PERSON).agg(F.sum(yes(F.col("is_current"))).alias("n"))
    return _count(
        per_person.where(F.col("n") != 1), "customer without exactly one current row"
    )


def totals_match(t: Tables) -> DataFrame:
    """Orders that have items and whose totals differ from them."""
    sums = t["fact_order_items"].groupBy("order_id").agg(
        F.count("*").alias("n"), F.sum("price").alias("p"), F.sum("freight_value").alias("f")
    )
    both = t["fact_orders"].select("order_id", "n_items", "items_value", "freight_value").join(
        sums, "order_id"
    )
    differs = (
        (F.col("n_items") != F.col("n"))
        | (F.col("items_value") != F.col("p"))
        | (F.col("freight_value") != F.col("f"))
    )
    return _count(both.where(differs), "order total <> sum of its items")


def no_version(t: Tables) -> DataFrame:
    missing = F.when(F.col(SURROGATE).isNull(), F.col("n"))
    return _total(_orders_by_version(t), missing, "fact rows with no customer version")


def wrong_version(t: Tables) -> DataFrame:
    astray = F.when(F.col("_range").isNotNull() & ~_covers("order_date"), F.col("n"))
    return _total(_orders_by_version(t), astray, "fact points at wrong customer version")


def items_without_order(t: Tables) -> DataFrame:
    return _count(
        t["fact_order_items"].join(t["fact_orders"], "order_id", "left_anti"),
        "order items without an order",
    )


def items_without_dimension(t: Tables) -> DataFrame:
    """Items whose product or seller is unknown.

    The items are counted per (product, seller) first, so an item of a hot product does not
    travel to the joins on its own.
    """
    known = t["dim_product"].select("product_id", F.lit(True).alias("has_product"))
    seller = t["dim_seller"].select("seller_id", F.lit(True).alias("has_seller"))
    counted = t["fact_order_items"].groupBy("product_id", "seller_id").agg(
        F.count("*").alias("n")
    )
    missing = (
        counted.join(known, "product_id", "left")
        .join(seller, "seller_id", "left")
        .where(F.col("has_product").isNull() | F.col("has_seller").isNull())
    )
    return _total(missing, F.col("n"), "order items missing product or seller")


def table_constraints(t: Tables) -> DataFrame:
    """What a database would refuse: bad ranges, key copies, missing dates and references."""
    dim, orders, sessions = t["dim_customer"], t["fact_orders"], t["fact_sessions"]
    days = t["dim_date"].select("full_date")

    def outside_calendar(df: DataFrame, day: str) -> DataFrame:
        # Only distinct days are looked up, weighted by their rows.
        per_day = df.groupBy(F.col(day).alias("full_date")).agg(F.count("*").alias("n"))
        return per_day.join(days, "full_date", "left_anti")

    start, end, current = F.col("valid_from"), F.col("valid_to"), F.col("is_current")
    # Keys of a person are counted per start first: one grouping tells both kinds of copies.
    per_start = dim.groupBy(PERSON, "valid_from").agg(
        F.count("*").alias("n"), F.sum(yes(current)).alias("now")
    )
    per_person = per_start.groupBy(PERSON).agg(
        F.count_if(F.col("n") > 1).alias("starts"), F.sum("now").alias("now")
    )
    unknown = F.col(SURROGATE).isNotNull() & F.col("_range").isNull()
    return _union(
        [
            _conditions(
                dim,
                {
                    "valid_to after valid_from": end <= start,
                    "current rows have no end": current != end.isNull(),
                    "required customer columns": F.col(PERSON).isNull()
                    | start.isNull()
                    | current.isNull(),
                },
            ),
            _total(per_person, F.col("starts"), "one version per start"),
            duplicate_keys(dim, [SURROGATE], "unique customer_sk"),
            _total(per_person, yes(F.col("now") > 1), "one current row per customer"),
            _conditions(
                sessions,
                {
                    "required session columns": F.col("furthest_stage").isNull()
                    | F.col("purchased").isNull()
                },
            ),
            _total(
                outside_calendar(orders, "order_date"), F.col("n"), "order_date in the calendar"
            ),
            _total(
                outside_calendar(t["fact_order_items"], "order_date"),
                F.col("n"),
                "item order_date in the calendar",
            ),
            _total(
                outside_calendar(sessions, "session_date"),
                F.col("n"),
                "session_date in the calendar",
            ),
            _total(
                _orders_by_version(t),
                F.when(unknown, F.col("n")),
                "customer_sk in the dimension",
            ),
        ]
    )


CHECKS = {
    "v1": duplicate_orders,
    "v2": duplicate_items,
    "v3": duplicate_sessions,
    "v4": overlapping_ranges,
    "v5": current_rows,
    "v6": totals_match,
    "v7": no_version,
    "v8": wrong_version,
    "v9": items_without_order,
    "v10": items_without_dimension,
    "v11": table_constraints,
}


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def all_checks(t: Tables) -> DataFrame:
    return _union([check(t) for check in CHECKS.values()])


def violations(t: Tables) -> list[tuple[str, int]]:
    """Names and counts of the checks that found something; empty for a sound warehouse."""
    bad = all_checks(t).where(F.col("violations") > 0).collect()
    return [(r["check_name"], r["violations"]) for r in bad]
