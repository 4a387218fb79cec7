"""Does every layer hold what the one before it shipped?"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.functions.time import in_days
from daygrain.functions.values import money, percent
from daygrain.operators.versions import PERSON

Tables = Mapping[str, DataFrame]
# The check labels in this module are fixed values: reports are compared by them.
AMOUNT = "decimal(38,2)"


def _totals(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """Rows (check, value) out of one aggregation of a table."""
    none = F.lit(0).cast(AMOUNT)
    exact = [F.coalesce(v.cast(AMOUNT), none).alias(f"v{k}") for k, v in enumerate(values.values())]
    rows = [
        F.struct(F.lit(name).alias("check"), F.col(f"v{k}").alias("value"))
        for k, name in enumerate(values)
    ]
    return df.agg(*exact).select(F.inline(F.array(*rows)))


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _rows() -> Column:
    return F.count("*")


def in_window(orders: DataFrame, first: str, last: str) -> DataFrame:
    """Orders placed on a day of the window, by the source's wall clock."""
    day = F.col("order_purchase_timestamp").cast("date")
    return orders.where(day.between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def with_verdict(orders: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Order and customer ids with `accepted`: whether quality rules let the order pass."""
    rejected = quarantine.select("order_id").distinct().withColumn("_rejected", F.lit(True))
    return orders.select("order_id", "customer_id").join(rejected, "order_id", "left").select(
        "order_id", "customer_id", F.col("_rejected").isNull().alias("accepted")
    )


def _source_and_kept(
    df: DataFrame, values: Mapping[str, tuple[Callable[[Column], Column], Column]]
) -> DataFrame:
    """Rows (check, source, kept): each aggregate over all rows and over the accepted ones."""
    none = F.lit(0).cast(AMOUNT)
    sums, rows = [], []
    for k, (name, (aggregate, value)) in enumerate(values.items()):
        for side, over in (("all", value), ("kept", F.when(F.col("accepted"), value))):
            sums.append(F.coalesce(aggregate(over).cast(AMOUNT), none).alias(f"v{k}_{side}"))
        rows.append(
            F.struct(
                F.lit(name).alias("check"),
                F.col(f"v{k}_all").alias("source"),
                F.col(f"v{k}_kept").alias("kept"),
            )
        )
    return df.agg(*sums).select(F.inline(F.array(*rows)))


def source_metrics(
    orders: DataFrame, items: DataFrame, payments: DataFrame, snapshots: DataFrame
) -> DataFrame:
    """The six totals of source orders `with_verdict`, of all and of the accepted ones.

    Everything is summed per order first, and both sides come out of one pass.
    """
    per_order = items.groupBy("order_id").agg(
        _rows().alias("n"),
        F.sum(money("price", 18)).alias("price"),
        F.sum(money("freight_value", 18)).alias("freight"),
    )
    paid = payments.groupBy("order_id").agg(F.sum(money("payment_value", 18)).alias("paid"))
    people = snapshots.select("customer_id", PERSON).distinct()
    return _union(
        [
            _source_and_kept(orders, {"orders": (F.sum, F.lit(1))}),
            _source_and_kept(
                per_order.join(orders, "order_id"),
                {
                    "order items": (F.sum, F.col("n")),
                    "items value": (F.sum, F.col("price")),
                    "freight value": (F.sum, F.col("freight")),
                },
            ),
            _source_and_kept(paid.join(orders, "order_id"), {"payments": (F.sum, F.col("paid"))}),
            _source_and_kept(people.join(orders, "customer_id"), {"people who ordered": (F.count_distinct, F.col(PERSON))}),
        ]
    )


def warehouse_metrics(t: Tables) -> DataFrame:
    return _union(
        [
            _totals(
                t["fact_orders"],
                {
                    "orders": _rows(),
                    "items value": F.sum("items_value"),
                    "freight value": F.sum("freight_value"),
                    "payments": F.sum("payment_value"),
                },
            ),
            _totals(t["fact_order_items"], {"order items": _rows()}),
            _totals(t["dim_customer"], {"people who ordered": F.count_distinct(PERSON)}),
        ]
    )


def direct_metrics(
    events: DataFrame, products: DataFrame, sellers: DataFrame, t: Tables
) -> tuple[DataFrame, DataFrame]:
    """Sessions, products and sellers, of which none is rejected here: (source, warehouse)."""
    source = [
        _totals(events, {"sessions": F.count_distinct("session_id")}),
        _totals(products, {"products": _rows()}),
        _totals(sellers, {"sellers": _rows()}),
    ]
    loaded = [
        _totals(t["fact_sessions"], {"sessions": _rows()}),
        _totals(t["dim_product"], {"products": _rows()}),
        _totals(t["dim_seller"], {"sellers": _rows()}),
    ]
    value = F.col("value")
    direct = _union(source).select("check", value.alias("source"), value.alias("kept"))
    return direct, _union(loaded)


def three_way(source: DataFrame, loaded: DataFrame) -> DataFrame:
    """Source, what quality rules rejected, and the warehouse, per metric.

    PASS means that the source without the rejected rows is what the warehouse has.
    """
    kept, got = F.col("kept"), F.col("value")
    return source.join(loaded, "check").select(
        "check",
        "source",
        (F.col("source") - kept).cast(AMOUNT).alias("rejected"),
        got.alias("warehouse"),
        F.when(F.abs(kept - got) < 0.005, "PASS").otherwise("FAIL").alias("result"),
    )


def rejected_orders(quarantine: DataFrame, window_orders: DataFrame) -> DataFrame:
    """Orders of the window that sit in quarantine, with the reason."""
    return quarantine.join(window_orders, "order_id", "left_semi").select(
        "order_id", "order_status", "dq_reason"
    )


def derived_facts(t: Tables) -> DataFrame:
    """Purchased sessions against orders, conversion, and people with several versions."""
    sessions, orders = t["fact_sessions"], t["fact_orders"]
    bought = sessions.agg(
        _rows().alias("sessions"), F.count_if("purchased").alias("purchased_sessions")
    )
    moved = t["dim_customer"].groupBy(PERSON).agg(_rows().alias("n")).where("n > 1")
    return bought.select(
        "sessions",
        "purchased_sessions",
        orders.agg(_rows().alias("n")).scalar().alias("orders"),
        moved.agg(_rows().alias("n")).scalar().alias("people_with_history"),
        percent(F.col("purchased_sessions"), F.col("sessions"), 2).alias("conversion_pct"),
    )


def copy_metrics(t: Tables) -> DataFrame:
    """The 14 figures on which two copies of the warehouse must agree."""
    return _union(
        [
            _totals(t["dim_date"], {"dim_date rows": _rows()}),
            _totals(
                t["dim_customer"],
                {
                    "dim_customer rows": _rows(),
                    "dim_customer current rows": F.count_if("is_current"),
                },
            ),
            _totals(t["dim_product"], {"dim_product rows": _rows()}),
            _totals(t["dim_seller"], {"dim_seller rows": _rows()}),
            _totals(
                t["fact_orders"],
                {
                    "fact_orders rows": _rows(),
                    "orders delivered_late": F.count_if("delivered_late"),
                    "sum items_value": F.sum("items_value"),
                    "sum freight_value": F.sum("freight_value"),
                    "sum payment_value": F.sum("payment_value"),
                },
            ),
            _totals(
                t["fact_order_items"],
                {
                    "fact_order_items rows": _rows(),
                    "sum item price": F.sum("price"),
                },
            ),
            _totals(
                t["fact_sessions"],
                {
                    "fact_sessions rows": _rows(),
                    "sessions purchased": F.count_if("purchased"),
                },
            ),
        ]
    )


def two_copies(a: DataFrame, b: DataFrame) -> DataFrame:
    return (
        a.withColumnRenamed("value", "copy_a")
        .join(b.withColumnRenamed("value", "copy_b"), "check", "full_outer")
        .withColumn("same", F.col("copy_a").eqNullSafe(F.col("copy_b")))
    )


def only_in(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys that are in one copy only, with the side that has them."""
    left = a.select(key).distinct().withColumn("in_a", F.lit(True))
    right = b.select(key).distinct().withColumn("in_b", F.lit(True))
    return (
        left.join(right, key, "full_outer")
        .where(F.col("in_a").isNull() | F.col("in_b").isNull())
        .select(key, F.when(F.col("in_a"), "a").otherwise("b").alias("side"))
    )


DIFF_COLUMNS = ("session_date", "n_events", "session_end", "furthest_stage", "purchased")


def session_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Sessions that only one copy calls purchased, both rows side by side."""
    bought = only_in(a.where("purchased"), b.where("purchased"), "session_id")

    def side(df: DataFrame, suffix: str) -> DataFrame:
        return df.select("session_id", *[F.col(c).alias(f"{c}_{suffix}") for c in DIFF_COLUMNS])

    return bought.join(side(a, "a"), "session_id", "left").join(side(b, "b"), "session_id", "left")


def session_diff_by_day(diff: DataFrame) -> DataFrame:
    day = F.coalesce("session_date_a", "session_date_b").alias("session_date")
    return diff.groupBy(day).agg(_rows().alias("sessions")).orderBy("session_date")


def event_funnel(events: DataFrame, first_stage: str) -> DataFrame:
    """Events per type and their share of the first stage's events, in percent (1 decimal)."""
    base = events.where(F.col("event_type") == first_stage).agg(_rows().alias("n"))
    return (
        events.groupBy("event_type")
        .agg(_rows().alias("events"))
        .withColumn("pct_of_first", percent(F.col("events"), base.scalar(), 1))
    )


def converting_orders(
    orders: DataFrame, customers: DataFrame, items: DataFrame, first: str, last: str
) -> DataFrame:
    """Orders of the window with their person and the product of their first item, if any."""
    lead = items.where(F.col("order_item_id") == 1).select("order_id", "product_id")
    return (
        orders.where(in_days("order_purchase_timestamp", first, last))
        .join(customers.select("customer_id", PERSON), "customer_id")
        .join(lead, "order_id", "left")
        .select(
            "order_id", PERSON, F.col("order_purchase_timestamp").alias("purchase_ts"), "product_id"
        )
    )


# Buckets of one level of checksums: what the driver and a broadcast may get of them.
SUMS = 1024


def _with_buckets(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with their key's bucket on two levels and a hash of all their columns, NULL being a value."""
    key = [c for k in keys for c in (F.col(k), F.col(k).isNull())]
    row = [c for k in df.columns for c in (F.col(k), F.col(k).isNull())]
    code = F.xxhash64(*key)
    return df.select(
        "*",
        F.pmod(code, F.lit(SUMS)).cast("int").alias("_coarse"),
        F.pmod(F.shiftright(code, 20), F.lit(SUMS)).cast("int").alias("_fine"),
        F.xxhash64(*row).alias("_row"),
    )


def bucket_sums(df: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Rows, and two sums of their hashes that do not depend on any order, per bucket."""
    low = F.col("_row").bitwiseAND(F.lit(0x7FFFFFFF))
    return df.groupBy(*levels).agg(
        _rows().alias("_n"), F.sum(low).alias("_sum"), F.bit_xor("_row").alias("_xor")
    )


def _unequal(a: DataFrame, b: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Buckets whose sums differ or that one side does not have."""
    sums = F.struct("_n", "_sum", "_xor")
    left = bucket_sums(a, levels).select(*levels, sums.alias("_a"))
    right = bucket_sums(b, levels).select(*levels, sums.alias("_b"))
    both = left.join(right, list(levels), "full_outer")
    return both.where(~F.col("_a").eqNullSafe(F.col("_b"))).select(*levels)


def row_difference(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What differs between two copies of a table: (keys, kind, columns, copies_a, copies_b).

    `kind` is only_a, only_b or changed, and `columns` names the changed ones. Both copies are reduced to
    checksums of `SUMS` key buckets; the rows of unequal buckets are reduced again to finer ones,
    and only rows of those are joined. So copies that agree cost two scans and no shuffle of rows, and one changed
    cell joins a millionth of the table. A key with several rows is compared by all of them; the
    columns named are those of its smallest rows.
    """
    keys, columns = list(keys), [c for c in a.columns if c not in keys]
    if sorted(a.columns) != sorted(b.columns):
        raise ValueError(f"different columns: {sorted(set(a.columns) ^ set(b.columns))}")
    a, b = _with_buckets(a, keys), _with_buckets(b.select(a.columns), keys)
    # At most SUMS rows are broadcast, then at most SUMS for each of them that differs.
    coarse = F.broadcast(_unequal(a, b, ["_coarse"]))
    a, b = (df.join(coarse, "_coarse", "left_semi") for df in (a, b))
    levels = ["_coarse", "_fine"]
    fine = F.broadcast(_unequal(a, b, levels))

    def per_key(df: DataFrame, side: str) -> DataFrame:
        low = F.col("_row").bitwiseAND(F.lit(0x7FFFFFFF))
        return (
            df.join(fine, levels, "left_semi")
            .groupBy(*keys)
            .agg(
                _rows().alias(f"copies_{side}"),
                F.struct(F.sum(low), F.bit_xor("_row")).alias(f"_sums_{side}"),
                F.min(F.struct(*columns)).alias(f"_{side}"),
            )
        )

    left, right = per_key(a, "a"), per_key(b, "b").withColumnsRenamed({k: f"_b_{k}" for k in keys})
    same_key = [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in keys]
    both = left.join(right, same_key, "full_outer")
    kind = (
        F.when(F.col("copies_b").isNull(), "only_a")
        .when(F.col("copies_a").isNull(), "only_b")
        .otherwise("changed")
    )
    differing = F.array_compact(
        F.array(*[F.when(~F.col(f"_a.{c}").eqNullSafe(F.col(f"_b.{c}")), F.lit(c)) for c in columns])
    )
    equal = F.col("copies_a").eqNullSafe(F.col("copies_b")) & F.col("_sums_a").eqNullSafe(F.col("_sums_b"))
    # Of a row that one side lacks the missing key is NULL there.
    there = F.col("copies_a").isNotNull()
    return both.where(~equal).select(
        *[F.when(there, F.col(k)).otherwise(F.col(f"_b_{k}")).alias(k) for k in keys],
        kind.alias("kind"),
        F.when(kind == "changed", differing).alias("columns"),
        F.coalesce("copies_a", F.lit(0)).alias("copies_a"),
        F.coalesce("copies_b", F.lit(0)).alias("copies_b"),
    )
