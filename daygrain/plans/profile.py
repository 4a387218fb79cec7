"""Profiling of source tables: grain, dates, missing values, impossible values, orphans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daygrain.functions.time import in_days
from daygrain.functions.values import money, percent, ratio, yes
from daygrain.operators.copies import copies_per_key



def _n() -> Column:
    return F.count("*")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(_n().alias("rows")).select(F.lit(name).alias("table"), "rows")
            for name, df in tables.items()
        ],
    )


def distinct_counts(df: DataFrame, **columns: str) -> DataFrame:
    """Rows, and the distinct values of each column under the given output name.

    One row per value is formed for each column in turn; no task sees a whole column.
    """
    return df.agg(
        _n().alias("rows"), *[F.count_distinct(c).alias(name) for name, c in columns.items()]
    )


def repeated_keys(df: DataFrame, key: str, out: str) -> DataFrame:
    """How many keys have more than one row."""
    return copies_per_key(df, key).agg(_n().alias(out))


def rows_per_group(
    df: DataFrame, group: str, position: str, names: tuple[str, str, str]
) -> DataFrame:
    """Groups, rows, and the highest position within a group, e.g. items per order."""
    groups, rows, highest = names
    per_group = df.groupBy(group).agg(_n().alias("n"), F.max(position).alias("top"))
    return per_group.agg(
        F.count(group).alias(groups), F.sum("n").alias(rows), F.max("top").alias(highest)
    )


def average(df: DataFrame, rows: str, groups: str, out: str) -> DataFrame:
    return df.withColumn(out, ratio(F.col(rows), F.col(groups), 2))


def date_range(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.min(ts).alias("first_order"), F.max(ts).alias("last_order"))


def per_month(df: DataFrame, ts: str) -> DataFrame:
    month = F.date_format(ts, "yyyy-MM").alias("month")
    return df.groupBy(month).agg(_n().alias("orders")).orderBy("month")


def per_day(df: DataFrame, ts: str) -> DataFrame:
    return df.groupBy(F.to_date(ts).alias("day")).agg(_n().alias("orders"))


def busiest_days(df: DataFrame, ts: str, k: int = 20) -> DataFrame:
    return per_day(df, ts).orderBy(F.col("orders").desc(), "day").limit(k)


def daily_volume(df: DataFrame, ts: str, first: str, last: str) -> DataFrame:
    return per_day(df.where(in_days(ts, first, last)), ts).orderBy("day")


def best_windows(df: DataFrame, ts: str, days: int = 11, k: int = 5) -> DataFrame:
    """The k best runs of `days` rows of the daily series.

    The window is over days that have orders, so a missing day lengthens the run in calendar
    time. It runs in one task, on one row per calendar day.
    """
    ahead = Window.orderBy("day").rowsBetween(0, days - 1)
    return (
        per_day(df, ts)
        .select(
            F.col("day").alias("window_start"),
            F.date_add("day", days - 1).alias("window_end"),
            F.sum("orders").over(ahead).alias("orders_in_window"),
        )
        .orderBy(F.col("orders_in_window").desc(), "window_start")
        .limit(k)
    )


def calendar_windows(
    daily: DataFrame, days: int, value: str, keys: Sequence[str] = (), day: str = "day"
) -> DataFrame:
    """Each day of a series with the sum of `value` over that day and the calendar days after it.

    A frame is `days` long whatever days are missing in it. The series is cut into months; a
    row also goes to the months before whose last frames reach it, so a month is a partition of
    its own and a long series, or one without keys, is not one task.
    """
    month = F.trunc(F.date_sub(day, days - 1), "MM")
    months = F.sequence(month, F.trunc(day, "MM"), F.expr("INTERVAL 1 MONTH"))
    spread = daily.select("*", F.explode(months).alias("_month")).withColumn(
        "_home", F.col("_month") == F.trunc(day, "MM")
    )
    ahead = (
        Window.partitionBy(*keys, "_month")
        .orderBy(F.datediff(day, F.lit("1970-01-01").cast("date")))
        .rangeBetween(0, days - 1)
    )
    return (
        spread.withColumn("_total", F.sum(value).over(ahead))
        .where("_home")
        .select(
            *keys,
            F.col(day).alias("window_start"),
            F.date_add(day, days - 1).alias("window_end"),
            F.col("_total").alias(f"{value}_in_window"),
        )
    )


def shares(df: DataFrame, column: str, out: str = "orders") -> DataFrame:
    """Rows per value and their percentage of all rows (2 decimals)."""
    total = df.agg(_n().alias("total"))
    return (
        df.groupBy(column)
        .agg(_n().alias(out))
        .withColumn("pct", percent(F.col(out), total.scalar(), 2))
        .orderBy(F.col(out).desc(), column)
    )


def null_rates(df: DataFrame, **columns: str) -> DataFrame:
    """Rows, and the percentage of NULLs in each column under the given output name."""
    return df.agg(
        _n().alias("n"), *[F.sum(yes(F.col(c).isNull())).alias(name) for name, c in columns.items()]
    ).withColumns({name: percent(F.col(name), F.col("n"), 2) for name in columns})


def nulls_by(df: DataFrame, group: str, column: str, out: str) -> DataFrame:
    return (
        df.groupBy(group)
        .agg(_n().alias("orders"), F.sum(yes(F.col(column).isNull())).alias(out))
        .orderBy(F.col("orders").desc(), group)
    )


def count_where(df: DataFrame, condition: Column, out: str) -> DataFrame:
    return df.where(condition).agg(_n().alias(out))


def later_before_earlier(df: DataFrame, later: str, earlier: str, out: str) -> DataFrame:
    return count_where(df, F.col(later) < F.col(earlier), out)


def surplus_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key. With one key column NULL is no key at all."""
    per_key = df.groupBy(*keys).agg(_n().alias("n"))
    keyed = F.lit(True) if len(keys) > 1 else F.col(keys[0]).isNotNull()
    return per_key.agg((F.coalesce(F.sum("n"), F.lit(0)) - F.sum(yes(keyed))).alias("dup_keys"))


def duplicate_keys(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [
            surplus_rows(df, keys).select(F.lit(name).alias("tbl"), "dup_keys")
            for name, (df, keys) in tables.items()
        ],
    )


def late_rate(df: DataFrame, delivered: str, estimated: str, status: str) -> DataFrame:
    late = F.col(delivered) > F.col(estimated)
    return (
        df.where(F.col(status) == "delivered")
        .agg(_n().alias("delivered_orders"), F.sum(yes(late)).alias("late"))
        .withColumn("late_pct", percent(F.col("late"), F.col("delivered_orders"), 2))
    )


def odd_payments(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count_if(F.col("payment_value") == 0).alias("zero_value"),
        F.count_if(F.col("payment_value") < 0).alias("negative_value"),
        F.count_if(F.col("payment_installments") == 0).alias("zero_installments"),
    )


def value_counts(df: DataFrame, column: str, by_value: bool = False) -> DataFrame:
    counted = df.groupBy(column).agg(_n().alias("n"))
    return counted.orderBy(column) if by_value else counted.orderBy(F.col("n").desc(), column)


def price_bounds(items: DataFrame) -> DataFrame:
    return items.agg(
        F.count_if(F.col("price") <= 0).alias("bad_price"),
        F.count_if(F.col("freight_value") < 0).alias("negative_freight"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
    )


def untranslated(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Categories without a translation; counted first, so the anti join sees one row each."""
    category = "product_category_name"
    return (
        products.where(F.col(category).isNotNull())
        .groupBy(category)
        .agg(_n().alias("products"))
        .join(translation.select(category), category, "left_anti")
        .orderBy(F.col("products").desc(), category)
    )


def unmatched(left: DataFrame, right: DataFrame, key: str, out: str) -> DataFrame:
    """Rows of `left` whose key is not in `right`; rows without a key are unmatched too.

    Both sides are reduced to one row per key first, so no key is hot in the join.
    """
    counted = left.groupBy(key).agg(_n().alias("n"))
    missing = counted.join(right.select(key).distinct(), key, "left_anti")
    return missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias(out))


def payment_mismatch(items: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders whose items and payments differ by more than a cent."""
    owed = items.groupBy("order_id").agg(
        F.sum(money("price", 18) + money("freight_value", 18)).alias("owed")
    )
    paid = payments.groupBy("order_id").agg(F.sum(money("payment_value", 18)).alias("paid"))
    gap = F.abs(F.col("owed") - F.col("paid"))
    return owed.join(paid, "order_id").agg(
        _n().alias("orders_compared"),
        F.count_if(gap > F.lit("0.01").cast("decimal(3,2)")).alias("mismatched"),
    )


def moved_people(snapshots: DataFrame) -> DataFrame:
    """People with more than one address, NULL parts counting as values."""
    addresses = snapshots.groupBy("customer_unique_id", "zip", "city", "state").agg(
        _n().alias("n")
    )
    return repeated_keys(addresses, "customer_unique_id", "people_with_changing_address")


def top_values(df: DataFrame, column: str, out: str, k: int = 10) -> DataFrame:
    return (
        df.groupBy(column).agg(_n().alias(out)).orderBy(F.col(out).desc(), column).limit(k)
    )


def table_profile(
    df: DataFrame, null_columns: Sequence[str] = (), date_pairs: Sequence[tuple[str, str]] = ()
) -> DataFrame:
    """Rows, NULLs per column and reversed date pairs of a table in a single scan."""
    return df.agg(
        _n().alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in null_columns],
        *[
            F.count_if(F.col(later) < F.col(earlier)).alias(f"{later}_before_{earlier}")
            for earlier, later in date_pairs
        ],
    )
