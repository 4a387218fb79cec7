"""Writes and reads of the zones: each query writes to a fresh shared folder, then reads it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.plans import kpi, slices
from daygrain.plans.clean import rejected
from daygrain.plans.gold import build_sessions
from daygrain.plans.warehouse import InvariantError, Warehouse
from daygrain.registry.base import query, when
from daygrain.registry.merging import EVENTS_STORED_UPTO
from daygrain.registry.star import Star
from daygrain.session import millisecond_timestamps, shared_dir
from daygrain.sinks import files
from daygrain.sinks.partitions import (
    overwrite_partitions,
    write_day_text,
    write_gold,
    write_partition,
)
from daygrain.sinks.watermark import latest
from daygrain.sources import schemas
from daygrain.sources.definitions import register_views
from daygrain.sources.readers import (
    read_day,
    read_events_upto,
    read_gold_day,
    read_partitions,
    read_table,
    read_text_table,
)
from daygrain.sources.ready import distinct_days, ready_days
from daygrain.streaming.arrivals import notices, run_ready_days


def _write_events(star: Star, lake: str) -> str:
    """The clean events of all days under `<lake>/clean`; returns that folder."""
    clean = files.join(lake, "clean")
    overwrite_partitions(star.clean_events, files.join(clean, "events"), "ingest_dt")
    return clean


def _clean_zone(star: Star) -> str:
    """The same, written once for all queries that only read it."""

    def write(path: str) -> None:
        _write_events(star, path)
        files.replace_text(star.spark, files.join(path, "_SUCCESS"), "")

    return files.join(star.written("clean_zone", write), "clean")


def _per_day(df: DataFrame, day: str = "ingest_dt") -> DataFrame:
    return df.groupBy(F.col(day).cast("string").alias(day)).agg(F.count("*").alias("rows"))


def _last_day(star: Star) -> str:
    return star.events.agg(F.max("ingest_dt")).first()[0]


_CLEAN_PER_DAY = "SELECT ingest_dt, count(*) AS rows FROM s_clean_events {where} GROUP BY 1"


@query(
    "s1_csv_scan",
    f"""
SELECT order_id, customer_id, order_status, {when("order_purchase_timestamp")} AS purchased,
       {when("order_approved_at")} AS approved, {when("order_delivered_customer_date")} AS delivered
FROM s_orders""",
)
def csv_scan(star: Star):
    """Orders through a CSV file with a header, read with their declared types."""
    folder = shared_dir(star.spark, "csv")
    star.orders.write.option("header", True).csv(folder)
    return read_table(star.spark, "orders", folder).select(
        "order_id",
        "customer_id",
        "order_status",
        F.col("order_purchase_timestamp").alias("purchased"),
        F.col("order_approved_at").alias("approved"),
        F.col("order_delivered_customer_date").alias("delivered"),
    )


@query(
    "s5_read_day",
    """
SELECT event_id, session_id, event_type, ingest_dt FROM s_clean_events
WHERE ingest_dt = (SELECT max(ingest_dt) FROM s_events)""",
)
def one_day(star: Star):
    clean = _clean_zone(star)
    return read_day(star.spark, clean, "events", _last_day(star)).select(
        "event_id", "session_id", "event_type", "ingest_dt"
    )


@query(
    "s6_events_upto",
    _CLEAN_PER_DAY.format(where=f"WHERE ingest_dt <= '{EVENTS_STORED_UPTO}'"),
)
def upto(star: Star):
    clean = _clean_zone(star)
    return _per_day(read_events_upto(star.spark, clean, EVENTS_STORED_UPTO))


@query(
    "s10_views",
    """
SELECT event_type, device, count(*) AS events FROM s_clean_events GROUP BY 1, 2""",
)
def views(star: Star):
    """SQL on the views that the table definitions make of the clean zone."""
    clean = _clean_zone(star)
    register_views(star.spark, clean, "clean", star.rules)
    return star.spark.sql(
        "SELECT event_type, device, count(*) AS events FROM clean_events GROUP BY ALL"
    )


@query(
    "s11_text_events",
    """
SELECT ingest_dt, count(*) AS rows, count(*) FILTER (WHERE product_id <> '0') AS readable,
       count(event_id) FILTER (WHERE product_id <> '0') AS with_id
FROM s_events GROUP BY 1""",
)
def text_events(star: Star):
    """Raw JSON read leniently: a broken line is a row, but has no values."""
    names = schemas.RAW["events"].fieldNames()
    text = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    # Cut before the first value: nothing of the line is left to read.
    line = F.when(F.col("product_id") == "0", F.left(text, F.lit(5))).otherwise(text)
    folder = shared_dir(star.spark, "json")
    star.events.select(line.alias("value"), "ingest_dt").write.partitionBy("ingest_dt").text(folder)
    raw = star.spark.read.schema(schemas.text_schema("events").add("ingest_dt", "string"))
    return (
        raw.json(folder)
        .groupBy("ingest_dt")
        .agg(
            F.count("*").alias("rows"),
            F.count("session_id").alias("readable"),
            F.count("event_id").alias("with_id"),
        )
    )


@query(
    "s12_text_tables",
    """
SELECT o.order_status, count(DISTINCT o.order_id) AS orders, sum(i.price)::DOUBLE AS revenue
FROM s_orders o JOIN s_lines i USING (order_id) GROUP BY 1""",
)
def text_tables(star: Star):
    """The revenue query on raw CSV files whose columns are all text."""
    base = shared_dir(star.spark, "csv")
    for name, df in (("orders", star.orders), ("order_items", star.all_lines)):
        df.write.option("header", True).csv(files.join(base, name))
    return kpi.revenue_by_status(
        read_text_table(star.spark, "orders", files.join(base, "orders")),
        read_text_table(star.spark, "order_items", files.join(base, "order_items")),
    )


def _keys(star: Star) -> DataFrame:
    """Object keys around each arrival day: the marker, plain or encoded, and what is none.

    The keys that are no marker are of days more than a year later.
    """
    other = F.date_add(F.col("ingest_dt").cast("date"), 400).cast("string")
    plain = F.concat(F.lit("dt="), "ingest_dt", F.lit("/_READY"))
    keys = F.array(
        F.when(F.col("ingest_dt") < EVENTS_STORED_UPTO, plain).otherwise(F.url_encode(plain)),
        F.concat(F.lit("dt="), other, F.lit("/events/part-0.json.gz")),
        F.concat(F.lit("raw/dt="), other, F.lit("/_READY")),
        F.concat(F.lit("dt="), other, F.lit("/_READY.tmp")),
        F.concat(F.lit("dt="), F.substring(other, 3, 8), F.lit("/_READY")),
    )
    return star.events.select(F.explode(keys).alias("key"))


@query("s14_ready_days", "SELECT DISTINCT ingest_dt AS dt FROM s_events")
def ready(star: Star):
    return ready_days(_keys(star))


@query(
    "s15_days_union",
    """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS dt FROM orders
UNION SELECT strftime(l_shipdate, '%Y-%m-%d') FROM lineitem
UNION SELECT ingest_dt FROM s_events""",
)
def all_days(star: Star):
    """Days on which anything was ordered, shipped or browsed."""
    return distinct_days(
        [
            star.table("orders").select(F.col("o_orderdate").cast("date").alias("dt")),
            star.table("lineitem").select(F.col("l_shipdate").cast("date").alias("dt")),
            star.events.select(F.col("ingest_dt").alias("dt")),
        ]
    )


@query("k1_overwrite", _CLEAN_PER_DAY.format(where=""))
def overwrite(star: Star):
    """All days written twice and the last one a third time: every day is there once."""
    lake = shared_dir(star.spark, "lake")
    clean = _write_events(star, lake)
    _write_events(star, lake)
    last = _last_day(star)
    again = star.clean_events.where(F.col("ingest_dt") == last)
    write_partition(again, files.join(clean, "events"), last)
    return _per_day(read_partitions(star.spark, files.join(clean, "events")))


@query(
    "k2_stale",
    _CLEAN_PER_DAY.format(where="WHERE ingest_dt < (SELECT max(ingest_dt) FROM s_events)"),
)
def stale(star: Star):
    """The last day is written again without rows: its old partition is gone, others stay."""
    clean = _write_events(star, shared_dir(star.spark, "lake"))
    none = star.clean_events.where(F.col("ingest_dt") < "")
    write_partition(none, files.join(clean, "events"), _last_day(star))
    return _per_day(read_partitions(star.spark, files.join(clean, "events")))


@query(
    "k3_quarantine",
    """
SELECT ingest_dt, dq_reason, count(*) AS rows FROM s_tagged_events
WHERE dq_reason <> '' GROUP BY 1, 2""",
)
def quarantine(star: Star):
    base = files.join(shared_dir(star.spark, "lake"), "quarantine", "events")
    overwrite_partitions(rejected(star.tagged_events), base, "ingest_dt")
    return (
        read_partitions(star.spark, base)
        .groupBy("ingest_dt", "dq_reason")
        .agg(F.count("*").alias("rows"))
    )


@query(
    "k4_replace",
    """
SELECT 'replaced' AS dt, count(*) AS sessions, sum(n_events)::BIGINT AS events FROM s_sessions
UNION ALL SELECT 'removed', 0, 0""",
)
def replace(star: Star):
    """A gold folder written with an older state and then replaced, another one removed."""
    gold = shared_dir(star.spark, "gold")
    early = build_sessions(star.clean_events.where(F.col("ingest_dt") <= EVENTS_STORED_UPTO))
    for dt, frames in (("replaced", (early, star.sessions)), ("removed", (early, None))):
        for df in frames:
            write_gold(star.spark, df, gold, "fact_sessions", dt)
    rows = [
        read_gold_day(star.spark, gold, "fact_sessions", dt)
        .agg(
            F.count("*").alias("sessions"),
            F.coalesce(F.sum("n_events"), F.lit(0)).alias("events"),
        )
        .select(F.lit(dt).alias("dt"), "*")
        for dt in ("replaced", "removed")
    ]
    return reduce(DataFrame.unionByName, rows)


@query(
    "k5_milliseconds",
    """
SELECT event_id, (epoch_us(ts) + event_id * 7 % 1000) // 1000 * 1000 AS micros FROM events""",
)
def milliseconds(star: Star):
    """Times with microseconds, written the way every zone is: what is read back ends in milliseconds."""
    micros = F.unix_micros(F.col("ts").cast("timestamp")) + F.col("event_id") * 7 % 1000
    df = star.table("events").select("event_id", F.timestamp_micros(micros).alias("event_ts"))
    base = shared_dir(star.spark, "times")
    with millisecond_timestamps(star.spark):
        write_partition(df, base, "all")
    return star.spark.read.parquet(base).select("event_id", F.unix_micros("event_ts").alias("micros"))


SLICE_FIRST, SLICE_LAST = "1997-11-10", "1997-12-09"


def _sliced_sql(table: str, source: str) -> str:
    return f"""
SELECT '{table}' AS "table", strftime(o.order_purchase_timestamp, '%Y-%m-%d') AS dt,
       count(*) AS rows FROM {source} x JOIN s_sliced o USING (order_id) GROUP BY ALL"""


@query(
    "k6_slice",
    f"""
WITH s_sliced AS (SELECT * FROM s_orders WHERE order_purchase_timestamp >= '{SLICE_FIRST}'
                  AND order_purchase_timestamp < DATE '{SLICE_LAST}' + 1)
{_sliced_sql("orders", "s_orders")}
UNION ALL {_sliced_sql("order_items", "s_items")}
UNION ALL {_sliced_sql("order_payments", "s_payments")}
UNION ALL SELECT 'customer_snapshots', strftime(effective_date, '%Y-%m-%d'), count(*)
          FROM s_snapshots WHERE customer_id IN (SELECT customer_id FROM s_sliced) GROUP BY ALL
UNION ALL SELECT 'order_reviews', strftime(review_creation_date, '%Y-%m-%d'), count(*)
          FROM s_reviews WHERE order_id IN (SELECT order_id FROM s_sliced)
          AND review_creation_date >= '{SLICE_FIRST}'
          AND review_creation_date < DATE '{SLICE_LAST}' + 1 GROUP BY ALL
UNION ALL SELECT 'products', '{SLICE_FIRST}', count(*) FROM s_products
UNION ALL SELECT 'sellers', '{SLICE_FIRST}', count(*) FROM s_sellers
UNION ALL SELECT 'product_category_name_translation', '{SLICE_FIRST}', count(*)
          FROM s_translation""",
)
def sliced(star: Star):
    """A month of the source tables shipped as gzip CSV day folders, counted from the files."""
    source = {
        "orders": star.orders,
        "order_items": star.order_items,
        "order_payments": star.order_payments,
        "order_reviews": star.order_reviews,
        "customer_snapshots": star.customer_snapshots,
        "products": star.products,
        "sellers": star.sellers,
        "product_category_name_translation": star.translation,
    }
    base = shared_dir(star.spark, "raw")
    cut = slices.slice_tables(source, SLICE_FIRST, SLICE_LAST)
    slices.ship(cut, base)

    def shipped(name: str) -> DataFrame:
        schema = schemas.raw_schema(name).add("dt", "string")
        rows = star.spark.read.schema(schema).option("header", True).csv(files.join(base, name))
        return rows.groupBy("dt").agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("table"), "dt", "rows"
        )

    return reduce(DataFrame.unionByName, [shipped(name) for name in cut])


@query(
    "k7_json_days",
    """
SELECT ingest_dt AS dt, count(*) AS rows, count(event_id) AS with_id, min(event_ts_raw) AS first
FROM s_events GROUP BY 1""",
)
def json_days(star: Star):
    """Raw events shipped as gzip JSON lines per arrival day, read back as text."""
    base = shared_dir(star.spark, "raw")
    days = star.events.drop(schemas.CORRUPT).withColumnRenamed("ingest_dt", "dt")
    write_day_text(days, base, "events", "json")
    read = star.spark.read.schema(schemas.text_schema("events").add("dt", "string"))
    return read.json(files.join(base, "events")).groupBy("dt").agg(
        F.count("*").alias("rows"),
        F.count("event_id").alias("with_id"),
        F.min("event_ts").alias("first"),
    )


@query(
    "k10_watermark",
    """
SELECT 'orders' AS "table", strftime(max(o_orderdate), '%Y-%m-%d') AS dt FROM orders
UNION ALL SELECT 'events', max(ingest_dt) FROM s_events""",
)
def watermark(star: Star):
    """The watermark of each table from a log with one entry per finished (table, day)."""
    orders = star.table("orders").select(
        F.lit("orders").alias("table"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt")
    )
    events = star.events.select(F.lit("events").alias("table"), F.col("ingest_dt").alias("dt"))
    return latest(orders.unionByName(events).distinct())


@query("stream_ready_days", "SELECT DISTINCT ingest_dt AS dt FROM s_events")
def streamed_days(star: Star):
    """Markers arriving as notification documents, handled by the stream day by day."""
    base = shared_dir(star.spark, "stream")
    inbox, done = files.join(base, "inbox"), files.join(base, "done")
    records = F.to_json(
        F.struct(
            F.array(
                F.struct(F.struct(F.struct("key").alias("object")).alias("s3"))
            ).alias("Records")
        )
    )
    _keys(star).distinct().select(records.alias("value")).write.text(inbox)

    def on_day(spark, dt: str) -> None:
        write_partition(spark.range(1), done, dt, "dt")

    stream = run_ready_days(notices(star.spark, inbox), on_day, files.join(base, "checkpoint"))
    stream.awaitTermination()
    return read_partitions(star.spark, done, "dt").select("dt")


@query(
    "k12_publish",
    """
SELECT 'fact_orders' AS "table", count(*) AS rows, sum(payment_value)::DOUBLE AS amount
FROM s_gold_orders
UNION ALL SELECT 'fact_order_items', count(*), sum(price)::DOUBLE FROM s_gold_items
UNION ALL SELECT 'fact_sessions', count(*), sum(n_events)::DOUBLE FROM s_sessions
UNION ALL SELECT 'dim_customer', count(DISTINCT customer_unique_id), 0 FROM s_gold_orders
UNION ALL SELECT 'dim_product', count(*), 0 FROM s_dim_product
UNION ALL SELECT 'dim_seller', count(*), 0 FROM s_sellers""",
)
def published(star: Star):
    """A load that passes the checks, then one that does not: readers still see the first.

    The second load ships the orders without their items' value, so totals and items disagree.
    """
    spark, base = star.spark, shared_dir(star.spark, "warehouse")
    gold, first, second = files.join(base, "gold"), "2024-02-01", "2024-02-02"
    earliest = star.feed.groupBy("customer_unique_id").agg(
        F.min_by(F.struct("zip", "city", "state"), "effective_date").alias("a"),
        F.min("effective_date").alias("effective_date"),
    )
    people = earliest.select(
        "customer_unique_id", "a.zip", "a.city", "a.state", "effective_date"
    )
    frames = {
        "dim_product": star.dim_product,
        "dim_seller": star.dim_seller,
        "customer_feed": people,
        "fact_orders": star.gold_orders,
        "fact_order_items": star.gold_items,
        "fact_sessions": star.sessions,
    }
    for table, df in frames.items():
        write_gold(spark, df.select(schemas.GOLD[table].fieldNames()), gold, table, first)
    broken = star.gold_orders.withColumn("items_value", F.lit(0).cast("decimal(12,2)"))
    write_gold(
        spark, broken.select(schemas.GOLD["fact_orders"].fieldNames()), gold, "fact_orders", second
    )
    warehouse = Warehouse(spark, files.join(base, "warehouse"), calendar=star.dim_date, grain="year")
    warehouse.load_day(first, gold)
    try:
        warehouse.load_day(second, gold)
    except InvariantError:
        pass
    else:
        raise AssertionError("a load that breaks the totals was published")
    amount = {
        "fact_orders": F.sum("payment_value"),
        "fact_order_items": F.sum("price"),
        "fact_sessions": F.sum("n_events"),
    }
    rows = [
        warehouse.read(table)
        .agg(
            F.count("*").alias("rows"),
            amount.get(table, F.lit(0)).cast("double").alias("amount"),
        )
        .select(F.lit(table).alias("table"), "*")
        for table in ("fact_orders", "fact_order_items", "fact_sessions", "dim_customer",
                      "dim_product", "dim_seller")
    ]
    return reduce(DataFrame.unionByName, rows)
