"""Rules one by one, all of them together, and their summary."""

from __future__ import annotations

from pyspark.sql import functions as F

from daygrain.functions.values import percent
from daygrain.operators import quality
from daygrain.operators.copies import mark_copies
from daygrain.plans.clean import accepted, prepare
from daygrain.registry.base import pct, query, when
from daygrain.registry.star import Star
from daygrain.session import shared_dir
from daygrain.sources import schemas
from daygrain.sources.readers import read_table
from daygrain.sources.shop import LINE_ORDER


def _events_under(star: Star, rule: str):
    """Prepared events with the reasons of one rule kind of their block."""
    block = star.rules["events"]["reject"]
    tagged = quality.with_reasons(
        prepare(star.events, "events"), {rule: block[rule]}, "dq_reason"
    )
    return tagged.where(F.col("dq_reason") != "").select(
        "event_id", "session_id", "ingest_dt", "event_ts_raw", "dq_reason"
    )


_EVENT_ROWS = "SELECT event_id, session_id, ingest_dt, event_ts_raw, {reason} AS dq_reason FROM s_prepared WHERE {where}"


@query(
    "q1_corrupt",
    """
SELECT ingest_dt, count(*) AS rows,
       count(*) FILTER (WHERE product_id = '0') AS corrupt
FROM s_events GROUP BY 1""",
)
def corrupt(star: Star):
    """Events through JSON text in which those for product 0 are cut short, counted per day."""
    names = schemas.RAW["events"].fieldNames()
    text = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    line = F.when(F.col("product_id") == "0", F.left(text, F.length(text) - 3)).otherwise(text)
    folder = shared_dir(star.spark, "corrupt")
    star.events.select(line.alias("value"), "ingest_dt").write.partitionBy("ingest_dt").text(folder)
    tagged = star.tagged("events", read_table(star.spark, "events", folder))
    return tagged.groupBy(F.col("ingest_dt").cast("string").alias("ingest_dt")).agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("dq_reason").startswith("corrupt_record")).alias("corrupt"),
    )


@query(
    "q2_not_null",
    _EVENT_ROWS.format(
        reason="""concat_ws(',', CASE WHEN event_id IS NULL THEN 'null:event_id' END,
            CASE WHEN session_id IS NULL THEN 'null:session_id' END,
            CASE WHEN customer_unique_id IS NULL THEN 'null:customer_unique_id' END,
            CASE WHEN event_ts IS NULL THEN 'null:event_ts' END)""",
        where="""event_id IS NULL OR session_id IS NULL OR customer_unique_id IS NULL
            OR event_ts IS NULL""",
    ),
)
def missing(star: Star):
    return _events_under(star, "not_null")


@query(
    "q3_positive",
    """
SELECT order_id, payment_sequential, 'non_positive:payment_installments' AS dq_reason
FROM s_payments WHERE payment_installments <= 0""",
)
def positive(star: Star):
    tagged = quality.with_reasons(
        star.order_payments, {"positive": ["payment_installments"]}, "dq_reason"
    )
    return tagged.where(F.col("dq_reason") != "").select(
        "order_id", "payment_sequential", "dq_reason"
    )


@query(
    "q4_allowed_values",
    """
SELECT review_id, order_id, review_score, 'bad_value:review_score' AS dq_reason
FROM s_reviews WHERE review_score NOT IN (1, 2, 3, 4, 5)""",
)
def allowed(star: Star):
    block = {"allowed_values": star.rules["order_reviews"]["reject"]["allowed_values"]}
    tagged = quality.with_reasons(star.order_reviews, block, "dq_reason")
    return tagged.where(F.col("dq_reason") != "").select(
        "review_id", "order_id", "review_score", "dq_reason"
    )


@query(
    "q5_valid_timestamp",
    _EVENT_ROWS.format(
        reason="'bad_timestamp:event_ts'", where="event_ts_raw IS NOT NULL AND event_ts IS NULL"
    ),
)
def parsed(star: Star):
    return _events_under(star, "valid_timestamp")


@query(
    "q6_ts_range",
    _EVENT_ROWS.format(
        reason="'out_of_range:event_ts'",
        where="event_ts < TIMESTAMP '2023-01-01' OR event_ts > TIMESTAMP '2025-01-01'",
    ),
)
def in_range(star: Star):
    return _events_under(star, "ts_range")


@query(
    "q7_required_when",
    """
SELECT order_id, order_status,
       'missing_when:order_delivered_customer_date:order_status=delivered' AS dq_reason
FROM s_orders WHERE order_status = 'delivered' AND order_delivered_customer_date IS NULL""",
)
def required(star: Star):
    block = {"required_when": star.rules["orders"]["reject"]["required_when"]}
    tagged = quality.with_reasons(star.orders, block, "dq_reason")
    return tagged.where(F.col("dq_reason") != "").select("order_id", "order_status", "dq_reason")


@query(
    "q8_date_order",
    "SELECT order_id, dq_warn FROM s_tagged_orders WHERE dq_warn <> ''",
)
def ordered_dates(star: Star):
    return star.tagged_orders.where(F.col("dq_warn") != "").select("order_id", "dq_warn")


@query(
    "q9_unique",
    f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, copy > 1 AS is_copy
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
             ORDER BY {', '.join(LINE_ORDER)}) AS copy FROM lineitem)""",
)
def unique(star: Star):
    marked = mark_copies(
        star.table("lineitem"), ["l_orderkey", "l_linenumber"], "is_copy", LINE_ORDER
    )
    return marked.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "is_copy"
    )


@query(
    "q10_apply_rules",
    f"""
SELECT event_id, session_id, event_type, event_ts_raw, ingest_dt,
       {when("event_ts")} AS event_ts, dq_reason, '' AS dq_warn
FROM s_tagged_events""",
)
def all_rules(star: Star):
    return star.tagged_events.select(
        "event_id", "session_id", "event_type", "event_ts_raw", "ingest_dt", "event_ts",
        "dq_reason", "dq_warn",
    )


@query(
    "q11_split",
    """
SELECT 'events' AS "table", count(*) AS total, count(*) FILTER (WHERE dq_reason = '') AS valid,
       count(*) FILTER (WHERE dq_reason <> '') AS bad, 0 AS warned FROM s_tagged_events
UNION ALL
SELECT 'orders', count(*), count(*) FILTER (WHERE dq_reason = ''),
       count(*) FILTER (WHERE dq_reason <> ''),
       count(*) FILTER (WHERE dq_reason = '' AND dq_warn <> '') FROM s_tagged_orders
UNION ALL
SELECT 'order_items', count(*), count(*) FILTER (WHERE price > 0),
       count(*) FILTER (WHERE price <= 0), 0 FROM s_lines
UNION ALL
SELECT 'order_payments', count(*), count(*), 0,
       count(*) FILTER (WHERE payment_value <= 0 OR payment_type = 'not_defined')
FROM s_payments
UNION ALL
SELECT 'order_reviews', count(*), count(*) FILTER (WHERE review_score BETWEEN 1 AND 5),
       count(*) FILTER (WHERE review_score NOT BETWEEN 1 AND 5), 0 FROM s_reviews""",
)
def split(star: Star):
    """Rows each table keeps and rejects; every row is on one side."""
    tagged = {
        "events": star.tagged_events,
        "orders": star.tagged_orders,
        "order_items": star.tagged("order_items", star.all_lines),
        "order_payments": star.tagged("order_payments", star.order_payments),
        "order_reviews": star.tagged("order_reviews", star.order_reviews),
    }
    out = None
    passed = F.col("dq_reason") == ""
    for name, df in tagged.items():
        row = df.agg(
            F.count("*").alias("total"),
            F.count_if(passed).alias("valid"),
            F.count_if(~passed).alias("bad"),
            F.count_if(passed & (F.col("dq_warn") != "")).alias("warned"),
        ).select(F.lit(name).alias("table"), "*")
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "q12_summary",
    f"""
SELECT reason, count(*) AS rows, (SELECT count(*) FROM s_tagged_events) AS total,
       {pct("count(*)", "(SELECT count(*) FROM s_tagged_events)", 3)} AS pct
FROM (SELECT unnest(string_split(dq_reason, ',')) AS reason FROM s_tagged_events
      WHERE dq_reason <> '') GROUP BY 1""",
)
def summary(star: Star):
    return quality.reason_report(star.tagged_events).withColumn(
        "pct", percent(F.col("rows"), F.col("total"), 3)
    )


@query(
    "g1_prepare",
    f"""
SELECT order_id, {when("purchase_ts")} AS order_purchase_timestamp,
       {when("approved_ts")} AS order_approved_at,
       {when("carrier_ts")} AS order_delivered_carrier_date,
       {when("delivered_ts")} AS order_delivered_customer_date,
       {when("estimated_ts")} AS order_estimated_delivery_date FROM s_orders_utc""",
)
def prepared(star: Star):
    return prepare(star.orders, "orders").drop("customer_id", "order_status")


@query(
    "g3_review_dedupe",
    """
SELECT count(*) AS passed, count(DISTINCT (review_id, order_id)) AS kept,
       count(*) - count(DISTINCT (review_id, order_id)) AS dropped
FROM s_reviews WHERE review_score BETWEEN 1 AND 5""",
)
def review_dedupe(star: Star):
    """Reviews that pass the rules, and those left after one per (review, order) is kept."""
    tagged = star.tagged("order_reviews", star.order_reviews)
    passed = tagged.where(F.col("dq_reason") == "").agg(F.count("*").alias("passed"))
    kept = accepted(tagged, "order_reviews").agg(F.count("*").alias("n"))
    return passed.select("passed", kept.scalar().alias("kept")).withColumn(
        "dropped", F.col("passed") - F.col("kept")
    )
