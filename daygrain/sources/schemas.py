"""Declared schemas of the raw tables and the typed layout of the clean and quarantine zones."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES = {
    "string": StringType(),
    "int": IntegerType(),
    "bigint": LongType(),
    "double": DoubleType(),
    "date": DateType(),
    "timestamp": TimestampType(),
    "boolean": BooleanType(),
    "decimal(10,2)": DecimalType(10, 2),
    "decimal(12,2)": DecimalType(12, 2),
}


def struct(columns: str) -> StructType:
    """Nullable columns from `name type, name type`, without the session a DDL parser needs."""
    pairs = (c.split(" ", 1) for c in columns.split(", "))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


# Table names, column names, order and types are the files' format (CSV cells are
# bound by position). "lenght" is how the source spells it.
RAW_DDL = {
    "orders": "order_id string, customer_id string, order_status string, "
    "order_purchase_timestamp timestamp, order_approved_at timestamp, "
    "order_delivered_carrier_date timestamp, order_delivered_customer_date timestamp, "
    "order_estimated_delivery_date timestamp",
    "order_items": "order_id string, order_item_id int, product_id string, seller_id string, "
    "shipping_limit_date timestamp, price double, freight_value double",
    "order_payments": "order_id string, payment_sequential int, payment_type string, "
    "payment_installments int, payment_value double",
    "order_reviews": "review_id string, order_id string, review_score int, "
    "review_comment_title string, review_comment_message string, "
    "review_creation_date timestamp, review_answer_timestamp timestamp",
    "customer_snapshots": "customer_id string, customer_unique_id string, zip string, "
    "city string, state string, effective_date string",
    "products": "product_id string, product_category_name string, product_name_lenght int, "
    "product_description_lenght int, product_photos_qty int, product_weight_g int, "
    "product_length_cm int, product_height_cm int, product_width_cm int",
    "sellers": "seller_id string, seller_zip_code_prefix string, seller_city string, "
    "seller_state string",
    "product_category_name_translation": "product_category_name string, "
    "product_category_name_english string",
    # event_ts is text here: a bad timestamp gets its own reason instead of a corrupt row.
    "events": "event_id string, session_id string, customer_unique_id string, product_id string, "
    "event_type string, event_ts string, device string",
}
CORRUPT = "_corrupt_record"
EVENTS = "events"

# Tables whose cells hold free text with line breaks. Only these pay for multi-line parsing,
# which keeps Spark from splitting a file among tasks.
FREE_TEXT = frozenset({"order_reviews"})

# Key of tables that may ship a row twice without a `unique` rule to reject the copy.
ROW_KEYS = {"order_reviews": ["review_id", "order_id"]}

RAW = {name: struct(ddl) for name, ddl in RAW_DDL.items()}
TABLES = tuple(RAW)


def raw_schema(name: str, corrupt: bool = True) -> StructType:
    """Schema to read `name` with; events carry the corrupt-record column unless told not to."""
    corrupt_field = [StructField(CORRUPT, StringType())] if name == EVENTS and corrupt else []
    return StructType([*RAW[name].fields, *corrupt_field])


def text_schema(name: str) -> StructType:
    """The same columns, all of them text, for reading raw files without typing them."""
    return StructType([StructField(f.name, StringType()) for f in RAW[name]])


def zone_schema(name: str, zone: str, has_rules: bool) -> StructType:
    """Columns of a table in the `clean` or `quarantine` zone, without the partition column."""
    fields = [
        StructField(f.name, TimestampType()) if (name, f.name) == (EVENTS, "event_ts") else f
        for f in RAW[name]
    ]
    if zone == "quarantine" and name == EVENTS:
        fields += [StructField(CORRUPT, StringType()), StructField("event_ts_raw", StringType())]
    if zone == "quarantine":
        fields.append(StructField("dq_reason", StringType()))
    if has_rules:
        fields.append(StructField("dq_warn", StringType()))
    return StructType(fields)


# The gold tables and the staging columns the warehouse loads by position.
GOLD_DDL = {
    "dim_product": "product_id string, category_pt string, category_en string, name_length int, "
    "description_length int, photos_qty int, weight_g int, length_cm int, height_cm int, "
    "width_cm int",
    "dim_seller": "seller_id string, zip string, city string, state string",
    "customer_feed": "customer_unique_id string, zip string, city string, state string, "
    "effective_date date",
    "fact_orders": "order_id string, customer_unique_id string, order_date date, "
    "order_status string, purchase_ts timestamp, approved_ts timestamp, "
    "delivered_carrier_ts timestamp, delivered_customer_ts timestamp, "
    "estimated_delivery_ts timestamp, delivered_late boolean, n_items int, "
    "items_value decimal(12,2), freight_value decimal(12,2), payment_value decimal(12,2)",
    "fact_order_items": "order_id string, order_item_id int, product_id string, "
    "seller_id string, customer_unique_id string, order_date date, price decimal(10,2), "
    "freight_value decimal(10,2)",
    "fact_sessions": "session_id string, customer_unique_id string, session_date date, "
    "device string, session_start timestamp, session_end timestamp, n_events int, "
    "furthest_stage string, viewed boolean, carted boolean, checkout_started boolean, "
    "purchased boolean",
}
GOLD = {name: struct(ddl) for name, ddl in GOLD_DDL.items()}

# One row per key in a staged day; a second one must fail the load.
STAGING_KEYS = {
    "dim_product": ["product_id"],
    "dim_seller": ["seller_id"],
    "customer_feed": ["customer_unique_id"],
    "fact_orders": ["order_id"],
    "fact_order_items": ["order_id", "order_item_id"],
    "fact_sessions": ["session_id"],
}
