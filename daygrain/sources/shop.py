"""The shop's tables as views of TPC-H-like tables and an event log.

A source for trying the plans on generated data: every frame has the declared raw columns, and
what the shop's files get wrong (copies, missing and bad values, late arrivals) comes from the
data's own columns.
"""

from __future__ import annotations

from functools import cached_property
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.functions.values import lookup, yes
from daygrain.operators.copies import keep_first
from daygrain.sinks import files
from daygrain.sources import schemas

# How the generated codes are read as the shop's.
STATUS = {"F": "delivered", "O": "shipped", "P": "canceled"}
EVENT_TYPE = {
    "view": "page_view",
    "click": "add_to_cart",
    "signup": "checkout_start",
    "purchase": "purchase",
}
PAYMENT_TYPE = {"A": "boleto", "N": "credit_card", "R": "not_defined"}
DEVICES = ("desktop", "mobile", "tablet")

# Bytes of the sources' files for each part that the orders and their lines are dealt to.
PART_BYTES = 8 << 20

# The total order by which copies of an order line are told apart.
LINE_ORDER = (
    "l_shipdate",
    "l_partkey",
    "l_suppkey",
    "l_extendedprice",
    "l_quantity",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
)

# The event log is newer than the shop's own files, so its accepted range is, too.
EVENT_RANGE = {"column": "event_ts", "min": "2023-01-01", "max": "2025-01-01"}


def _text(col: str) -> Column:
    return F.col(col).cast("string")


def _exact(col: str, digits: int = 2) -> Column:
    return F.col(col).cast(f"decimal(12,{digits})")


class Shop:
    """Raw tables of the shop, timestamps in local wall clock, over the tables in `folder`."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def source_state(self) -> tuple:
        """Changes when a source table does, so that no query is answered from an older lake."""
        return files.state(self.spark, self.folder)

    @cached_property
    def order_parts(self) -> int:
        """Parts for orders and what belongs to them: more for larger files, so that one stays small."""
        size = sum(s[1] for s in self.source_state if s[0] in ("orders.parquet", "lineitem.parquet"))
        return max(self.spark.sparkContext.defaultParallelism, ceil(size / PART_BYTES))

    def _raw(self, name: str, df: DataFrame) -> DataFrame:
        """The declared columns in declared order and type."""
        return df.select(
            *[F.col(f.name).cast(f.dataType) for f in schemas.raw_schema(name, corrupt=False)]
        )

    @cached_property
    def order_heads(self) -> DataFrame:
        """Orders without the dates that come from their lines."""
        return self.table("orders").select(
            _text("o_orderkey").alias("order_id"),
            F.concat(F.lit("c"), "o_orderkey").alias("customer_id"),
            F.concat(F.lit("u"), "o_custkey").alias("customer_unique_id"),
            lookup(STATUS, "o_orderstatus").alias("order_status"),
            F.col("o_orderdate").cast("timestamp").alias("order_purchase_timestamp"),
            "o_custkey",
            "o_orderpriority",
        )

    @cached_property
    def orders(self) -> DataFrame:
        def shipped(pick, condition: Column) -> Column:
            return pick(F.when(condition, F.col("l_shipdate")))

        dates = self.table("lineitem").groupBy(_text("l_orderkey").alias("order_id")).agg(
            shipped(F.min, F.col("l_returnflag") == "A").alias("order_approved_at"),
            shipped(F.min, F.col("l_linestatus") == "O").alias("order_delivered_carrier_date"),
            shipped(F.max, F.col("l_linestatus") == "F").alias("last_delivery"),
        )
        arrived = F.when(F.col("order_status") == "delivered", F.col("last_delivery"))
        return self._raw(
            "orders",
            self.order_heads.join(dates, "order_id", "left").withColumns(
                {
                    "order_delivered_customer_date": arrived,
                    "order_estimated_delivery_date": F.col("order_purchase_timestamp")
                    + F.expr("interval 365 days"),
                }
            ),
        )

    def _lines(self, lines: DataFrame) -> DataFrame:
        freight = F.round(_exact("l_extendedprice") * _exact("l_tax"), 2)
        return self._raw(
            "order_items",
            lines.select(
                F.col("order_id") if "order_id" in lines.columns else _text("l_orderkey").alias("order_id"),
                F.col("l_linenumber").alias("order_item_id"),
                _text("l_partkey").alias("product_id"),
                _text("l_suppkey").alias("seller_id"),
                F.col("l_shipdate").alias("shipping_limit_date"),
                F.col("l_extendedprice").alias("price"),
                freight.alias("freight_value"),
            ),
        )

    @cached_property
    def all_lines(self) -> DataFrame:
        """Order items with the copies of (order_id, order_item_id) the source has."""
        return self._lines(self.table("lineitem"))

    @cached_property
    def order_items(self) -> DataFrame:
        """Order items without copies. Lines of an order are brought together, so that what is
        joined or summed per order later stays where it is."""
        lines = self.table("lineitem").withColumn("order_id", _text("l_orderkey")).drop("l_orderkey")
        lines = lines.repartition(self.order_parts, "order_id")
        return self._lines(keep_first(lines, ["order_id", "l_linenumber"], LINE_ORDER))

    @cached_property
    def order_payments(self) -> DataFrame:
        """A payment per order line, less its discount."""
        paid = F.round(_exact("l_extendedprice") * (1 - _exact("l_discount")), 2)
        return self._raw(
            "order_payments",
            self.table("lineitem").select(
                _text("l_orderkey").alias("order_id"),
                F.col("l_linenumber").alias("payment_sequential"),
                lookup(PAYMENT_TYPE, "l_returnflag").alias("payment_type"),
                (F.col("l_quantity").cast("int") - 1).alias("payment_installments"),
                paid.alias("payment_value"),
            ),
        )

    @cached_property
    def order_reviews(self) -> DataFrame:
        """A review per order line; one review id serves several orders, scores reach 0."""
        score = 5 - F.floor(_exact("l_discount") * 50).cast("int")
        return self._raw(
            "order_reviews",
            self.table("lineitem").select(
                F.concat_ws("-", "l_partkey", "l_linenumber").alias("review_id"),
                _text("l_orderkey").alias("order_id"),
                score.alias("review_score"),
                F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias(
                    "review_comment_title"
                ),
                F.when(F.col("l_linestatus") != "O", F.col("l_linestatus")).alias(
                    "review_comment_message"
                ),
                F.col("l_shipdate").alias("review_creation_date"),
                (F.col("l_shipdate") + F.make_dt_interval("l_linenumber")).alias(
                    "review_answer_timestamp"
                ),
            ),
        )

    @cached_property
    def customer_snapshots(self) -> DataFrame:
        """One row per order: the person and the address they ordered with."""
        people = self.table("customer").select(
            F.col("c_custkey").alias("o_custkey"),
            _text("c_nationkey").alias("zip"),
            F.col("c_mktsegment").alias("city"),
        )
        return self._raw(
            "customer_snapshots",
            self.order_heads.join(people, "o_custkey").withColumns(
                {
                    "state": F.col("o_orderpriority"),
                    "effective_date": F.date_format("order_purchase_timestamp", "yyyy-MM-dd"),
                }
            ),
        )

    @cached_property
    def products(self) -> DataFrame:
        part = self.table("part")
        price = F.col("p_retailprice").cast("int")
        return self._raw(
            "products",
            part.select(
                _text("p_partkey").alias("product_id"),
                F.when(F.col("p_brand") != "Brand#7", F.col("p_type")).alias(
                    "product_category_name"
                ),
                F.length("p_name").alias("product_name_lenght"),
                F.length("p_brand").alias("product_description_lenght"),
                F.when(F.col("p_size") > 2, F.col("p_size")).alias("product_photos_qty"),
                F.when(F.col("p_size") < 50, F.col("p_size") * 10).alias("product_weight_g"),
                price.alias("product_length_cm"),
                F.col("p_size").alias("product_height_cm"),
                (F.col("p_size") + 1).alias("product_width_cm"),
            ),
        )

    @cached_property
    def translation(self) -> DataFrame:
        """English names of the product types the shop has translated so far."""
        kinds = self.table("part").select(F.col("p_type").alias("product_category_name"))
        return kinds.distinct().where(F.col("product_category_name") != "PROMO").select(
            "product_category_name",
            F.lower("product_category_name").alias("product_category_name_english"),
        )

    @cached_property
    def sellers(self) -> DataFrame:
        nation = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return self.table("supplier").join(
            nation, F.col("s_nationkey") == F.col("n_nationkey")
        ).select(
            _text("s_suppkey").alias("seller_id"),
            _text("s_nationkey").alias("seller_zip_code_prefix"),
            F.col("n_name").alias("seller_city"),
            F.col("r_name").alias("seller_state"),
        )

    @cached_property
    def geolocation(self) -> DataFrame:
        """A point per customer and seller, many to a zip prefix."""

        def points(name: str, zip_col: str, value: str, key: str) -> DataFrame:
            return self.table(name).select(
                F.lpad(_text(zip_col), 5, "0").alias("zip"),
                _exact(value).alias("lat"),
                F.col(key).cast("decimal(12,2)").alias("lng"),
            )

        return points("customer", "c_nationkey", "c_acctbal", "c_custkey").unionByName(
            points("supplier", "s_nationkey", "s_acctbal", "s_suppkey")
        )

    @cached_property
    def events(self) -> DataFrame:
        """Raw events with the day `ingest_dt` they are shipped on, faults included.

        The `k` code in an event's properties picks its fault: no id, unreadable time, a time
        in 1970, shipped twice in a day, shipped again a day later. Events of the last hour of
        a day arrive with the next day.
        """
        log = self.table("events")
        code = F.get_json_object("props", "$.k").cast("int")
        late = yes(F.hour("ts") >= 23)
        arrivals = (
            F.when(code.isin(3, 4), F.array(late, late))
            .when(code == 5, F.array(late, late + 1))
            .otherwise(F.array(late))
        )
        stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
        text = (
            F.when(code == 1, "not-a-timestamp")
            .when(code == 2, "1970-01-01T00:00:00")
            .otherwise(stamp)
        )
        kind = F.coalesce(lookup(EVENT_TYPE, "event_type"), F.col("event_type"))
        device = F.element_at(
            F.array(*[F.lit(d) for d in DEVICES]), (F.col("user_id") % 3 + 1).cast("int")
        )
        return log.select(
            F.when(code != 0, _text("event_id")).alias("event_id"),
            F.concat_ws("-", "user_id", F.date_format("ts", "yyyyMMdd")).alias("session_id"),
            F.concat(F.lit("u"), "user_id").alias("customer_unique_id"),
            F.floor("value").cast("string").alias("product_id"),
            kind.alias("event_type"),
            text.alias("event_ts"),
            device.alias("device"),
            F.to_date("ts").alias("_day"),
            F.explode(arrivals).alias("_days_late"),
        ).select(
            *schemas.RAW["events"].fieldNames(),
            F.lit(None).cast("string").alias(schemas.CORRUPT),
            F.date_add("_day", F.col("_days_late")).cast("string").alias("ingest_dt"),
        )
