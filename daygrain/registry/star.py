"""Clean, gold and warehouse tables over the generated ones, built by the plans of a day's run.

As in a lake, a table is written when it is first needed and then read: the folders are shared
by the queries of one Spark application, and what is read from them needs no rebuilding when an
executor is lost.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Mapping
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.operators.quality import load_rules
from daygrain.operators.versions import PERSON, SURROGATE, as_of, history
from daygrain.plans import distinct, gold
from daygrain.plans.clean import accepted, prepare, rejected, tag_table
from daygrain.plans.sessions import index_days
from daygrain.session import shared_dir, shuffle_partitions
from daygrain.sinks import files
from daygrain.sources import schemas
from daygrain.sources.readers import read_text_table
from daygrain.sources.shop import EVENT_RANGE, Shop

# (application, source folder and its state, table) to the folder it was written to.
_WRITTEN: dict[tuple, str] = {}
_WRITING = threading.RLock()

# Lines of a shipped text file: gzip cannot be split, so a file is the work of one task.
LINES_PER_FILE = 100_000
# Shipped text is read once or twice, so it is packed at the fast level of gzip.
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


# Warehouse table to the attribute of `Star` that builds it.
_TABLES = {
    "dim_date": "dim_date",
    "dim_customer": "dim_customer",
    "dim_product": "dim_product",
    "dim_seller": "dim_seller",
    "fact_orders": "fact_orders",
    "fact_order_items": "fact_items",
    "fact_sessions": "sessions",
}


class Tables(Mapping):
    """The warehouse tables by name. One is built when it is looked up, so a check that reads two
    tables of seven does not wait for the others."""

    def __init__(self, star: Star):
        self.star = star

    def __getitem__(self, table: str) -> DataFrame:
        return getattr(self.star, _TABLES[table])

    def __contains__(self, table: object) -> bool:
        return table in _TABLES

    def __iter__(self) -> Iterator[str]:
        return iter(_TABLES)

    def __len__(self) -> int:
        return len(_TABLES)


class Star(Shop):
    def written(self, name: str, write: Callable[[str], None]) -> str:
        """The folder `write` filled for this source and application; threads take turns."""
        key = (self.spark.sparkContext.applicationId, self.folder, self.source_state, name)
        with _WRITING:
            path = _WRITTEN.get(key)
            if path is None or not files.exists(self.spark, files.join(path, "_SUCCESS")):
                path = shared_dir(self.spark, name)
                write(path)
                _WRITTEN[key] = path
        return path

    def added(self, path: str, write: Callable[[str], None]) -> None:
        """Fill a folder inside a written one, unless its job was committed before."""
        with _WRITING:
            if not files.exists(self.spark, files.join(path, "_SUCCESS")):
                write(path)

    def stored(
        self, name: str, build: Callable[[], DataFrame], partition: str | None = None
    ) -> DataFrame:
        def write(path: str) -> None:
            df = build()
            writer = df.hint("rebalance", partition).write.partitionBy(partition) if (
                partition
            ) else df.write
            writer.option("compression", "zstd").parquet(path)

        path = self.written(name, write)
        if partition is None:
            return self.spark.read.parquet(path)
        # Declared as text, so the partition column is not guessed to be a date.
        schema = self.spark.read.parquet(path).drop(partition).schema.add(partition, "string")
        return self.spark.read.schema(schema).parquet(path)

    def stored_by_order(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A stored table in buckets of `order_id`: joins and sums per order of two such tables
        move nothing. The catalog keeps how it is cut, under a name of its own."""
        n = self.order_parts

        def write(path: str) -> None:
            with shuffle_partitions(self.spark, n):
                (
                    build().repartition(n, "order_id").write.bucketBy(n, "order_id")
                    .format("parquet").option("compression", "zstd").option("path", path)
                    .saveAsTable(path.rsplit("/", 1)[1].replace("-", "_"))
                )

        path = self.written(name, write)
        return self.spark.table(path.rsplit("/", 1)[1].replace("-", "_"))

    @cached_property
    def rules(self) -> dict:
        rules = load_rules()
        rules["events"]["reject"]["ts_range"] = EVENT_RANGE
        return rules

    def tagged(self, name: str, raw: DataFrame) -> DataFrame:
        """Rows with their reasons, as if every arrival day had been cleaned by itself."""
        within = ["ingest_dt"] if "ingest_dt" in raw.columns else []
        return tag_table(prepare(raw, name), name, self.rules, within)

    # Raw zone: text files.

    @cached_property
    def raw_events(self) -> DataFrame:
        """Events as shipped: gzip JSON lines per arrival day, read without types."""

        def write(path: str) -> None:
            self.events.drop(schemas.CORRUPT).hint("rebalance", "ingest_dt").write.partitionBy(
                "ingest_dt"
            ).options(**GZIP).option("ignoreNullFields", False).json(path)

        path = self.written("raw_events", write)
        schema = schemas.text_schema("events").add("ingest_dt", "string")
        return self.spark.read.schema(schema).json(path)

    def _raw_csv(self, name: str, df: DataFrame) -> DataFrame:
        def write(path: str) -> None:
            writer = df.write.option("maxRecordsPerFile", LINES_PER_FILE)
            writer.option("header", True).options(**GZIP).csv(path)

        return read_text_table(self.spark, name, self.written(f"raw_{name}", write))

    @cached_property
    def raw_orders(self) -> DataFrame:
        return self._raw_csv("orders", self.orders)

    @cached_property
    def raw_items(self) -> DataFrame:
        return self._raw_csv("order_items", self.all_lines)

    # Clean and quarantine zones.

    @cached_property
    def tagged_events(self) -> DataFrame:
        return self.tagged("events", self.events)

    @cached_property
    def clean_events(self) -> DataFrame:
        return self.stored(
            "clean_events", lambda: accepted(self.tagged_events, "events"), "ingest_dt"
        )

    @property
    def clean_events_at(self) -> str:
        """The folder of the event zone, one sub-folder per arrival day."""
        self.clean_events
        return self.written("clean_events", lambda path: None)

    @cached_property
    def event_index_at(self) -> str:
        def write(path: str) -> None:
            index_days(self.spark, self.clean_events_at, path)
            files.replace_text(self.spark, files.join(path, "_SUCCESS"), "")

        return self.written("event_index", write)

    @cached_property
    def session_bitmaps_at(self) -> str:
        """Bitmaps of the sessions of each arrival day and event type."""

        def write(path: str) -> None:
            distinct.index_days(self.clean_events, path, "session_id", ["event_type"])
            files.replace_text(self.spark, files.join(path, "_SUCCESS"), "")

        return self.written("session_bitmaps", write)

    @cached_property
    def tagged_orders(self) -> DataFrame:
        return self.tagged("orders", self.orders)

    @cached_property
    def clean_orders(self) -> DataFrame:
        return self.stored_by_order("clean_orders", lambda: accepted(self.tagged_orders, "orders"))

    @cached_property
    def quarantined_orders(self) -> DataFrame:
        return self.stored("quarantine_orders", lambda: rejected(self.tagged_orders))

    @cached_property
    def clean_items(self) -> DataFrame:
        return self.stored_by_order(
            "clean_items",
            lambda: accepted(self.tagged("order_items", self.order_items), "order_items"),
        )

    # Gold builders, not stored.

    def build_sessions(self, dt: str | None = None) -> DataFrame:
        return gold.build_sessions(self.clean_events, dt)

    def build_feed(self) -> DataFrame:
        return gold.build_customer_feed(self.customer_snapshots, self.clean_orders)

    @cached_property
    def linked_orders(self) -> DataFrame:
        """Clean orders with their person, which both facts need."""
        return self.stored_by_order(
            "linked_orders", lambda: gold.attach_customer(self.clean_orders, self.customer_snapshots)
        )

    def build_fact_orders(self) -> DataFrame:
        return gold.build_fact_orders(
            self.linked_orders, self.clean_items, self.order_payments, None
        )

    def build_fact_items(self) -> DataFrame:
        return gold.build_fact_items(self.linked_orders, self.clean_items, None)

    def build_dim_product(self) -> DataFrame:
        return gold.build_dim_product(self.products, self.translation)

    def build_dim_seller(self) -> DataFrame:
        return gold.build_dim_seller(self.sellers)

    def build_dim_date(self) -> DataFrame:
        """A calendar over all days on which something was ordered or browsed."""

        def bounds(table: str, ts: str) -> DataFrame:
            day = F.col(ts).cast("date")
            return self.table(table).agg(F.min(day).alias("first"), F.max(day).alias("last"))

        both = bounds("orders", "o_orderdate").unionByName(bounds("events", "ts"))
        return gold.calendar(both.agg(F.min("first").alias("first"), F.max("last").alias("last")))

    # Warehouse tables.

    @cached_property
    def sessions(self) -> DataFrame:
        return self.stored("fact_sessions", self.build_sessions)

    @cached_property
    def feed(self) -> DataFrame:
        return self.stored("customer_feed", self.build_feed)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self.stored("dim_customer", lambda: history(self.feed))

    @cached_property
    def dim_product(self) -> DataFrame:
        return self.stored("dim_product", self.build_dim_product)

    @cached_property
    def dim_seller(self) -> DataFrame:
        return self.stored("dim_seller", self.build_dim_seller)

    @cached_property
    def dim_date(self) -> DataFrame:
        return self.stored("dim_date", self.build_dim_date)

    @cached_property
    def gold_orders(self) -> DataFrame:
        """Orders before their customer version is looked up.

        As in a day's run the gold rows are written first: the lookup uses its input more than
        once, and a written one is cheaper than the joins it comes from.
        """
        return self.stored_by_order("gold_orders", self.build_fact_orders)

    @cached_property
    def gold_items(self) -> DataFrame:
        return self.stored_by_order("gold_items", self.build_fact_items)

    @cached_property
    def fact_orders(self) -> DataFrame:
        return self.stored_by_order(
            "fact_orders", lambda: as_of(self.gold_orders, self.dim_customer, "order_date")
        )

    @cached_property
    def fact_items(self) -> DataFrame:
        """Items of an order have its one person and day, so only orders travel to their version."""

        def build() -> DataFrame:
            items = self.gold_items
            heads = items.select("order_id", PERSON, "order_date").distinct()
            versions = as_of(heads, self.dim_customer, "order_date")
            return items.join(versions.select("order_id", SURROGATE), "order_id").select(
                *items.columns, SURROGATE
            )

        return self.stored_by_order("fact_order_items", build)

    @property
    def warehouse(self) -> Mapping[str, DataFrame]:
        return Tables(self)

    def with_version(self, facts: DataFrame, dim: DataFrame | None = None) -> DataFrame:
        """The version a fact points at, told by its start: surrogate keys are hashes."""
        dim = self.dim_customer if dim is None else dim
        start = dim.select(SURROGATE, F.col("valid_from").alias("version_from"))
        return facts.join(start, SURROGATE, "left").drop(SURROGATE)
