"""The runs themselves: shipped files to clean zone, clean zone to gold, gold days to warehouse.

The clean and the gold run get whole tables as the drop of one day, the warehouse several days.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.plans import clean, gold
from daygrain.plans.gold import build_sessions
from daygrain.plans.warehouse import Warehouse
from daygrain.registry.base import define, query
from daygrain.registry.star import GZIP, LINES_PER_FILE, Star
from daygrain.session import shared_dir
from daygrain.sinks import files
from daygrain.sinks.partitions import write_gold
from daygrain.sources import schemas
from daygrain.sources.readers import no_rows, read_gold_day, read_inferred, read_partitions

# Everything has arrived by this day.
DAY = "2024-12-31"


def ship(star: Star, *names: str) -> str:
    """Tables as text files of one day's drop, all but the sellers if no names are given; returns
    the raw folder. A table is shipped once, whichever queries ask for it."""
    tables = {
        "events": star.events.drop("ingest_dt", schemas.CORRUPT),
        "orders": star.orders,
        "order_items": star.order_items,
        "order_payments": star.order_payments,
        "order_reviews": star.order_reviews,
        "customer_snapshots": star.customer_snapshots,
        "products": star.products,
        "product_category_name_translation": star.translation,
    }

    def prepare(path: str) -> None:
        files.replace_text(star.spark, files.join(path, "rules.yaml"), json.dumps(star.rules))
        files.replace_text(star.spark, files.join(path, "_SUCCESS"), "")

    def write(name: str, at: str) -> None:
        writer = tables[name].write.option("maxRecordsPerFile", LINES_PER_FILE).options(**GZIP)
        if name == schemas.EVENTS:
            writer.option("ignoreNullFields", False).mode("overwrite").json(at)
        else:
            writer.option("header", True).option("escape", '"').mode("overwrite").csv(at)

    path = star.written("raw_drop", prepare)
    for name in names or tables:
        star.added(files.join(path, f"dt={DAY}", name), lambda at, name=name: write(name, at))
    return path


def clean_day(star: Star) -> tuple[str, list[dict]]:
    """The lake the clean run filled from the drop, and the run's summaries."""
    raw = ship(star)

    def write(path: str) -> None:
        done = clean.run(
            star.spark, DAY, raw_dir=raw, lake_dir=path, rules_path=files.join(raw, "rules.yaml")
        )
        files.replace_text(star.spark, files.join(path, "_SUCCESS"), json.dumps(done))

    lake = star.written("lake", write)
    return lake, json.loads(files.read_text(star.spark, files.join(lake, "_SUCCESS")))


define(
    "s_drop",
    """
SELECT 'events' AS "table", dq_reason, false AS warned, NULL AS row_key FROM s_drop_events
UNION ALL SELECT 'orders', dq_reason, dq_warn <> '', NULL FROM s_tagged_orders
UNION ALL SELECT 'order_items', '', false, NULL FROM s_items
UNION ALL SELECT 'order_payments', '', payment_value <= 0 OR payment_type = 'not_defined', NULL
          FROM s_payments
UNION ALL SELECT 'order_reviews',
                 CASE WHEN review_score < 1 THEN 'bad_value:review_score' ELSE '' END, false,
                 review_id || '/' || order_id FROM s_reviews
UNION ALL SELECT 'customer_snapshots', '', false, NULL FROM s_snapshots
UNION ALL SELECT 'products', '', false, NULL FROM s_products
UNION ALL SELECT 'product_category_name_translation', '', false, NULL FROM s_translation""",
)


@query(
    "g4_clean_run",
    """
SELECT "table", count(*) AS total, count(*) FILTER (WHERE dq_reason <> '') AS quarantined,
       count(*) FILTER (WHERE warned AND dq_reason = '') AS warned,
       coalesce(count(row_key) FILTER (WHERE dq_reason = ''), 0)
         - coalesce(count(DISTINCT row_key) FILTER (WHERE dq_reason = ''), 0) AS dups_dropped,
       count(*) FILTER (WHERE dq_reason = '') - count(row_key) FILTER (WHERE dq_reason = '')
         + count(DISTINCT row_key) FILTER (WHERE dq_reason = '') AS clean_rows,
       count(*) FILTER (WHERE dq_reason <> '') AS quarantine_rows
FROM s_drop GROUP BY 1""",
)
def clean_run(star: Star):
    """A drop without sellers: the run's summary of each table beside the rows of both zones."""
    lake, done = clean_day(star)

    def rows(zone: str, table: str) -> DataFrame:
        found = read_partitions(star.spark, files.join(lake, zone, table))
        if found is None:
            found = no_rows(star.spark, schemas.struct("ingest_dt string"))
        return found.where(F.col("ingest_dt") == DAY).agg(F.count("*").alias("n"))

    lines = [
        star.spark.range(1).select(
            F.lit(s["table"]).alias("table"),
            *[F.lit(s[c]).cast("bigint").alias(c) for c in (
                "total", "quarantined", "warned", "dups_dropped")],
            rows("clean", s["table"]).scalar().alias("clean_rows"),
            rows("quarantine", s["table"]).scalar().alias("quarantine_rows"),
        )
        for s in done
    ]
    return reduce(DataFrame.unionByName, lines)


@query(
    "l4_reasons",
    """
SELECT "table", reason, rows,
       row_number() OVER (PARTITION BY "table" ORDER BY rows DESC, reason) AS place
FROM (SELECT "table", unnest(string_split(dq_reason, ',')) AS reason, count(*) AS rows
      FROM s_drop WHERE dq_reason <> '' GROUP BY 1, 2)""",
)
def reasons(star: Star):
    """The reasons a clean run reports per table, the most frequent first."""
    _, done = clean_day(star)
    found = [
        (s["table"], reason, rows, place)
        for s in done
        for place, (reason, rows) in enumerate(s["by_reason"].items(), 1)
    ]
    return star.spark.createDataFrame(found, "table string, reason string, rows long, place long")


def gold_day(star: Star) -> tuple[str, dict[str, int]]:
    """The gold folders of the cleaned day and the run's counts.

    Sellers of an earlier run lie there before; the day did not ship any.
    """
    lake, _ = clean_day(star)

    def write(path: str) -> None:
        write_gold(star.spark, star.build_dim_seller(), path, "dim_seller", DAY)
        rows = gold.run(star.spark, DAY, files.join(lake, "clean"), path)
        files.replace_text(star.spark, files.join(path, "_SUCCESS"), json.dumps(rows))

    path = star.written("gold", write)
    return path, json.loads(files.read_text(star.spark, files.join(path, "_SUCCESS")))


@query(
    "g12_gold_run",
    """
SELECT 'fact_orders' AS "table", count(*) AS reported, count(*) AS rows,
       sum(items_value + payment_value)::DOUBLE AS amount FROM s_gold_orders
UNION ALL SELECT 'fact_order_items', count(*), count(*), sum(price)::DOUBLE FROM s_gold_items
UNION ALL SELECT 'fact_sessions', count(*), count(*), sum(n)::DOUBLE
          FROM (SELECT count(*) AS n FROM s_drop_events WHERE dq_reason = '' GROUP BY session_id)
UNION ALL SELECT 'customer_feed', count(*), count(*), NULL FROM s_feed
UNION ALL SELECT 'dim_product', count(*), count(*), sum(weight_g)::DOUBLE FROM s_dim_product
UNION ALL SELECT 'dim_seller', 0, 0, NULL
UNION ALL SELECT 'items_without_order', count(*), NULL, NULL FROM s_items
          WHERE order_id NOT IN (SELECT order_id FROM s_clean_orders)""",
)
def gold_run(star: Star):
    """What the gold run reports beside what its folders hold; the absent sellers are gone."""
    path, reported = gold_day(star)
    amount = {
        "fact_orders": F.sum(F.col("items_value") + F.col("payment_value")),
        "fact_order_items": F.sum("price"),
        "fact_sessions": F.sum("n_events"),
        "dim_product": F.sum("weight_g"),
    }

    def line(table: str) -> DataFrame:
        if table in schemas.GOLD:
            stored = read_gold_day(star.spark, path, table, DAY).agg(
                F.count("*").alias("rows"),
                amount.get(table, F.lit(None)).cast("double").alias("amount"),
            )
        else:
            stored = star.spark.range(1).select(
                F.lit(None).cast("bigint").alias("rows"), F.lit(None).cast("double").alias("amount")
            )
        return stored.select(
            F.lit(table).alias("table"), F.lit(reported[table]).cast("bigint").alias("reported"), "*"
        )

    return reduce(DataFrame.unionByName, [line(t) for t in reported])


# Days of the replay: the arrivals up to the day, and the orders placed from one day to another.
REPLAYED = (
    ("2024-01-10", "1900-01-01", "1995-01-01"),
    ("2024-01-20", "1995-01-01", "1997-01-01"),
    (DAY, "1997-01-01", "2100-01-01"),
)
_CUTS = ", ".join(f"effective_date >= DATE '{first}'" for _, first, _ in REPLAYED)


@query(
    "k13_replay",
    f"""
WITH fed AS (
  SELECT *, row_number() OVER (PARTITION BY customer_unique_id, {_CUTS}
                               ORDER BY effective_date) AS nth FROM s_feed),
changed AS (
  SELECT customer_unique_id AS person, effective_date AS day,
         (zip, city, state) IS DISTINCT FROM lag((zip, city, state)) OVER w AS moved
  FROM fed WHERE nth = 1 WINDOW w AS (PARTITION BY customer_unique_id ORDER BY effective_date)),
versions AS (
  SELECT person, day, lead(day) OVER (PARTITION BY person ORDER BY day) AS until
  FROM changed WHERE moved)
SELECT 'dim_customer' AS "table", person AS key, strftime(day, '%Y-%m-%d') AS day,
       strftime(until, '%Y-%m-%d') AS until, NULL::DOUBLE AS amount FROM versions
UNION ALL
SELECT 'fact_orders', order_id, strftime(max(day), '%Y-%m-%d'), NULL,
       any_value(payment_value)::DOUBLE
FROM s_gold_orders JOIN versions ON person = customer_unique_id AND day <= order_date
GROUP BY order_id
UNION ALL
SELECT 'fact_sessions', session_id, strftime(session_date, '%Y-%m-%d'), NULL, n_events::DOUBLE
FROM s_sessions""",
)
def replay(star: Star):
    """Three gold days loaded in order and the second one again: people move, sessions grow and
    get an earlier day by late events. What is stored equals the state built in one go."""
    spark, base = star.spark, shared_dir(star.spark, "replay")
    gold_dir = files.join(base, "gold")
    for dt, first, last in REPLAYED:

        def placed(day: str, first=first, last=last):
            bounds = [F.lit(d).cast("date") for d in (first, last)]
            return (F.col(day) >= bounds[0]) & (F.col(day) < bounds[1])

        feed = star.feed.where(placed("effective_date")).groupBy("customer_unique_id").agg(
            F.min_by(F.struct("zip", "city", "state", "effective_date"), "effective_date").alias("a")
        )
        frames = {
            "customer_feed": feed.select("customer_unique_id", "a.*"),
            "fact_orders": star.gold_orders.where(placed("order_date")),
            "fact_order_items": star.gold_items.where(placed("order_date")),
            "fact_sessions": build_sessions(star.clean_events.where(F.col("ingest_dt") <= dt)),
        }
        if dt == REPLAYED[0][0]:
            frames |= {"dim_product": star.dim_product, "dim_seller": star.dim_seller}
        for table, df in frames.items():
            write_gold(spark, df.select(schemas.GOLD[table].fieldNames()), gold_dir, table, dt)
    warehouse = Warehouse(
        spark,
        files.join(base, "warehouse"),
        version_guard=True,
        calendar=star.dim_date,
        grain={"fact_orders": "year", "fact_order_items": "year", "fact_sessions": "day"},
    )
    warehouse.load_all(gold_dir)
    warehouse.load_day(REPLAYED[1][0], gold_dir)
    dim, none = warehouse.read("dim_customer"), F.lit(None)

    def rows(table: str, df: DataFrame, key: str, day: str, until, amount) -> DataFrame:
        return df.select(
            F.lit(table).alias("table"),
            F.col(key).alias("key"),
            F.col(day).cast("date").alias("day"),
            until.cast("date").alias("until"),
            amount.cast("double").alias("amount"),
        )

    orders = star.with_version(warehouse.read("fact_orders"), dim)
    sessions = warehouse.read("fact_sessions")
    return reduce(
        DataFrame.unionByName,
        [
            rows("dim_customer", dim, "customer_unique_id", "valid_from", F.col("valid_to"), none),
            rows("fact_orders", orders, "order_id", "version_from", none, F.col("payment_value")),
            rows("fact_sessions", sessions, "session_id", "session_date", none, F.col("n_events")),
        ],
    )


@query(
    "s8_inferred_scan",
    """
SELECT payment_type, count(*) AS payments, sum(payment_installments)::BIGINT AS installments,
       max(payment_sequential) AS last_sequential, 'int' AS installments_type,
       'double' AS value_type FROM s_payments GROUP BY 1""",
)
def inferred(star: Star):
    """Payments from text files without a schema: types are found by the extra pass."""
    payments = read_inferred(
        star.spark, files.join(ship(star, "order_payments"), f"dt={DAY}", "order_payments")
    )
    types = dict(payments.dtypes)
    return payments.groupBy("payment_type").agg(
        F.count("*").alias("payments"),
        F.sum("payment_installments").alias("installments"),
        F.max("payment_sequential").alias("last_sequential"),
        F.lit(types["payment_installments"]).alias("installments_type"),
        F.lit(types["payment_value"]).alias("value_type"),
    )


@query(
    "d4_drift",
    """
SELECT * FROM (VALUES ('order_id', 'string', 'int', 'type'),
                      ('price', 'double', NULL, 'missing'),
                      ('cost', NULL, 'double', 'unexpected'))
    AS found("column", declared, observed, drift)
WHERE EXISTS (SELECT 1 FROM s_items)""",
)
def drift(star: Star):
    """Items as the files have them, one column renamed, against what is declared."""
    shipped = files.join(ship(star, "order_items"), f"dt={DAY}", "order_items")
    found = read_inferred(star.spark, shipped)
    found = found.withColumnRenamed("price", "cost").withColumns(
        {c: F.col(c).cast("string") for c in ("product_id", "seller_id")}
    )
    return clean.columns_drift(found, "order_items").where(F.col("drift") != "")
