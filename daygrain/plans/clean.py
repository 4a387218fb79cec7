"""Raw day to clean and quarantine partitions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from daygrain.functions.time import LOCAL_ZONE, parse_ts, utc
from daygrain.operators import quality
from daygrain.operators.copies import dedupe
from daygrain.plans import sessions
from daygrain.session import PACKED, configure, millisecond_timestamps, shared_dir
from daygrain.sinks import files
from daygrain.sinks.partitions import write_partition
from daygrain.sinks.watermark import Watermarks, advance
from daygrain.sources import schemas
from daygrain.sources.readers import read_table

# Columns that serve the rules and are of no use in the clean zone.
HELPERS = (schemas.CORRUPT, "event_ts_raw")


def prepare(df: DataFrame, name: str, zone: str = LOCAL_ZONE) -> DataFrame:
    """Parse the event time, then turn every timestamp from local wall clock into UTC."""
    if name == schemas.EVENTS:
        df = parse_ts(df, "event_ts")
    stamps = [f.name for f in df.schema if isinstance(f.dataType, TimestampType)]
    return df.withColumns({c: utc(c, zone) for c in stamps})


def first_copy_order(df: DataFrame) -> list[Column]:
    """Which of several rows with one key counts as the first: the one with the earliest time."""
    return [F.col(f.name) for f in df.schema if isinstance(f.dataType, TimestampType)][:1]


def tag_table(df: DataFrame, name: str, rules: dict, within: Sequence[str] = ()) -> DataFrame:
    """Prepared rows of a table with their reasons; a table without rules passes as it is."""
    if name not in rules:
        return df.withColumn("dq_reason", F.lit(""))
    return quality.tag_rows(df, rules[name], first_copy_order(df), within)


def accepted(tagged: DataFrame, name: str) -> DataFrame:
    """Rows for the clean zone."""
    valid = tagged.where(F.col("dq_reason") == "").drop("dq_reason", *HELPERS)
    return dedupe(valid, schemas.ROW_KEYS[name]) if name in schemas.ROW_KEYS else valid


def rejected(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("dq_reason") != "")


def process_table(
    spark: SparkSession,
    name: str,
    dt: str,
    src: str,
    clean_dir: str,
    quarantine_dir: str,
    rules: dict,
    watermarks,
) -> dict:
    """Clean one table of one day; returns its summary.

    The tagged rows are written once to the shared folder and read by the two writes, so raw text is
    parsed and copies are ranked once, also if an executor is lost between them. The summary
    is counted during that first write. The watermark moves when all writes are done, never before.
    """
    tally = quality.Tally(name, rules.get(name))
    tagged = tally.attach(tag_table(prepare(read_table(spark, name, src), name), name, rules))
    held = shared_dir(spark, "tagged")
    index = files.join(clean_dir, sessions.INDEX)
    try:
        tagged.write.options(**PACKED).parquet(held)
        tagged = spark.read.schema(tagged.schema).parquet(held)
        summary = tally.summary()
        if name == schemas.EVENTS:
            sessions.forget_days(spark, index, [dt])
        clean_rows = write_partition(accepted(tagged, name), files.join(clean_dir, name), dt)
        write_partition(rejected(tagged), files.join(quarantine_dir, name), dt)
        if name == schemas.EVENTS:
            sessions.index_days(spark, files.join(clean_dir, name), index, [dt])
    finally:
        files.delete_folder(spark, held)
    return {
        **summary,
        "clean": clean_rows,
        "dups_dropped": summary["total"] - summary["quarantined"] - clean_rows,
        "watermark_moved": advance(watermarks, name, dt),
    }


def run(
    spark: SparkSession,
    dt: str,
    raw_dir: str,
    lake_dir: str,
    rules_path: str | None = None,
    watermarks=None,
    tables: Iterable[str] | None = None,
    clean_dir: str | None = None,
    quarantine_dir: str | None = None,
) -> list[dict]:
    """Clean every table the day shipped; a table that is not in the drop is skipped."""
    configure(spark)
    rules = quality.load_rules(rules_path, spark) if rules_path else quality.load_rules()
    store = watermarks or Watermarks(spark, files.join(lake_dir, "watermarks"))
    clean_dir = clean_dir or files.join(lake_dir, "clean")
    quarantine_dir = quarantine_dir or files.join(lake_dir, "quarantine")
    done = []
    with millisecond_timestamps(spark):
        for name in tables or (schemas.EVENTS, *(t for t in schemas.TABLES if t != schemas.EVENTS)):
            src = files.join(raw_dir, f"dt={dt}", name)
            if files.exists(spark, src):
                done.append(
                    process_table(
                        spark, name, dt, src, clean_dir, quarantine_dir, rules, store
                    )
                )
    return done


def columns_drift(observed: DataFrame, name: str) -> DataFrame:
    """Declared against observed columns of a table: (column, declared, observed, drift)."""
    spark = observed.sparkSession
    declared = [(f.name, f.dataType.simpleString()) for f in schemas.RAW[name]]
    seen = [(f.name, f.dataType.simpleString()) for f in observed.schema]
    left = spark.createDataFrame(declared, "column string, declared string")
    right = spark.createDataFrame(seen, "column string, observed string")
    return left.join(right, "column", "full_outer").withColumn(
        "drift",
        F.when(F.col("observed").isNull(), "missing")
        .when(F.col("declared").isNull(), "unexpected")
        .when(F.col("declared") != F.col("observed"), "type")
        .otherwise(""),
    )
