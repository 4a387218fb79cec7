"""Scans of the raw, clean, quarantine and gold zones."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daygrain.sinks import files
from daygrain.sources import schemas


def read_table(
    spark: SparkSession, name: str, path: str, *, strict_header: bool = True
) -> DataFrame:
    """One raw table, a file or a folder, with its declared schema.

    Cells that do not fit their type become NULL. A CSV header that is not in schema order
    fails the read; with `strict_header=False` cells are bound by position whatever it says.
    """
    if name == schemas.EVENTS:
        return (
            spark.read.schema(schemas.raw_schema(name))
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", schemas.CORRUPT)
            .json(path)
        )
    return (
        spark.read.schema(schemas.raw_schema(name))
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("escape", '"')
        .option("multiLine", name in schemas.FREE_TEXT)
        .option("enforceSchema", not strict_header)
        .csv(path)
    )


def read_text_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """The raw table with every column as text: casts happen in the query.

    A broken JSON line is a row of NULLs here, not an error.
    """
    reader = spark.read.schema(schemas.text_schema(name))
    if name == schemas.EVENTS:
        return reader.option("mode", "PERMISSIVE").json(path)
    return (
        reader.option("header", True)
        .option("escape", '"')
        .option("multiLine", name in schemas.FREE_TEXT)
        .option("enforceSchema", False)
        .csv(path)
    )


def read_inferred(spark: SparkSession, path: str) -> DataFrame:
    """A source CSV with inferred types, for profiling only: it costs an extra pass."""
    return (
        spark.read.option("header", True)
        .option("inferSchema", True)
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
    )


def _with_text_partition(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.col(column).cast("string"))


def read_partitions(
    spark: SparkSession, base: str, column: str = "ingest_dt"
) -> DataFrame | None:
    """A whole partitioned table, partition value as text, or None if it has no partition."""
    if not any(name.startswith(f"{column}=") for name in files.children(spark, base)):
        return None
    return _with_text_partition(spark.read.parquet(base), column)


def read_day(spark: SparkSession, clean: str, table: str, dt: str) -> DataFrame | None:
    """One day of a clean table, or None if that day shipped none of it."""
    base = files.join(clean, table)
    folder = files.join(base, f"ingest_dt={dt}")
    if not files.exists(spark, folder):
        return None
    # Only the one folder is listed; basePath keeps ingest_dt as a column.
    return _with_text_partition(
        spark.read.option("basePath", base).parquet(folder), "ingest_dt"
    )


def read_days(spark: SparkSession, base: str, days: Iterable[str], column: str = "ingest_dt") -> DataFrame:
    """Some days of a partitioned table: folders of others are not even listed."""
    paths = [files.join(base, f"{column}={d}") for d in days]
    return _with_text_partition(spark.read.option("basePath", base).parquet(*paths), column)


def read_events_upto(spark: SparkSession, clean: str, dt: str) -> DataFrame | None:
    """All events that arrived up to `dt`; None unless `dt` itself shipped events."""
    base = files.join(clean, schemas.EVENTS)
    if not files.exists(spark, files.join(base, f"ingest_dt={dt}")):
        return None
    # A filter on the partition column alone: later days are pruned, not read.
    events = spark.read.parquet(base).where(F.col("ingest_dt") <= F.lit(dt).cast("date"))
    return _with_text_partition(events, "ingest_dt")


def no_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    """An empty frame the optimizer knows to be empty, so it drops what depends on it."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return spark.range(1).where(F.lit(False)).select(*columns)


def read_gold_day(spark: SparkSession, gold: str, table: str, dt: str) -> DataFrame:
    """One gold folder in staging column order, empty if the day has none.

    The folder itself is the root of the read, so `dt` does not become a column.
    """
    schema = schemas.GOLD[table]
    folder = files.join(gold, table, f"dt={dt}")
    if not files.exists(spark, folder):
        return no_rows(spark, schema)
    return spark.read.schema(schema).parquet(folder).select(schema.fieldNames())
