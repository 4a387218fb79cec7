"""Idempotent writes: a day replaces itself and nothing else."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from daygrain.session import PACKED
from daygrain.sinks import files


def _written(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Count rows while they are written instead of in a job of their own."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_partition(df: DataFrame, base: str, dt: str, column: str = "ingest_dt") -> int:
    """Replace partition `dt` of the table at `base` by the rows of `df`; returns their number.

    Replacing by no rows must remove what an earlier run left: dynamic overwrite alone would
    keep it, since it only touches partitions it writes to.
    """
    df, seen = _written(df.withColumn(column, F.lit(dt)))
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**PACKED)
        .partitionBy(column)
        .parquet(base)
    )
    rows = seen.get["rows"]
    if rows == 0:
        files.delete_folder(df.sparkSession, files.join(base, f"{column}={dt}"))
    return rows


def overwrite_partitions(df: DataFrame, base: str, column: str) -> None:
    """Replace every partition `df` has rows for, and no other."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**PACKED)
        .partitionBy(column)
        .parquet(base)
    )


def write_gold(spark, df: DataFrame | None, gold: str, table: str, dt: str) -> int:
    """Replace a gold day folder; None removes what an earlier run left there."""
    folder = files.join(gold, table, f"dt={dt}")
    if df is None:
        files.delete_folder(spark, folder)
        return 0
    df, seen = _written(df)
    df.write.mode("overwrite").options(**PACKED).parquet(folder)
    return seen.get["rows"]


def write_day_text(df: DataFrame, base: str, table: str, fmt: str, day: str = "dt") -> None:
    """Ship rows as gzip text into `<base>/<table>/dt=.../`, one folder per day value."""
    writer = df.write.mode("overwrite").partitionBy(day).option("compression", "gzip")
    if fmt == "json":
        writer.option("ignoreNullFields", False).json(files.join(base, table))
    else:
        writer.option("header", True).option("escape", '"').csv(files.join(base, table))
