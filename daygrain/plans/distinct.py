"""Exact distinct counts over any days, from one set of bitmaps per arrival day.

Every value gets a number once, in a dictionary that each day extends by what it brought first. A
day's bitmaps say which numbers it has, per group of `by` columns and bucket of 32,768 numbers; a
day's new values are numbered beside each other, so they fill few buckets. Counting a window merges
the bitmaps of its days and adds up their bits: the rows are not read again, and what
is shuffled is a bitmap per group, bucket and task.

Numbers are unique, not dense: the generation, then the task that gave it, then its place in the task.
A day may be indexed again: its bitmaps are replaced, and the dictionary has its values already.
A NULL value is no value, as in a distinct count.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.sinks import files
from daygrain.sinks.partitions import overwrite_partitions
from daygrain.sources.readers import read_days

NUMBERS = "numbers"
BITMAPS = "bitmaps"
# Generations of the dictionary fit in the 15 bits above task and place.
_GENERATION_BITS = 48
_PREFIX = "generation="


def _generations(spark: SparkSession, folder: str) -> list[int]:
    names = files.children(spark, files.join(folder, NUMBERS))
    return sorted(int(n.removeprefix(_PREFIX)) for n in names if n.startswith(_PREFIX))


def dictionary(spark: SparkSession, folder: str) -> DataFrame | None:
    """(value, number) of all values seen so far; only finished generations count."""
    base = files.join(folder, NUMBERS)
    at = [files.join(base, f"{_PREFIX}{g}") for g in _generations(spark, folder)]
    at = [path for path in at if files.exists(spark, files.join(path, "_SUCCESS"))]
    return spark.read.parquet(*at) if at else None


def extend_dictionary(spark: SparkSession, folder: str, values: DataFrame) -> DataFrame:
    """Number the values (one column, `value`) that have none yet; returns the whole dictionary."""
    known = dictionary(spark, folder)
    new = values.where("value IS NOT NULL").distinct()
    if known is not None:
        new = new.join(known, "value", "left_anti")
    generation = max(_generations(spark, folder), default=-1) + 1
    if generation >= 1 << (63 - _GENERATION_BITS):
        raise ValueError(f"{folder}: no generation left, number the values anew")
    number = F.lit(generation << _GENERATION_BITS) + F.monotonically_increasing_id()
    new.withColumn("number", number).write.parquet(files.join(folder, NUMBERS, f"{_PREFIX}{generation}"))
    return dictionary(spark, folder)


def index_days(
    rows: DataFrame, folder: str, value: str, by: Sequence[str], day: str = "ingest_dt"
) -> None:
    """Replace the bitmaps of all days of `rows`, which have to be complete days."""
    spark = rows.sparkSession
    plain = rows.select(*by, day, F.col(value).alias("value")).where("value IS NOT NULL")
    numbers = extend_dictionary(spark, folder, plain.select("value"))
    # A value that a third of the rows have is one row per group and day before it is looked up.
    found = plain.distinct().join(numbers, "value")
    bitmaps = found.groupBy(*by, day, F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")
    )
    overwrite_partitions(bitmaps, files.join(folder, BITMAPS), day)


def count_distinct(
    spark: SparkSession, folder: str, by: Sequence[str], days: Iterable[str] | None = None, day: str = "ingest_dt"
) -> DataFrame:
    """(by, n) over the given indexed days, or all of them; `by` may be fewer columns than were indexed."""
    base = files.join(folder, BITMAPS)
    if days is None:
        days = [n.split("=", 1)[1] for n in files.children(spark, base) if n.startswith(f"{day}=")]
    merged = read_days(spark, base, days, day).groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias("n"))
