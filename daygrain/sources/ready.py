"""Which days are there to work on."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.sinks import files

# Fixed value: the marker that ends a day's drop, at the root of the raw zone.
MARKER = r"^dt=(\d{4}-\d{2}-\d{2})/_READY$"


def ready_days(notices: DataFrame, key: str = "key") -> DataFrame:
    """Days whose marker was created, from object-created notices with a URL-encoded key.

    Any other key, such as a data file, a nested folder or a temporary name, is dropped.
    """
    day = F.regexp_extract(F.url_decode(F.col(key)), MARKER, 1)
    return notices.select(day.alias("dt")).where(F.col("dt") != "").distinct()


def notice_keys(notices: DataFrame) -> DataFrame:
    """Object keys out of notification documents with a `Records` array."""
    return notices.select(F.explode("Records").alias("r")).select(
        F.col("r.s3.object.key").alias("key")
    )


NOTICE_SCHEMA = "Records array<struct<s3: struct<object: struct<key: string>>>>"


def distinct_days(tables: Iterable[DataFrame], column: str = "dt") -> DataFrame:
    """Days any of the tables has. A day may have late sessions but no orders."""
    days = [t.select(F.col(column).cast("string").alias("dt")).distinct() for t in tables]
    return reduce(DataFrame.unionByName, days).distinct()


def gold_days(spark: SparkSession, gold: str, tables: Iterable[str]) -> list[str]:
    """Sorted days of the gold folders of all tables, from their names only."""
    found = set()
    for table in tables:
        found.update(
            name.removeprefix("dt=")
            for name in files.children(spark, files.join(gold, table))
            if name.startswith("dt=")
        )
    return sorted(found)
