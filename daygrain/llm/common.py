"""Scratch tables in the shared folder, table access, and lookups whose hot keys are broadcast."""

from __future__ import annotations

import atexit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.session import shared_dir

# What separates words: the fixed ASCII white space of the contracts.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"

# A key is hot above one row in so many; there are fewer hot keys than this, whatever the data.
HOT_SHARE = 1000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


class Scratch:
    """Parquet tables below `spark.checkpoint.dir`, which survive a lost executor.

    `drop` removes one that nothing reads any more; the rest goes when the application ends.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.path = shared_dir(spark, purpose)
        atexit.register(self._remove, self.path)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        self._remove(f"{self.path}/{name}")

    def _remove(self, path: str) -> None:
        context = self.spark.sparkContext
        if context._jsc is not None:
            place = context._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def hot_keys(rows: DataFrame, key: str) -> DataFrame:
    """The keys with more than one row in `HOT_SHARE`, fewer than `HOT_SHARE` of them. NULL is none."""
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") * HOT_SHARE > F.lit(rows.count())).select(key)


def attach(rows: DataFrame, lookup: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Left join on `key`, of which `lookup` has one row each.

    `rows`, `lookup` and `hot` should be stored tables: each is read twice. Rows of hot keys stay
    where they are and meet their few lookup rows by broadcast; all others are shuffled. Rows
    whose key is NULL stay, too.
    """
    extra = [F.lit(None).cast(f.dataType).alias(f.name) for f in lookup.schema if f.name != key]
    few = F.broadcast(hot)
    near = rows.join(few, key, "left_semi").join(
        F.broadcast(lookup.join(few, key, "left_semi")), key, "left"
    )
    far = rows.where(F.col(key).isNotNull()).join(few, key, "left_anti").join(lookup, key, "left")
    none = rows.where(F.col(key).isNull()).select("*", *extra)
    return near.unionByName(far).unionByName(none)
