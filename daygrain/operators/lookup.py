"""Many-to-one joins that hold up when one key has a large part of all rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot if it has more than this fraction of all rows. So there are fewer hot keys than
# the number below, however many rows there are, and their lookup rows may be broadcast.
HOT_KEYS = 2000


def hot_keys(rows_per_key: DataFrame, rows: str) -> DataFrame:
    """The hot keys out of rows counted per key: always fewer than HOT_KEYS."""
    total = rows_per_key.agg(F.sum(rows).alias("total"))
    return rows_per_key.where(F.col(rows) * HOT_KEYS > total.scalar()).drop(rows)


def attach(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    rows_per_key: DataFrame | None = None,
) -> DataFrame:
    """`facts` with the other columns of `lookup`, which has one row per key.

    Spark splits a skewed join partition only if both sides of the join come straight from a
    shuffle. A lookup that was aggregated or ranked by the key does not, so the split is made
    here: rows of hot keys get their match from a broadcast, and in the join of all others
    they and the rows without a key are spread by the input partition they come from.

    `rows_per_key` may pass the facts counted per key, as column `_n`, if they are at hand.
    """
    keys = list(keys)
    values = [c for c in lookup.columns if c not in keys]
    counted = rows_per_key or facts.groupBy(*keys).agg(F.count("*").alias("_n"))
    packed = lookup.select(*keys, F.struct(*values).alias("_found"))
    hot = packed.join(F.broadcast(hot_keys(counted, "_n")), keys, "left_semi")
    spread = reduce(or_, [F.col(k).isNull() for k in keys], F.col("_hot").isNotNull())
    joined = (
        facts.join(F.broadcast(hot.withColumnRenamed("_found", "_hot")), keys, "left")
        .withColumn("_lane", F.when(spread, F.spark_partition_id() + 1).otherwise(0))
        .join(packed.withColumn("_lane", F.lit(0)), [*keys, "_lane"], "left")
        .withColumn("_found", F.coalesce("_hot", "_found"))
    )
    if how == "inner":
        joined = joined.where(F.col("_found").isNotNull())
    return joined.select(*facts.columns, *[F.col("_found")[c].alias(c) for c in values])
