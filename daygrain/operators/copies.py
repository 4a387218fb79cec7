"""Rows that share a key: mark the extra copies, or keep one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _columns(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _total_order(df: DataFrame, order_by: Sequence[Column | str]) -> list[Column]:
    """The caller's order, ties broken by the columns themselves. Rows still tied are identical."""
    given = [F.col(c) if isinstance(c, str) else c for c in order_by]
    return [*given, *[F.col(f"`{c}`").asc_nulls_first() for c in df.columns]]


def mark_copies(
    df: DataFrame,
    keys: str | Sequence[str],
    out: str,
    order_by: Sequence[Column | str] = (),
) -> DataFrame:
    """Add boolean `out`: true for every row but the first of its key. NULL keys are no copies.

    A window over the key alone would put a key that holds a third of all rows into one task.
    So rows are ranked in two steps. First among the rows of the same key that one input
    partition holds, which splits a hot key over as many groups as there are partitions. Then
    only the first of each such group competes for the key, at most one row per partition;
    the others already lost and stay in their own group.
    """
    keys = _columns(keys)
    order = _total_order(df, order_by)
    part, local, lane, overall = (f"_{out}_{x}" for x in ("part", "local", "lane", "rank"))
    ranked = (
        df.withColumn(part, F.spark_partition_id())
        .withColumn(local, F.row_number().over(Window.partitionBy(*keys, part).orderBy(*order)))
        .withColumn(lane, F.when(F.col(local) == 1, -1).otherwise(F.col(part)))
        .withColumn(
            overall, F.row_number().over(Window.partitionBy(*keys, lane).orderBy(*order))
        )
    )
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    late = (F.col(local) > 1) | (F.col(overall) > 1)
    return ranked.withColumn(out, keyed & late).drop(part, local, lane, overall)


def keep_first(
    df: DataFrame, keys: str | Sequence[str], order_by: Sequence[Column | str] = ()
) -> DataFrame:
    """One row per key, the first in `order_by`.

    The filter on the row number lets Spark cut each map task's output to one row per key
    before the shuffle (WindowGroupLimit), so a hot key does not travel.
    """
    rank = F.row_number().over(
        Window.partitionBy(*_columns(keys)).orderBy(*_total_order(df, order_by))
    )
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def dedupe(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """One row per key; which one depends on the rows' content only, not on their layout."""
    return keep_first(df, key)


def copies_per_key(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their number of rows."""
    return (
        df.groupBy(*_columns(keys))
        .agg(F.count("*").alias("copies"))
        .where(F.col("copies") > 1)
    )


def require_unique(df: DataFrame, keys: str | Sequence[str], what: str) -> DataFrame:
    """The same rows; running the plan fails if two of them share a key.

    The test rides on the first key column, which every consumer reads. It is a window over
    the keys, so a merge on the same keys needs no further shuffle.
    """
    keys = _columns(keys)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    refuse = F.raise_error(F.concat(F.lit(f"{what}: more than one row for key "), F.to_json(
        F.struct(*keys))))
    checked = F.when(F.col("_rank") > 1, refuse.cast(df.schema[keys[0]].dataType)).otherwise(
        F.col(keys[0])
    )
    names = df.columns
    return (
        df.withColumn("_rank", rank)
        .withColumn("_checked", checked)
        .select(*[F.col("_checked").alias(n) if n == keys[0] else F.col(n) for n in names])
    )
