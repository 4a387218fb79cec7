"""Exact dedup: frequent digests are settled by broadcast, all others by one shuffle.

Texts are equal when identical after deleting ASCII white space; a NULL text counts as empty.
Of equal texts the row with the most code points in its original text stays, then the smallest
doc_id (a NULL id after all others). Repeated rows, that is the same id, text and length, are
copies too: one of them stays. Empty tables give empty results. Very long texts meet only
row-level functions. Extra columns are untouched; `survivors` carries each row as a struct beside its
working columns, so clashing names do no harm.

Frequent digests come from Spark's mergeable frequent-items sketch, which is the Misra-Gries
summary with batched decrements: a digest of more than 3.5 / TRACKED of all rows cannot be
missed. What it returns only chooses a path; counts and winners are computed from all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daygrain.llm.common import SPACE, Scratch

# Frequent digests that are broadcast, and counters of the sketch that finds them.
FREQUENT = 512
TRACKED = 16384


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")


def _keys(text: Column, doc_id: Column) -> list[Column]:
    return [
        doc_id.alias("__id"),
        F.unhex(F.sha2(normalised(text), 256)).alias("__digest"),
        F.char_length(F.coalesce(text, F.lit(""))).cast("long").alias("__chars"),
        F.xxhash64(text).alias("__raw"),
    ]


def _rank() -> list[Column]:
    return [F.desc("__chars"), F.asc_nulls_last("__id"), F.asc("__raw")]


def _winners(keys: DataFrame) -> DataFrame:
    """At most `FREQUENT` rows: digest, exact group size and the key of the row that stays."""
    found = F.expr(f"approx_top_k(xxhash64(__digest), {FREQUENT}, {TRACKED})")
    candidates = keys.agg(found.alias("top")).select(F.explode("top.item").alias("__code"))
    best = F.min(
        F.struct(
            (-F.col("__chars")).alias("short"), F.col("__id").isNull().alias("none"), "__id", "__raw"
        )
    )
    return (
        keys.withColumn("__code", F.xxhash64("__digest"))
        .join(F.broadcast(candidates), "__code", "left_semi")
        .groupBy("__digest")
        .agg(F.count(F.lit(1)).alias("__size"), best.alias("__best"))
        .where("__size > 1")
        .orderBy(F.desc("__size"), "__digest")
        .limit(FREQUENT)
    )


def _stays() -> Column:
    return (
        (F.col("__chars") == -F.col("__best.short"))
        & F.col("__id").eqNullSafe(F.col("__best.__id"))
        & (F.col("__raw") == F.col("__best.__raw"))
    )


def _stored(docs: DataFrame, doc_id: str, text: str, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    keys = scratch.save(docs.select(*_keys(F.col(text), F.col(doc_id))), "keys")
    return keys, scratch.save(_winners(keys), "winners")


def assignments(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's decision: doc_id, keep_id, group_size, kept, text_sha256."""
    keys, winners = _stored(docs, doc_id, text, Scratch(docs.sparkSession, "exact-dedup"))
    hot = keys.join(F.broadcast(winners), "__digest")
    settled = hot.select(
        "__digest", "__id", F.col("__best.__id").alias("keep_id"), "__size",
        F.lit(False).alias("kept"), _stays().alias("first"),
    )
    again = Window.partitionBy("__digest", "__id").orderBy("__digest")
    firsts = settled.where("first").withColumn("kept", F.row_number().over(again) == 1)
    group = Window.partitionBy("__digest")
    ordered = group.orderBy(*_rank())
    rest = keys.join(F.broadcast(winners), "__digest", "left_anti").select(
        "__digest",
        "__id",
        F.first("__id").over(ordered).alias("keep_id"),
        F.count(F.lit(1)).over(group).alias("__size"),
        (F.row_number().over(ordered) == 1).alias("kept"),
    )
    return (
        settled.where("NOT first").drop("first")
        .unionByName(firsts.drop("first"))
        .unionByName(rest)
        .select(
            F.col("__id").alias("doc_id"),
            "keep_id",
            F.col("__size").alias("group_size"),
            "kept",
            F.lower(F.hex("__digest")).alias("text_sha256"),
        )
    )


def survivors(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, all columns kept. Copies of frequent texts never reach the shuffle."""
    _, winners = _stored(docs, doc_id, text, Scratch(docs.sparkSession, "exact-dedup"))
    rows = docs.select(F.struct("*").alias("row"), *_keys(F.col(text), F.col(doc_id)))
    by_rank = Window.partitionBy("__digest").orderBy(*_rank())
    firsts = rows.join(F.broadcast(winners), "__digest").where(_stays())
    rest = rows.join(F.broadcast(winners), "__digest", "left_anti")
    once = [
        part.withColumn("__place", F.row_number().over(by_rank)).where("__place = 1").select("row.*")
        for part in (firsts, rest)
    ]
    return once[0].unionByName(once[1])
