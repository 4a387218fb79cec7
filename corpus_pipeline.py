"""A corpus from raw documents to token ids: five stages, each written before the next one reads it.

quality (documents that read like junk go) -> exact copies -> near copies (one document of each group
stays) -> mix (sources to their target weights, in training order, repeated documents repeated)
-> pieces (token ids of every document).

Every stage works on all rows its predecessor kept. NULL and empty texts pass through quality (an
empty text is scored by the share of good labels), are one class for exact dedup, and are never taken
by the mix. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daygrain.llm import exact_dedup, mixing, near_dedup, pieces, quality
from daygrain.llm.common import Scratch, table
from daygrain.session import configure

# Rows that go to a Python worker at once. Both sides hold a batch and its answer beside the heap, and keep that memory for the
# stages that follow; whole texts are large rows.
BATCH_ROWS = 1024


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return quality.good_only(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.survivors(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return near_dedup.survivors(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.training_order(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return pieces.encode(docs).select("doc_id", "source", "lang", "n_chars", "ids")


STAGES = [
    ("quality", keep_good),
    ("exact", drop_copies),
    ("near", drop_near_copies),
    ("mix", mix_sources),
    ("pieces", encode),
]

# Neighbours, links by sets of shingles and pieces are no SQL; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
