"""The pipeline against its stages done by hand on a small table."""

from collections import Counter

import duckdb
import pyarrow as pa
import sentencepiece as library

import corpus_pipeline
from daygrain.llm import pieces, quality
from daygrain.llm.registry import ORACLES
from tests.llm.test_near_dedup import brute_force

FOLDER = "/root/testdata/sf0.001"
WHITE = str.maketrans("", "", " \t\n\x0b\x0c\r")


def test_run_gives_what_the_stages_give_by_hand(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    model = quality.train(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    good = [rows[r.doc_id] for r in quality.score(docs, model).collect() if r.predicted]
    assert 0 < len(good) < len(rows)
    first = {}
    for r in sorted(good, key=lambda r: (-len(r.text), r.doc_id)):
        first.setdefault(r.text.translate(WHITE), r)
    single = list(first.values())
    assert len(single) < len(good)
    kept = [rows[i] for i, _, _, stays in brute_force([(r.doc_id, r.text) for r in single]) if stays]
    con = duckdb.connect()
    con.register("documents", pa.Table.from_pylist([r.asDict() for r in kept]))
    turns = Counter()
    mixed = con.execute(f"SELECT doc_id, size, taken FROM ({ORACLES['op5_curriculum_mix']})").fetchall()
    for doc_id, size, taken in mixed:
        turns[doc_id] = -(-taken // size) if size else 0
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert Counter(r.doc_id for r in got) == +turns
    reference = library.SentencePieceProcessor(model_file=pieces.MODEL)
    assert all(r.ids == reference.encode(rows[r.doc_id].text) for r in got)


def test_stages_keep_the_columns_and_bear_odd_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, target double"
    odd = [(1, None, "en", "a", 0, 1.0), (2, "", None, None, 0, 1.0), (None, "some words here", "en", "a", 15, 1.0),
           (3, "some words here", "en", "b", 15, None), (3, "some words here", "en", "b", 15, None)]
    for docs in (spark.createDataFrame(odd, schema), spark.createDataFrame([], schema)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, FOLDER)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns
                docs = out
            out.collect()


def test_python_gets_few_texts_at_once(spark):
    """Failed check of the pipeline: batches of 10,000 whole texts, held by the JVM and by the worker."""
    too_large = spark.sparkContext.accumulator(0)
    docs = spark.range(5000).selectExpr("id AS doc_id", "concat('some text ', id) AS text", "'en' AS lang", "'a' AS source", "20L AS n_chars").coalesce(1)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    for _, stage in (corpus_pipeline.STAGES[0], corpus_pipeline.STAGES[2], corpus_pipeline.STAGES[4]):
        spark.conf.unset(name)
        stage(spark, docs, FOLDER)

        def largest(batches):
            for batch in batches:
                too_large.add(batch.num_rows > corpus_pipeline.BATCH_ROWS)
                yield batch

        assert docs.mapInArrow(largest, docs.schema).count() == 5000
    assert too_large.value == 0
