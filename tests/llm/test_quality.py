"""Quality scores: held-out accuracy, exact neighbours, odd rows."""

import random
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from daygrain.llm import quality
from daygrain.llm.registry import QUERIES

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = QUERIES["op1_quality"](spark, FOLDER)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    right = F.avg((F.col("quality") == F.col("predicted")).cast("int"))
    unseen = got.join(labels, "doc_id").where("held_out").groupBy("quality").agg(right.alias("right")).collect()
    assert len(unseen) == 2 and min(r.right for r in unseen) > 0.9
    assert got.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert got.where("score IS NULL OR score < 0 OR score > 1 OR predicted <> int(score >= 0.5)").isEmpty()


def test_scores_are_those_of_all_neighbours():
    rng = np.random.default_rng(3)
    found = np.sqrt(rng.dirichlet(np.full(quality.BUCKETS + quality.REPEATS, 0.05), 90)).astype(np.float32)
    labels = rng.integers(0, 2, 90)
    model = quality.fit_model(found, labels, 0.4)
    new = np.concatenate([found[:5], np.zeros((1, found.shape[1]), np.float32)])
    scores = model.scores(new)
    for row, score in zip(new[:5], scores):
        vector = model.latent(row[None])[0]
        near = sorted(((float(vector @ v), y) for v, y in zip(model.vectors, labels)), reverse=True)[: quality.NEIGHBOURS]
        weights = [max(c, 1e-6) ** 8 for c, _ in near]
        assert abs(score - sum(w * y for w, (_, y) in zip(weights, near)) / sum(weights)) < 1e-4
    assert scores[5] == 0.4


def test_odd_rows(spark):
    good = [(k, f"A quiet day number {k} by the sea, and then the rain came over the hills.", "v") for k in range(30)]
    bad = [(100 + k, f"BUY!! NOW!! {k} $$$ | $$$ | BUY!! BUY!!", "v") for k in range(30)]
    odd = [(200, None, "v"), (201, "", "v"), (202, "ab", "v"), (203, "A quiet day " * 20_000, "v"), (None, "x y z", "v"), (1, good[1][1], "v"), (1, good[1][1], "v")]
    docs = spark.createDataFrame(good + bad + odd, "doc_id long, text string, score string")
    marks = [(k, 1, 0) for k in range(30)] + [(100 + k, 0, 1) for k in range(30)] + [(None, 1, 0), (999, None, 1), (1, 1, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    rows = quality.score(docs, model).collect()
    assert len(rows) == 67
    scores = {r.doc_id: r.score for r in rows}
    assert all(scores[k] > 0.5 for k in range(30)) and all(scores[100 + k] < 0.5 for k in range(30))
    assert scores[200] == scores[201] == model.prior
    kept = quality.good_only(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= set(range(30))
    none = quality.train(docs.limit(0), labels.limit(0))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(docs.limit(0), model).collect() == []


def test_scores_do_not_depend_on_the_layout(spark):
    """Ties among neighbours, ids with two labels and ids with two texts, stored in two orders."""
    rows = [(k, f"{'good words of text' if k % 3 else 'BUY!!! now $$$'} number {k % 4}") for k in range(60)] + [(7, "another text"), (7, "a text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = [(k, int(k % 3 > 0), "x") for k in range(60)] + [(7, 0, "x"), (8, 0, "y")]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, label string")
    found = []
    for n in (1, 6):
        order = F.xxhash64("doc_id", F.lit(n))
        model = quality.train(docs.repartition(n, order), labels.repartition(n, order))
        found.append({r.doc_id: r.score for r in quality.score(docs.where("text NOT IN ('another text')"), model).collect()})
    assert found[0] == found[1]


def test_a_block_of_texts_takes_little_memory():
    """Failed check of the pipeline: two workers and the JVM took more than 3000 MB of an executor."""
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(300)).encode() for _ in range(800)]
    texts[3:6] = [b"", b"ab", b"one long text " * 9000]
    offsets = np.cumsum([0, *map(len, texts)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    vectors = quality.unit(np.random.default_rng(1).standard_normal((2 * quality.PER_LABEL, quality.LATENT))).astype(np.float32)
    axes = np.random.default_rng(2).standard_normal((quality.TRIPLETS + quality.REPEATS, quality.LATENT)).astype(np.float32)
    model = quality.Model(np.ones(len(axes), np.float32), axes, vectors, np.arange(len(vectors)) % 2.0, 0.5)
    quality.features(data[:9], np.array([0, 9]))
    tracemalloc.start()
    found = quality.features(data, offsets)
    scores = model.scores(found)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 48e6
    # Texts by themselves have the same features, and so the same score.
    for k in (0, 3, 4, 5, 6, 127, 128, 799):
        alone = np.frombuffer(texts[k], np.uint8)
        assert (quality.features(alone, np.array([0, len(alone)]))[0] == found[k]).all()
        assert abs(model.scores(found[k : k + 1])[0] - scores[k]) < 1e-4
