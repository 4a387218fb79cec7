"""Quality by nearest-neighbour voting in a latent space.

A document is described by the shares of hashed byte triplets of its text (A-Z in lower case) and of its outline (small letters,
capitals, digits and non-ASCII bytes become one symbol each, all other bytes stay), and by how
much it repeats itself (a word like the one before, a word pair seen before). Weighted by
inverse document frequency and reduced by a singular value decomposition, these are its latent
vector. Cosines of every document with every labelled vector are exact products of blocks;
the `NEIGHBOURS` largest vote with their similarity as weight.

The labelled vectors are a bounded sample: per label the `PER_LABEL` labelled rows that come first
by a hash of their doc_id, so at most 2 * PER_LABEL vectors are broadcast, whatever the corpus.
Labels are learned only from rows whose crc32(doc_id as text) mod 3 is not 1; nothing but the
text enters a score.

A NULL text is an empty text. A text without triplets has no neighbours and gets the sample's
share of label 1 before balancing. Without labels every score is 0.5. Very long texts are read whole. Repeated rows are scored
alike; a NULL doc_id is scored, not learned from; of an id with several labels the smaller one counts, of one with several texts
the smaller text. The vectors stand in an order of their own content, so which of several equal cosines is among the nearest
does not depend on how the tables are stored. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.llm.textblocks import blocks, lowered, mix64, run_hashes, span_hashes, word_bounds

PER_LABEL = 2048
NEIGHBOURS = 25
LATENT = 48
# Hashed triplets of the outline, and as many of the text.
BUCKETS = 1024
TRIPLETS = 2 * BUCKETS
# Two counters of repetition, which stand out against some hundred triplets.
REPEATS = 2
REPEAT_WEIGHT = 4.0
_SHARPNESS = 8
# Texts that are hashed and looked up at once, within a block.
HASHED_BYTES, HASHED_ROWS = 1 << 17, 128

_OUTLINE = np.arange(256, dtype=np.uint64)
_OUTLINE[97:123], _OUTLINE[65:91], _OUTLINE[48:58], _OUTLINE[128:] = 97, 65, 48, 128
_OUTLINE[[9, 11, 12, 13]] = 32


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Square roots of the shares of all buckets, a row per text; all 0 for a text without any."""
    out = np.zeros((len(offsets) - 1, TRIPLETS + REPEATS), np.float32)
    start = 0
    # A byte takes some hundred more while it is hashed, so few texts are hashed at once.
    while start < len(out):
        end = int(np.searchsorted(offsets, offsets[start] + HASHED_BYTES, side="right")) - 1
        end = min(len(out), max(end, start + 1), start + HASHED_ROWS)
        _count(data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start], out[start:end])
        start = end
    return np.sqrt(out, out=out)


def _count(data: np.ndarray, offsets: np.ndarray, out: np.ndarray) -> None:
    """Fills `out` with the shares of all buckets."""
    n = len(offsets) - 1
    low = lowered(data)
    if len(data) >= 3:
        row = np.repeat(np.arange(n), np.diff(offsets))
        inside = row[2:] == row[:-2]
        for at, signs in ((0, _OUTLINE[data]), (BUCKETS, low.astype(np.uint64) | np.uint64(1 << 32))):
            code = mix64(signs[:-2] << np.uint64(16) | signs[1:-1] << np.uint64(8) | signs[2:])
            cell = row[:-2] * BUCKETS + (code % np.uint64(BUCKETS)).astype(np.int64)
            out[:, at : at + BUCKETS] = np.bincount(cell[inside], minlength=n * BUCKETS).reshape(n, BUCKETS)
    total = out[:, :BUCKETS].sum(1, keepdims=True)
    out /= np.maximum(total, 1)
    starts, ends, first = word_bounds(low, offsets)
    words = span_hashes(low, starts, ends)
    owner = np.repeat(np.arange(n), np.diff(first))
    if len(words) > 1:
        near = owner[1:] == owner[:-1]
        pairs, owners = run_hashes(words, 2)[near], owner[1:][near]
        counts = np.maximum(np.bincount(owners, minlength=n), 1)
        same = np.bincount(owner[1:][near & (words[1:] == words[:-1])], minlength=n)
        _, places = np.unique(pairs ^ mix64(owners.astype(np.uint64) + np.uint64(1)), return_index=True)
        fresh = np.bincount(owners[places], minlength=n)
        total_pairs = np.bincount(owners, minlength=n)
        out[:, TRIPLETS] = REPEAT_WEIGHT * same / counts
        out[:, TRIPLETS + 1] = REPEAT_WEIGHT * (total_pairs - fresh) / counts


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


@dataclass
class Model:
    """Weights and axes of the latent space, the labelled vectors and their labels."""

    weights: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def latent(self, found: np.ndarray) -> np.ndarray:
        weighted = found * self.weights
        weighted /= np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-12)
        return unit(weighted @ self.axes)

    def scores(self, found: np.ndarray) -> np.ndarray:
        out = np.full(len(found), self.prior)
        some = found.any(axis=1)
        if len(self.vectors) and some.any():
            cosines = self.latent(found if some.all() else found[some]) @ self.vectors.T
            k = min(NEIGHBOURS, len(self.vectors))
            rows = np.flatnonzero(some)
            for start in range(0, len(rows), HASHED_ROWS):
                part = cosines[start : start + HASHED_ROWS]
                near = np.argpartition(part, -k, axis=1)[:, -k:]
                weights = np.clip(np.take_along_axis(part, near, 1), 1e-6, 1) ** _SHARPNESS
                out[rows[start : start + HASHED_ROWS]] = (weights * self.labels[near]).sum(1) / weights.sum(1)
        return np.clip(out, 0.0, 1.0)


def fit_model(found: np.ndarray, labels: np.ndarray, prior: float) -> Model:
    seen = (found > 0).sum(axis=0)
    weights = np.log((1 + len(found)) / (1 + seen)).astype(np.float32) + 1
    weighted = unit(found * weights)
    # Axes of the decomposition from the small Gram matrix of the features.
    values, axes = np.linalg.eigh(weighted.T @ weighted)
    axes = axes[:, np.argsort(values)[::-1][:LATENT]].astype(np.float32)
    return Model(weights, axes, unit(weighted @ axes).astype(np.float32), labels.astype(np.float32), prior)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, end, data, offsets in blocks(batch.column(1)):
            found = [row.tobytes() for row in features(data, offsets)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(start, end - start), pa.array(found, pa.binary())], ["label", "found"]
            )


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text") -> Model:
    learn = labels.where(F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id)) & F.col(label).isin(0, 1)).select(
        F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")
    )
    parts = [
        learn.where(F.col("label") == v).orderBy(F.xxhash64("id"), "id").limit(PER_LABEL) for v in (0, 1)
    ]
    sample = parts[0].unionByName(parts[1]).groupBy("id").agg(F.min("label").alias("label"))
    chosen = (
        docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
        .join(F.broadcast(sample), "id")
        .groupBy("id", "label").agg(F.min("text").alias("text"))
        .select("label", "text")
    )
    rows = chosen.mapInArrow(_feature_rows, "label int, found binary").collect()
    rows.sort(key=lambda r: (bytes(r.found), r.label))
    share = learn.agg(F.avg("label")).first()[0]
    if not rows:
        none = np.zeros((0, TRIPLETS + REPEATS), np.float32)
        return fit_model(none, np.zeros(0), 0.5 if share is None else share)
    found = np.stack([np.frombuffer(r.found, np.float32) for r in rows])
    return fit_model(found, np.array([r.label for r in rows]), share)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score and predicted of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [np.zeros(0)]
            for _, _, data, offsets in blocks(batch.column(1)):
                values.append(shared.value.scores(features(data, offsets)))
            found = np.concatenate(values).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        scored, "doc_id long, score double, predicted int"
    )


def good_only(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows whose text is predicted to be good, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, data, offsets in blocks(batch.column(place)):
                keep = shared.value.scores(features(data, offsets)) >= 0.5
                yield batch.slice(start, end - start).filter(pa.array(keep))

    return docs.mapInArrow(kept, docs.schema)
