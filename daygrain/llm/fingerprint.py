"""Quartile bucket digests of texts, and of each text edited with the start of its successor.

All byte triplets of a text (neighbours, and those one byte apart) are hashed into 128 buckets.
Each bucket's count is encoded by the quartile it falls into, two bits a bucket; a header has the
logarithm of the length and the ratios of the quartiles. Two digests differ by the sum of
their codes' distances (opposite ends count double) and of their headers'; likeness is
1 - difference / LIMIT, not below 0.

The order by doc_id is a range partitioning, so that no task sees more than its range. Within a
range a row meets its successor as it streams by; only the last row of a range waits for the first
one of the next, so two rows per partition are paired in a second, small step.

A NULL text is an empty text, which has the digest of zeros. A NULL doc_id comes before all others
and repeated ids follow each other in the order of their texts; a table of one row is its own
successor. Very long texts are hashed whole. Empty tables give empty results; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daygrain.llm.common import Scratch
from daygrain.llm.textblocks import blocks, buffers, mix64

BUCKETS = 128
LIMIT = 300
# Distance of two quartile codes.
_STEP = np.array([[0, 1, 2, 6], [1, 0, 1, 2], [2, 1, 0, 1], [6, 2, 1, 0]])
_LENGTH_BASE = 1.1
_SLOT = mix64(np.arange(1 << 12, dtype=np.uint64) + np.uint64(77))


def codes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of bytes per text: length, two quartile ratios, then 128 quartile codes."""
    n = len(offsets) - 1
    counts = np.zeros(n * BUCKETS, np.int64)
    row = np.repeat(np.arange(n), np.diff(offsets))
    wide = data.astype(np.uint64)
    for reach in (1, 2):
        if len(data) > 2 * reach:
            inside = row[2 * reach :] == row[: -2 * reach]
            code = mix64(
                wide[: -2 * reach] << np.uint64(16) | wide[reach:-reach] << np.uint64(8) | wide[2 * reach :] | np.uint64(reach << 24)
            )
            cell = row[: -2 * reach] * BUCKETS + (code >> np.uint64(57)).astype(np.int64)
            counts += np.bincount(cell[inside], minlength=n * BUCKETS)
    counts = counts.reshape(n, BUCKETS)
    ranked = np.sort(counts, axis=1)
    q1, q2, q3 = (ranked[:, k : k + 1] for k in (BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1))
    out = np.zeros((n, 3 + BUCKETS), np.uint8)
    out[:, 0] = np.floor(np.log1p(np.diff(offsets)) / np.log(_LENGTH_BASE)).astype(np.int64)
    top = np.maximum(q3[:, 0], 1)
    out[:, 1] = 15 * q1[:, 0] // top
    out[:, 2] = 15 * q2[:, 0] // top
    out[:, 3:] = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    return out


def as_text(code: np.ndarray) -> str:
    quads = code[3:].reshape(-1, 4).astype(np.uint8)
    packed = quads[:, 0] << 6 | quads[:, 1] << 4 | quads[:, 2] << 2 | quads[:, 3]
    return f"{code[0]:02x}{code[1]:x}{code[2]:x}{packed.tobytes().hex()}"


def from_text(text: str) -> np.ndarray:
    packed = np.frombuffer(bytes.fromhex(text[4:]), np.uint8)
    quads = np.stack([packed >> 6, packed >> 4 & 3, packed >> 2 & 3, packed & 3], axis=1).ravel()
    head = [int(text[:2], 16), int(text[2], 16), int(text[3], 16)]
    return np.concatenate([np.array(head, np.uint8), quads]).astype(np.uint8)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of pairs of codes, row by row."""
    a, b = a.astype(np.int64), b.astype(np.int64)
    apart = _STEP[a[:, 3:], b[:, 3:]].sum(axis=1)
    apart += 2 * np.abs(a[:, 0] - b[:, 0]) + np.abs(a[:, 1:3] - b[:, 1:3]).sum(axis=1)
    return 1.0 - np.minimum(apart, LIMIT) / LIMIT


def _cut(data: bytes, points: int) -> int:
    """The byte after so many code points of UTF-8."""
    heads = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    return int(heads[points]) if points < len(heads) else len(data)


def edited(text: bytes, n_chars: int, following: bytes) -> bytes:
    swap = n_chars // 4
    return text[: _cut(text, n_chars - swap)] + following[: _cut(following[: 4 * swap + 4], swap)] if swap else text


def n_points(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return np.diff(heads[offsets])


_FIELDS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _described(ids: list, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
    """Results of all but the last of these consecutive documents."""
    column = pa.array(texts, pa.large_binary()).cast(pa.large_string())
    own, points = [], []
    for _, _, data, offsets in blocks(column):
        own.append(codes(data, offsets))
        points.append(n_points(data, offsets))
    own, points = np.concatenate(own), np.concatenate(points)
    changed = [edited(t, int(n), f) for t, n, f in zip(texts, points, texts[1:])]
    column = pa.array(changed, pa.large_binary()).cast(pa.large_string())
    new = np.concatenate([codes(data, offsets) for _, _, data, offsets in blocks(column)])
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(ids[:-1], pa.int64()),
            pa.array(points[:-1].astype(np.int64)),
            pa.array([hashlib.sha256(t).hexdigest() for t in changed]),
            pa.array([as_text(c) for c in own[:-1]]),
            pa.array([as_text(c) for c in new]),
            pa.array(likeness(own[:-1], new)),
            pa.array(likeness(own[:-1], own[1:])),
        ],
        _FIELDS,
    )


# Documents that are described at once, in bytes.
_RUN_BYTES = 1 << 22


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    """Consecutive documents in runs of bounded size; each run begins with the last one before it."""
    ids, texts, held = [], [], 0
    for batch in batches:
        data, offsets = buffers(batch.column(1))
        raw = data.tobytes()
        for row, doc_id in enumerate(batch.column(0).to_pylist()):
            ids.append(doc_id)
            texts.append(raw[offsets[row] : offsets[row + 1]])
            held += len(texts[-1])
            if held > _RUN_BYTES and len(ids) > 1:
                yield ids, texts
                ids, texts, held = ids[-1:], texts[-1:], len(texts[-1])
    if ids:
        yield ids, texts


_END_KIND = [("end", pa.int32()), ("text", pa.string())]


def _in_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of one range, then its first and last row as they are (end 0 and 1)."""

    def plain(out: pa.RecordBatch) -> pa.RecordBatch:
        n = out.num_rows
        return pa.RecordBatch.from_arrays(
            [*out.columns, pa.nulls(n, pa.int32()), pa.nulls(n, pa.string())], [*_FIELDS, "end", "text"]
        )

    ends: list[tuple] = []
    for ids, texts in _runs(batches):
        if not ends:
            ends = [(ids[0], texts[0])]
        last = (ids[-1], texts[-1])
        if len(ids) > 1:
            for out in _described(ids, texts):
                yield plain(out)
    if ends:
        ends.append(last)
        kinds = [pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([i for i, _ in ends], pa.int64()), *[pa.nulls(2, k) for k in kinds],
                pa.array([0, 1], pa.int32()), pa.array([t.decode("utf-8", "replace") for _, t in ends]),
            ],
            [*_FIELDS, "end", "text"],
        )


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [[t.encode() for t in batch.column(k).to_pylist()] for k in (1, 2)]
        for row, doc_id in enumerate(batch.column(0).to_pylist()):
            yield from _described([doc_id, None], [texts[0][row], texts[1][row]])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's digest, its edited text's, and how alike its neighbours are."""
    scratch = Scratch(docs.sparkSession, "fingerprint")
    ordered = (
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    found = scratch.save(ordered.mapInArrow(_in_range, f"{_RESULT}, end int, text string"), "ranges")
    # Two rows per partition, whatever the number of documents.
    order = Window.orderBy(F.asc_nulls_first("doc_id"), "end")
    following = F.coalesce(F.lead("text").over(order), F.first("text").over(order))
    waiting = (
        found.where("end IS NOT NULL").select("doc_id", "end", "text", following.alias("following"))
        .where("end = 1").select("doc_id", "text", "following")
    )
    return found.where("end IS NULL").drop("end", "text").unionByName(waiting.mapInArrow(_pairs, _RESULT))
