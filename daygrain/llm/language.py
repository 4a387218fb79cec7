"""Language identification that labels spans of mixed-language text.

Words are runs of letters. The script of its first letter leaves a word only those languages that
use the script; each of them scores the word by the log-probabilities of its hashed letter
triplets. A Viterbi pass over the words of a text chooses the languages, with a penalty for each
switch. The prediction is the language with the most letters, the score its share of all letters.

The counts behind the probabilities are taken over the whole text of every learnable document
and summed in Spark; the model is one number per language and triplet bucket. Learnable is a
document with a language whose crc32(doc_id as text) mod 3 is not 1 (a NULL doc_id is not).

Most texts have one language, and then no pass over their words is needed: if no run of words
gains more than half a penalty in any other language, the constant path is the best one. That test is
a running maximum over whole blocks of texts, and only texts that fail it go through Viterbi.

A NULL text or one without a letter is `und` with score 0. With nothing to learn from, all are.
Very long texts are read whole. Of languages with equally many letters the first by name is predicted. Repeated rows
are labelled alike, empty tables give empty results, extra columns are not read. Spans count code points of the text itself:
lower-casing maps code point to code point.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.quality import held_out
from daygrain.llm.textblocks import blocks, mix64

BUCKETS = 1 << 14
SWITCH = 15.0
SMOOTHING = 0.5
# A language uses a script that makes up this share of its letters.
USES = 0.01
UNDETERMINED = "und"
_EXCLUDED = -40.0

# First and last code point of the scripts told apart; other letters share one number.
SCRIPTS = {
    "Latin": ((0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)),
    "Greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "Cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF)),
    "Armenian": ((0x530, 0x58F),),
    "Hebrew": ((0x590, 0x5FF),),
    "Arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF)),
    "Devanagari": ((0x900, 0x97F),),
    "Bengali": ((0x980, 0x9FF),),
    "Tamil": ((0xB80, 0xBFF),),
    "Thai": ((0xE00, 0xE7F),),
    "Georgian": ((0x10A0, 0x10FF),),
    "Hangul": ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)),
    "Kana": ((0x3040, 0x30FF),),
    "Han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x2FFFF)),
}
N_SCRIPTS = len(SCRIPTS) + 2  # 0: no letter, last: any other script


@cache
def script_table() -> np.ndarray:
    """The script number of every code point, 0 where it is no letter."""
    letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    out = np.full(0x110000, N_SCRIPTS - 1, np.uint8)
    for k, ranges in enumerate(SCRIPTS.values(), 1):
        for low, high in ranges:
            out[low : high + 1] = k
    out[~letters] = 0
    return out


@dataclass
class Letters:
    """A block of texts: per letter its triplet bucket, per word where it begins and which text it is in."""

    bucket: np.ndarray
    script: np.ndarray
    word_start: np.ndarray  # into the letters
    word_text: np.ndarray
    span: np.ndarray  # code point offsets of each word in its text: (start, end)


def letters_of(data: np.ndarray, offsets: np.ndarray) -> Letters:
    n = len(offsets) - 1
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    heads = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=heads[1:])
    begins = heads[offsets]
    script = script_table()[points]
    at = np.flatnonzero(script)
    if not len(at):
        none = np.zeros(0, np.int64)
        return Letters(none, script[:0], none, none, np.zeros((0, 2), np.int64))
    text = np.searchsorted(begins, at, side="right") - 1
    linked = (at[1:] == at[:-1] + 1) & (text[1:] == text[:-1])
    codes = points[at].astype(np.uint64)
    before = np.zeros_like(codes)
    after = np.zeros_like(codes)
    before[1:][linked] = codes[:-1][linked]
    after[:-1][linked] = codes[1:][linked]
    code = mix64(before << np.uint64(42) | codes << np.uint64(21) | after)
    start = np.concatenate([[0], np.flatnonzero(~linked) + 1])
    stop = np.concatenate([start[1:], [len(at)]])
    owner = text[start]
    span = np.stack([at[start] - begins[owner], at[stop - 1] + 1 - begins[owner]], axis=1)
    return Letters((code % np.uint64(BUCKETS)).astype(np.int64), script[at], start, owner, span)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Letters per language and bucket of one partition; scripts are counted behind the buckets."""
    width = BUCKETS + N_SCRIPTS
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for start, end, data, offsets in blocks(pc.utf8_lower(batch.column(1))):
            found = letters_of(data, offsets)
            names, place = np.unique(np.array(langs[start:end], object), return_inverse=True)
            lengths = np.diff(np.concatenate([found.word_start, [len(found.bucket)]]))
            row = np.repeat(place[found.word_text] if len(found.word_text) else found.word_text, lengths)
            size = len(names) * width
            table = np.bincount(row * width + found.bucket, minlength=size)
            table += np.bincount(row * width + BUCKETS + found.script, minlength=size)
            for k, name in enumerate(names):
                part = table[k * width : (k + 1) * width]
                sums[name] = sums[name] + part if name in sums else part.copy()
    for name, table in sums.items():
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(table[at].astype(np.int64))],
            ["lang", "bucket", "n"],
        )


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # bucket x language: log-probabilities
    uses: np.ndarray  # script x language


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    learn = docs.where(
        F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id))
    ).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    counted = learn.mapInArrow(_counts, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = counted.groupBy("lang").agg(F.collect_list("bucket").alias("at"), F.collect_list("n").alias("n")).orderBy("lang")
    rows = found.collect()  # a bounded number of buckets per language
    table = np.zeros((BUCKETS + N_SCRIPTS, len(rows)))
    for k, row in enumerate(rows):
        table[row["at"], k] = row["n"]
    counts, scripts = table[:BUCKETS] + SMOOTHING, table[BUCKETS:]
    uses = scripts >= USES * np.maximum(scripts.sum(axis=0), 1)
    uses[~uses.any(axis=1)] = True  # a script that no language uses leaves the choice to the triplets
    return Model([r["lang"] for r in rows], np.log(counts / counts.sum(axis=0)).astype(np.float32), uses)


def viterbi(scores: list[np.ndarray], penalty: float = SWITCH) -> list[np.ndarray]:
    """The best path through each text's words x languages scores, for texts side by side."""
    order = sorted(range(len(scores)), key=lambda k: -len(scores[k]))
    paths: list[np.ndarray] = [np.zeros(0, np.int64)] * len(scores)
    while order:
        # Texts of similar length together, so that padding stays small.
        longest = len(scores[order[0]])
        group = [k for k in order[:256] if 2 * len(scores[k]) >= longest]
        order = order[len(group) :]
        sizes = np.array([len(scores[k]) for k in group])
        table = np.zeros((longest, len(group), scores[group[0]].shape[1]))
        for j, k in enumerate(group):
            table[: sizes[j], j] = scores[k]
        best, came = table[0].copy(), np.zeros(table.shape, np.int16)
        stay = np.arange(table.shape[2])
        last = best.copy()
        for t in range(1, longest):
            top = best.argmax(axis=1)
            switched = best[np.arange(len(group)), top] - penalty
            better = switched[:, None] > best
            came[t] = np.where(better, top[:, None], stay)
            best = np.where(better, switched[:, None], best) + table[t]
            ended = sizes == t + 1
            last[ended] = best[ended]
        for j, k in enumerate(group):
            path = np.empty(sizes[j], np.int64)
            path[-1] = last[j].argmax()
            for t in range(sizes[j] - 1, 0, -1):
                path[t - 1] = came[t, j, path[t]]
            paths[k] = path
    return paths


def word_scores(found: Letters, model: Model) -> np.ndarray:
    columns = [np.add.reduceat(model.weights[:, k][found.bucket], found.word_start) for k in range(len(model.langs))]
    scores = np.stack(columns, axis=1).astype(np.float64)
    scores[~model.uses[found.script[found.word_start]]] += _EXCLUDED
    return scores


def best_paths(scores: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The best language of each word; `text` says which text each word is in, in order.

    A text stays in its best language without a look at all paths if no run of words gains more than half
    a penalty elsewhere: m >= 2 runs elsewhere gain at most m / 2 penalties and need m - 1 switches or more, one
    needs a switch or is the whole text, which gains nothing.
    """
    starts = np.concatenate([[0], np.flatnonzero(np.diff(text)) + 1])
    sizes = np.diff(np.concatenate([starts, [len(text)]]))
    which = np.repeat(np.arange(len(starts)), sizes)
    top = np.add.reduceat(scores, starts).argmax(axis=1)
    path = top[which]
    own = scores[np.arange(len(path)), path]
    mixed = np.zeros(len(starts), bool)
    for k in range(scores.shape[1]):
        # The largest gain of any run of words if they were in language k.
        sums = np.cumsum(scores[:, k] - own)
        before = np.concatenate([[0.0], sums[:-1]])
        apart = which * (2 * np.abs(sums).max() + 1)
        lowest = np.minimum.accumulate(before - apart) + apart
        mixed |= np.maximum.reduceat(sums - lowest, starts) > SWITCH / 2
    at = np.flatnonzero(mixed)
    for k, found in zip(at, viterbi([scores[starts[k] : starts[k] + sizes[k]] for k in at])):
        path[starts[k] : starts[k] + sizes[k]] = found
    return path


_SPANS = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def label(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score and the spans (language, first and last code point) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.langs, UNDETERMINED], object)
        for batch in batches:
            for start, end, data, offsets in blocks(pc.utf8_lower(batch.column(1))):
                n = end - start
                found = letters_of(data, offsets)
                pred, share, spans = np.full(n, len(model.langs)), np.zeros(n), [[] for _ in range(n)]
                if len(found.word_text) and model.langs:
                    path = best_paths(word_scores(found, model), found.word_text)
                    lengths = np.diff(np.concatenate([found.word_start, [len(found.bucket)]]))
                    k = len(model.langs)
                    letters = np.bincount(found.word_text * k + path, lengths, n * k).reshape(n, k)
                    some = letters.sum(axis=1) > 0
                    pred[some] = letters.argmax(axis=1)[some]
                    share[some] = (letters.max(axis=1) / np.maximum(letters.sum(axis=1), 1))[some]
                    turn = np.ones(len(path), bool)
                    turn[1:] = (path[1:] != path[:-1]) | (found.word_text[1:] != found.word_text[:-1])
                    first = np.flatnonzero(turn)
                    final = np.concatenate([first[1:], [len(path)]]) - 1
                    for a, b in zip(first, final):
                        spans[found.word_text[a]].append(
                            {"lang": names[path[a]], "start": int(found.span[a, 0]), "end": int(found.span[b, 1])}
                        )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, n), pa.array(names[pred], pa.string()), pa.array(share), pa.array(spans, _SPANS)],
                    ["doc_id", "lang_pred", "score", "spans"],
                )

    kind = "doc_id long, lang_pred string, score double, spans array<struct<lang:string,start:bigint,end:bigint>>"
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(labelled, kind)
