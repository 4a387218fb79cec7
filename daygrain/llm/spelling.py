"""Spelling variants: words one edit apart, each led to the most frequent of its neighbours.

Words are runs of ASCII and Latin-1 letters, A-Z in lower case. They are counted over whole texts; a word
takes part with at least `MIN_LENGTH` code points and `MIN_COUNT` occurrences. Two words are near if
one inserted, deleted or replaced code point turns one into the other. A word's form is its near word
with the largest count, if that is `LIFT` times its own; the root is where the forms end.

1. A word's vector counts its letters, in `DIMS` groups. One edit adds at most one letter and takes
   at most one, so near words are at most two apart in L1: one up, one down. That is all the
   search needs: sums of what a box lacks and of what it exceeds, each at most one.
2. Each length has a k-d tree over these vectors, cut from a bounded sample of the vocabulary. The sample only
   decides how even the leaves are; there are at most `LEAVES` of them, which bounds what tasks are
   sent. A word lies in one leaf, and asks every leaf of its own and of the next length whose
   box an edit can reach.
3. A task holds one leaf and the words that ask it. It goes down a local k-d tree with tight boxes,
   and compares the letters of what is left: one place differs, or a common beginning and end
   cover the shorter word. Pairs never leave the task, only counts and the best near word.
4. Roots are found by pointer jumping. Each form has `LIFT` times the count, so chains are short.

NULL and empty texts have no words. A NULL id takes part like any other. Words of any length are compared whole.
Ties in the count go to the word that is smaller in code-point order. Repeated rows count as often
as they are there. Words with equal vectors cannot be told apart by boxes and are compared in one
task. Empty tables give no words. Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.common import Scratch
from daygrain.llm.textblocks import blocks, buffers, lowered

MIN_LENGTH = 6
MIN_COUNT = 5
LIFT = 5
# Groups of letters: a-z and six of accented ones.
DIMS = 32
# Words in a leaf, leaves of all trees together, and words the trees are cut from.
BLOCK = 2048
LEAVES = 4096
SAMPLE = 32768
# Words in a leaf of a task's own tree, and cells of a comparison that are held at once.
_SMALL = 32
_CELLS = 1 << 22
# Counted words a task holds before it hands them on.
_HELD = 1 << 19
# Words up to so many bytes have their checksums taken together.
_SHORT = 64

_LEAD = 0xC3  # first byte of U+00C0 to U+00FF in UTF-8
_ASCII = np.zeros(256, bool)
_ASCII[65:91] = _ASCII[97:123] = True
_GROUP = np.zeros(256, np.int64)
_GROUP[97:123] = np.arange(26)
_GROUP[0xC0:] = 26 + np.arange(64) % (DIMS - 26)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & np.uint32(1), (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


_CRC = _crc_table()

Edit = Callable[[str, int], str]


def run_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of all maximal runs of letters; a run never crosses two texts."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lead = data == _LEAD
    letter = _ASCII[data] | lead
    letter[1:] |= lead[:-1]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    first, last = letter.copy(), letter.copy()
    first[1:] &= ~letter[:-1] | cut[1:-1]
    last[:-1] &= ~letter[1:] | cut[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The CRC-32 of each span's bytes, going on from the checksums `before`."""
    out = np.zeros(len(starts), np.uint32)
    sizes = ends - starts
    order = np.argsort(-sizes, kind="stable")
    long = int(np.searchsorted(-sizes[order], -_SHORT, side="left"))
    for i in order[:long]:
        out[i] = zlib.crc32(data[starts[i] : ends[i]], int(before[i]))
    order = order[long:]
    at, sizes, state = starts[order], sizes[order], ~before[order].astype(np.uint32)
    for k in range(int(sizes[0]) if len(sizes) else 0):
        n = int(np.searchsorted(-sizes, -k, side="left"))
        active = state[:n]
        state[:n] = _CRC[(active ^ data[at[:n] + k]) & np.uint32(255)] ^ (active >> np.uint32(8))
    out[order] = ~state
    return out


def _spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans as a string column."""
    sizes = ends - starts
    places = np.concatenate([[0], np.cumsum(sizes)])
    picked = np.repeat(starts - places[:-1], sizes) + np.arange(places[-1])
    return pa.StringArray.from_buffers(
        len(sizes), pa.py_buffer(places.astype(np.int32)), pa.py_buffer(data[picked])
    )


def _merged(held: list[pa.Table]) -> pa.Table:
    total = pa.concat_tables(held).group_by("word").aggregate([("n", "sum")])
    return pa.table({"word": total["word"], "n": total["n_sum"]})


def _counts(batches: Iterable[pa.RecordBatch], every: int, edit: Edit | None, least: int) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    for batch in batches:
        ids, column = batch.column("doc_id").to_pylist(), batch.column("text")
        for start, end, data, offsets in blocks(column):
            data = lowered(data)
            starts, ends = run_bounds(data, offsets)
            plain = np.ones(len(starts), bool)
            extra: list[str] = []
            if edit is not None and len(starts):
                home = np.searchsorted(offsets, starts, side="right") - 1 + start
                # Runs of texts with empty ones between them lie in the last text that begins at or before them.
                before = np.array([zlib.crc32(f"{i}:".encode()) for i in ids[start:end]], np.uint32)
                codes = checksums(data, starts, ends, before[home - start])
                for i in np.flatnonzero(codes % np.uint32(every) == 0):
                    if ids[home[i]] is not None:
                        plain[i] = False
                        extra.append(edit(data[starts[i] : ends[i]].tobytes().decode(), int(codes[i])))
            leads = np.concatenate([[0], np.cumsum(data == _LEAD)])
            points = ends - starts - (leads[ends] - leads[starts])
            plain &= points >= least
            words = _spans(data, starts[plain], ends[plain])
            if extra := [w for w in extra if len(w) >= least]:
                words = pa.concat_arrays([words, pa.array(extra, pa.string())])
            found = pc.value_counts(words)
            held.append(pa.table({"word": found.field("values"), "n": found.field("counts")}))
            if sum(map(len, held)) > _HELD:
                held = [_merged(held)]
                if len(held[0]) > _HELD // 2:
                    yield from held.pop().combine_chunks().to_batches()
    if held:
        yield from _merged(held).combine_chunks().to_batches()


def vocabulary(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", every: int = 0, edit: Edit | None = None,
    least: int = MIN_LENGTH, count: int = MIN_COUNT,
) -> DataFrame:
    """word and n. `edit(word, checksum)` replaces an occurrence where `every` divides the CRC-32 of
    `<doc_id>:<word>`; a NULL id has none."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    counted = rows.mapInArrow(partial(_counts, every=every, edit=edit, least=least), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= count)


# ---- Vectors and trees


def letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All words of a column, one byte per code point, and the word's offsets into them."""
    data, offsets = buffers(column)
    lead = data == _LEAD
    leads = np.concatenate([[0], np.cumsum(lead)])
    points = data.copy()
    points[1:][lead[:-1]] += 0x40
    return points[~lead], offsets - leads[offsets]


def vectors(points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Letter counts of each word; what passes 16 bits is cut off, which brings no two words apart."""
    n = len(offsets) - 1
    row = np.repeat(np.arange(n), np.diff(offsets))
    counts = np.bincount(row * DIMS + _GROUP[points], minlength=n * DIMS)
    return np.minimum(counts, 32767).astype(np.int16).reshape(n, DIMS)


def reach(low: np.ndarray, high: np.ndarray, asked: np.ndarray, down: int) -> np.ndarray:
    """Which vectors can be led into the box by one letter more and `down` letters less."""
    lacks = np.maximum(low - asked, 0).sum(-1, dtype=np.int32)
    exceeds = np.maximum(asked - high, 0).sum(-1, dtype=np.int32)
    return (lacks <= 1) & (exceeds <= down)


def cut(points: np.ndarray) -> tuple[int, int] | None:
    """The dimension and value that halve the points best, if any part them."""
    middle = np.floor(np.median(points, axis=0)).astype(np.int16)
    best = None
    for value in (middle, middle - 1):
        left = (points <= value).sum(0)
        even = np.minimum(left, len(points) - left)
        dim = int(even.argmax())
        if even[dim] and (best is None or even[dim] > best[0]):
            best = (int(even[dim]), dim, int(value[dim]))
    return best and best[1:]


def plant(points: np.ndarray, most: float, number: Iterator[int]):
    """A k-d tree: a leaf's number, or (dimension, value, left, right)."""
    split = cut(points) if len(points) > most else None
    if split is None:
        return next(number)
    left = points[:, split[0]] <= split[1]
    return (*split, plant(points[left], most, number), plant(points[~left], most, number))


def _leaf_of(tree, asked: np.ndarray, rows: np.ndarray, out: np.ndarray) -> None:
    if not isinstance(tree, tuple):
        out[rows] = tree
    elif len(rows):
        left = asked[rows, tree[0]] <= tree[1]
        _leaf_of(tree[2], asked, rows[left], out)
        _leaf_of(tree[3], asked, rows[~left], out)


def _reached(tree, asked: np.ndarray, rows: np.ndarray, down: int) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, rows that an edit can lead into its box)."""
    low, high = np.full(DIMS, -1, np.int16), np.full(DIMS, 32767, np.int16)
    todo = [(tree, rows, low, high)]
    while todo:
        node, rows, low, high = todo.pop()
        rows = rows[reach(low, high, asked[rows], down)]
        if not len(rows):
            continue
        if not isinstance(node, tuple):
            yield node, rows
            continue
        dim, value, left, right = node
        for child, bound, limit in ((left, high, value), (right, low, value + 1)):
            bound = bound.copy()
            bound[dim] = limit
            todo.append((child, rows, *((low, bound) if child is left else (bound, high))))


_HOME, _SAME, _SHORTER = 0, 1, 2
_ROUTED = "length int, leaf int, role int, word string, n long"


def _route(batches: Iterable[pa.RecordBatch], trees: dict) -> Iterator[pa.RecordBatch]:
    names = ["length", "leaf", "role", "word", "n"]
    for batch in batches:
        points, offsets = letters(batch.column("word"))
        sizes, asked = np.diff(offsets), vectors(points, offsets)
        for length in map(int, np.unique(sizes)):
            rows = np.flatnonzero(sizes == length)
            home = np.zeros(len(sizes), np.int64)
            _leaf_of(trees.get(length, 0), asked, rows, home)
            parts = [(length, home[rows], _HOME, rows)]
            for leaf, got in _reached(trees.get(length, 0), asked, rows, 1):
                got = got[home[got] != leaf]
                parts.append((length, np.full(len(got), leaf), _SAME, got))
            for leaf, got in _reached(trees.get(length + 1, 0), asked, rows, 0):
                parts.append((length + 1, np.full(len(got), leaf), _SHORTER, got))
            for long, leaf, role, got in parts:
                if len(got):
                    picked = batch.take(pa.array(got))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(got), long, np.int32)), pa.array(leaf.astype(np.int32)),
                        pa.array(np.full(len(got), role, np.int32)), picked.column("word"), picked.column("n"),
                    ], names)


def _sampled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        points, offsets = letters(batch.column("word"))
        made = vectors(points, offsets)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.diff(offsets).astype(np.int32)), pa.array([v.tobytes() for v in made], pa.binary())], ["length", "vector"]
        )


def _trees(words: DataFrame) -> dict:
    """Length to tree, cut from at most `SAMPLE` words; a length that is not in it has one leaf."""
    total = words.count()
    picked = words.select("word").orderBy(F.xxhash64("word"), "word").limit(SAMPLE)
    rows = picked.mapInArrow(_sampled, "length int, vector binary").collect()
    share = len(rows) / max(total, 1)
    most = max(BLOCK, total / LEAVES) * share
    by_length: dict[int, list[bytes]] = {}
    for r in rows:
        by_length.setdefault(r.length, []).append(bytes(r.vector))
    grown = {}
    for length, found in by_length.items():
        points = np.frombuffer(b"".join(found), np.int16).reshape(-1, DIMS)
        grown[length] = plant(points, most, iter(range(1 << 30)))
    return grown


# ---- Search within a leaf


def near_boxes(held: np.ndarray, asked: np.ndarray, down: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(asking, held) rows one letter up and `down` letters down at most, by a k-d tree over `held`."""
    todo = [(np.arange(len(held)), np.arange(len(asked)))]
    while todo:
        own, rows = todo.pop()
        if not len(own):
            continue
        box = held[own]
        rows = rows[reach(box.min(0), box.max(0), asked[rows], down)]
        if not len(rows):
            continue
        split = cut(box) if len(own) > _SMALL else None
        if split is not None:
            left = box[:, split[0]] <= split[1]
            todo += [(own[left], rows), (own[~left], rows)]
            continue
        width = max(1, _CELLS // (min(len(own), 4096) * DIMS))
        for i in range(0, len(own), 4096):
            for k in range(0, len(rows), width):
                some, part = own[i : i + 4096], rows[k : k + width]
                met = reach(held[some][None], held[some][None], asked[part][:, None], down)
                a, b = np.nonzero(met)
                if len(a):
                    yield part[a], some[b]


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """A common beginning and a common end cover the shorter word."""
    size = short.shape[1]
    begins = np.logical_and.accumulate(short == long[:, :size], axis=1).sum(1)
    ends = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(1)
    return begins + ends >= size


class _Side:
    """Words of one role and length: letters, vectors, counts, and what they have met."""

    def __init__(self, rows: pa.Table):
        self.words, self.n = rows.column("word").combine_chunks(), rows.column("n").to_numpy()
        points, offsets = letters(self.words)
        self.letters = points.reshape(len(self.words), -1) if len(self.words) else points.reshape(0, 0)
        self.vectors = vectors(points, offsets)
        self.met = np.zeros(len(self.words), np.int64)
        self.best = np.full(len(self.words), np.iinfo(np.int64).max)
        texts = self.words.to_pylist()
        self.order = np.array(sorted(range(len(texts)), key=lambda i: (-self.n[i], texts[i])), np.int64)
        self.rank = np.empty(len(texts), np.int64)
        self.rank[self.order] = np.arange(len(texts))

    def meet(self, rows: np.ndarray, other: "_Side", others: np.ndarray) -> None:
        np.add.at(self.met, rows, 1)
        np.minimum.at(self.best, rows, other.rank[others])

    def found(self, other: "_Side") -> pa.Table:
        rows = np.flatnonzero(self.met)
        best = other.order[self.best[rows]]
        return pa.table({
            "word": self.words.take(pa.array(rows)), "n_near": pa.array(self.met[rows]),
            "near": other.words.take(pa.array(best)), "near_n": pa.array(other.n[best]),
        })


_FOUND = "word string, n_near long, near string, near_n long"


def _search(rows: pa.Table) -> pa.Table:
    role = rows.column("role").to_numpy()
    home = _Side(rows.filter(pa.array(role == _HOME)))
    out = []
    for kind, down, fits in ((_HOME, 1, one_replaced), (_SAME, 1, one_replaced), (_SHORTER, 0, one_inserted)):
        # Words of the leaf ask it themselves; a side of its own keeps what they have met apart.
        asking = _Side(rows.filter(pa.array(role == kind)))
        back = _Side(rows.filter(pa.array(role == _HOME))) if kind == _SHORTER else None
        for a, b in near_boxes(home.vectors, asking.vectors, down):
            step = max(1, _CELLS // max(1, home.letters.shape[1]))
            for i in range(0, len(a), step):
                some, theirs = a[i : i + step], b[i : i + step]
                good = fits(asking.letters[some], home.letters[theirs])
                asking.meet(some[good], home, theirs[good])
                if back is not None:
                    back.meet(theirs[good], asking, some[good])
        out.append(asking.found(home))
        if back is not None:
            out.append(back.found(asking))
    return pa.concat_tables(out)


def near_words(words: DataFrame, scratch: Scratch) -> DataFrame:
    """word, n_near, near and near_n (the best near word) of each word of a stored vocabulary that has any."""
    routed = words.select("word", "n").mapInArrow(partial(_route, trees=_trees(words)), _ROUTED)
    found = routed.groupBy("length", "leaf").applyInArrow(_search, _FOUND)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n")
    )


def roots(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, form) to (word, root), by pointer jumping: paths halve in every round."""
    at, k = scratch.save(links.select("word", F.col("form").alias("root")), "roots-0"), 0
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = at.join(ahead, "root", "left")
        if joined.where("further IS NOT NULL").isEmpty():
            return at
        k += 1
        at = scratch.save(joined.select("word", F.coalesce("further", "root").alias("root")), f"roots-{k}")
        scratch.drop(f"roots-{k - 1}")


def variants(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", every: int = 0, edit: Edit | None = None
) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word that takes part."""
    scratch = Scratch(docs.sparkSession, "spelling")
    words = scratch.save(vocabulary(docs, doc_id, text, every, edit), "words")
    near = scratch.save(near_words(words, scratch), "near")
    lifted = F.col("near_n") >= LIFT * F.col("n")
    formed = scratch.save(
        words.join(near, "word", "left").select(
            "word", F.when(lifted, F.col("near")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(lifted, F.col("near_n")).alias("form_n"),
        ),
        "formed",
    )
    ends = roots(formed.where("form IS NOT NULL").select("word", "form"), scratch)
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def one_letter_less(word: str, code: int) -> str:
    place = code % len(word)
    return word[:place] + word[place + 1 :]
