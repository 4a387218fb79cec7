"""SentencePiece encoding and decoding with a shared-prefix Viterbi pass over distinct words.

The model file's pieces and scores are read with the public library; encoding and decoding are done
here. White space becomes the marker U+2581 and a marker is put in front. No piece has a marker
behind another character, so a text falls apart into marked words (a run of markers and what
follows it), and no piece crosses from one to the next.

The distinct marked words of a batch are sorted, which makes them the paths of a trie in depth-first
order: a word shares with the one before it all states of their common prefix. A state is the best
segmentation of a prefix, told by its last piece. Merging pieces by score gives exactly one
segmentation of every prefix, and a piece ends the one of prefix + piece exactly if the piece is
what its own text merges to and the pair (last piece of the prefix, piece) does not merge across
its border; that is the forward step. Pairs are looked up in a table that fills as it goes.

A character without a piece becomes the pieces of its UTF-8 bytes. Decoding joins pieces, turns
markers into spaces, bytes into text, and drops the marker in front, so a text without U+2581
comes back as it was. U+2581 itself is read as a space. A NULL or empty text has no pieces
and decodes to an empty text. Very long words are cut into the longest stretches that hold no character
a piece of several characters could span; otherwise their states are walked like any other's.
Repeated rows are encoded alike, empty tables give empty results, extra columns are untouched.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# Words whose pieces a task remembers, and the pieces per remembered word at most.
REMEMBERED = 150_000
REMEMBERED_PIECES = 64
# Pairs of pieces a task remembers.
REMEMBERED_PAIRS = 250_000
# Rows worked on at once, and characters.
_ROWS, _CHARS = 512, 1 << 20


@dataclass
class Vocabulary:
    """Pieces that merge, their scores, byte pieces and what every id decodes to."""

    ids: dict[str, int]
    scores: dict[str, float]
    byte_ids: list[int]
    texts: list[bytes]
    joinable: frozenset = frozenset()
    whole: frozenset = frozenset()  # pieces whose own text merges to them
    _apart: dict[tuple[str, str], bool] = field(default_factory=dict)

    @classmethod
    def read(cls, data: bytes) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=data)
        ids, scores, byte_ids, texts = {}, {}, [0] * 256, []
        for k in range(model.get_piece_size()):
            piece = model.id_to_piece(k)
            if model.is_byte(k):
                byte_ids[int(piece[3:5], 16)] = k
                texts.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(k) or model.is_unknown(k) or model.is_unused(k):
                texts.append(b"")
            else:
                ids[piece], scores[piece] = k, model.get_score(k)
                texts.append(piece.replace(MARK, " ").encode())
        out = cls(ids, scores, byte_ids, texts, frozenset("".join(p for p in ids if len(p) > 1)))
        out.whole = frozenset(p for p in ids if len(out.merge(p)) == 1)
        return out

    def merge(self, text: str) -> list[str]:
        """Merge neighbours with the best score until none is a piece: the definition, by brute force."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = self.scores.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def apart(self, left: str, right: str) -> bool:
        """Whether the two pieces stay apart when their texts meet."""
        found = self.merge(left + right) == [left, right]
        if len(self._apart) < REMEMBERED_PAIRS:
            # One string for each piece, not two for each pair.
            self._apart[sys.intern(left), sys.intern(right)] = found
        return found

    def encode_sorted(self, words: list[str]) -> Iterator[list[str]]:
        """The pieces of each word; words in sorted order share the states of common prefixes."""
        whole, known = self.whole, self._apart
        before = ""
        last: list[str] = [""]  # the last piece of the segmentation of each prefix
        for word in words:
            common = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                common += 1
            del last[common + 1 :]
            for end in range(common + 1, len(word) + 1):
                # Exactly one piece that ends here fits; short ones are the likely ones.
                start = end - 1
                piece = word[start]
                while start:
                    if piece in whole or start == end - 1:
                        left = last[start]
                        fits = known.get((left, piece))
                        if fits is None:
                            fits = self.apart(left, piece)
                        if fits:
                            break
                    start -= 1
                    piece = word[start:end]
                last.append(piece)
            pieces, end = [], len(word)
            while end:
                piece = last[end]
                pieces.append(piece)
                end -= len(piece)
            before = word
            pieces.reverse()
            yield pieces

    def number(self, pieces: list[str]) -> list[int]:
        out = []
        for piece in pieces:
            found = self.ids.get(piece)
            if found is not None:
                out.append(found)
            else:
                out.extend(self.byte_ids[b] for b in piece.encode())
        return out


class Encoder:
    """Encodes batches of texts; remembers a bounded number of words between them."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        lonely = "".join(sorted(set(chr(c) for c in range(128)) - vocabulary.joinable))
        # Marked words, cut around characters that no longer piece holds.
        self.words = re.compile(f"[{re.escape(lonely)}]|{MARK}*[^{MARK}{re.escape(lonely)}]+|{MARK}+")
        self.known: dict[str, tuple[int, ...]] = {}

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array and the offsets of each text in it."""
        split = [self.words.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        numbers: dict[str, int] = {}
        flat = [numbers.setdefault(w, len(numbers)) for words in split for w in words]
        known = self.known
        fresh = sorted(w for w in numbers if w not in known)
        table: list = [known.get(w) for w in numbers]
        if len(known) + len(fresh) > REMEMBERED:
            known.clear()
        for word, pieces in zip(fresh, self.vocabulary.encode_sorted(fresh)):
            ids = tuple(self.vocabulary.number(pieces))
            table[numbers[word]] = ids
            if len(ids) <= REMEMBERED_PIECES and len(known) < REMEMBERED:
                known[word] = ids
        sizes = np.fromiter(map(len, table), np.int64, len(table))
        pool = np.fromiter((i for ids in table for i in ids), np.int32, int(sizes.sum()))
        begins = np.concatenate([[0], np.cumsum(sizes)])[:-1] if len(sizes) else sizes
        words = np.array(flat, np.int64)
        lengths = sizes[words] if len(words) else words
        ends = np.cumsum(lengths)
        out = pool[np.repeat(begins[words] - (ends - lengths), lengths) + np.arange(lengths.sum())] if len(words) else pool
        counts = np.fromiter(map(len, split), np.int64, len(split))
        offsets = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return out, offsets


def decode(vocabulary: Vocabulary, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
    texts = vocabulary.texts
    parts = [texts[i] for i in ids.tolist()]
    out = []
    for a, b in zip(offsets[:-1], offsets[1:]):
        joined = b"".join(parts[a:b]).decode("utf-8", "replace")
        out.append(joined[1:] if joined[:1] == " " else joined)
    return out


@cache
def _encoder(data: bytes) -> Encoder:
    """One per worker process and model."""
    return Encoder(Vocabulary.read(data))


def _runs(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    start, held, texts = 0, 0, []
    for row, value in enumerate(column):
        text = value.as_py() or ""
        texts.append(text)
        held += len(text)
        if held >= _CHARS or len(texts) >= _ROWS:
            yield start, texts
            start, held, texts = row + 1, 0, []
    if texts:
        yield start, texts


def _model_bytes(docs: DataFrame, path: str) -> bytes:
    """The model file, read on the driver: a vocabulary of some hundred KB."""
    if "://" in path:
        return bytes(docs.sparkSession.read.format("binaryFile").load(path).first().content)
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, text: str = "text", model: str = MODEL, ids: str = "ids") -> DataFrame:
    """All columns and `ids`, the ids of the text's pieces."""
    shared = docs.sparkSession.sparkContext.broadcast(_model_bytes(docs, model))
    others = [c for c in docs.columns if c != ids]
    place = others.index(text)
    source = docs.select(*[F.col(f"`{c}`") for c in others])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in batches:
            for start, texts in _runs(batch.column(place)):
                found, offsets = encoder.encode(texts)
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(found.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*batch.slice(start, len(texts)).columns, lists], [*others, ids])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema)
    return source.mapInArrow(encoded, f"{kinds}, `{ids}` array<int>")


def decode_column(docs: DataFrame, ids: str = "ids", text: str = "decoded", model: str = MODEL) -> DataFrame:
    """All columns and `text`, decoded from `ids`."""
    shared = docs.sparkSession.sparkContext.broadcast(_model_bytes(docs, model))
    others = [c for c in docs.columns if c != text]
    place = others.index(ids)
    source = docs.select(*[F.col(f"`{c}`") for c in others])

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _encoder(shared.value).vocabulary
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                lists = part.column(place).fill_null([])
                offsets = np.asarray(lists.offsets, np.int64)
                flat = np.asarray(lists.values)[offsets[0] : offsets[-1]]
                texts = decode(vocabulary, flat, offsets - offsets[0])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*others, text])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema)
    return source.mapInArrow(decoded, f"{kinds}, `{text}` string")
