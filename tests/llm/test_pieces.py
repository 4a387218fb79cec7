"""Encoding against the public library, round trips, odd rows."""

import random

import pytest
import sentencepiece as library

from daygrain.llm import pieces

FOLDER = "/root/testdata/sf0.01"
ODD = [
    "", " ", "  a  b ", "a\nb\t\tc", "Hello  world!", "aaaaaaaaaaaaaaaaaaaaaaa", "日本語のテキスト", "\U0001f600\U0001f601 x", "é é", "x" * 500,
    "        deep indent\r\n", "==========", "1234567890 3.14159", "\x00\x01", "ſtraße ﬁ ½", " nbsp　wide",
]


@pytest.fixture(scope="module")
def model():
    with open(pieces.MODEL, "rb") as file:
        data = file.read()
    return library.SentencePieceProcessor(model_proto=data), pieces.Encoder(pieces.Vocabulary.read(data))


def lists(encoder, texts):
    ids, offsets = encoder.encode(texts)
    return [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]


def test_odd_texts_are_encoded_like_the_library_does(model):
    reference, encoder = model
    assert lists(encoder, ODD) == reference.encode(ODD)


def test_random_texts(model):
    reference, encoder = model
    rng = random.Random(2)
    alphabet = "abcdefghi  \n\t.,;{}()ABCéß▁漢0123456789\r"
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(1, 60))) for _ in range(1500)]
    texts += ["".join(rng.choices("aehinorst ", k=rng.randrange(1, 80))) for _ in range(1500)]
    assert lists(encoder, texts) == reference.encode(texts)


def test_documents_and_round_trip(spark, model):
    reference, encoder = model
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = pieces.decode_column(pieces.encode(docs)).collect()
    assert len(rows) == docs.count()
    assert [r.ids for r in rows] == reference.encode([r.text for r in rows])
    assert all(r.text == r.decoded for r in rows)


def test_odd_rows(spark, model):
    long = "word " * 60_000
    rows = [(None, 1), ("", 2), (long, 3), ("a b", 4), ("a b", 4), ("x" * 5_000, 5)]
    docs = spark.createDataFrame([(t, i, "clash") for t, i in rows], "text string, doc_id long, ids string")
    got = pieces.decode_column(pieces.encode(docs)).collect()
    assert [r.doc_id for r in got] == [1, 2, 3, 4, 4, 5]
    assert got[0].ids == [] and got[0].decoded == "" and got[1].ids == []
    assert got[2].decoded == long and got[2].ids == model[0].encode(long)
    assert got[5].ids == model[0].encode("x" * 5_000)
    assert pieces.encode(docs.limit(0)).collect() == []


def test_shared_states_are_those_of_each_word_alone(model):
    _, encoder = model
    words = sorted({"▁the", "▁them", "▁theme", "▁themes", "▁thematic", "▁a", "▁ab", "▁▁▁x", "▁▁▁", "theme", "xyzzy"})
    shared = list(encoder.vocabulary.encode_sorted(words))
    assert shared == [next(encoder.vocabulary.encode_sorted([w])) for w in words] == [encoder.vocabulary.merge(w) for w in words]
