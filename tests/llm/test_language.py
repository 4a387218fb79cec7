"""Languages: held-out accuracy, the best path against full Viterbi, odd rows."""

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from daygrain.llm import language
from daygrain.llm.registry import QUERIES

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = QUERIES["op4_language_id"](spark, FOLDER)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").where("held_out").collect()
    assert len(rows) > 200
    assert sum(r.lang == r.lang_pred for r in rows) > 0.97 * len(rows)
    assert got.count() == docs.count()


def path_value(scores, path):
    return scores[np.arange(len(path)), path].sum() - language.SWITCH * np.count_nonzero(np.diff(path))


def test_paths_are_the_best_ones():
    rng = np.random.default_rng(1)
    texts = [rng.normal(0, 9, (n, 3)) for n in (1, 2, 6, 7, 7, 5)] + [np.repeat(rng.normal(0, 9, (3, 2)), 2, axis=0).reshape(4, 3)]
    joined = np.concatenate(texts)
    owner = np.repeat([0, 1, 2, 4, 5, 8, 9], [len(t) for t in texts])
    found = np.split(language.best_paths(joined, owner), np.cumsum([len(t) for t in texts])[:-1])
    for scores, path in zip(texts, found):
        best = max(path_value(scores, np.array(p)) for p in itertools.product(range(3), repeat=len(scores)))
        assert abs(path_value(scores, path) - best) < 1e-9
    for scores, path in zip(texts, language.viterbi(texts)):
        best = max(path_value(scores, np.array(p)) for p in itertools.product(range(3), repeat=len(scores)))
        assert abs(path_value(scores, path) - best) < 1e-9


def test_text_of_two_languages_with_a_third_one_on_top():
    """First A, then B, while C has the best total: no single run gains more than a penalty over C."""
    gain = language.SWITCH / 5
    first, second = [gain, -4 * gain / 3, 0.0], [-4 * gain / 3, gain, 0.0]
    scores = np.array([first] * 4 + [second] * 4)
    path = language.best_paths(scores, np.zeros(8, int))
    assert path.tolist() == [0] * 4 + [1] * 4


def test_short_texts_against_full_viterbi():
    rng = np.random.default_rng(4)
    scores, owner = [], []
    for k in range(200):
        n = int(rng.integers(1, 12))
        half = np.repeat(rng.normal(0, 1, (2, 4)), [n // 2, n - n // 2], axis=0)
        scores.append((half + rng.normal(0, 0.3, (n, 4))) * language.SWITCH * rng.choice([0.05, 0.2, 0.5, 1.0, 3.0]))
        owner += [k] * n
    paths = np.split(language.best_paths(np.concatenate(scores), np.array(owner)), np.cumsum([len(t) for t in scores])[:-1])
    for table, path, full in zip(scores, paths, language.viterbi(scores), strict=True):
        assert abs(path_value(table, path) - path_value(table, full)) < 1e-9


def test_lower_case_moves_no_offset():
    """Spans are code points of the text itself: lower-casing maps code point to code point."""
    text = "".join(chr(c) for c in range(0x20, 0x20000) if not 0xD800 <= c < 0xE000)
    assert len(pc.utf8_lower(pa.array([text]))[0].as_py()) == len(text)


def test_spans_and_odd_rows(spark):
    english = "the cat and the dog went over the hill with the other thing "
    russian = "это было очень давно и никто уже не помнил как это началось "
    rows = [(k, english * 3 + f"number {'abcdefg'[k % 7]}", "en", "x") for k in range(20)]
    rows += [(100 + k, russian * 3, "ru", "x") for k in range(20)]
    odd = [
        (200, None, "en", "x"), (201, "", "en", "x"), (202, "12 34 !?", "en", "x"), (203, english * 4 + russian * 2, None, "x"),
        (204, english * 20_000, None, "x"), (None, english, "ru", "x"), (205, "word", None, "x"), (205, "word", None, "x"), (206, "漢字", None, "x"),
    ]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, score string")
    model = language.train(docs)
    assert model.langs == ["en", "ru"]
    got = {r.doc_id: r for r in language.label(docs, model).collect()}
    assert [got[k].lang_pred for k in (200, 201, 202)] == ["und"] * 3
    assert got[0].lang_pred == "en" and got[100].lang_pred == "ru" and got[204].lang_pred == "en"
    both = got[203]
    assert both.lang_pred == "en" and [s.lang for s in both.spans] == ["en", "ru"]
    assert both.spans[0].start == 0 and both.spans[1].start == 4 * len(english)
    assert 0.5 < both.score < 1
    assert got[206].lang_pred in ("en", "ru")
    assert language.label(docs.limit(0), model).collect() == []
    nothing = language.train(docs.limit(0))
    assert {r.lang_pred for r in language.label(docs, nothing).collect()} == {"und"}
