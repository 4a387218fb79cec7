"""Spelling variants against loops over all pairs of words; the query itself has SQL, which test_exact_dedup compares."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from daygrain.llm import spelling
from daygrain.llm.common import Scratch

SCHEMA = "doc_id long, text string, word string, n int, leaf string"


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def by_loops(rows, every):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if every and doc_id is not None and h % every == 0:
                run = spelling.one_letter_less(run, h)
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    out = {}
    for w, n in words.items():
        met = [v for v in words if near(v, w)]
        best = min(met, key=lambda v: (-words[v], v), default=None)
        out[w] = [best if best and words[best] >= 5 * n else None, None, n, len(met), None]
        out[w][4] = words[best] if out[w][0] else None
    for w, row in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        row[1] = root
    return {(w, *row) for w, row in out.items()}


def corpus(seed):
    random.seed(seed)
    letters = "abcéÉß×"
    base = ["".join(random.choice(letters) for _ in range(random.randrange(5, 10))) for _ in range(12)]
    rows = []
    for k, word in enumerate(base * 3):
        for _ in range(random.choice([1, 3, 40])):
            p = random.randrange(len(word))
            form = random.choice([word, word, word[:p] + word[p + 1 :], word[:p] + random.choice(letters) + word[p:], word[:p] + "b" + word[p + 1 :]])
            rows.append((random.choice([None, 7 * k, k + len(rows)]), f"1{form}-{form.upper()} {word}·{word}"))
    long = "ab" * 40_000
    return rows + [(1, None), (2, ""), (3, "x" + long), (3, "x" + long), *[(k, f"{long} y{long}") for k in range(6)], (9, "中́" * 50)]


@pytest.mark.parametrize("seed, every, block", [(1, 0, 2048), (2, 3, 4), (3, 2, 1)])
def test_words_equal_loops(spark, monkeypatch, seed, every, block):
    monkeypatch.setattr(spelling, "BLOCK", block)
    rows = corpus(seed)
    docs = spark.createDataFrame([(*r, "w", 1, "l") for r in rows], SCHEMA).repartition(3)
    edit = spelling.one_letter_less if every else None
    got = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(docs, every=every, edit=edit).collect()]
    want = by_loops(rows, every)
    assert len(got) == len(set(got)) and set(got) == want
    assert any(r[1] for r in want)


def test_chains_of_forms(spark):
    """abcdef 5 < abcdeg 25 < abcxeg 125: the first word's root is the last one; ties take the smaller word."""
    texts = ["abcdef"] * 5 + ["abcdeg"] * 25 + ["abcxeg"] * 125 + ["abcxzg"] * 125 + ["abcdez"] * 25
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r.word: r for r in spelling.variants(docs).collect()}
    assert (got["abcdef"].form, got["abcdef"].root, got["abcdef"].form_n) == ("abcdeg", "abcxeg", 25)
    assert got["abcxeg"].form is None and got["abcxeg"].root == "abcxeg" and got["abcxeg"].n_near == 2


def test_no_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert spelling.variants(docs).collect() == []


def test_checksums_of_spans():
    random.seed(5)
    words = [bytes(random.randrange(97, 123) for _ in range(random.choice([1, 3, 9, 64, 65, 300]))) for _ in range(200)]
    data = np.frombuffer(b" ".join(words), np.uint8)
    starts = np.cumsum([0] + [len(w) + 1 for w in words[:-1]])
    before = [zlib.crc32(b"%d:" % k) for k in range(200)]
    got = spelling.checksums(data, starts, starts + np.array([len(w) for w in words]), np.array(before, np.uint32))
    assert got.tolist() == [zlib.crc32(w, b) for w, b in zip(words, before, strict=True)]


def test_boxes_lose_no_pair():
    """All pairs that one edit can explain by counts are found, whatever the tree."""
    rng = np.random.default_rng(3)
    held, asked = (rng.integers(0, 3, (300, spelling.DIMS)).astype(np.int16) * (rng.random((300, spelling.DIMS)) < 0.1) for _ in range(2))
    for down in (0, 1):
        got = {(int(i), int(k)) for a, b in spelling.near_boxes(held, asked, down) for i, k in zip(a, b, strict=True)}
        diff = held[None].astype(int) - asked[:, None]
        want = (np.maximum(diff, 0).sum(2) <= 1) & (np.maximum(-diff, 0).sum(2) <= down)
        assert got == {(int(i), int(k)) for i, k in zip(*np.nonzero(want), strict=True)}


def test_routing_reaches_every_leaf_an_edit_leads_to(spark):
    random.seed(11)
    words = sorted({"".join(random.choice("abcd") for _ in range(random.randrange(6, 9))) for _ in range(400)})
    points, offsets = spelling.letters(pa.array(words))
    made = spelling.vectors(points, offsets)
    trees = {}
    for size in (6, 7, 8):
        trees[size] = spelling.plant(made[np.diff(offsets) == size], 5, iter(range(10**6)))
    batch = pa.RecordBatch.from_arrays([pa.array(words), pa.array(range(len(words)))], ["word", "n"])
    routed = [r for b in spelling._route([batch], trees) for r in b.to_pylist()]
    home = {r["word"]: (r["length"], r["leaf"]) for r in routed if r["role"] == 0}
    asks = {(r["word"], r["length"], r["leaf"]) for r in routed}
    assert len(home) == len(words)
    for a in words:
        for b in words:
            if a != b and len(b) >= len(a) and near(a, b):
                assert (a, *home[b]) in asks


def test_counting_hands_on_what_it_holds(spark, monkeypatch):
    monkeypatch.setattr(spelling, "_HELD", 2)
    docs = spark.createDataFrame([(k, "tables chairs") for k in range(6)] + [(9, "chairs")], "doc_id long, text string")
    words = Scratch(spark, "t").save(spelling.vocabulary(docs), "words")
    assert {r.word: r.n for r in words.collect()} == {"tables": 6, "chairs": 7}
