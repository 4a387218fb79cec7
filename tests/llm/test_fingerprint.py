"""Digests against a loop over the documents in order."""

import hashlib

import numpy as np

from daygrain.llm import fingerprint
from daygrain.llm.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


def digest(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return fingerprint.codes(data, np.array([0, len(data)]))


def expected(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    out = []
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        swap = len(text) // 4
        changed = text[: len(text) - swap] + following[:swap]
        a, b, c = digest(text), digest(changed), digest(following)
        out.append((
            i, len(text), hashlib.sha256(changed.encode()).hexdigest(), fingerprint.as_text(a[0]), fingerprint.as_text(b[0]),
            float(fingerprint.likeness(a, b)[0]), float(fingerprint.likeness(a, c)[0]),
        ))
    return sorted(out, key=str)


def test_query_gives_what_a_loop_gives(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op6_fingerprint"](spark, FOLDER).collect()
    assert sorted(map(tuple, got), key=str) == expected([tuple(r) for r in docs])


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "_RUN_BYTES", 50)
    rows = [(3, "äöü" * 7 + "\U0001f600"), (1, None), (2, ""), (4, "x"), (5, "long " * 50_000), (5, "again"), (5, "again"), (None, "no id"), (9, "ends here")]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, end int")
    assert sorted(map(tuple, fingerprint.fingerprints(docs).collect()), key=str) == expected(rows)
    one = docs.where("doc_id = 9")
    assert sorted(map(tuple, fingerprint.fingerprints(one).collect()), key=str) == expected([(9, "ends here")])
    assert fingerprint.fingerprints(docs.limit(0)).collect() == []


def test_counts_and_round_trip():
    text = "abcabcabcxyz" * 5
    code = digest(text)[0]
    assert (fingerprint.from_text(fingerprint.as_text(code)) == code).all()
    data = text.encode()
    counts = np.zeros(fingerprint.BUCKETS, int)
    for reach in (1, 2):
        for k in range(len(data) - 2 * reach):
            key = data[k] << 16 | data[k + reach] << 8 | data[k + 2 * reach] | reach << 24
            counts[int(fingerprint.mix64(np.array([key], np.uint64))[0]) >> 57] += 1
    q = np.sort(counts)[[31, 63, 95]]
    assert (code[3:] == (counts[:, None] > q).sum(axis=1)).all()


def test_likeness_is_bounded_and_symmetric():
    a, b = digest("some text of a kind " * 9), digest("quite another one, 123 " * 9)
    assert fingerprint.likeness(a, a)[0] == 1 and fingerprint.likeness(a, b)[0] == fingerprint.likeness(b, a)[0]
    assert 0 <= fingerprint.likeness(a, b)[0] < 0.5
