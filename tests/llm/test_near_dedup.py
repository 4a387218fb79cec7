"""Near-duplicate groups against all pairs, and the sketch against the true similarity."""

import re

import numpy as np
import pyarrow as pa

from daygrain.llm import near_dedup, textblocks
from daygrain.llm.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


def brute_force(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    label = {k: k for k in range(len(sets))}

    def find(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                label[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        r = find(k)
        least[r] = min(i, least.get(r, i))
    return sorted((i, len(s), least[find(k)], least[find(k)] == i) for k, (i, s) in enumerate(sets))


def test_query_gives_what_all_pairs_give(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op3_near_dedup"](spark, FOLDER).collect()
    assert sorted(map(tuple, got)) == brute_force([tuple(r) for r in docs])


def test_edge_cases(spark, monkeypatch):
    long = " ".join(f"w{k}" for k in range(30_000))
    base = [f"v{k}" for k in range(100)]
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE\ttwo"), (6, "one two three four five"),
        (7, long), (8, long + " end"), (9, " ".join(base)), (10, " ".join(base[:99] + ["x"])),
        (11, " ".join(base[:50] + ["y"] + base[51:])), (11, " ".join(base[:50] + ["y"] + base[51:])),
        (12, "É a é b c"), (13, "é a é b c"), (0, " ".join(base[5:])),
    ]
    rows += [(100 + k, " ".join(base[: 90 + k % 9])) for k in range(40)]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, node string, label string")
    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    got = sorted(map(tuple, near_dedup.near_groups(df).collect()))
    assert got == brute_force(rows)
    kept = near_dedup.survivors(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(g[0] for g in got if g[3])


def test_near_copies_without_an_id(spark):
    """A NULL id takes part: linked with an id, with another NULL id, and not with what is different."""
    words = [f"w{k}" for k in range(60)]
    other = [f"v{k}" for k in range(60)]
    rows = [(None, " ".join(words)), (5, " ".join(words[:-1])), (None, " ".join(other)), (None, " ".join(other[1:])), (None, " ".join(other)),
            (7, "something else altogether is said here"), (None, None)]
    docs = spark.createDataFrame([(*r, 1, 2, "r", 3) for r in rows], "doc_id long, text string, __keep int, keep int, row string, id int")
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in near_dedup.near_groups(docs).collect())
    assert got == [("5", 55, "5"), ("7", 2, "7"), ("None", 0, "None"), ("None", 55, "None"), ("None", 56, "5"), ("None", 56, "None"),
                   ("None", 56, "None")]
    kept = near_dedup.survivors(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {5, 7, None}
    links = near_dedup._links
    found = []
    near_dedup._links = lambda *a: found.append(links(*a)) or found[0]
    try:
        near_dedup.near_groups(docs).collect()
    finally:
        near_dedup._links = links
    assert found[0].count() == 2


def test_large_clusters_in_blocks(spark, monkeypatch):
    """Copies of one text, chains away from it and a second group in the same buckets, cut into small blocks."""
    rng = np.random.default_rng(11)
    base = [f"v{k}" for k in range(200)]
    rows = []
    for k in range(60):  # close to the head
        words = list(base)
        words[int(rng.integers(200))] = f"x{k}"
        rows.append((k, " ".join(words)))
    for k in range(40):  # a chain: each link holds, the ends are far apart
        rows.append((100 + k, " ".join(base[k * 4 :] + [f"c{j}" for j in range(k * 4)])))
    for k in range(60):  # near the limit on both sides
        words = list(base)
        for at in rng.choice(200, int(rng.integers(2, 7)), False):
            words[at] = f"y{k}"
        rows.append((200 + k, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute_force(rows)
    for block, elements in ((5, 1 << 21), (1000, 2000)):
        monkeypatch.setattr(near_dedup, "BLOCK", block)
        monkeypatch.setattr(near_dedup, "BLOCK_ELEMENTS", elements)
        assert sorted(map(tuple, near_dedup.near_groups(df).collect())) == expected


def test_known_components_are_not_compared_again(monkeypatch):
    monkeypatch.setattr(near_dedup, "_ENTRIES", 7)
    sets = [np.arange(k, k + 20, dtype=np.uint64) for k in (0, 1, 2, 100, 101, 500)]
    nodes = [bytes([k]) for k in range(6)]
    assert near_dedup.forest(nodes, [b"a"] * 6, sets) == []
    found = near_dedup.forest(nodes, nodes, sets)
    assert len(found) == 3 and frozenset((nodes[3], nodes[4])) in map(frozenset, found)
    found = near_dedup.forest(nodes, [b"a", b"a", b"b", b"c", b"d", b"d"], sets)
    assert len(found) == 2 and frozenset((nodes[3], nodes[4])) in map(frozenset, found)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert near_dedup.near_groups(df).collect() == []
    assert near_dedup.survivors(df).collect() == []


def test_sketch_agrees_with_the_similarity():
    rng = np.random.default_rng(5)
    for n in (3, 40, 900):
        pool = rng.integers(0, 2**63, 2 * n).astype(np.uint64)
        shares = []
        for _ in range(40):
            a, b = np.sort(rng.choice(pool, n, False)), np.sort(rng.choice(pool, n, False))
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            shares.append((near_dedup.sketch(a) == near_dedup.sketch(b)).mean() - true)
        assert abs(np.mean(shares)) < 0.02 and np.std(shares) < 0.05


def test_words_are_those_of_the_pattern():
    texts = ["a b\tc\x0bd\x0ce\rf\n", "", None, "  x", "y  ", "ä b  ", "z"]
    column = pa.array(texts)
    for part in (column, column.slice(1, 4)):
        for start, end, data, offsets in textblocks.blocks(part, 4):
            starts, ends, first = textblocks.word_bounds(data, offsets)
            for k in range(end - start):
                found = [bytes(data[starts[j] : ends[j]]).decode() for j in range(first[k], first[k + 1])]
                assert found == WORDS.findall(part[start + k].as_py() or "")
