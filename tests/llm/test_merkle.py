"""The Merkle manifest against loops; its query has SQL, which test_exact_dedup compares."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from daygrain.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels_of(nodes, arity):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + arity])) for i in range(0, len(last), arity)])
    return levels


def climb(levels, i, arity, node):
    """The siblings up to the top, and what `node` in place i leads to."""
    siblings = []
    for level in levels[:-1]:
        start = i - i % arity
        run = level[start : start + arity]
        siblings += run[: i - start] + run[i - start + 1 :]
        node = sha("".join(run[: i - start] + [node] + run[i - start + 1 :]))
        i //= arity
    return siblings, node


def by_loops(rows, arity, shown):
    key = lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))
    groups = {}
    for row in sorted(rows, key=key):
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda n: (n is not None, (n or "").encode()))
    trees = {n: levels_of([leaf_of(r) for r in groups[n]], arity) for n in names}
    whole = levels_of([trees[n][-1][0] for n in names], arity)
    out = []
    for place, n in enumerate(names):
        for i, row in enumerate(groups[n]):
            low, node = climb(trees[n], i, arity, leaf_of(shown(row)))
            high, node = climb(whole, place, arity, node)
            out.append((str(row[0]), leaf_of(row), trees[n][-1][0], whole[-1][0], sha("".join(low + high)), node,
                        node == whole[-1][0]))
    return sorted(out)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, __index int, tree string, place string"


def rows_for(sizes):
    random.seed(7)
    rows = []
    for source, n in sizes.items():
        for _ in range(n):
            doc_id = random.choice([None, random.randrange(10**6), random.randrange(40)])
            text = random.choice([None, "", "Abc É", "x" * random.randrange(50), "Long " * 30_000])
            rows.append((doc_id, source, random.choice([None, "en", "é"]), random.choice([None, 3]), text))
    return rows + rows[:3]


MIXED = {None: 5, "": 1, "b": 40, "B": 16, "é": 17, "z": 1}


@pytest.mark.parametrize("arity, sizes", [
    (2, MIXED), (16, MIXED), (16, {"only": 1}), (3, {"only": 33}), (16, {f"s{i}": 1 for i in range(18)}),
])
def test_trees_equal_loops(spark, arity, sizes):
    rows = rows_for(sizes)
    docs = spark.createDataFrame([(*r, 1, "t", "p") for r in rows], SCHEMA).repartition(5)
    lowered = F.when(F.col("doc_id") % 2 == 0, F.translate("text", "A", "a")).otherwise(F.col("text"))
    shown = lambda r: (*r[:4], r[4].replace("A", "a") if r[4] and r[0] is not None and r[0] % 2 == 0 else r[4])
    found = merkle.verified(merkle.manifest(docs, arity=arity, presented={"text": lowered}))
    got = sorted((str(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in found.collect())
    assert got == by_loops(rows, arity, shown)


def test_no_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert merkle.verified(merkle.manifest(docs)).collect() == []


def test_places_do_not_depend_on_the_layout(spark):
    rows = spark.range(1000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("tree"), (F.col("id") * 7 % 1000).alias("k")
    )
    from daygrain.llm.common import Scratch

    found = [
        sorted(map(tuple, merkle.numbered(rows.repartition(n), ["k"], Scratch(spark, "t"), "n").select("tree", "k", "index", "size").collect()))
        for n in (1, 7)
    ]
    assert found[0] == found[1]
    hot = [(k, i) for tree, k, i, _ in found[0] if tree == "hot"]
    assert [i for _, i in sorted(hot)] == list(range(len(hot)))
