"""Exact dedup against its SQL and on odd rows."""

import pytest

import compare
from daygrain.llm import exact_dedup
from daygrain.llm.registry import ORACLES, QUERIES

FOLDER = f"{compare.DATA}/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_gives_what_its_sql_gives(spark, name):
    assert compare.compare(QUERIES[name](spark, FOLDER), compare.connect(FOLDER), ORACLES[name]) == ""


ROWS = [
    (5, "a b"), (3, "ab"), (4, " a b"), (9, None), (8, ""), (7, " \t"), (None, "x"), (6, "x"), (2, "x" * 100_000),
    (1, "q"), (1, "q"), (11, "A b"), (12, "a\u00a0b"), (13, "ab"), (13, "ab"),
]


@pytest.mark.parametrize("frequent", [1, 512])
def test_odd_rows(spark, monkeypatch, frequent):
    monkeypatch.setattr(exact_dedup, "FREQUENT", frequent)
    names = "doc_id long, text string, kept int, __x string, __digest string, __place int, __best int, row int"
    docs = spark.createDataFrame([(i, t, 1, "c", "d", 2, 3, 4) for i, t in ROWS], names)
    got = exact_dedup.assignments(docs).collect()
    assert len(got) == len(ROWS)
    by_id = {r.doc_id: r for r in got}
    assert {by_id[i].keep_id for i in (3, 4, 5, 13)} == {4} and by_id[5].group_size == 5
    assert {by_id[i].keep_id for i in (7, 8, 9)} == {7} and by_id[None].keep_id == 6
    assert sum(r.kept for r in got if r.doc_id == 1) == 1
    assert sum(r.kept for r in got) == 7
    kept = exact_dedup.survivors(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 6, 7, 11, 12]
    assert exact_dedup.assignments(docs.limit(0)).collect() == [] == exact_dedup.survivors(docs.limit(0)).collect()
