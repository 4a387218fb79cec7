"""Every registered query against its SQL on the smallest tables."""

import inspect

import pytest

import __spark_entry__ as entry
import compare
from daygrain.registry import QUERIES as REFERENCE

FOLDER = f"{compare.DATA}/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
# The corpus operators have tests of their own.


@pytest.fixture(scope="module")
def tables():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(set(ORACLES) & set(REFERENCE)))
def test_query_gives_what_its_sql_gives(spark, tables, name):
    assert compare.compare(QUERIES[name](spark, FOLDER), tables, ORACLES[name]) == ""


def test_entry_reads_the_smoke_tables(spark):
    df = entry.entry(spark)
    assert "session_conversion_pct" in df.columns and df.count() > 0


def test_contract():
    assert set(ORACLES) <= set(QUERIES)
    for run in QUERIES.values():
        assert len(inspect.signature(run).parameters) == 2
