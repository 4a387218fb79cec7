"""Queries under a name, each with the SQL that has to give the same rows where SQL can."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from daygrain.registry.star import Star
from daygrain.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Common table expressions the SQL texts share, in the order they build on each other.
_WITH: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Types two engines hand out alike: days and times as ISO text, amounts as doubles."""

    def column(name: str, kind) -> F.Column:
        col = F.col(f"`{name}`")
        if isinstance(kind, DateType):
            return col.cast("string").alias(name)
        if isinstance(kind, (TimestampType, TimestampNTZType)):
            return F.date_format(col, "yyyy-MM-dd HH:mm:ss").alias(name)
        if isinstance(kind, DecimalType):
            return col.cast("double").alias(name)
        return col

    return df.select(*[column(f.name, f.dataType) for f in df.schema])


def define(name: str, sql: str) -> None:
    _WITH[name] = sql.strip()


def complete(sql: str) -> str:
    """Put the shared expressions a text uses, directly or not, in front of it."""
    needed: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"\bs_\w+", todo.pop()))
        for name in words & _WITH.keys() - needed:
            needed.add(name)
            todo.append(_WITH[name])
    parts = [f"{n} AS (\n{text}\n)" for n, text in _WITH.items() if n in needed]
    sql = sql.strip()
    if not parts:
        return sql
    if sql.startswith("WITH "):
        return f"WITH {', '.join(parts)},\n{sql.removeprefix('WITH ')}"
    return f"WITH {', '.join(parts)}\n{sql}"


def query(name: str, sql: str | None = None):
    """Register `build(star) -> DataFrame` under `name`."""

    def add(build: Callable[[Star], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"two queries called {name}")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return portable(build(Star(configure(spark), folder)))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = complete(sql)
        return build

    return add


def pct(part: str, whole: str, digits: int, times: int = 100) -> str:
    """SQL for `times * part / whole` rounded half up on integers, NULL for a zero whole."""
    k = 2 * times * 10**digits
    return (
        f"((({k} * ({part})::BIGINT + ({whole})::BIGINT) // nullif(2 * ({whole})::BIGINT, 0))"
        f"::DOUBLE / {float(10**digits)})"
    )


def to_utc(col: str) -> str:
    return f"(({col}) AT TIME ZONE 'America/Sao_Paulo') AT TIME ZONE 'UTC'"


def local_day(col: str) -> str:
    return f"((({col}) AT TIME ZONE 'UTC') AT TIME ZONE 'America/Sao_Paulo')::DATE"


def when(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S')"
