"""Which arrival days the sessions of a day need: a narrow index beside the clean events.

Late events reach back to any earlier day, so a day's sessions need all their history. The index
says where that is. It keeps two 64-bit codes per event and arrival day, of the session and of the
event, 16 bytes where the row itself has hundreds. A run finds the events of the sessions its day
touched and every day that holds one of them or a copy of one; only those days are read.

An equal code of another event or session brings a few rows too many, never too few: a session that
shipped nothing on the day is not returned by `gold.build_sessions`, whatever of it was read.

A day's index counts once its marker is there. The marker goes before the day's events are replaced
and comes back when its index is written, so a crash leaves a day without index, which is then
read from the events themselves.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.sinks import files
from daygrain.sinks.partitions import overwrite_partitions
from daygrain.sources import schemas
from daygrain.sources.readers import read_days

INDEX = "event_index"
MARKERS = "days"
ROWS = "rows"
_DAY = "ingest_dt"
_SCHEMA = "session_code long, event_code long, ingest_dt string"


def entries(events: DataFrame) -> DataFrame:
    return events.select(
        F.xxhash64("session_id").alias("session_code"), F.xxhash64("event_id").alias("event_code"), _DAY
    )


def _marker(index: str, dt: str) -> str:
    return files.join(index, MARKERS, dt)


def forget_days(spark: SparkSession, index: str, days: Iterable[str]) -> None:
    """Call before the events of these days are replaced or removed."""
    for dt in days:
        files.delete_folder(spark, _marker(index, dt))


def index_days(spark: SparkSession, events: str, index: str, days: Iterable[str] | None = None) -> list[str]:
    """Index the given arrival days of the event table at `events`, or all; returns them."""
    there = event_days(spark, events)
    days = sorted(there if days is None else set(days) & set(there))
    if days:
        overwrite_partitions(entries(read_days(spark, events, days)), files.join(index, ROWS), _DAY)
        for dt in days:
            files.replace_text(spark, _marker(index, dt), "")
    return days


def event_days(spark: SparkSession, events: str) -> list[str]:
    """Arrival days that have a folder."""
    names = [n.split("=", 1)[1] for n in files.children(spark, events) if n.startswith(f"{_DAY}=")]
    return [n for n in names if not n.startswith("__")]  # rows without a day arrived on none


def _known(spark: SparkSession, events: str, index: str, days: list[str]) -> DataFrame:
    """The entries of these days, from the index where a day has one."""
    marked = set(files.children(spark, files.join(index, MARKERS)))
    stored, other = [d for d in days if d in marked], [d for d in days if d not in marked]
    parts = []
    if stored:
        base = files.join(index, ROWS)
        # A day without events has a marker and no folder.
        paths = [p for d in stored if files.exists(spark, p := files.join(base, f"{_DAY}={d}"))]
        if paths:
            parts.append(spark.read.schema(_SCHEMA).option("basePath", base).parquet(*paths))
    if other:
        parts.append(entries(read_days(spark, events, other)))
    return reduce(DataFrame.unionByName, parts)


def touched_events(spark: SparkSession, events: str, index: str, dt: str) -> DataFrame | None:
    """The events that decide the sessions `dt` touched; None if `dt` shipped none.

    These are all events up to `dt` of the sessions that have a row on `dt`, with all copies of
    those events, in whatever session a copy was filed. `gold.build_sessions` gives the same
    rows for them as for the whole history.
    """
    days = [d for d in event_days(spark, events) if d <= dt]
    if dt not in days:
        return None
    known = _known(spark, events, index, days)
    # The codes of the day go into joins as they are: both sides come straight from their
    # shuffles then, and Spark splits a session with very many events.
    today = known.where(F.col(_DAY) == dt).select("session_code")
    wanted = known.join(today, "session_code", "left_semi").select("event_code")
    # One row per calendar day at most.
    holding = known.join(wanted, "event_code", "left_semi").select(_DAY).distinct()
    needed = sorted(r[_DAY] for r in holding.collect())
    found = read_days(spark, events, needed).withColumn("event_code", F.xxhash64("event_id"))
    return found.join(wanted, "event_code", "left_semi").drop("event_code")


def touched_of_clean(spark: SparkSession, clean: str, dt: str) -> DataFrame | None:
    return touched_events(spark, files.join(clean, schemas.EVENTS), files.join(clean, INDEX), dt)
